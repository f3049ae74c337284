from datetime import date

from shopspan.operators import stable_batches as sb
from shopspan.sources.staging import new_staging_path


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "hhn bigint")


def found(spark, path):
    return {r.hhn: r.unique_hhn_num for r in sb.numbers(path, spark).collect()}


def test_old_numbers_stay_and_only_new_rows_are_written(spark):
    path = new_staging_path(spark, "numbers")
    assert sb.extend(path, ids(spark, [50, 10, 10, None, 30]), date(2001, 1, 6)) == 3
    assert found(spark, path) == {10: 0, 30: 1, 50: 2}
    files = set(sb.numbers(path, spark).inputFiles())
    assert sb.extend(path, ids(spark, [5, 10, 40, 50]), date(2001, 1, 13)) == 2
    assert found(spark, path) == {10: 0, 30: 1, 50: 2, 5: 3, 40: 4}
    later = sb.numbers(path, spark)
    assert files < set(later.inputFiles())
    assert {r.hhn for r in later.where("added = date '2001-01-13'").collect()} == {5, 40}
    got = {r.hhn: r.hhn_batch_num for r in sb.batches(path, spark, 2).collect()}
    assert got == {10: 0, 30: 0, 50: 1, 5: 1, 40: 2}


def test_repeated_and_broken_runs(spark):
    path = new_staging_path(spark, "numbers")
    day = date(2001, 1, 6)
    sb.extend(path, ids(spark, range(100)), day)
    assert sb.extend(path, ids(spark, range(100)), day) == 0
    # A part of the next run was stored, with numbers of its own.
    sb.extend(path, ids(spark, [500, 300]), date(2001, 1, 13))
    assert sb.extend(path, ids(spark, [*range(100), 300, 400, 500, -1]), date(2001, 1, 13)) == 2
    numbers = found(spark, path)
    assert len(set(numbers.values())) == len(numbers) == 104 and numbers[7] == 7 and numbers[-1] == 102


def test_no_ids(spark):
    path = new_staging_path(spark, "numbers")
    assert sb.extend(path, ids(spark, []), date(2001, 1, 6)) == 0
    assert sb.extend(path, ids(spark, [None]), date(2001, 1, 6)) == 0
    assert sb.extend(path, ids(spark, [4]), date(2001, 1, 13)) == 1 and found(spark, path) == {4: 0}
