import zlib
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shopspan.operators import sampling


@pytest.fixture(scope="module")
def households(spark):
    return spark.range(1, 3001).withColumnRenamed("id", "hhn")


def _ids(df):
    return {r.hhn for r in df.select("hhn").collect()}


def test_split_follows_crc32(households):
    got = _ids(sampling.hash_split(households, 0.3, 0.2))
    want = {i for i in range(1, 3001) if 0.2 * 2**32 < zlib.crc32(str(i).encode()) <= 0.5 * 2**32}
    assert got == want
    train, test = sampling.hash_split(households, 0.7), sampling.hash_split(households, 0.3, 0.7)
    assert not _ids(train) & _ids(test) and len(_ids(train) | _ids(test)) == 3000
    assert sampling.hash_split(households, None) is households


def test_history_window_edges(spark):
    end = date(2021, 3, 7)
    days = [(end - timedelta(days=d),) for d in (0, 7, 14, 21)]
    df = spark.createDataFrame(days, "week_ending_date date")
    kept = {r[0] for r in sampling.history_window(df, end, 2).collect()}
    assert kept == {end - timedelta(days=7), end - timedelta(days=14)}


def test_undersample_cuts_big_bins_exactly(spark):
    # 900 households with 1 week, 61 with 5, 40 with 9.
    sizes = [(i, 1) for i in range(900)] + [(1000 + i, 5) for i in range(61)] + [(2000 + i, 9) for i in range(40)]
    rows = spark.createDataFrame(sizes, "hhn bigint, n int").select(
        "hhn", F.explode(F.sequence(F.lit(1), "n")).alias("week")
    )
    # Sizes 40, 61, 900: the 0.6 quantile is 61 + 0.2 * 839 = 228.8.
    assert sampling.bin_cutoff(sampling.size_bins(rows), 0.6).first().cutoff == 228
    kept = sampling.undersample(rows, 0.6)
    assert {r.size_bin: r.hh_count for r in sampling.size_bins(kept).collect()} == {0: 228, 1: 61, 2: 40}
    draws = sorted(range(900), key=lambda i: (zlib.crc32(f"123:{i}".encode()), i))[:228]
    assert {i for i in _ids(kept) if i < 900} == set(draws)
    assert kept.where("hhn >= 1000").count() == 61 * 5 + 40 * 9


def test_folds_cover_everyone(households):
    sizes = {r.fold: r.n for r in sampling.assign_folds(households, 5, 101).groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert sum(sizes.values()) == 3000 and len(sizes) == 5 and min(sizes.values()) > 500
