import random

from pyspark.sql import functions as F

from shopspan.llm.membership import may_be_in


def test_no_key_is_missed_and_few_others_pass(spark):
    rng = random.Random(2)
    keys = [rng.randint(-2**63, 2**63 - 1) for _ in range(3000)]
    others = [rng.randint(-2**63, 2**63 - 1) for _ in range(3000)]
    table = lambda values: spark.createDataFrame([(v,) for v in values], "h long")
    holds = may_be_in(table(keys + [0, -1, keys[0]]))
    assert table(keys + [0, -1]).where(holds(F.col("h"))).count() == len(keys) + 2
    assert table(others).where(holds(F.col("h"))).count() < 30


def test_no_keys(spark):
    none = spark.createDataFrame([], "h long")
    assert spark.range(50).where(may_be_in(none)(F.xxhash64("id"))).count() == 0
