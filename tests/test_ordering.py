import random

from pyspark.sql import functions as F

from shopspan.operators.ordering import ordered_positions, running_sums


def _rows(n=4000):
    rng = random.Random(5)
    ids = rng.sample(range(10 * n), n)
    # One group holds most rows, one a single row.
    return [("hot" if i % 5 else "cold", x, rng.randint(0, 9)) for i, x in enumerate(ids)] + [("one", 1, 4)]


def test_positions_and_sums_match_brute_force(spark):
    rows = _rows()
    # Without coalescing the hot group is certain to cross slice borders.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "g string, x bigint, v bigint").repartition(7)
        ranked = ordered_positions(df, ["g"], [F.desc("x")]).collect()
        overall = ordered_positions(df.select("x").where("g <> 'one'"), [], [F.asc("x")]).collect()
        summed = running_sums(df, ["g"], [F.asc("x")], ["v"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups = {}
    for g, x, v in rows:
        groups.setdefault(g, []).append((x, v))
    want, cum = {}, {}
    for g, members in groups.items():
        total = 0
        for i, (x, v) in enumerate(sorted(members)):
            total += v
            want[g, x], cum[g, x] = len(members) - 1 - i, total
    assert {(r.g, r.x): r.position for r in ranked} == want
    assert {(r.g, r.x): r.cum_v for r in summed} == cum
    places = sorted(x for g, x, _ in rows if g != "one")
    assert {r.x: r.position for r in overall} == {x: i for i, x in enumerate(places)}
