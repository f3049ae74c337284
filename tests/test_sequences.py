from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shopspan.operators import sequences as seq
from shopspan.operators.calendar import WeekSpan

# The events here and the expected rows below.
EVENTS = [0, 1, 0, 0, 1, 0, 0]


def _column(df, name, order="t"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


@pytest.fixture(scope="module")
def one(spark):
    return spark.createDataFrame([(1, t, t, e) for t, e in enumerate(EVENTS)], "hhn bigint, t int, k int, event int")


def test_time_to_event(one):
    discrete = seq.with_targets(one)
    assert _column(discrete, "tte") == [1, 0, 2, 1, 0, 2, 1]
    assert _column(discrete, "u") == [1, 1, 1, 1, 1, 0, 0]
    continuous = seq.with_targets(one, discrete=False)
    assert _column(continuous, "tte") == [1, 3, 2, 1, 2, 1, 0]
    assert _column(continuous, "u") == [1, 1, 1, 1, 0, 0, 0]
    assert seq.sequence_lengths(one).first().seq_length == 7


def test_densify_and_cuts(spark):
    first = date(2021, 1, 3)
    week = [first + timedelta(weeks=i) for i in range(6)]
    rows = [(1, week[2], 2.0, 5.0), (1, week[4], 3.0, None), (2, week[0], 1.0, 7.0), (3, week[5], 1.0, 1.0),
            (3, week[5], 3.0, 5.0)]
    df = spark.createDataFrame(rows, "hhn bigint, week_ending_date date, n_transaction double, div_reg_index double")
    columns = ["n_transaction", "div_reg_index"]
    axis = seq.read_axis(df)
    assert axis == WeekSpan(week[0], week[5]) and seq.axis_length(axis) == 6
    dense = seq.densify(df, axis, columns).cache()
    got = [tuple(r) for r in dense.where("hhn = 1").orderBy("t").select("k", "t", *columns).collect()]
    assert got == [(2, 0, 2.0, 5.0), (3, 1, 0.0, 0.0), (4, 2, 3.0, 0.0), (5, 3, 0.0, 0.0)]
    assert dense.where("hhn = 3").select(*columns).first() == (2.0, 3.0)
    cut = seq.drop_last_steps(dense, 6, 2)
    assert {(r.hhn, r.k) for r in cut.collect()} == {(1, 2), (1, 3), (2, 0), (2, 1), (2, 2), (2, 3)}

    train = seq.train_sequences(dense, 6, 1)
    # Household 1 keeps k = 2..4 with events 1 0 1; features move one step ahead.
    got = [tuple(r) for r in train.where("hhn = 1").orderBy("t").select("t", "k", "n_transaction", "tte", "u").collect()]
    assert got == [(1, 3, 2.0, 1, 1), (2, 4, 0.0, 0, 1)]
    # Household 2 never buys again: censored at the cut, not at the axis end.
    assert _column(train.where("hhn = 2"), "tte") == [4, 3, 2, 1]
    valid = seq.valid_sequences(dense, 6, 2, 1)
    assert _column(valid.where("hhn = 2"), "tte") == [5, 4, 3, 2]
    assert _column(valid.where("hhn = 2"), "weight") == [0, 0, 0, 1]
    assert valid.where("hhn = 3").count() == 0


def test_steps_to_cut():
    assert seq.steps_to_cut(100, None, 0.11) == 11
    assert seq.steps_to_cut(100, 11, 0.11) == 11 and seq.steps_to_cut(50, 4) == 4
    with pytest.raises(ValueError):
        seq.steps_to_cut(100, 4, 0.11)


TTE = [
    [None, None, None, 3, 2, 1, 0, 5, 4, 3, 2, 1],
    [11, 10, 9, 8, 7, 6, 5, 4, 3, 2, 1, 0],
    [3, 2, 1, 0, 3, 2, 1, 0, 3, 2, 1, 0],
]


@pytest.mark.parametrize(
    "cutoff, since, valid",
    [
        (4, [4, 4, 1], [False, False, True]),
        (5, [5, 5, 2], [False, False, True]),
        (6, [0, 6, 3], [True, False, True]),
        (7, [1, 7, 0], [True, False, True]),
        (8, [2, 8, 1], [True, False, True]),
        (10, [4, 10, 3], [True, False, True]),
        (11, [5, 0, 0], [True, True, True]),
    ],
)
def test_time_since_last_event(spark, cutoff, since, valid):
    rows = [(h, k, v) for h, row in enumerate(TTE) for k, v in enumerate(row) if v is not None]
    df = spark.createDataFrame(rows, "hhn bigint, k int, tte int")
    got = seq.time_since_last_event(df, cutoff).orderBy("hhn").collect()
    assert [r.time_since for r in got] == since and [r.is_valid for r in got] == valid


def test_alignment_both_ways(spark):
    rows = [(1, 1), (1, 2), (1, 3), (2, 1)]
    df = spark.createDataFrame(rows, "hhn bigint, t int")
    left = seq.left_padded(df, 5)
    assert {tuple(r) for r in left.select("hhn", "k").collect()} == {(1, 3), (1, 4), (1, 5), (2, 5)}
    assert {tuple(r) for r in seq.right_padded(left).select("hhn", "t").collect()} == set(rows)


def test_unmask(spark):
    targets = [
        ([3, 2, 1, 0, 2, 1, 1.2, 1.2, 1.2], [1, 1, 1, 1, 0, 0, 0.5, 0.5, 0.5]),
        ([3, 2, 1, 0, 2, 1, 0, 1, 0], [1] * 9),
        ([3, 2, 1, 0, 2, 1, 0, 2, 1], [1, 1, 1, 1, 1, 1, 1, 0, 0]),
    ]
    rows = [
        (h, t, float(tte[t]), float(u[t]), float(t), 10.0 + t)
        for h, (tte, u) in enumerate(targets) for t in range(9)
    ]
    df = spark.createDataFrame(rows, "hhn bigint, t int, tte double, u double, alpha double, beta double")
    got = {(r.hhn, r.t): tuple(r)[2:] for r in seq.unmask(df, ["tte", "u", "alpha", "beta"]).collect()}
    for h, t, *values in rows:
        masked = h == 0 and t >= 6
        assert got[h, t] == ((None,) * 4 if masked else tuple(values))


def test_pack_and_unpack(spark):
    rows = [(1, 1, 5.0, 2.0), (1, 2, 6.0, 1.0), (2, 1, 7.0, 0.0)]
    df = spark.createDataFrame(rows, "hhn bigint, t int, x double, tte double")
    packed = seq.pack_sequences(df, 3, ["x", "tte"], [-1.0, 0.5])
    assert {r.hhn: r.flattened_inputs for r in packed.collect()} == {
        1: [5.0, 2.0, 6.0, 1.0, -1.0, 0.5], 2: [7.0, 0.0, -1.0, 0.5, -1.0, 0.5]}
    back = seq.unpack_sequences(packed, ["x", "tte"])
    assert {tuple(r) for r in back.where("x <> -1").collect()} == set(rows) and back.count() == 6


def test_dense_rows_are_dealt_by_their_number(spark, monkeypatch):
    # 40 households with one purchase each, at the axis start: 40 rows become 40 * 100.
    first = date(2021, 1, 3)
    df = spark.createDataFrame([(h, first, 1.0) for h in range(40)], "hhn bigint, week_ending_date date, n_transaction double")
    axis = WeekSpan(first, first + timedelta(weeks=99))
    assert seq.dense_tasks(df, axis) == 1 and seq.dense_tasks(df.limit(0), axis) == 1
    assert seq.dense_tasks(df, axis, rows_per_task=500) == 8
    monkeypatch.setattr(seq.dense_tasks, "__defaults__", (7, 500))
    dense = seq.densify(df, axis, ["n_transaction"])
    parts = [r[0] for r in dense.groupBy(F.spark_partition_id()).count().collect()]
    assert dense.count() == 4000 and dense.rdd.getNumPartitions() == 8 and len(parts) > 4
