from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shopspan.functions import dates, measures as m


def test_units_and_offers(spark):
    rows = [  # quantity, weight, offer -> units, on offer
        (3.0, 0.0, 7, 3.0, 3.0),
        (0.0, 0.0, 7, 0.0, 0.0),
        (3.0, 1.5, None, 1.5, 0.0),
        (3.0, None, 0, 3.0, 0.0),
        (0.0, None, 5, None, None),
    ]
    df = spark.createDataFrame(rows, "quantity double, weight double, offer_id int, want double, want_offer double")
    df = df.withColumn("uom", m.unit_of_measure(F.col("weight"))).withColumn("units", m.units_sold())
    for r in df.withColumn("offered", m.offer_only(F.col("units"))).collect():
        assert (r.units, r.offered) == (r.want, r.want_offer)


def test_non_merch_compares_strings(spark):
    rows = [
        ("8044", "x", True), ("8104", "x", True), ("8105", "x", False), ("80441", "x", True),
        ("8040", "x", True), ("7435", "x", True), ("7000", "x", True), ("6633", "x", False),
        ("6639", "x", True), ("1", "a C/C RECORD b", True), (None, "C/C RECORD", True),
    ]
    df = spark.createDataFrame(rows, "mdm_sub_cat_id string, variant_name string, want boolean")
    assert df.where(m.is_non_merch() != F.col("want")).count() == 0


def test_ratio_and_clip(spark):
    rows = [(0.0, 5.0, 0.0), (-1.0, 5.0, 0.0), (4.0, 5.0, 1.0), (4.0, -1.0, 0.0), (4.0, 1.0, 0.25)]
    df = spark.createDataFrame(rows, "u double, o double, want double")
    got = df.select(m.unit_offer_ratio(F.col("u"), F.col("o")).alias("r"), "want").collect()
    assert all(r.r == r.want for r in got)
    df = spark.createDataFrame([(-2.0,), (3.0,), (None,)], "x double")
    assert [r[0] for r in df.select(m.clip_at_zero(F.col("x"))).collect()] == [0.0, 3.0, None]


def test_dates(spark):
    assert dates.normalize_end_date("2020-02-03") == date(2020, 2, 3)
    assert dates.normalize_end_date("2020-02-03 11:00:00") == date(2020, 2, 3)
    assert dates.normalize_end_date(datetime(2020, 2, 3, 5)) == date(2020, 2, 3)
    assert dates.normalize_end_date(None) == date.today()
    with pytest.raises(ValueError):
        dates.reject_future("2999-01-01")
    df = spark.createDataFrame(
        [(date(2020, 1, 20), date(2020, 1, 7))], "a date, b date"
    ).select(
        dates.weeks_between("a", "b").alias("w"), dates.weeks_between("b", "a").alias("v"),
        dates.add_offset_colon(F.lit("2022-08-11T06:29:44-0700")).alias("s"),
        dates.offset_timestamp(F.lit("2022-08-11 06:29:44").cast("timestamp")).alias("o"),
    )
    r = df.first()
    assert (r.w, r.v, r.s) == (1, -1, "2022-08-11T06:29:44-07:00")
    assert r.o in ("2022-08-11T06:29:44Z", "2022-08-11T06:29:44+00:00")
