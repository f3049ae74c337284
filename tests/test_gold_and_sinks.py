import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shopspan.config import RetentionParams
from shopspan.operators import features, gold, predictions, quality
from shopspan.operators.merging import upsert
from shopspan.sources import sinks
from shopspan.sources.snapshots import LONG_HISTORY, SHORT_HISTORY, VersionedTable
from shopspan.sources.tables import calendar_between

WEEK = date(2021, 1, 31)


def test_segments_use_rounded_probability(spark):
    rows = [(0.99995, "Churned"), (0.99994, "At Risk"), (0.75, "At Risk"), (0.5, "High"), (0.25, "Med"), (0.2499, "Low")]
    df = spark.createDataFrame(rows, "p double, want string")
    assert df.where(gold.churn_segment(F.round("p", 4)) != F.col("want")).count() == 0


def test_churn_output(spark):
    rows = [(1, WEEK, 10.0, 2), (1, WEEK - timedelta(weeks=4), 5.0, 1), (2, WEEK - timedelta(weeks=20), 1.0, 1)]
    hw = spark.createDataFrame(rows, "hhn bigint, week_ending_date date, sales_dollars double, n_transaction bigint")
    kpis = predictions.household_kpis(hw, WEEK, 156)
    assert kpis.where("hhn = 1").first().historical_sales == 15.0
    scored = spark.createDataFrame([(1, 4.0, 1.0), (2, 4.0, 1.0), (9, 4.0, 1.0)], "hhn bigint, alpha double, beta double")
    got = {r.hhn: r for r in predictions.churn_output(scored, kpis, 13, "m", WEEK).collect()}
    assert set(got) == {1, 2}
    assert (got[1].weeks_until_churned, got[1].weeks_since_first_shop) == (13, 4)
    assert math.isclose(got[1].churn_probability, math.exp(-13 / 4))
    assert (got[2].weeks_until_churned, got[2].churn_probability) == (0, 1.0)


def test_latest_predictions_keep_ties(spark):
    t1, t2 = datetime(2021, 1, 1), datetime(2021, 1, 2)
    rows = [(1, WEEK, WEEK, t1, 1), (1, WEEK, WEEK, t2, 2), (1, WEEK, WEEK, t2, 3), (2, WEEK, WEEK, t1, 4)]
    df = spark.createDataFrame(rows, "hhn bigint, max_week_ending_date date, prediction_date date, table_update_dt timestamp, n int")
    assert sorted(r.n for r in predictions.latest_predictions(df).collect()) == [2, 3, 4]


def test_annualized_sales(spark):
    days = calendar_between(spark, date(2018, 1, 1), date(2021, 2, 3))
    start = gold.lookback_start(WEEK, 2)
    rows = [
        (1, 1, 100.0, WEEK), (1, 1, 300.0, WEEK - timedelta(weeks=13)), (1, 2, 999.0, WEEK),
        (2, 1, 50.0, WEEK), (3, 1, 70.0, WEEK), (4, 1, 80.0, WEEK), (5, 2, 80.0, WEEK),
        (1, 1, 5000.0, start - timedelta(days=1)), (6, 1, 10.0, WEEK), (6, 1, 20.0, start - timedelta(days=30)),
    ]
    sales = spark.createDataFrame(rows, "customer_hk bigint, item_hk bigint, merch_sales double, fiscal_date date")
    customers = spark.createDataFrame(
        [(1, 10, "A"), (2, 10, "Training"), (3, 30, None), (4, 0, "A"), (5, 50, "A"), (6, 60, "A")],
        "customer_hk bigint, current_household_id bigint, current_card_type string",
    )
    items = spark.createDataFrame([(1, "Y"), (2, "N")], "item_hk bigint, financial_sale_flag string")
    tenure = {r.hhn: r for r in gold.base_tenure(sales, customers, days, WEEK).collect()}
    assert tenure[10].n_periods_tenure == 2 and tenure[10].first_event_trunc == WEEK - timedelta(weeks=14)
    got = {r.hhn: r.annualized_sales for r in gold.annualized_sales(sales, customers, items, days, WEEK, ["Training"]).collect()}
    assert got == {10: 800.0, 30: 280.0, 60: 40.0}


def test_upsert_semantics(spark):
    schema = "hhn bigint, a double, note string"
    old = spark.createDataFrame([(1, 1.0, "old"), (2, 2.0, "old"), (3, None, "old"), (4, 4.0, "old")], schema)
    new = spark.createDataFrame([(1, 9.0, "new"), (2, 2.0, "new"), (3, 3.0, "new"), (5, 5.0, "new")], schema)
    merged = upsert(old, new, ["hhn"], ["a"], ["a"])
    want = {(1, 9.0, "old"), (2, 2.0, "old"), (3, None, "old"), (4, 4.0, "old"), (5, 5.0, "new")}
    assert {tuple(r) for r in merged.collect()} == want
    assert {tuple(r) for r in upsert(merged, new, ["hhn"], ["a"], ["a"]).collect()} == want


def test_merge_touches_only_named_partitions(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "hhn bigint, annualized_sales double, churn_max_week_ending_date date"
    before = WEEK - timedelta(days=7)
    first = spark.createDataFrame([(1, 1.0, WEEK), (1, 7.0, before)], schema)
    second = spark.createDataFrame([(1, 2.0, WEEK), (2, 3.0, WEEK)], schema)
    for source in (first, second, second):
        sinks.merge_into(path, source, "churn_max_week_ending_date", **gold.ANNUALIZED_MERGE)
    got = {tuple(r) for r in spark.read.parquet(path).select("hhn", "annualized_sales", "churn_max_week_ending_date").collect()}
    assert got == {(1, 2.0, WEEK), (2, 3.0, WEEK), (1, 7.0, before)}
    with pytest.raises(ValueError, match="repeats a key"):
        sinks.merge_into(path, second.union(second), "churn_max_week_ending_date", **gold.ANNUALIZED_MERGE)
    # A source that names both weeks but changes one leaves the other week's files alone.
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("part-*")}
    old = files()
    third = spark.createDataFrame([(1, 2.5, WEEK), (1, 7.0, before)], schema)
    sinks.merge_into(path, third, "churn_max_week_ending_date", **gold.ANNUALIZED_MERGE)
    assert {f for f, t in files().items() if old.get(f) == t} == {f for f in old if f"={before}" in str(f)}
    nameless = spark.createDataFrame([(3, 1.0, None)], schema)
    with pytest.raises(ValueError, match="without"):
        sinks.merge_into(path, nameless, "churn_max_week_ending_date", **gold.ANNUALIZED_MERGE)


def test_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "v"))
    at = [datetime(2021, 1, 1), datetime(2021, 2, 1), datetime(2021, 6, 1)]
    assert [table.write(spark.range(i + 1), at=when) for i, when in enumerate(at)] == [0, 1, 2]
    assert table.read_as_of().count() == 3 and table.read_as_of(version=0).count() == 1
    assert table.read_as_of(timestamp=datetime(2021, 3, 1)).count() == 2
    with pytest.raises(ValueError):
        table.read_as_of(timestamp=datetime(2020, 1, 1))
    assert table.last_operation(datetime(2021, 6, 11)).first().days_since == 10
    table.expire(LONG_HISTORY, datetime(2021, 6, 2))
    assert table.history().count() == 3
    table.expire(SHORT_HISTORY, datetime(2022, 6, 2))
    assert [r.version for r in table.history().collect()] == [2]
    assert [p.name for p in (tmp_path / "v" / "data").iterdir()] == ["v=2"]
    assert table.write(spark.range(9), at=datetime(2022, 6, 3)) == 3 and table.read_as_of().count() == 9


def _observed(results):
    return {r.rule: r.passed for r in results.collect()}


def test_quality_rules(spark):
    p = RetentionParams(min_rows_per_week=2, min_sales_per_week=10, min_units_per_week=1)
    schema = ("hhn bigint, week_number int, year_number int, sales_dollars double, units_sales double, "
              "avg_n_transaction double, avg_n_ecomm_trans double, unit_offer_ratio double, region string, zero int")
    rows = [(1, 1, 2020, 6.0, 1.0, 1.0, 0.5, 0.5, "a", 0), (2, 1, 2020, 6.0, 1.0, 0.5, 0.0, 1.5, None, 0),
            (3, 2, 2020, 3.0, 2.0, 1.0, 0.5, 0.5, "a", 0)]
    df = spark.createDataFrame(rows, schema)
    got = _observed(quality.check_household_weeks(df, p))
    failed = {rule for rule, passed in got.items() if not passed}
    assert failed == {
        "rows_per_week", "sales_per_week", "no_nulls:region", "not_all_zero:zero",
        "avg_n_transaction_at_least_1", "avg_n_ecomm_trans_not_0", "unit_offer_ratio_in_0_1",
    }
    with pytest.raises(quality.QualityError, match="no_nulls:region"):
        quality.require(quality.check_household_weeks(df, p), "t")
    empty = _observed(quality.row_checks(df.where("false"), []))
    assert not empty["not_all_zero:hhn"] and empty["no_nulls:hhn"]
    assert quality.require_single_value(df, "year_number") == 2020
    with pytest.raises(quality.QualityError):
        quality.require_single_value(df, "hhn")
    assert not _observed(quality.schema_check(df, ["hhn"]))["exact_columns"]


def test_low_weeks_and_holiday(spark):
    days = calendar_between(spark, date(2020, 1, 1), date(2021, 2, 3))
    xmas, other = date(2020, 12, 27), date(2020, 12, 20)
    df = spark.createDataFrame([(xmas,), (other,)], "max_week_ending_date date")
    assert [r[0] for r in quality.low_weeks_except_holiday(df, days, 2).collect()] == [other]
    assert quality.low_weeks_except_holiday(df, days, 1).count() == 0


def test_regions(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], f"{features.REGION} string")
    lookup = features.region_lookup(rows.where(f"{features.REGION} <> 'c'"))
    got = {r[features.REGION]: r.div_reg_index for r in features.with_region_index(rows, lookup, "b").collect()}
    assert got == {"a": 1, "b": 2, "c": 2}
    assert [r[0] for r in features.unseen_regions(rows, lookup).collect()] == ["c"]
    with pytest.raises(ValueError):
        features.default_index(lookup, "zz")


def test_lines_are_summed_before_the_customer_join(spark):
    """No exchange on the customer key carries single lines."""
    sales = spark.createDataFrame([(0, 1, 1.0, WEEK)], "customer_hk bigint, item_hk bigint, merch_sales double, fiscal_date date")
    customers = spark.createDataFrame([(1, 1, "a")], "customer_hk bigint, current_household_id bigint, current_card_type string")
    items = spark.createDataFrame([(1, "Y")], "item_hk bigint, financial_sale_flag string")
    days = spark.createDataFrame([(WEEK, WEEK)], "date date, week_end_date date")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (gold.base_tenure(sales, customers, days, WEEK), gold.annualized_sales(sales, customers, items, days, WEEK)):
            lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
            for k, line in enumerate(lines):
                if "Exchange hashpartitioning(customer_hk" in line and "fiscal_date" not in line.split("]")[0]:
                    assert any(x in lines[k + 1] + lines[k + 2] for x in ("HashAggregate", "Scan", "Project", "Filter"))
                    below = "".join(lines[k + 1:k + 3])
                    assert "HashAggregate" in below or "current_household_id" in "".join(lines[k + 1:k + 6])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_staging_needs_a_shared_folder_and_cleans_up(spark, tmp_path):
    from types import SimpleNamespace

    from shopspan.sources import staging

    for master, fine in (("local", True), ("local[4]", True), ("local-cluster[2,1,1024]", False), ("spark://h:7077", False)):
        fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master))
        if fine:
            assert staging.staging_folder(fake).startswith("/tmp/")
        else:
            with pytest.raises(RuntimeError, match="checkpoint"):
                staging.staging_folder(fake)
    with staging.staging_scope(spark):
        rows = staging.staged(spark.range(3), "x")
        path = rows.inputFiles()[0]
        assert rows.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_a_table_without_partitions_is_written_where_its_rows_are(spark, tmp_path):
    rows = spark.range(0, 40, 1, 5)
    sinks.overwrite(rows, str(tmp_path / "plain"))
    assert len(list((tmp_path / "plain").glob("part-*"))) == 5
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "plain")).collect()) == list(range(40))
