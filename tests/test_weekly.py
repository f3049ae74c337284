import re
from datetime import date
from decimal import Decimal

import pytest

from shopspan.operators import calendar as cal
from shopspan.operators import weekly
from shopspan.plans import queries
from shopspan.sources.tables import SalesTables, calendar_between, line_tasks

SALE = (
    "customer_id bigint, transaction_number bigint, fiscal_date date, store_number bigint, item_id bigint, "
    "offer_id int, merch_sales decimal(18,4), product_cost decimal(18,4), unit_count double, weight double, "
    "points_issued bigint, points_redeemed bigint, ecomm_trans_id bigint"
)


def sale(cx, txn, day, store, item, amount, offer=0, units=1.0, points=0, online=None):
    return (cx, txn, day, store, item, offer, Decimal(amount), Decimal(amount) / 2, units, 0.0, 1, points, online)


@pytest.fixture(scope="module")
def tables(spark):
    d1, d2 = date(2020, 1, 7), date(2020, 1, 14)
    rows = [
        sale(1, 10, d1, 1, 1, 5), sale(1, 10, d1, 1, 2, 7, offer=3, units=2.0),
        sale(1, 11, d1, 2, 1, 12, online=99),
        sale(2, 12, d1, 2, 1, 1), sale(2, 12, d1, 2, 3, 4, points=-5),
        sale(2, 13, d2, 3, 1, 50), sale(2, 14, d2, 2, 1, 1),
        sale(0, 15, d1, 1, 1, 9), sale(3, 16, d1, 1, 1, 9), sale(1, 17, date(2019, 1, 1), 1, 1, 9),
        sale(4, 18, d2, 1, 9, 9),
    ]
    location = [(1, "ST", "A", 1, "north"), (2, "ST", "A", 1, "south"), (3, "ST", "A", 1, "west"),
                (4, "DC", "A", 1, "x"), (5, "ST", "Z", 1, "x"), (6, "ST", "A", 0, "x")]
    product = [(1, 1, "100", "a"), (2, 1, "8040", "b"), (3, 1, "100", "c"), (9, 0, "100", "off")]
    customer = [(1, 100, 1, 0), (2, 100, 1, 0), (3, 0, 1, 0), (4, 200, 1, 1)]
    return SalesTables(
        spark.createDataFrame(rows, SALE),
        calendar_between(spark, date(2020, 1, 1), date(2020, 2, 1)),
        spark.createDataFrame(location, "id bigint, location_type string, banner_short_name string, is_active int, divisional_regional_rollup string"),
        spark.createDataFrame(product, "ID bigint, IS_ACTIVE int, MDM_SUB_CAT_ID string, Variant_Name string"),
        spark.createDataFrame(customer, "ldw_customer_id bigint, household_id bigint, is_active int, deleted_flag int"),
    )


@pytest.fixture(scope="module")
def keys(tables):
    bounds = cal.complete_week_bounds(tables.dim_date, date(2020, 1, 27), 3)
    return cal.read_keys(tables.dim_date, bounds)


def test_transactions(tables, keys):
    got = {
        r.transaction_number: r
        for r in weekly.transaction_grain(
            tables.retail_sale, tables.dim_location, tables.dim_product, keys[0], ["A"]
        ).collect()
    }
    assert sorted(got) == [10, 11, 12, 13, 14, 16]
    ten = got[10]
    assert (ten.sales_dollars, ten.sales_dollars_offer, ten.row_count) == (12, 7, 2)
    assert (ten.units_sales, ten.units_sales_real, ten.units_sales_real_offer) == (3.0, 1.0, 0.0)
    assert (ten.unique_item_count, ten.unique_item_count_offer) == (1, 0)
    assert (got[12].points_redeemed, got[12].redeem_count) == (5, 1.0)


def test_household_weeks(tables, keys):
    cx = weekly.build_customer_weeks(tables, keys[0], ["A"])
    assert {(r.cx, r.location_id): r.n_ecomm_trans for r in cx.where("week_number = 2").collect()} == {
        (1, 1): 0, (1, 2): 1, (2, 2): 0, (3, 1): 0}
    rows = weekly.build_household_weeks(cx, tables, keys[1], ["A"], per_batch=1).orderBy("week_number").collect()
    assert [(r.hhn, r.week_number, r.n_transaction) for r in rows] == [(100, 2, 3), (100, 3, 2)]
    # Stores 1 and 2: 12 against 17.
    assert (rows[0].maxsales_location_id, rows[0].divisional_regional_rollup) == (2, "south")
    assert rows[0].week_ending_date == date(2020, 1, 12) and rows[0].hhn_batch_num == 0
    real = weekly.household_store_weeks(cx, tables.dim_customer, keys[1], true_counts=True)
    assert real.selectExpr("sum(n_transaction)").first()[0] == 5


def test_top_store_tie_and_dropped_store(spark, tables, keys):
    rows = [(1, 2, 2020, 7, Decimal(5)), (1, 2, 2020, 3, Decimal(5)), (1, 2, 2020, 1, Decimal(4))]
    df = spark.createDataFrame(rows, "hhn bigint, week_number int, year_number int, location_id bigint, sales_dollars decimal(18,4)")
    assert weekly.top_stores(df).first().maxsales_location_id == 3
    cx = weekly.build_customer_weeks(tables, keys[0], ["A"])
    fewer = tables._replace(dim_location=tables.dim_location.where("id <> 3"))
    weeks = weekly.build_household_weeks(cx, fewer, keys[1], ["A"]).collect()
    assert [r.week_number for r in weeks] == [2]


def test_one_scan_of_the_sales(spark, tables, keys):
    plan = weekly.build_customer_weeks(tables, keys[0], ["A"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ecomm_trans_id") and plan.count("Join Inner") + plan.count("Join LeftOuter") == 3


def test_medians_are_exact_for_many_households(spark):
    # More different values than an approximate percentile tells apart; other weeks of one, two and no known values.
    n = 120_001
    big = spark.range(n).selectExpr(
        "2020 AS year_number", "7 AS week_number", f"CAST(pmod(id * 7919, {n}) AS decimal(28,4)) / 4 AS sales_dollars",
        f"CAST(pmod(id * 104729, {n}) AS double) / 2 AS units_sales")
    few = spark.sql("""SELECT * FROM VALUES (2020, 8, 5, 2D), (2020, 8, 3, 1D), (2020, 9, 4, 6D), (2020, 10, null, 9D), (2020, 11, null, null)
        AS t(year_number, week_number, sales_dollars, units_sales)""")
    rows = big.unionAll(few).selectExpr("year_number", "week_number", "CAST(sales_dollars AS decimal(28,4)) AS sales_dollars", "units_sales",
                                        "1L AS n_transaction", "0L AS n_ecomm_trans")
    got = {r.week_number: (r.median_sales, r.median_units_sales) for r in weekly.weekly_globals(rows).collect()}
    assert got == {7: (Decimal("15000.0000"), 30000.0), 8: (3, 1.0), 9: (4, 6.0), 10: (None, 9.0), 11: (None, None)}


@pytest.mark.parametrize("name", ["transaction_grain", "customer_weeks", "household_batches", "quality_customer_weeks"])
def test_weekly_steps_are_dealt_by_the_number_of_lines(spark, monkeypatch, name):
    folder = "/root/testdata/sf0.001"
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    assert line_tasks(spark, folder, 700) == -(-lines // 700) == 9
    few = sorted(map(tuple, queries.REGISTRY[name](spark, folder).collect()), key=str)
    monkeypatch.setattr(queries.src, "line_tasks", lambda *a: 9)
    many = queries.REGISTRY[name](spark, folder)
    assert sorted(map(tuple, many.collect()), key=str) == few
    plan = many._jdf.queryExecution().executedPlan().toString()
    # Lines and orders meet, transactions and customers' weeks are summed, all in nine tasks.
    keys = {"transaction_grain": ["l_orderkey", "transaction_number"], "household_batches": []}
    for key in keys.get(name, ["l_orderkey", "transaction_number", "cx"]):
        assert re.search(rf"hashpartitioning\({key}#\d+L, 9\)", plan)
    assert not re.search(r"hashpartitioning\((fiscal_date|cx|hhn)#[^()]*, 4\)", plan)


def test_joins_with_items_stores_and_batches_are_dealt_too(spark, monkeypatch):
    """Where Spark broadcasts none of them, as on large tables, rows of a task follow the lines, not the shuffle partitions."""
    folder = "/root/testdata/sf0.001"
    key = "spark.sql.autoBroadcastJoinThreshold"
    few = sorted(map(tuple, queries.REGISTRY["household_weeks"](spark, folder).collect()), key=str)
    monkeypatch.setattr(queries.src, "line_tasks", lambda *a: 9)
    plans, write = [], weekly.staged

    def record(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(weekly, "staged", record)
    monkeypatch.setattr(queries, "staged", record)
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows = sorted(map(tuple, queries.REGISTRY["household_weeks"](spark, folder).collect()), key=str)
    finally:
        spark.conf.set(key, before)
    assert rows == few and len(plans) == 2
    for plan, joined in zip(plans, (["item_id", "location_id", "cx"], ["maxsales_location_id", "hhn"])):
        for name in joined:
            found = re.findall(rf"hashpartitioning\({name}#\d+L?, (\d+)\)", plan)
            assert found and set(found) == {"9"}, (name, found)
