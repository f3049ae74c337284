from datetime import date, timedelta
from decimal import Decimal

import pytest

from shopspan.operators import gold
from shopspan.operators import rolling_sales as rolling
from shopspan.sources.staging import new_staging_path
from shopspan.sources.tables import calendar_between

SALES = "customer_hk bigint, item_hk bigint, merch_sales decimal(18,4), fiscal_date date"


@pytest.fixture(scope="module")
def world(spark):
    days = calendar_between(spark, date(2018, 1, 1), date(2021, 2, 28))
    ends = sorted({r[0] for r in days.where("week_end_date = date").select("date").collect()})
    last = ends[-3]
    rows = [
        (c, 1 + (c + k) % 3, Decimal(c * 100 + k) / 7 * (-1 if (c + k) % 11 == 0 else 1), last - timedelta(days=4 * k + c % 7 - 20))
        for c in range(1, 25) for k in range(0, 110) if (c * 5 + k) % 6 == 0 and not (c == 3 and k < 60) and not (c == 4 and k > 6)
    ]
    rows += [(7, None, Decimal(5), last), (None, 1, Decimal(9), last), (8, 1, None, last), (9, 2, Decimal(4), last - timedelta(days=363))]
    sales = spark.createDataFrame([(c, i, None if x is None else x.quantize(Decimal("0.0001")), d) for c, i, x, d in rows], SALES)
    customers = spark.createDataFrame(
        [(c, c // 2, None if c % 5 == 0 else "AB"[c % 2] if c % 7 else "Training") for c in range(1, 25)],
        "customer_hk bigint, current_household_id bigint, current_card_type string",
    )
    items = spark.createDataFrame([(1, "Y"), (2, "N"), (3, "Y")], "item_hk bigint, financial_sale_flag string")
    return days, last, sales, customers, items


def full(world, week, sales=None):
    days, _, lines, customers, items = world
    rows = gold.annualized_sales(lines if sales is None else sales, customers, items, days, week, ["Training"], 1)
    return sorted(tuple(r) for r in rows.select("hhn", "annualized_sales").collect())


def kept(world, path, week):
    _, _, sales, customers, _ = world
    rows = rolling.annualized_from_window(rolling.stored_window(path, sales, week), customers, week, ["Training"])
    return sorted(tuple(r) for r in rows.select("hhn", "annualized_sales").collect())


def test_moves_equal_the_full_build(spark, world):
    days, last, sales, _, items = world
    path = new_staging_path(spark, "rolling")
    moved = []
    for k in range(5):
        week = last + timedelta(weeks=k - 4)
        moved.append(rolling.advance_stored(path, sales, items, days, week, 1))
        assert kept(world, path, week) == full(world, week)
    assert moved == [False, True, True, True, True] and full(world, last)


def test_a_move_reads_one_week_of_lines(spark, world):
    """Lines of other weeks are not there, and nothing changes."""
    days, last, sales, _, items = world
    path = new_staging_path(spark, "rolling")
    rolling.advance_stored(path, sales, items, days, last - timedelta(weeks=1), 1)
    one_week = sales.where(f"fiscal_date > date '{last - timedelta(weeks=1)}'")
    assert rolling.advance_stored(path, one_week, items, days, last, 1)
    assert kept(world, path, last) == full(world, last)


def test_corrected_and_empty_weeks_replace_what_was_stored(spark, world):
    days, last, sales, _, items = world
    path, before = new_staging_path(spark, "rolling"), last - timedelta(weeks=1)
    for week in (before, last):
        rolling.advance_stored(path, sales, items, days, week, 1)
    for corrected in (sales.where("customer_hk % 2 = 0"), sales.limit(0), sales):
        lines = sales.where(f"fiscal_date <= date '{before}'").unionAll(corrected.where(f"fiscal_date > date '{before}'"))
        rolling.advance_stored(path, lines, items, days, last, 1)
        assert kept(world, path, last) == full(world, last, lines)


def test_gaps_and_other_windows_are_built(spark, world):
    days, last, sales, _, items = world
    path = new_staging_path(spark, "rolling")
    assert not rolling.advance_stored(path, sales, items, days, last - timedelta(weeks=5), 1)
    assert not rolling.advance_stored(path, sales, items, days, last, 1)
    assert kept(world, path, last) == full(world, last)
    assert not rolling.advance_stored(path, sales, items, days, last + timedelta(weeks=1), 2)


def test_no_lines_give_no_rows(spark, world):
    days, last, sales, _, items = world
    path = new_staging_path(spark, "rolling")
    for week in (last - timedelta(weeks=1), last):
        rolling.advance_stored(path, sales.limit(0), items, days, week, 1)
        assert kept(world, path, week) == []


def test_unfit_tables_are_refused(spark, world):
    days, last, sales, _, items = world
    path = new_staging_path(spark, "rolling")
    with pytest.raises(TypeError, match="decimal"):
        rolling.advance_stored(path, sales.selectExpr("customer_hk", "item_hk", "cast(merch_sales as double) merch_sales", "fiscal_date"),
                               items, days, last, 1)
    with pytest.raises(ValueError, match="seventh day"):
        rolling.advance_stored(path, sales, items, days, last - timedelta(days=2), 1)
