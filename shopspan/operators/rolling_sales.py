"""Annualized sales of a rolling window, moved on by one week of sales.

Two tables grow by one partition a week. ``weeks`` holds each customer's financial sales of a week. ``window`` holds each customer's
sums over the look-back window and the weeks in which they shopped. A move adds the new week's partition of ``weeks`` to the window
of the week before and takes off the week that leaves it, so a run reads one week of sales lines, two partitions of ``weeks`` and one
of ``window`` instead of two years of lines. Sums are decimals: what was added comes off exactly.

Both tables are kept per customer. Households and card types are those of the customer table of the day a result is asked for, as in
a full build. Financial items are those of the run that read the lines; after a change of flags, remove both tables.

A week may be run again, also with corrected lines; later weeks are then run again after it, in order.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from shopspan.operators.gold import counted_cards, tenure_columns
from shopspan.sources import sinks
from shopspan.sources.staging import remove_folder, staged

EPOCH = date(1970, 1, 1)
WEEKS_IN_YEAR = 52


def _day(week: date) -> int:
    return (week - EPOCH).days


def _schemas(sales: DataFrame) -> tuple[str, str]:
    kind = sales.schema["merch_sales"].dataType
    if not isinstance(kind, DecimalType):
        raise TypeError("merch_sales must be decimal: sums of doubles cannot be taken off again exactly")
    customer = sales.schema["customer_hk"].dataType.simpleString()
    money = f"decimal({min(38, kind.precision + 18)},{kind.scale})"
    return (
        f"customer_hk {customer}, sales {money}, n_lines bigint, week date",
        f"customer_hk {customer}, sales {money}, n_lines bigint, weeks array<int>, window_weeks int, as_of date",
    )


def require_whole_weeks(dim_date: DataFrame, week: date, n_weeks: int) -> None:
    """The calendar's weeks must end every seventh day up to ``week``, else a window of whole weeks is another one."""
    first = week - timedelta(days=7 * n_weeks - 1)
    days = dim_date.where(F.col("date").between(F.lit(first), F.lit(week)))
    if not days.where(F.col("week_end_date") != _week_of(F.col("date"), week)).isEmpty():
        raise ValueError(f"weeks of the calendar do not end every seventh day before {week}")


def _week_of(day, week: date):
    return F.date_sub(F.lit(week), (F.floor(F.datediff(F.lit(week), day) / 7) * 7).cast("int"))


def week_sales(sales: DataFrame, items: DataFrame, week: date, n_weeks: int = 1) -> DataFrame:
    """Financial sales and lines per customer and week of the ``n_weeks`` weeks up to ``week``: customer_hk, sales, n_lines, week.

    A customer with other purchases only has a row too, of zero lines. Purchases without a card share one customer, whose lines are
    summed before the shuffle.
    """
    first = week - timedelta(days=7 * n_weeks - 1)
    financial = items.where("financial_sale_flag = 'Y'").select("item_hk", F.lit(True).alias("financial"))
    return (
        sales.where(F.col("fiscal_date").between(F.lit(first), F.lit(week)))
        .select("fiscal_date", "customer_hk", "item_hk", "merch_sales")
        .join(financial, "item_hk", "left")
        .groupBy("customer_hk", _week_of(F.col("fiscal_date"), week).alias("week"))
        .agg(
            F.coalesce(F.sum(F.when(F.col("financial"), F.col("merch_sales"))), F.lit(0)).alias("sales"),
            F.count(F.when(F.col("financial"), 1)).alias("n_lines"),
        )
        .select("customer_hk", "sales", "n_lines", "week")
    )


def build_window(weeks: DataFrame) -> DataFrame:
    """Sums and shopping weeks (days since 1970-01-01, ascending) per customer of the given customer weeks."""
    return weeks.groupBy("customer_hk").agg(
        F.sum("sales").alias("sales"), F.sum("n_lines").alias("n_lines"),
        F.sort_array(F.collect_list(F.unix_date("week"))).alias("weeks"),
    )


def move_window(previous: DataFrame, new: DataFrame, expired: DataFrame, week: date, n_weeks: int) -> DataFrame:
    """The window up to ``week`` from that of the week before, the customer weeks of ``week`` and those that leave.

    One aggregate over at most three rows a customer; a customer without a week left has no row.
    """
    none = F.array().cast("array<int>")
    parts = (
        previous.select("customer_hk", "sales", "n_lines", "weeks")
        .unionAll(new.select("customer_hk", "sales", "n_lines", F.array(F.unix_date("week"))))
        .unionAll(expired.select("customer_hk", -F.col("sales"), -F.col("n_lines"), none))
    )
    summed = parts.groupBy("customer_hk").agg(
        F.sum("sales").alias("sales"), F.sum("n_lines").alias("n_lines"), F.flatten(F.collect_list("weeks")).alias("weeks")
    )
    first = F.lit(_day(week) - 7 * (n_weeks - 1))
    return summed.withColumn("weeks", F.sort_array(F.filter("weeks", lambda d: d >= first))).where(F.size("weeks") > 0)


def _replace(df: DataFrame, path: str, column: str, values: list[date], schema: str) -> None:
    """Write the partitions ``values`` of a table; one without rows is removed."""
    spark = df.sparkSession
    rows = staged(df, "rolling-sales")
    found = {r[0] for r in rows.select(column).distinct().collect()}  # at most the weeks of the window
    # Written under the table's types, which the sums may exceed by digits that they do not use.
    typed = rows.to(spark.createDataFrame([], schema).schema)
    sinks.overwrite_partitions(typed, path, column)
    for value in values:
        if value not in found:
            remove_folder(spark, f"{path}/{column}={value}")


def advance_stored(path: str, sales: DataFrame, items: DataFrame, dim_date: DataFrame, week: date, years: int = 2) -> bool:
    """Write the window up to ``week``; whether it was moved on from the week before or built from all lines.

    A window is built where that of the week before is missing or spans other years.
    """
    n_weeks, spark = WEEKS_IN_YEAR * years, sales.sparkSession
    week_schema, window_schema = _schemas(sales)
    weeks_path, window_path = f"{path}/weeks", f"{path}/window"
    require_whole_weeks(dim_date, week, n_weeks)
    stored = sinks.read_if_exists(spark, window_path, window_schema)
    previous = None
    if stored is not None:
        previous = stored.where((F.col("as_of") == F.lit(week - timedelta(weeks=1))) & (F.col("window_weeks") == n_weeks))
    moved = previous is not None and not previous.isEmpty()
    n_read = 1 if moved else n_weeks
    written = [week - timedelta(weeks=k) for k in range(n_read)]
    _replace(week_sales(sales, items, week, n_read), weeks_path, "week", written, week_schema)
    weeks = spark.read.schema(week_schema).parquet(weeks_path)
    if moved:
        new, expired = (weeks.where(F.col("week") == F.lit(w)) for w in (week, week - timedelta(weeks=n_weeks)))
        window = move_window(previous, new, expired, week, n_weeks)
    else:
        window = build_window(weeks.where(F.col("week").between(F.lit(written[-1]), F.lit(week))))
    columns = {"window_weeks": F.lit(n_weeks), "as_of": F.lit(week)}
    _replace(window.withColumns(columns), window_path, "as_of", [week], window_schema)
    return moved


def stored_window(path: str, sales: DataFrame, week: date) -> DataFrame:
    spark: SparkSession = sales.sparkSession
    return spark.read.schema(_schemas(sales)[1]).parquet(f"{path}/window").where(F.col("as_of") == F.lit(week))


def annualized_from_window(
    window: DataFrame, customers: DataFrame, week: date, excluded_cards=(), period_weeks: int = 13
) -> DataFrame:
    """Annualized sales as of ``week``; equals ``gold.annualized_sales`` over all lines of the window."""
    holders = customers.where("current_household_id != 0").select(
        "customer_hk", F.col("current_household_id").alias("hhn"), counted_cards(excluded_cards).alias("counted_card"),
    )
    counted = lambda c: F.sum(F.when(F.col("counted_card"), F.col(c)))
    households = window.join(holders, "customer_hk").groupBy("hhn").agg(
        counted("sales").alias("sales"), counted("n_lines").alias("n_lines"), F.min(F.col("weeks")[0]).alias("first_week"),
    )
    first_event = F.date_sub(F.date_from_unix_date("first_week"), 7)
    per_period = F.col("sales").cast("double") / F.col("n_periods_tenure")
    return (
        households.where("n_lines > 0")
        .withColumns(tenure_columns(first_event, week, period_weeks))
        .select(
            "hhn", F.round(per_period * (WEEKS_IN_YEAR / period_weeks), 0).alias("annualized_sales"),
            F.lit(week).alias("churn_max_week_ending_date"),
        )
    )
