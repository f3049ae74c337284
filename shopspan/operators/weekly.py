"""Sales lines -> transactions -> customer weeks -> household weeks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopspan.functions import measures as m
from shopspan.operators import stable_batches
from shopspan.operators.calendar import KeyDates, KeyWeeks, unique_weeks
from shopspan.operators.ordering import ordered_positions, running_sums
from shopspan.sources.staging import staged
from shopspan.sources.tables import dealt, lower_case_columns

TRANSACTION_KEYS = ("fiscal_date", "cx", "location_id", "transaction_number")
CARRIED_SUMS = (
    "sales_dollars", "extended_cost", "sales_dollars_offer", "units_sales",
    "units_sales_offer", "points_earned", "points_redeemed", "redeem_count",
)
HOUSEHOLD_SUMS = tuple(c for c in CARRIED_SUMS if c != "sales_dollars_offer")


def listed_stores(dim_location: DataFrame, banners) -> DataFrame:
    return dim_location.where(
        (F.col("location_type") == "ST")
        & F.col("banner_short_name").isin(*banners)
        & (F.col("is_active") == 1)
    )


def live_customers(dim_customer: DataFrame) -> DataFrame:
    """Customer -> household of active, undeleted, known households."""
    return dim_customer.where(
        (F.col("household_id") != 0) & (F.col("is_active") == 1) & (F.col("deleted_flag") == 0)
    ).select(F.col("ldw_customer_id").alias("cx"), F.col("household_id").alias("hhn"))


def within_dates(key: KeyDates) -> Column:
    return F.col("fiscal_date").between(F.lit(key.min_date), F.lit(key.max_date))


def within_weeks(key: KeyWeeks) -> Column:
    """Closed (year, week) range, written on the bare columns so it prunes partitions."""
    year, week = F.col("year_number"), F.col("week_number")
    return (
        year.between(key.start_year, key.end_year)
        & ~((year == key.start_year) & (week < key.start_week))
        & ~((year == key.end_year) & (week > key.end_week))
    )


def known_lines(sales: DataFrame, key: KeyDates) -> DataFrame:
    """Known customers' lines in the window, in any store and on any item."""
    return lower_case_columns(sales).where((F.col("customer_id") != 0) & within_dates(key)).select(
        "fiscal_date",
        F.col("customer_id").alias("cx"),
        "transaction_number",
        F.col("store_number").alias("location_id"),
        "item_id",
        "offer_id",
        F.col("unit_count").alias("quantity"),
        "weight",
        F.col("merch_sales").alias("sales"),
        F.col("product_cost").alias("cost"),
        "points_issued",
        "points_redeemed",
        m.unit_of_measure(F.col("weight")).alias("uom"),
        F.col("ecomm_trans_id").isNotNull().alias("online"),
    )


def _with_listing(
    lines: DataFrame, dim_location: DataFrame, dim_product: DataFrame, banners, how: str, tasks: int = 0
) -> DataFrame:
    """Lines with what is listed of their store and item. Lines follow the tasks of a table that is not broadcast."""
    stores = listed_stores(dim_location, banners).select(F.col("id").alias("location_id"), F.lit(True).alias("listed"))
    items = lower_case_columns(dim_product).where("is_active = 1").select(
        F.col("id").alias("item_id"), "mdm_sub_cat_id", "variant_name", F.lit(True).alias("active")
    )
    return lines.join(dealt(stores, tasks, "location_id"), "location_id", how).join(
        dealt(items, tasks, "item_id"), "item_id", how
    )


def sale_lines(
    sales: DataFrame, dim_location: DataFrame, dim_product: DataFrame, key: KeyDates, banners, tasks: int = 0
) -> DataFrame:
    """Known customers' lines in the window, in listed stores, on active items."""
    return _with_listing(known_lines(sales, key), dim_location, dim_product, banners, "inner", tasks)


# Measure -> input column; all are sums over the lines of a transaction.
LINE_SUMS = {
    "sales_dollars": "sales",
    "extended_cost": "cost",
    "sales_dollars_offer": "sales_offer",
    "extended_cost_offer": "cost_offer",
    "units_sales": "units",
    "units_sales_offer": "units_offer",
    "units_sales_real": "units_real",
    "units_sales_real_offer": "units_real_offer",
    "sales_quantity": "quantity",
    "sales_weight": "weight",
    "points_earned": "points_in",
    "points_redeemed": "points_out",
    "redeem_count": "redeemed_units",
}


def line_measures(lines: DataFrame, *others: str) -> DataFrame:
    units, units_offer = F.col("units"), m.offer_only(F.col("units"))
    dropped = F.coalesce(m.is_non_merch(), F.lit(False))
    return lines.withColumn("units", m.units_sold()).select(
        *TRANSACTION_KEYS, *others,
        "item_id", "sales", "cost", "units", "quantity", "weight",
        m.offer_only(F.col("sales")).alias("sales_offer"),
        m.offer_only(F.col("cost")).alias("cost_offer"),
        units_offer.alias("units_offer"),
        F.when(dropped, 0).otherwise(units).alias("units_real"),
        F.when(dropped, 0).otherwise(units_offer).alias("units_real_offer"),
        F.coalesce("points_issued", F.lit(0)).alias("points_in"),
        (-F.coalesce("points_redeemed", F.lit(0))).alias("points_out"),
        F.when(F.col("points_redeemed") < 0, units).otherwise(0).alias("redeemed_units"),
        (~dropped).cast("int").alias("is_item"),
        (~dropped & F.coalesce(m.on_offer(), F.lit(False))).cast("int").alias("is_offer_item"),
    )


def transaction_sums(lines: DataFrame) -> DataFrame:
    """One row per date, customer, store and transaction."""
    return lines.groupBy(*TRANSACTION_KEYS).agg(
        F.max("fiscal_date").alias("transaction_dt"),
        *[m.sum_or_zero(c).alias(name) for name, c in LINE_SUMS.items()],
        F.count(F.lit(1)).alias("row_count"),
    )


def transaction_grain(
    sales: DataFrame, dim_location: DataFrame, dim_product: DataFrame, key: KeyDates, banners, tasks: int = 0
) -> DataFrame:
    """``transaction_sums`` plus the numbers of distinct items, in all and on offer.

    Lines are first summed per item, so the distinct items are plain row counts; a
    distinct aggregate would copy every line once per distinct column instead.
    """
    listed = dealt(sale_lines(sales, dim_location, dim_product, key, banners, tasks), tasks, "transaction_number")
    lines = line_measures(listed)
    per_item = lines.groupBy(*TRANSACTION_KEYS, "item_id").agg(
        *[F.sum(c).alias(c) for c in LINE_SUMS.values()],
        F.max("is_item").alias("is_item"),
        F.max("is_offer_item").alias("is_offer_item"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    return per_item.groupBy(*TRANSACTION_KEYS).agg(
        F.max("fiscal_date").alias("transaction_dt"),
        *[m.sum_or_zero(c).alias(name) for name, c in LINE_SUMS.items()],
        F.sum("is_item").alias("unique_item_count"),
        F.sum("is_offer_item").alias("unique_item_count_offer"),
        F.sum("n_lines").alias("row_count"),
    )


def flagged_transactions(
    sales: DataFrame, dim_location: DataFrame, dim_product: DataFrame, key: KeyDates, banners, tasks: int = 0
) -> DataFrame:
    """Transactions as in ``transaction_sums`` with ``ecomm_flag``, from one scan of the sales.

    A transaction is online if any of its lines is, also one outside listed stores or on an inactive
    item. So all known customers' lines are summed, but only listed ones count in the sums, and the
    flag is looked up among the few rows of one customer's transaction.
    """
    lines = _with_listing(known_lines(sales, key), dim_location, dim_product, banners, "left", tasks)
    counts = F.coalesce(F.col("listed") & F.col("active"), F.lit(False))
    counted = dealt(lines.withColumn("counts", counts).drop("listed", "active"), tasks, "transaction_number")
    measured = line_measures(counted, "online", "counts")
    summed = measured.groupBy(*TRANSACTION_KEYS).agg(
        F.max("fiscal_date").alias("transaction_dt"),
        *[F.coalesce(F.sum(F.when(F.col("counts"), F.col(c))), F.lit(0)).alias(name) for name, c in LINE_SUMS.items()],
        F.count(F.when(F.col("counts"), 1)).alias("row_count"),
        F.max("online").alias("online"),
    )
    one = Window.partitionBy("fiscal_date", "cx", "transaction_number")
    flag = F.when(F.max("online").over(one), F.lit(1))
    return summed.withColumn("ecomm_flag", flag).where("row_count > 0").drop("online")


def customer_weeks(flagged: DataFrame, dim_date: DataFrame, tasks: int = 0) -> DataFrame:
    """One row per customer, week and store, in as many tasks as the lines need."""
    days = dim_date.select(
        F.col("date").alias("fiscal_date"),
        F.col("week").alias("week_number"),
        F.col("year").alias("year_number"),
    )
    # One row per calendar day: bounded by the calendar, whatever the sales volume.
    return dealt(flagged.join(F.broadcast(days), "fiscal_date"), tasks, "cx").groupBy(
        "cx", "week_number", "year_number", "location_id"
    ).agg(
        F.count(F.lit(1)).alias("n_transaction"),
        m.sum_of_known(F.col("ecomm_flag")).alias("n_ecomm_trans"),
        *[F.sum(c).alias(c) for c in CARRIED_SUMS],
    )


def build_customer_weeks(tables, key: KeyDates, banners) -> DataFrame:
    # Measures the weekly tables do not carry are pruned together with their inputs.
    tasks = tables.line_tasks
    flagged = flagged_transactions(tables.retail_sale, tables.dim_location, tables.dim_product, key, banners, tasks)
    return customer_weeks(flagged, tables.dim_date, tasks)


def household_store_weeks(
    customer_week_rows: DataFrame, dim_customer: DataFrame, key: KeyWeeks, true_counts: bool = False, tasks: int = 0
) -> DataFrame:
    """One row per household, week and store; all of a household's lie in one task.

    ``n_transaction`` counts the merged customer-week rows; ``true_counts`` sums
    their transactions instead.
    """
    counted = F.sum("n_transaction") if true_counts else F.count(F.lit(1))
    return (
        dealt(customer_week_rows.where(within_weeks(key)).join(live_customers(dim_customer), "cx"), tasks, "hhn")
        .groupBy("hhn", "week_number", "year_number", "location_id")
        .agg(
            counted.alias("n_transaction"),
            F.sum("n_ecomm_trans").alias("n_ecomm_trans"),
            *[F.sum(c).alias(c) for c in CARRIED_SUMS],
        )
    )


def top_store() -> Column:
    """The store with the largest sales; the smaller id wins a tie."""
    return F.max_by("location_id", F.struct("sales_dollars", -F.col("location_id")))


def top_stores(store_weeks: DataFrame) -> DataFrame:
    return store_weeks.groupBy("hhn", "week_number", "year_number").agg(top_store().alias("maxsales_location_id"))


def household_totals(store_weeks: DataFrame, dim_date: DataFrame) -> DataFrame:
    """One row per household and week; top store and sums come from one aggregation."""
    totals = store_weeks.groupBy("hhn", "week_number", "year_number").agg(
        F.sum("n_transaction").alias("n_transaction"),
        m.sum_of_known(F.col("n_ecomm_trans")).alias("n_ecomm_trans"),
        *[F.sum(c).alias(c) for c in HOUSEHOLD_SUMS],
        top_store().alias("maxsales_location_id"),
    )
    # At most one row per calendar week.
    weeks = F.broadcast(unique_weeks(dim_date))
    return totals.join(weeks, ["year_number", "week_number"]).select(
        "hhn", "week_number", "year_number", "week_ending_date", "n_transaction",
        "n_ecomm_trans", "maxsales_location_id", "sales_dollars", "extended_cost",
        "units_sales",
        m.unit_offer_ratio(F.col("units_sales"), F.col("units_sales_offer")).alias("unit_offer_ratio"),
        "points_earned", "points_redeemed", "redeem_count",
    )


MEDIANS = {"median_sales": "sales_dollars", "median_units_sales": "units_sales"}


def weekly_medians(totals: DataFrame) -> DataFrame:
    """Exact medians per week, of an even number the lower middle; no week is gathered in one task.

    Both measures go through one sort: a row holds a value of one of them and null in the other.
    """
    week = ["year_number", "week_number"]
    values = F.array(*[
        F.struct(F.lit(name).alias("median"), *[(F.col(c) if c == own else F.lit(None).cast(totals.schema[c].dataType)).alias(c)
                                                for c in MEDIANS.values()])
        for name, own in MEDIANS.items()
    ])
    counted = (
        totals.select(*week, F.explode(values).alias("v")).select(*week, "v.*")
        .where(F.col("sales_dollars").isNotNull() | F.col("units_sales").isNotNull())
        .groupBy(*week, "median", *MEDIANS.values()).agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_sums(counted, [*week, "median"], [F.asc(c) for c in MEDIANS.values()], ["n"])
    # Two rows per week of the window.
    sizes = F.broadcast(ranked.groupBy(*week, "median").agg(F.sum("n").alias("total")))
    middle = F.expr("(total + 1) div 2")
    return ranked.join(sizes, [*week, "median"]).where((F.col("cum_n") >= middle) & (F.col("cum_n") - F.col("n") < middle)).groupBy(*week).agg(*[
        F.max(F.when(F.col("median") == name, F.col(c))).alias(name) for name, c in MEDIANS.items()
    ])


def weekly_globals(totals: DataFrame) -> DataFrame:
    """Median and mean behaviour of all households, per week."""
    week = ["year_number", "week_number"]
    means = totals.groupBy(*week).agg(
        F.avg("n_transaction").cast("decimal(27,5)").alias("avg_n_transaction"),
        F.avg("n_ecomm_trans").cast("decimal(27,5)").alias("avg_n_ecomm_trans"),
    )
    return means.join(weekly_medians(totals), week, "left")


def household_batches(totals: DataFrame, per_batch: int = 25_000) -> DataFrame:
    """Number the distinct households in id order and cut the numbers into batches."""
    numbered = ordered_positions(totals.select("hhn").distinct(), [], [F.asc("hhn")])
    return numbered.select(
        "hhn",
        F.col("position").alias("unique_hhn_num"),
        F.floor(F.col("position") / per_batch).alias("hhn_batch_num"),
    )


def finish_household_weeks(
    totals: DataFrame, dim_location: DataFrame, banners, per_batch: int, batches: DataFrame | None = None, tasks: int = 0
) -> DataFrame:
    """Attach region, weekly globals and batch number, of ``batches`` where given, in as many tasks as the lines need.

    ``totals`` is read four times, so pass a stored table. Weeks whose top store
    is not a listed active store drop out here, after globals and batches.
    """
    stores = listed_stores(dim_location, banners).select(
        F.col("id").alias("maxsales_location_id"), "divisional_regional_rollup"
    )
    # One row per week of the window.
    globals_ = F.broadcast(weekly_globals(totals))
    batches = (household_batches(totals, per_batch) if batches is None else batches).select("hhn", "hhn_batch_num")
    return (
        totals.join(dealt(stores, tasks, "maxsales_location_id"), "maxsales_location_id")
        .join(globals_, ["year_number", "week_number"], "left")
        .join(dealt(batches, tasks, "hhn"), "hhn")
        .select(
            *totals.columns, "divisional_regional_rollup", "median_sales", "median_units_sales",
            "avg_n_transaction", "avg_n_ecomm_trans", "hhn_batch_num",
        )
    )


def build_household_weeks(
    customer_week_rows: DataFrame,
    tables,
    key: KeyWeeks,
    banners,
    per_batch: int = 25_000,
    true_counts: bool = False,
    numbers_path: str | None = None,
    run_date: date | None = None,
) -> DataFrame:
    """Household weeks; batches follow the numbers kept at ``numbers_path``, extended by the run, or are counted anew."""
    store_weeks = household_store_weeks(customer_week_rows, tables.dim_customer, key, true_counts, tables.line_tasks)
    totals = staged(household_totals(store_weeks, tables.dim_date), "household-totals")
    batches = None
    if numbers_path:
        stable_batches.extend(numbers_path, totals.select("hhn"), run_date)
        batches = stable_batches.batches(numbers_path, totals.sparkSession, per_batch)
    return finish_household_weeks(totals, tables.dim_location, banners, per_batch, batches, tables.line_tasks)
