"""Gold tables: annualized sales and household churn segments."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopspan.functions import weibull
from shopspan.schemas import HOUSEHOLD_CHURN_COLUMNS


def lookback_start(max_week: date, years: int) -> date:
    return max_week - timedelta(days=7 * 52 * years - 1)


def counted_cards(excluded) -> Column:
    """Cards that are not excluded; an unknown card type counts."""
    card = F.col("current_card_type")
    return ~card.isin(*excluded) | card.isNull()


def tenure_columns(first_event: Column, max_week: date, period_weeks: int) -> dict:
    weeks = (F.datediff(F.lit(max_week), first_event) / 7).cast("int")
    return {
        "weeks_since_first_shop_trunc": weeks,
        "period_length_weeks": F.lit(period_weeks),
        "n_periods_tenure": F.ceil((weeks + 1) / period_weeks),
    }


def base_tenure(
    sales: DataFrame, customers: DataFrame, dim_date: DataFrame, max_week: date,
    years: int = 2, period_weeks: int = 13,
) -> DataFrame:
    """Start of each household's first shopping week in the look-back window."""
    start = lookback_start(max_week, years)
    in_window = F.col("fiscal_date").between(F.lit(start), F.lit(max_week))
    # One row per calendar day.
    days = F.broadcast(dim_date.select(F.col("date").alias("fiscal_date"), "week_end_date"))
    first_weeks = (
        sales.where(in_window).select("fiscal_date", "customer_hk")
        .join(days, "fiscal_date")
        .groupBy("customer_hk").agg(F.min("week_end_date").alias("first_week"))
    )
    return (
        first_weeks
        .join(customers.select("customer_hk", F.col("current_household_id").alias("hhn")), "customer_hk")
        .groupBy("hhn")
        .agg(F.date_sub(F.min("first_week"), 7).alias("first_event_trunc"))
        .withColumns(tenure_columns(F.col("first_event_trunc"), max_week, period_weeks))
        .withColumn("max_wed", F.lit(max_week))
        .select("hhn", "max_wed", "first_event_trunc", "weeks_since_first_shop_trunc",
                "period_length_weeks", "n_periods_tenure")
    )


def annualized_sales(
    sales: DataFrame, customers: DataFrame, items: DataFrame, dim_date: DataFrame, max_week: date,
    excluded_cards=(), years: int = 2, period_weeks: int = 13,
) -> DataFrame:
    """Mean sales per period of tenure, scaled to 52 weeks and rounded to dollars.

    Tenure counts every purchase of the household, sales only financial items on
    counted cards. Both come from one scan: lines are summed per customer and day, then per
    household and day, and the household's first week is a window over those few rows.
    """
    start = lookback_start(max_week, years)
    # The first week may begin up to six days before the window.
    scanned = F.col("fiscal_date").between(F.lit(start - timedelta(days=6)), F.lit(max_week))
    financial = items.where("financial_sale_flag = 'Y'").select("item_hk", F.lit(True).alias("financial"))
    holders = customers.where("current_household_id != 0").select(
        "customer_hk", F.col("current_household_id").alias("hhn"),
        counted_cards(excluded_cards).alias("counted_card"),
    )
    # Lines are summed per customer and day before any join on customers: purchases without a card,
    # which share one customer, become one row per day. Sums of financial items are kept apart.
    per_customer = (
        sales.where(scanned).select("fiscal_date", "customer_hk", "item_hk", "merch_sales")
        .join(financial, "item_hk", "left")
        .groupBy("customer_hk", "fiscal_date")
        .agg(
            F.sum(F.when(F.col("financial"), F.col("merch_sales"))).alias("sales"),
            F.count(F.when(F.col("financial"), 1)).alias("n_lines"),
        )
    )
    daily = per_customer.join(holders, "customer_hk").groupBy("hhn", "fiscal_date").agg(
        F.sum(F.when(F.col("counted_card"), F.col("sales"))).alias("sales"),
        F.coalesce(F.sum(F.when(F.col("counted_card"), F.col("n_lines"))), F.lit(0)).alias("n_lines"),
    )
    days = F.broadcast(dim_date.select(F.col("date").alias("fiscal_date"), "week_end_date"))
    in_window = F.when(F.col("fiscal_date") >= F.lit(start), F.col("week_end_date"))
    first_event = F.date_sub(F.min(in_window).over(Window.partitionBy("hhn")), 7)
    per_period = F.sum("sales").cast("double") / F.col("n_periods_tenure")
    return (
        daily.join(days, "fiscal_date", "left")
        .withColumn("first_event_trunc", first_event)
        .where(F.col("fiscal_date") > F.col("first_event_trunc"))
        .withColumns(tenure_columns(F.col("first_event_trunc"), max_week, period_weeks))
        .groupBy("hhn", "n_periods_tenure")
        .agg(
            F.round(F.coalesce(per_period * (52 / period_weeks), F.lit(0.0)), 0).alias("annualized_sales"),
            F.sum("n_lines").alias("n_lines"),
        )
        .where("n_lines > 0")
        .select("hhn", "annualized_sales", F.lit(max_week).alias("churn_max_week_ending_date"))
    )


def churn_segment(p: Column) -> Column:
    """Segment of an already rounded churn probability."""
    return (
        F.when(p == 1, "Churned")
        .when(p >= 0.75, "At Risk")
        .when(p.between(0.5, 0.75), "High")
        .when(p.between(0.25, 0.5), "Med")
        .otherwise("Low")
    )


def next_week_shop_probability(alpha: Column, beta: Column) -> Column:
    return F.round(weibull.cdf(F.lit(1.0), alpha, beta), 4)


def household_churn(annualized: DataFrame, latest: DataFrame) -> DataFrame:
    """Latest predictions joined with annualized sales of the same week."""
    sales = annualized.where("hhn != 0").select(
        "hhn", F.col("churn_max_week_ending_date").alias("max_week_ending_date"),
        F.round("annualized_sales").alias("annualized_sales"),
    )
    joined = sales.join(latest, ["hhn", "max_week_ending_date"])
    rounded = joined.withColumns(
        {
            "churn_probability": F.round("churn_probability", 4),
            "next_week_shop_prob": next_week_shop_probability(F.col("alpha"), F.col("beta")),
        }
    )
    return (
        rounded.withColumn("churn_segment", churn_segment(F.col("churn_probability")))
        .select(*HOUSEHOLD_CHURN_COLUMNS)
        .distinct()
    )


ANNUALIZED_MERGE = dict(
    keys=["hhn", "churn_max_week_ending_date"],
    compare=["annualized_sales"],
    update=["annualized_sales"],
)
_CHURN_VALUES = [
    "annualized_sales", "next_week_shop_prob", "churn_probability", "churn_segment",
    "prediction_date",
]
# weeks_since_last_shop is written on insert only.
CHURN_MERGE = dict(
    keys=["hhn", "max_week_ending_date"], compare=_CHURN_VALUES, update=_CHURN_VALUES
)
