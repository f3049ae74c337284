"""Churn prediction table from fitted parameters and household history."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopspan.functions import weibull
from shopspan.functions.dates import normalize_end_date, weeks_between
from shopspan.schemas import CHURN_OUTPUT_COLUMNS


def household_kpis(household_weeks: DataFrame, max_week: date, n_weeks: int) -> DataFrame:
    """First and last active week, sales and transactions in the latest ``n_weeks``."""
    week = F.col("week_ending_date")
    first = max_week - timedelta(weeks=n_weeks - 1)
    return household_weeks.where(week.between(F.lit(first), F.lit(max_week))).groupBy("hhn").agg(
        F.lit(max_week).alias("max_week_ending_date"),
        F.max(week).alias("last_event"),
        F.min(week).alias("first_event"),
        F.sum("sales_dollars").alias("historical_sales"),
        F.sum("n_transaction").cast("short").alias("historical_transactions"),
        F.lit(n_weeks).cast("short").alias("historical_kpis_num_weeks"),
    )


def with_recency(kpis: DataFrame, n_weeks_churn: int) -> DataFrame:
    last, first, now = F.col("last_event"), F.col("first_event"), F.col("max_week_ending_date")
    left = F.greatest(F.lit(0), n_weeks_churn - F.datediff(now, last) / 7)
    return kpis.withColumns(
        {
            "weeks_since_first_shop": weeks_between(now, first),
            "weeks_since_last_shop": weeks_between(now, last),
            "tenure_4wk_periods": F.ceil((F.datediff(now, first) / 7 + 1) / 4).cast("short"),
            "weeks_until_churned": left.cast("byte"),
        }
    )


def churn_probability(weeks_left, alpha, beta):
    """Chance of no purchase in the weeks left; 1 when the household is overdue."""
    return F.exp(-weibull.cumulative_hazard(weeks_left, alpha, beta))


def churn_output(
    scored: DataFrame,
    kpis: DataFrame,
    n_weeks_churn: int,
    model_version: str,
    prediction_date: date | str | None = None,
) -> DataFrame:
    """Scored households that have history in the window."""
    joined = scored.select("hhn", "alpha", "beta").join(with_recency(kpis, n_weeks_churn), "hhn")
    return joined.withColumns(
        {
            "prediction_date": F.lit(normalize_end_date(prediction_date)),
            "churn_probability": churn_probability(
                F.col("weeks_until_churned"), F.col("alpha"), F.col("beta")
            ),
            "churn_definition_weeks": F.lit(n_weeks_churn).cast("byte"),
            "model_version": F.lit(model_version),
            "table_update_dt": F.current_timestamp(),
        }
    ).select(*CHURN_OUTPUT_COLUMNS)


def latest_predictions(churn_rows: DataFrame) -> DataFrame:
    """Rows of the last update per household, week and prediction date; ties stay.

    Aggregate and join instead of a window: a key repeated very often is combined
    before the shuffle on one side and split by adaptive skew handling on the other.
    """
    keys = ["hhn", "max_week_ending_date", "prediction_date"]
    newest = churn_rows.groupBy(*keys).agg(F.max("table_update_dt").alias("table_update_dt"))
    return churn_rows.join(newest, [*keys, "table_update_dt"], "left_semi")
