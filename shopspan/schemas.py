"""Column contracts of the produced tables.

Fixed values: the names and their order are what readers of the tables expect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Columns of a train / test / prediction subset of the household-week table.
SUBSET_COLUMNS = (
    "year_number", "week_number", "week_ending_date", "hhn",
    "n_transaction", "n_ecomm_trans", "maxsales_location_id",
    "sales_dollars", "extended_cost", "units_sales", "unit_offer_ratio",
    "points_earned", "points_redeemed", "redeem_count",
    "divisional_regional_rollup", "median_sales", "median_units_sales",
    "avg_n_transaction", "avg_n_ecomm_trans",
)

# Model inputs. The order is part of the exported vector's layout.
RESCALED_FEATURES = (
    "n_transaction", "n_ecomm_trans", "sales_dollars", "extended_cost",
    "units_sales", "points_earned", "points_redeemed", "redeem_count",
    "avg_n_transaction", "avg_n_ecomm_trans", "median_sales",
    "median_units_sales",
)
PLAIN_FEATURES = ("unit_offer_ratio", "week_in_year_cos", "week_in_year_sin")
NUMERIC_FEATURES = RESCALED_FEATURES + PLAIN_FEATURES
STORE_FEATURE = "div_reg_index"
ALL_FEATURES = NUMERIC_FEATURES + (STORE_FEATURE,)

FEATURE_TYPES = {
    **{name: "double" for name in NUMERIC_FEATURES},
    "n_transaction": "int",
    "n_ecomm_trans": "int",
    "points_earned": "bigint",
    "points_redeemed": "bigint",
    "redeem_count": "bigint",
    STORE_FEATURE: "int",
}

CLIPPED_COLUMNS = (
    "sales_dollars", "extended_cost", "units_sales", "points_earned",
    "points_redeemed",
)

CHURN_OUTPUT_COLUMNS = (
    "prediction_date", "max_week_ending_date", "hhn", "alpha", "beta",
    "churn_probability", "churn_definition_weeks", "weeks_until_churned",
    "weeks_since_last_shop", "weeks_since_first_shop", "model_version",
    "table_update_dt",
)

HOUSEHOLD_CHURN_COLUMNS = (
    "max_week_ending_date", "hhn", "churn_probability",
    "weeks_since_last_shop", "next_week_shop_prob", "annualized_sales",
    "churn_segment", "prediction_date",
)


def require_columns(df: DataFrame, columns) -> DataFrame:
    """Project to a contract; a missing column fails analysis at once."""
    return df.select(*columns)
