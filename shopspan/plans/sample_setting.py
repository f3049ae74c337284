"""Parameters that fit the test star schema (see the adapters in sources.tables)."""

from __future__ import annotations

from datetime import date

from shopspan.config import RetentionParams

END_DATE = date(2001, 8, 1)

SAMPLE_PARAMS = RetentionParams(
    end_date_train=END_DATE,
    end_date_pred=END_DATE,
    train_frac=0.7,
    test_frac=0.3,
    listed_banners=("AMERICA", "ASIA", "EUROPE"),
    default_region="NATION_21",
    households_per_batch=100,
    excluded_card_types=("MACHINERY",),
    # Tables here have thousands of rows where production has billions.
    min_rows_per_week=1,
    min_sales_per_week=1.0,
    min_units_per_week=1.0,
    min_households_per_week=1,
)
