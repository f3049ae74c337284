"""Run parameters.

Defaults are the production setting; ``RetentionParams.dev()`` is the small one.
The object is frozen, so one run cannot leak changed values into another.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date


@dataclass(frozen=True)
class RetentionParams:
    # Dates: None means "today".
    end_date_train: date | str | None = None
    end_date_pred: date | str | None = None

    # Lengths in weeks.
    n_weeks_total_train: int = 156
    n_weeks_total_pred: int = 156
    n_weeks_stats: int = 156
    n_weeks_churn: int = 13
    n_validation_steps: int = 17
    n_testing_steps: int = 17
    min_box_width: int = 10
    # Share of the steps that validation cuts off; must agree with the number if given.
    validation_fraction: float | None = None
    consider_last_event: bool = True

    # Household shares taken by the hash split; None means every household.
    train_frac: float | None = 0.15
    test_frac: float | None = 0.025
    predict_frac: float | None = None
    batch_numbers_train: tuple[int, ...] | None = None
    households_per_batch: int = 25_000

    # Preparation.
    undersample_quantile: float | None = 0.6
    # Seeds and fillings that stored samples and vectors were made with.
    sample_seed: int = 123
    mask_value: float = 0.133713371337
    censor_dummy: float = 0.5

    # Model comparison.
    n_folds: int = 5
    fold_seed: int = 101
    t_test_level: float = 0.05
    recent_runs_hours: int = 24
    # A model is trained anew when the newest is this old.
    max_model_age_days: int = 60

    # Business rules that depend on whose data is read.
    listed_banners: tuple[str, ...] = ()
    default_region: str | None = None
    excluded_card_types: tuple[str, ...] = ()

    # Gold tables.
    lookback_years: int = 2
    period_weeks: int = 13
    # Keep each customer's sums of the window and move them on by one week of lines a run.
    rolling_sales: bool = False

    # Data-quality floors.
    min_rows_per_week: int = 600_000
    min_sales_per_week: float = 60_000_000
    min_units_per_week: float = 15_000_000
    min_households_per_week: int = 2_500_000

    @classmethod
    def dev(cls, **changes) -> "RetentionParams":
        small = cls(
            n_weeks_total_train=35,
            n_weeks_total_pred=35,
            n_weeks_stats=35,
            train_frac=0.001,
            test_frac=0.001,
            predict_frac=0.001,
            min_households_per_week=1_000,
        )
        return replace(small, **changes)
