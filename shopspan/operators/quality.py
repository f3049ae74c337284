"""Data-quality rules.

All rules of one grain are evaluated in one aggregation; the result is a small
table (rule, observed, passed). ``require`` turns failures into an exception.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopspan.config import RetentionParams
from shopspan.operators.calendar import holiday_weeks


class QualityError(Exception):
    pass


class WeeklyFloor(NamedTuple):
    """The weekly value must not fall below ``floor`` in any week."""

    name: str
    measure: Column
    floor: float


class RowRule(NamedTuple):
    """No row may satisfy ``violated``."""

    name: str
    violated: Column


def _as_table(one_row: DataFrame, entries: list[tuple[str, Column, Column]]) -> DataFrame:
    structs = [
        F.struct(F.lit(name).alias("rule"), observed.cast("double").alias("observed"),
                 F.coalesce(passed, F.lit(False)).alias("passed"))
        for name, observed, passed in entries
    ]
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _numeric(df: DataFrame, skip=()) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def row_checks(df: DataFrame, rules: list[RowRule], not_null=None, not_all_zero=None) -> DataFrame:
    """Row rules, null counts per column and all-zero columns in one pass."""
    nulls = df.columns if not_null is None else list(not_null)
    zeros = _numeric(df) if not_all_zero is None else list(not_all_zero)
    measures = [F.count(F.lit(1)).alias("total")]
    entries = []
    for c in nulls:
        measures.append(F.count_if(F.col(c).isNull()).alias(f"null_{c}"))
        entries.append((f"no_nulls:{c}", F.col(f"null_{c}"), F.col(f"null_{c}") == 0))
    for c in zeros:
        measures.append(F.count_if(F.col(c) == 0).alias(f"zero_{c}"))
        entries.append((f"not_all_zero:{c}", F.col(f"zero_{c}"), F.col(f"zero_{c}") < F.col("total")))
    for i, rule in enumerate(rules):
        measures.append(F.count_if(rule.violated).alias(f"rule_{i}"))
        entries.append((rule.name, F.col(f"rule_{i}"), F.col(f"rule_{i}") == 0))
    return _as_table(df.agg(*measures), entries)


def weekly_checks(df: DataFrame, floors: list[WeeklyFloor], week=("year_number", "week_number")) -> DataFrame:
    """Smallest weekly value of every measure against its floor."""
    per_week = df.groupBy(*week).agg(*[f.measure.alias(f"m{i}") for i, f in enumerate(floors)])
    lowest = per_week.agg(*[F.min(f"m{i}").alias(f"m{i}") for i in range(len(floors))])
    # No week at all means no week below the floor.
    entries = [
        (f.name, F.col(f"m{i}"), F.coalesce(F.col(f"m{i}") >= f.floor, F.lit(True)))
        for i, f in enumerate(floors)
    ]
    return _as_table(lowest, entries)


def schema_check(df: DataFrame, expected) -> DataFrame:
    """The column list must match exactly, in order."""
    same = list(df.columns) == list(expected)
    return df.sparkSession.range(1).select(
        F.lit("exact_columns").alias("rule"), F.lit(float(not same)).alias("observed"),
        F.lit(same).alias("passed"),
    )


def outside(column: str, lo: float, hi: float) -> Column:
    return (F.col(column) < lo) | (F.col(column) > hi)


def _weekly_floors(p: RetentionParams) -> list[WeeklyFloor]:
    return [
        WeeklyFloor("rows_per_week", F.count(F.lit(1)), p.min_rows_per_week),
        WeeklyFloor("sales_per_week", F.sum("sales_dollars"), p.min_sales_per_week),
        WeeklyFloor("units_per_week", F.sum("units_sales"), p.min_units_per_week),
    ]


def check_customer_weeks(df: DataFrame, p: RetentionParams) -> DataFrame:
    return weekly_checks(df, _weekly_floors(p)).unionByName(row_checks(df, []))


def check_household_weeks(df: DataFrame, p: RetentionParams) -> DataFrame:
    rules = [
        RowRule("avg_n_transaction_at_least_1", F.col("avg_n_transaction") < 1),
        RowRule("avg_n_ecomm_trans_not_0", F.col("avg_n_ecomm_trans") == 0),
        RowRule("unit_offer_ratio_in_0_1", outside("unit_offer_ratio", 0, 1)),
    ]
    return weekly_checks(df, _weekly_floors(p)).unionByName(row_checks(df, rules))


def check_churn_output(df: DataFrame, p: RetentionParams) -> DataFrame:
    n = p.n_weeks_total_pred
    rules = [
        RowRule("churn_probability_in_0_1", outside("churn_probability", 0, 1)),
        RowRule("weeks_until_churned_in_range", outside("weeks_until_churned", 0, p.n_weeks_churn)),
        RowRule("alpha_beta_positive", (F.col("alpha") <= 0) | (F.col("beta") <= 0)),
        RowRule(
            "weeks_since_shop_in_range",
            (F.col("weeks_since_last_shop") > n) | (F.col("weeks_since_first_shop") > n),
        ),
    ]
    return row_checks(df, rules)


def low_weeks_except_holiday(df: DataFrame, dim_date: DataFrame, floor: int) -> DataFrame:
    """Weeks with too few households, unless they contain the holiday."""
    low = df.groupBy("max_week_ending_date").agg(F.count(F.lit(1)).alias("n_households")).where(
        F.col("n_households") < floor
    )
    exempt = holiday_weeks(dim_date).withColumnRenamed("week_end_date", "max_week_ending_date")
    return low.join(F.broadcast(exempt), "max_week_ending_date", "left_anti")


def check_fits(fitted: DataFrame) -> DataFrame:
    """Every segment's fit has converged, and there is one."""
    one = fitted.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("converged")).alias("open"))
    return _as_table(one, [("has_fits", F.col("n"), F.col("n") > 0), ("converged", F.col("open"), F.col("open") == 0)])


def require_feature_count(df: DataFrame, features, keys=("hhn", "week_ending_date")) -> None:
    """Exactly the features a model is fitted on, beside the keys."""
    found = [c for c in df.columns if c not in keys]
    if sorted(found) != sorted(features):
        raise QualityError(f"expected {len(features)} features, found {len(found)}: {sorted(set(found) ^ set(features))}")


def check_household_churn(df: DataFrame, dim_date: DataFrame, p: RetentionParams, columns) -> DataFrame:
    probability = RowRule("churn_probability_in_0_1", outside("churn_probability", 0, 1))
    too_few = low_weeks_except_holiday(df, dim_date, p.min_households_per_week).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        schema_check(df, columns)
        .unionByName(row_checks(df, [probability], not_all_zero=[]))
        .unionByName(_as_table(too_few, [("households_per_week", F.col("n"), F.col("n") == 0)]))
        .unionByName(_as_table(df.agg(F.count(F.lit(1)).alias("n")), [("not_empty", F.col("n"), F.col("n") > 0)]))
    )


def require(results: DataFrame, table: str) -> None:
    """Raise with every failed rule. The result table has one row per rule."""
    failed = results.where("NOT passed").collect()
    if failed:
        listed = ", ".join(f"{r['rule']} (observed {r['observed']})" for r in failed)
        raise QualityError(f"{table}: {listed}")


def require_single_value(df: DataFrame, column: str):
    """The one value a partition-scoped write may touch."""
    values = df.select(column).distinct().limit(2).collect()
    if len(values) != 1:
        raise QualityError(f"expected exactly one {column}, found {'several' if values else 'none'}")
    return values[0][0]
