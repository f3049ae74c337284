"""Model inputs at household-week grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopspan.functions.dates import week_phase
from shopspan.functions.measures import clip_at_zero
from shopspan.schemas import (
    ALL_FEATURES, CLIPPED_COLUMNS, FEATURE_TYPES, RESCALED_FEATURES, STORE_FEATURE,
)

REGION = "divisional_regional_rollup"


def region_lookup(rows: DataFrame) -> DataFrame:
    """Regions numbered from 1 in name order; 0 stays free for absent weeks."""
    regions = rows.select(REGION).distinct()
    # One row per sales region, so one task is enough for the numbering.
    by_name = Window.partitionBy(F.lit(0)).orderBy(REGION)
    return regions.select(F.row_number().over(by_name).alias(STORE_FEATURE), REGION)


def default_index(lookup: DataFrame, default_region: str) -> int:
    row = lookup.where(F.col(REGION) == default_region).first()
    if row is None:
        raise ValueError(f"default region {default_region!r} is not in the lookup")
    return row[STORE_FEATURE]


def with_region_index(rows: DataFrame, lookup: DataFrame, default_region: str) -> DataFrame:
    """Region number of each row; regions the lookup does not know get the default's."""
    fallback = F.lit(default_index(lookup, default_region))
    # One row per sales region.
    return rows.join(F.broadcast(lookup), REGION, "left").withColumn(
        STORE_FEATURE, F.coalesce(STORE_FEATURE, fallback)
    )


def unseen_regions(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    return rows.select(REGION).distinct().join(F.broadcast(lookup), REGION, "left_anti")


def region_cardinality(indexed: DataFrame) -> DataFrame:
    """Distinct region numbers in use, plus one for absent weeks."""
    return indexed.agg((F.count_distinct(STORE_FEATURE) + 1).alias("div_reg_unique_count"))


def household_features(rows: DataFrame, lookup: DataFrame, default_region: str) -> DataFrame:
    """Clip, embed the week number, index the region and cast: 16 features per row."""
    cos, sin = week_phase(F.col("week_number"))
    clipped = rows.withColumns({c: clip_at_zero(F.col(c)) for c in CLIPPED_COLUMNS}).withColumns(
        {"week_in_year_cos": cos, "week_in_year_sin": sin}
    )
    return with_region_index(clipped, lookup, default_region).select(
        "hhn", "week_ending_date", *[F.col(c).cast(FEATURE_TYPES[c]).alias(c) for c in ALL_FEATURES]
    )


def rescale(df: DataFrame, columns=RESCALED_FEATURES) -> DataFrame:
    return df.withColumns({c: F.log1p(c) for c in columns})
