"""History windows, hash splits, undersampling and folds.

Every choice is a pure function of the household id, so a recomputed task picks the
same households again.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopspan.config import RetentionParams
from shopspan.functions.dates import normalize_end_date
from shopspan.operators.ordering import ordered_positions
from shopspan.schemas import SUBSET_COLUMNS, require_columns
from shopspan.sources.staging import staged

HASH_SPACE = 2**32


def history_window(household_weeks: DataFrame, end_date: date | str | None, n_weeks: int) -> DataFrame:
    """Weeks before ``end_date``, going back ``n_weeks``; literals reach the scan."""
    end = normalize_end_date(end_date)
    week = F.col("week_ending_date")
    return household_weeks.where(
        (week < F.lit(end)) & (week >= F.lit(end - timedelta(weeks=n_weeks)))
    )


def household_hash(seed: int | None = None) -> Column:
    """CRC-32 of the household id as text, optionally salted."""
    text = F.col("hhn").cast("string")
    return F.crc32(text if seed is None else F.concat(F.lit(f"{seed}:"), text))


def hash_split(df: DataFrame, fraction: float | None, lower: float = 0.0) -> DataFrame:
    """Households whose hash lies in (lower, lower + fraction] of the hash space."""
    if fraction is None:
        return df
    place = household_hash()
    return df.where(
        (place > lower * HASH_SPACE) & (place <= (lower + fraction) * HASH_SPACE)
    )


def subset(
    household_weeks: DataFrame,
    end_date: date | str | None,
    n_weeks: int,
    fraction: float | None = 0.2,
    lower: float = 0.0,
    batches=None,
) -> DataFrame:
    rows = history_window(household_weeks, end_date, n_weeks)
    if batches is not None:
        wanted = [batches] if isinstance(batches, int) else list(batches)
        rows = rows.where(F.col("hhn_batch_num").isin(wanted))
    return require_columns(hash_split(rows, fraction, lower), SUBSET_COLUMNS)


def train_subset(household_weeks: DataFrame, p: RetentionParams) -> DataFrame:
    return subset(
        household_weeks, p.end_date_train, p.n_weeks_total_train, p.train_frac, 0.0,
        p.batch_numbers_train,
    )


def test_subset(household_weeks: DataFrame, p: RetentionParams) -> DataFrame:
    lower = 0.0 if p.test_frac is None else 1 - p.test_frac
    return subset(
        household_weeks, p.end_date_train, p.n_weeks_total_train, p.test_frac, lower,
        p.batch_numbers_train,
    )


def prediction_subset(household_weeks: DataFrame, p: RetentionParams) -> DataFrame:
    """All scored households in one pass: the hash range (0, fraction]."""
    fraction = 1.0 if p.predict_frac is None else p.predict_frac
    return subset(household_weeks, p.end_date_pred, p.n_weeks_total_pred, fraction)


def prediction_half(household_weeks: DataFrame, p: RetentionParams, lower_half: bool) -> DataFrame:
    """One of the two adjacent hash ranges that make up ``prediction_subset``."""
    half = 0.5 if p.predict_frac is None else p.predict_frac / 2
    return subset(
        household_weeks, p.end_date_pred, p.n_weeks_total_pred, half, 0.0 if lower_half else half
    )


def household_sizes(rows: DataFrame) -> DataFrame:
    """Active weeks per household and the four-week-wide bin they fall in."""
    return rows.groupBy("hhn").agg(F.count(F.lit(1)).alias("num_active_week")).withColumn(
        "size_bin", F.floor((F.col("num_active_week") - 1) / 4)
    )


def size_bins(rows: DataFrame) -> DataFrame:
    return household_sizes(rows).groupBy("size_bin").agg(F.count(F.lit(1)).alias("hh_count"))


def bin_cutoff(bins: DataFrame, quantile: float) -> DataFrame:
    """Interpolated quantile of the bin sizes, rounded down. A few dozen bins at most."""
    return bins.agg(F.floor(F.percentile("hh_count", quantile)).alias("cutoff"))


def kept_households(rows: DataFrame, quantile: float, seed: int) -> DataFrame:
    """Households that stay when bins above the cutoff are cut down to it.

    Oversize bins keep the households with the smallest salted hashes. The rank is
    taken over spread-out slices, so a bin may hold any share of all households.
    """
    # One small row per household, read by the bins and by both kinds of bin below.
    sizes = staged(household_sizes(rows), "household-sizes")
    bins = sizes.groupBy("size_bin").agg(F.count(F.lit(1)).alias("hh_count"))
    limits = bins.withColumn("cutoff", bin_cutoff(bins, quantile).scalar())
    # One row per bin of active weeks: at most a quarter of the window's weeks.
    marked = sizes.join(F.broadcast(limits), "size_bin")
    whole = marked.where("hh_count <= cutoff").select("hhn", "size_bin")
    oversize = marked.where("hh_count > cutoff").select(
        "hhn", "size_bin", "cutoff", household_hash(seed).alias("draw")
    )
    ranked = ordered_positions(oversize, ["size_bin"], [F.asc("draw"), F.asc("hhn")])
    return whole.unionByName(ranked.where("position < cutoff").select("hhn", "size_bin"))


def undersample(rows: DataFrame, quantile: float | None, seed: int = 123) -> DataFrame:
    if quantile is None:
        return rows
    return rows.join(kept_households(rows, quantile, seed).select("hhn"), "hhn", "left_semi")


def assign_folds(df: DataFrame, n_folds: int, seed: int) -> DataFrame:
    """Near-equal test folds by salted hash."""
    return df.withColumn("fold", F.pmod(household_hash(seed), F.lit(n_folds)).cast("int"))
