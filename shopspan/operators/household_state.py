"""What segments need to know of each household, kept from week to week.

A state is one row per household: the weeks of the window in which it has a row, those in which it bought, and its latest region.
The state of a week is that of the week before, less the week that leaves the window, plus the new week's rows. A run thus reads one
week of household rows and one state instead of all weeks of the window, and gives the same rows as a full build.

Each week's state is a partition of its own and stays as it was written, so a week may be run again, also with corrected rows; later
weeks are then run again after it. Weeks are days since 1970-01-01; lists are at most as long as the window.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopspan.operators.features import REGION, with_region_index
from shopspan.operators.fitting import with_bins
from shopspan.schemas import STORE_FEATURE
from shopspan.sources import sinks

EPOCH = date(1970, 1, 1)
COLUMNS = ("hhn", "weeks", "events", REGION)
SCHEMA = f"hhn bigint, weeks array<int>, events array<int>, {REGION} string, window_weeks int, as_of date"


def _day(week: date) -> int:
    return (week - EPOCH).days


def _first_day(week: date, n_weeks: int) -> int:
    return _day(week) - 7 * (n_weeks - 1)


def build_state(rows: DataFrame, week: date, n_weeks: int) -> DataFrame:
    """State as of ``week`` from the household rows of its window; households without a row have none."""
    day = F.unix_date("week_ending_date")
    return (
        rows.where(F.col("week_ending_date").between(F.lit(week - timedelta(weeks=n_weeks - 1)), F.lit(week)))
        .groupBy("hhn")
        .agg(
            F.sort_array(F.collect_set(day)).alias("weeks"),
            F.sort_array(F.collect_set(F.when(F.col("n_transaction") > 0, day))).alias("events"),
            F.max_by(REGION, "week_ending_date").alias(REGION),
        )
    )


def advance(previous: DataFrame, new_rows: DataFrame, week: date, n_weeks: int) -> DataFrame:
    """State as of ``week`` from the state of the week before and the rows of ``week`` alone."""
    old = previous.select("hhn", *[F.col(c).alias(f"old_{c}") for c in COLUMNS[1:]])
    joined = old.join(build_state(new_rows, week, 1), "hhn", "full")
    first = F.lit(_first_day(week, n_weeks))
    none = F.array().cast("array<int>")

    def moved(c: str) -> Column:
        # The new week is later than all others, so the order stays.
        return F.concat(F.filter(F.coalesce(f"old_{c}", none), lambda d: d >= first), F.coalesce(c, none)).alias(c)

    # A household's latest region is that of its latest row, which a null region of the new week replaces too.
    region = F.when(F.size("weeks") > 0, F.col(REGION)).otherwise(F.col(f"old_{REGION}")).alias(REGION)
    return joined.select("hhn", moved("weeks"), moved("events"), region).where(F.size("weeks") > 0)


def advance_stored(path: str, household_weeks: DataFrame, week: date, n_weeks: int) -> None:
    """Write the state of ``week``, from the stored state of the week before where there is one with the same window.

    ``household_weeks`` needs hhn, week_ending_date, n_transaction and the region. Where no state can be moved on, it is built from
    all weeks of the window.
    """
    stored = sinks.read_if_exists(household_weeks.sparkSession, path, SCHEMA)
    previous = None
    if stored is not None:
        previous = stored.where((F.col("as_of") == F.lit(week - timedelta(weeks=1))) & (F.col("window_weeks") == n_weeks))
    if previous is None or previous.isEmpty():
        state = build_state(household_weeks, week, n_weeks)
    else:
        state = advance(previous, household_weeks.where(F.col("week_ending_date") == F.lit(week)), week, n_weeks)
    sinks.overwrite_partitions(state.withColumns({"window_weeks": F.lit(n_weeks), "as_of": F.lit(week)}), path, "as_of")


def stored_state(path: str, spark, week: date) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path).where(F.col("as_of") == F.lit(week)).select(*COLUMNS)


def state_segments(state: DataFrame, week: date, lookup: DataFrame, default_region: str) -> DataFrame:
    """Segment of each household as of ``week``; equals ``fitting.current_segments`` over the window's rows."""
    last = F.lit(_day(week))
    facts = with_region_index(state, lookup, default_region).select(
        "hhn",
        ((last - F.try_element_at("events", F.lit(-1))) / 7).cast("int").alias("recency"),
        F.size("events").cast("long").alias("n_events"),
        ((last - F.col("weeks")[0]) / 7 + 1).cast("int").alias("n_steps"),
        F.col(STORE_FEATURE).cast("int").alias("region_id"),
    )
    return with_bins(facts)
