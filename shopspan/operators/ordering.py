"""Ranks and running sums over groups too large for one task.

A window over a whole group sorts that group in a single task. Here Spark's range
sort spreads each group over many tasks, every task counts inside its own slice, and
a small table of slice totals (at most slices + groups rows) supplies the offsets.
The sorted slices are stored first, so slice borders cannot move between the two
passes or after a lost executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopspan.sources.staging import staged


def _sorted_slices(df: DataFrame, group: list[str], order: list) -> DataFrame:
    return staged(
        df.orderBy(*[F.asc(g) for g in group], *order)
        .withColumn("slice", F.spark_partition_id())
        .withColumn("slot", F.monotonically_increasing_id()),
        "sorted",
    )


def _before_slice(totals: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Sums over the earlier slices of the same group. One row per slice and group."""
    earlier = (
        Window.partitionBy(*(group or [F.lit(0)]))
        .orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.select(
        *group, "slice",
        *[c for c in totals.columns if c not in {*group, "slice", *columns}],
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in columns],
    )


def ordered_positions(df: DataFrame, group: list[str], order: list) -> DataFrame:
    """Add the 0-based ``position`` of each row within its group."""
    rows = _sorted_slices(df, group, order)
    totals = rows.groupBy(*group, "slice").agg(
        F.count(F.lit(1)).alias("n"), F.min("slot").alias("first_slot")
    )
    offsets = F.broadcast(_before_slice(totals, group, ["n"]))
    return rows.join(offsets, [*group, "slice"]).select(
        *df.columns,
        (F.col("slot") - F.col("first_slot") + F.col("n_before")).alias("position"),
    )


def running_sums(df: DataFrame, group: list[str], order: list, columns: list[str]) -> DataFrame:
    """Add ``cum_<column>``: the sum up to and including the row, per group."""
    rows = _sorted_slices(df, group, order)
    totals = rows.groupBy(*group, "slice").agg(*[F.sum(c).alias(c) for c in columns])
    offsets = F.broadcast(_before_slice(totals, group, columns))
    inside = (
        Window.partitionBy(*group, "slice")
        .orderBy("slot")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.select("*", *[F.sum(c).over(inside).alias(f"{c}_inside") for c in columns])
        .join(offsets, [*group, "slice"])
        .select(
            *df.columns,
            *[(F.col(f"{c}_inside") + F.col(f"{c}_before")).alias(f"cum_{c}") for c in columns],
        )
    )


def next_values(df: DataFrame, group: list[str], order: list, columns: list[str]) -> DataFrame:
    """Add ``next_<column>``: the value of the following row of the group, null for the last."""
    rows = _sorted_slices(df, group, order)
    first = F.min_by(F.struct(*columns), "slot")
    # One row per slice and group; a slice's last row continues in the group's next slice.
    after = Window.partitionBy(*(group or [F.lit(0)])).orderBy("slice")
    starts = rows.groupBy(*group, "slice").agg(first.alias("start")).select(
        *group, "slice", F.lead("start").over(after).alias("start_after")
    )
    inside = Window.partitionBy(*group, "slice").orderBy("slot")
    following = F.coalesce(F.lead(F.struct(*columns)).over(inside), F.col("start_after"))
    return (
        rows.join(F.broadcast(starts), [*group, "slice"])
        .withColumn("following", following)
        .select(*df.columns, *[F.col(f"following.{c}").alias(f"next_{c}") for c in columns])
    )
