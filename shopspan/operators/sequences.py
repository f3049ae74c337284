"""Weekly sequences and their time-to-event targets, in long form.

Vocabulary: ``k`` is the step on the common calendar axis, ``t`` the step since the
household's first active week; ``k - t`` is constant per household. Padding is the
absence of a row. All windows here partition by household and see at most one row
per axis step, and all of them share one hash partitioning.

Windows that look ahead run over descending ``t``: a growing frame costs one pass,
while a shrinking one would be re-evaluated for every row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopspan.operators.calendar import WeekSpan
from shopspan.schemas import ALL_FEATURES, RESCALED_FEATURES



def _backward():
    return Window.partitionBy("hhn").orderBy(F.desc("t"))


def _from_here_on():
    return _backward().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _after_here():
    return _backward().rowsBetween(Window.unboundedPreceding, -1)


def read_axis(rows: DataFrame) -> WeekSpan:
    """First and last week present, as two scalars."""
    row = rows.agg(
        F.min("week_ending_date").alias("lo"), F.max("week_ending_date").alias("hi")
    ).first()
    if row["lo"] is None:
        raise ValueError("the subset holds no rows")
    return WeekSpan(row["lo"], row["hi"])


def axis_length(axis: WeekSpan, step_days: int = 7) -> int:
    return (axis.last - axis.first).days // step_days + 1


#: Dense rows of one task: what its windows sort and keep in memory.
ROWS_PER_TASK = 200_000


def dense_tasks(features: DataFrame, axis: WeekSpan, step_days: int = 7, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Tasks for the dense rows, from their exact number: first weeks say how many each household will have."""
    first = features.groupBy("hhn").agg(F.min("week_ending_date").alias("first"))
    steps = F.floor(F.datediff(F.lit(axis.last), "first") / step_days) + 1
    return max(1, math.ceil((first.agg(F.sum(steps)).first()[0] or 0) / rows_per_task))


def densify(
    features: DataFrame, axis: WeekSpan, columns=ALL_FEATURES, step_days: int = 7
) -> DataFrame:
    """One row per household and step, from its first active week to the axis end.

    Steps without a row get zero in every feature. Each row is expanded over the gap
    up to the household's next row, so no axis table is joined in. Several rows of
    one household and week are averaged.

    Households are dealt by the number of their dense rows: by the few rows before the expansion
    Spark would choose far too few tasks for what follows.
    """
    forward = Window.partitionBy("hhn").orderBy("week_ending_date")
    per_week = (
        features.repartition(dense_tasks(features, axis, step_days), "hhn")
        .groupBy("hhn", "week_ending_date")
        .agg(*[F.avg(c).alias(c) for c in columns])
    )
    week = F.col("week_ending_date")
    past_end = F.date_add(F.lit(axis.last), step_days)
    covered = F.datediff(F.coalesce(F.lead(week).over(forward), past_end), week)
    return (
        per_week.select(
            "hhn", week, *columns,
            F.min(week).over(forward).alias("first_week"),
            (covered / step_days).cast("int").alias("n_covered"),
        )
        .withColumn("fill", F.explode(F.sequence(F.lit(0), F.col("n_covered") - 1)))
        .withColumn("week_ending_date", F.date_add(week, F.col("fill") * step_days))
        .select(
            "hhn",
            "week_ending_date",
            (F.datediff(week, F.lit(axis.first)) / step_days).cast("int").alias("k"),
            (F.datediff(week, F.col("first_week")) / step_days).cast("int").alias("t"),
            *[F.when(F.col("fill") == 0, F.coalesce(c, F.lit(0.0))).otherwise(0.0).alias(c)
              for c in columns],
        )
    )


def prediction_sequences(features: DataFrame, axis: WeekSpan) -> DataFrame:
    """Dense, rescaled sequences up to the axis end, keyed by household and step, without targets."""
    return densify(features, axis).withColumns({c: F.log1p(c) for c in RESCALED_FEATURES})


def flag_events(dense: DataFrame, feature: str = "n_transaction") -> DataFrame:
    return dense.withColumn("event", (F.col(feature) > 0).cast("int"))


def left_padded(rows: DataFrame, n_steps: int) -> DataFrame:
    """Place sequences that only know ``t`` = 1.. so that all end at step ``n_steps``."""
    length = F.max("t").over(Window.partitionBy("hhn"))
    return rows.withColumn("k", (F.col("t") + n_steps - length).cast("int"))


def right_padded(rows: DataFrame) -> DataFrame:
    """The reverse: ``t`` = 1.. from each household's first step on the common axis."""
    first = F.min("k").over(Window.partitionBy("hhn"))
    return rows.withColumn("t", (F.col("k") - first + 1).cast("int"))


def sequence_lengths(rows: DataFrame) -> DataFrame:
    return rows.groupBy("hhn").agg(F.count(F.lit(1)).alias("seq_length"))


def tte_discrete(position: str = "t") -> Column:
    """Steps to the next event at or after this step; past the end if there is none."""
    at = F.col(position)
    following = F.min(F.when(F.col("event") == 1, at)).over(_from_here_on())
    return F.coalesce(following, F.max(at).over(_from_here_on()) + 1) - at


def tte_continuous(position: str = "t") -> Column:
    """Distance to the next event strictly after this point, else to the last point."""
    at = F.col(position)
    following = F.min(F.when(F.col("event") == 1, at)).over(_after_here())
    return F.coalesce(following, F.max(at).over(_from_here_on())) - at


def uncensored_discrete() -> Column:
    return F.max("event").over(_from_here_on())


def uncensored_continuous() -> Column:
    return F.coalesce(F.max("event").over(_after_here()), F.lit(0))


def with_targets(rows: DataFrame, discrete: bool = True, position: str = "t") -> DataFrame:
    if discrete:
        return rows.withColumns({"tte": tte_discrete(position), "u": uncensored_discrete()})
    return rows.withColumns({"tte": tte_continuous(position), "u": uncensored_continuous()})


def drop_last_steps(rows: DataFrame, n_axis: int, n_drop: int) -> DataFrame:
    """Cut the end of the calendar axis; households that start in it vanish."""
    return rows.where(F.col("k") < n_axis - n_drop)


def pair_with_next_target(rows: DataFrame) -> DataFrame:
    """Features of one step beside the target of the next.

    ``t`` and ``k`` name the target's step, so the first one is 1.
    """
    target = F.lag(F.struct("tte", "u", "event")).over(_backward())
    return (
        rows.withColumn("target", target)
        .where(F.col("target").isNotNull())
        .withColumns(
            {
                "t": F.col("t") + 1,
                "k": F.col("k") + 1,
                "tte": F.col("target.tte"),
                "u": F.col("target.u"),
                "event": F.col("target.event"),
            }
        )
        .drop("target", "week_ending_date")
    )


def steps_to_cut(n_axis: int, n_steps: int | None = None, fraction: float | None = None) -> int:
    if fraction is None:
        if n_steps is None:
            raise ValueError("give the number or the fraction of steps to cut")
        return n_steps
    by_fraction = math.floor(n_axis * fraction)
    if n_steps is not None and n_steps != by_fraction:
        raise ValueError(f"{n_steps} steps and fraction {fraction} ({by_fraction} steps) disagree")
    return by_fraction


def train_sequences(dense: DataFrame, n_axis: int, n_cut: int) -> DataFrame:
    """Targets see nothing of the cut-off steps: events there count as censored."""
    kept = drop_last_steps(flag_events(dense), n_axis, n_cut)
    return pair_with_next_target(with_targets(kept))


def valid_sequences(dense: DataFrame, n_axis: int, n_cut: int, to_keep: int) -> DataFrame:
    """Targets know the full history; only steps past the training end weigh 1."""
    paired = pair_with_next_target(with_targets(flag_events(dense)))
    kept = drop_last_steps(paired, n_axis, n_cut - to_keep).withColumn(
        "weight", (F.col("k") >= n_axis - n_cut).cast("double")
    )
    household = Window.partitionBy("hhn")
    return (
        kept.withColumn("held_out", F.max("weight").over(household))
        .where("held_out > 0")
        .drop("held_out")
    )


def time_since_last_event(rows: DataFrame, cutoff: int, index: str = "k") -> DataFrame:
    """Steps from the last event up to ``cutoff``; without one, ``cutoff`` and not valid."""
    at = F.col(index)
    return rows.groupBy("hhn").agg(
        F.max(F.when((F.col("tte") == 0) & (at <= cutoff), at)).alias("last_event")
    ).select(
        "hhn",
        (cutoff - F.coalesce("last_event", F.lit(0))).cast("int").alias("time_since"),
        F.col("last_event").isNotNull().alias("is_valid"),
    )


# --- dense export -------------------------------------------------------------


def pack_sequences(rows: DataFrame, n_steps: int, columns, fills) -> DataFrame:
    """One flat vector per household: ``n_steps`` x ``columns``, filled on the right.

    A household contributes at most ``n_steps`` rows, so its list is bounded.
    """
    values = F.array(*[F.col(c).cast("double") for c in columns])
    filler = F.array(*[F.lit(float(v)) for v in fills])
    steps = F.array_sort(F.collect_list(F.struct("t", values.alias("values"))))
    return rows.groupBy("hhn").agg(steps.alias("steps")).select(
        "hhn",
        F.flatten(
            F.concat(
                F.transform("steps", lambda s: s["values"]),
                F.array_repeat(filler, F.lit(n_steps) - F.size("steps")),
            )
        ).alias("flattened_inputs"),
    )


def unpack_sequences(packed: DataFrame, columns, key=("hhn",)) -> DataFrame:
    """Back to one row per step; no shuffle. ``t`` starts at 1 as in the paired rows."""
    width = len(columns)
    flat = F.col("flattened_inputs")
    last = (F.size(flat) / width - 1).cast("int")
    return (
        packed.select(*key, flat, F.explode(F.sequence(F.lit(0), last)).alias("step"))
        .select(*key, (F.col("step") + 1).alias("t"),
                F.slice(flat, F.col("step") * width + 1, F.lit(width)).alias("values"))
        .select(*key, "t", *[F.col("values")[i].alias(c) for i, c in enumerate(columns)])
    )


def mask_weight(mask_value: float, first_feature: str) -> Column:
    """1 on real steps, 0 on filled ones."""
    return (F.col(first_feature) != mask_value).cast("double")


def unmask(rows: DataFrame, columns, dummy: float = 0.5) -> DataFrame:
    """Steps whose censoring flag is the dummy lose their targets and predictions."""
    padded = F.col("u") == dummy
    blank = {c: F.when(~padded, F.col(c)) for c in columns if c != "u"}
    return rows.withColumns({**blank, "u": F.when(~padded, F.col("u"))})
