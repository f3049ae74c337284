"""Business reports on predicted churn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopspan.operators.ordering import running_sums

# Names of the four risk bins, lowest first.
FOUR_BIN_NAMES = ("Low", "Medium", "High", "At Risk")


def bin_edges(n_bins: int) -> list[float]:
    """Right edges; the step is multiplied, not accumulated."""
    step = 1.0 / n_bins
    return [step * (i + 1) for i in range(n_bins)]


def risk_bin(p, n_bins: int) -> Column:
    """0-based bin of [left, right); the last bin takes everything above."""
    passed = F.lit(0)
    for edge in bin_edges(n_bins)[:-1]:
        passed = passed + (p >= F.lit(edge)).cast("int")
    return passed


def group_medians(scores: DataFrame, group: str, value: str) -> DataFrame:
    """Exact median per group, without gathering a group in one task."""
    counted = scores.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_sums(counted, [group], [F.asc(value)], ["n"])
    # One row per group.
    totals = F.broadcast(ranked.groupBy(group).agg(F.sum("n").alias("total")))
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1

    def holds(place):
        return F.when(place.between(first, last), F.col(value)).otherwise(0.0)

    lower, upper = F.expr("(total - 1) div 2"), F.expr("total div 2")
    return ranked.join(totals, group).groupBy(group).agg(
        ((F.sum(holds(lower)) + F.sum(holds(upper))) / 2).alias("median_prob")
    )


def risk_report(outcomes: DataFrame, n_bins: int, names=None) -> DataFrame:
    """Per risk bin: range, mean and median score, rows, churned and shares.

    ``outcomes`` holds the rows of one horizon (``score``, ``churned``); it is read
    twice, so store it first.
    """
    binned = outcomes.select(risk_bin(F.col("score"), n_bins).alias("segment"), "score", "churned")
    stats = binned.groupBy("segment").agg(
        F.avg("score").alias("mean_prob"),
        F.count(F.lit(1)).alias("total_count"),
        F.sum("churned").alias("churned"),
    )
    all_churned = stats.agg(F.sum("churned")).scalar()
    edges = [0.0, *bin_edges(n_bins)]
    ranges = F.array(*[F.lit(f"{lo:.2f} - {hi:.2f}") for lo, hi in zip(edges, edges[1:])])
    label = F.array(*[F.lit(n) for n in names])[F.col("segment")] if names else F.col("segment").cast("string")
    return stats.join(group_medians(binned, "segment", "score"), "segment").select(
        "segment", label.alias("segment_name"), ranges[F.col("segment")].alias("prob_range"),
        "mean_prob", "median_prob", "total_count", "churned",
        (F.col("churned") / F.col("total_count") * 100).alias("percent_churned"),
        F.try_divide(F.col("churned") * 100.0, all_churned).alias("percent_of_total_churned"),
    ).orderBy(F.desc("segment"))


def risk_report_check(outcomes: DataFrame, n_bins: int) -> DataFrame:
    """Independent recount by explicit ranges; the last range includes its right edge."""
    step = 1.0 / n_bins
    score = F.col("score")
    ranges = []
    for i in range(n_bins):
        left, right = step * i, step * (i + 1)
        below = score < right if i < n_bins - 1 else score <= right
        inside = (score >= left) & below
        ranges.append(F.struct(
            F.lit(i).alias("segment"), F.lit(round(left, 2)).alias("left_edge"),
            F.lit(round(right, 2)).alias("right_edge"),
            inside.cast("int").alias("hit"), (inside.cast("int") * F.col("churned")).alias("lost"),
        ))
    per_range = outcomes.select(F.explode(F.array(*ranges)).alias("r")).select("r.*")
    return per_range.groupBy("segment", "left_edge", "right_edge").agg(
        F.sum("hit").alias("total_count"), F.sum("lost").alias("churned")
    ).withColumn(
        "percent_churned", F.try_divide(F.col("churned") * 100.0, F.col("total_count"))
    )


def scale_up(outcomes: DataFrame, fraction: float) -> DataFrame:
    """Rows, churned households, and the row count the whole population would have."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("churned").alias("n_churned"),
    ).withColumn("n_rows_scaled", F.col("n_rows") / fraction)


def score_histogram(outcomes: DataFrame, n_bins: int = 10) -> DataFrame:
    """Equal-width counts between the smallest and largest value, scores beside labels.

    Without outcomes the result is empty.
    """
    bounds = outcomes.agg(
        F.min("score").alias("score_lo"), F.max("score").alias("score_hi"),
        F.min("churned").alias("churned_lo"), F.max("churned").alias("churned_hi"),
    )

    def place(name):
        value, lo, hi = F.col(name), *(bounds.select(f"{name}_{end}").scalar() for end in ("lo", "hi"))
        # A single distinct value is centred in a range of width one.
        left = F.when(hi == lo, lo - 0.5).otherwise(lo)
        width = F.when(hi == lo, 1.0).otherwise(hi - lo)
        return F.least(F.floor((value - left) / width * n_bins), F.lit(n_bins - 1)).cast("int")

    pairs = outcomes.select(F.explode(F.array(
        F.struct(F.lit("model").alias("series"), place("score").alias("bin")),
        F.struct(F.lit("truth").alias("series"), place("churned").alias("bin")),
    )).alias("p")).select("p.*")
    counts = pairs.groupBy("series", "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = counts.select("series").distinct().withColumn(
        "bin", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1)))
    )
    return grid.join(counts, ["series", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
