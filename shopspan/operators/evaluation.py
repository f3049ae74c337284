"""Churn metrics per prediction horizon ("box width").

A household is in the box when it buys within the horizon; churn, its complement, is
the positive class. ``by`` names extra grouping columns such as fold and model; all
groups and horizons are evaluated in the same jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopspan.functions import weibull
from shopspan.operators.ordering import next_values, running_sums


def evaluation_frame(
    rows: DataFrame, begin_k: int, consider_last_event: bool, by: tuple[str, ...] = (),
    values: tuple[str, ...] = ("alpha", "beta"), known: tuple[str, ...] | None = None,
) -> DataFrame:
    """``values`` and time to event at step ``begin_k``, one row per household.

    Households without one of the ``known`` values (default: all) at that step drop out.

    With ``consider_last_event`` the steps since the last event as of the step before
    come along, and households without a known last event drop out.
    """
    at, starts = F.col("k"), F.col("k") == begin_k
    past_event = F.when((at < begin_k) & (F.col("tte") == 0), at)
    frame = rows.where(at <= begin_k).groupBy("hhn", *by).agg(
        *[F.max(F.when(starts, F.col(c))).alias(c) for c in (*values, "tte")],
        F.max(past_event).alias("last_event"),
    ).dropna(subset=[*(values if known is None else known), "tte"])
    if not consider_last_event:
        return frame.withColumn("since", F.lit(0)).drop("last_event")
    return (
        frame.where("last_event IS NOT NULL")
        .withColumn("since", (begin_k - 1) - F.col("last_event"))
        .drop("last_event")
    )


def box_widths(n_steps: int, min_box_width: int, consider_last_event: bool) -> list[int]:
    widths = range(min(min_box_width, n_steps - 1), n_steps)
    return [w for w in widths if not (consider_last_event and w == 0)]


def box_outcomes(
    frame: DataFrame,
    n_steps: int,
    min_box_width: int,
    consider_last_event: bool,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Per household and horizon: churned (0/1) and predicted churn probability."""
    widths = box_widths(n_steps, min_box_width, consider_last_event)
    left = F.col("box_width") - F.col("since")
    alpha, beta = F.col("alpha"), F.col("beta")
    return (
        frame.withColumn("box_width", F.explode(F.array(*[F.lit(w) for w in widths])))
        .where(left >= 0)
        .select(
            *by, "hhn", "box_width",
            (F.col("tte") > left).cast("int").alias("churned"),
            (1 - weibull.cmf(left, alpha, beta)).alias("score"),
        )
    )


def probability_bin(p, n_bins: int) -> Column:
    """Bin number 1..n of (i/n, (i+1)/n]; zero belongs to the first bin."""
    guess = F.greatest(F.lit(1), F.least(F.ceil(p * n_bins), F.lit(n_bins)))
    # The edges i/n decide, not the product, which may be off by one unit in the last place.
    return (
        F.when((guess > 1) & (p <= (guess - 1) / F.lit(n_bins)), guess - 1)
        .when((guess < n_bins) & (p > guess / F.lit(n_bins)), guess + 1)
        .otherwise(guess)
        .cast("int")
    )


def probability_bins(outcomes: DataFrame, by: tuple[str, ...] = (), n_bins: int = 10) -> DataFrame:
    """Mean label, mean score and share of rows per bin; empty bins hold zeros."""
    keys = [*by, "box_width"]
    filled = outcomes.groupBy(*keys, probability_bin(F.col("score"), n_bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("churned").alias("labels"),
        F.sum("score").alias("scores"),
    )
    # From here on: at most n_bins rows per group and horizon.
    totals = filled.groupBy(*keys).agg(F.sum("n").alias("total"))
    grid = totals.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(n_bins))))
    return grid.join(filled, [*keys, "bin"], "left").select(
        *keys, "bin",
        F.coalesce(F.col("labels") / F.col("n"), F.lit(0.0)).alias("mean_label"),
        F.coalesce(F.col("scores") / F.col("n"), F.lit(0.0)).alias("mean_score"),
        F.coalesce(F.col("n") / F.col("total"), F.lit(0.0)).alias("fraction"),
    )


def calibration_error(bins: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    gap = F.abs(F.col("mean_label") - F.col("mean_score"))
    return bins.groupBy(*by, "box_width").agg(F.sum(F.col("fraction") * gap).alias("ece"))


def score_steps(outcomes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Cumulative positives and negatives down the distinct scores of each horizon.

    Equal scores collapse before the shuffle; the running sums spread one horizon
    over many tasks, so its number of distinct scores is not limited by one task.
    """
    keys = [*by, "box_width"]
    steps = outcomes.groupBy(*keys, "score").agg(
        F.sum("churned").alias("pos"), F.sum(1 - F.col("churned")).alias("neg")
    ).withColumn("step", F.lit(1).cast("bigint"))
    summed = running_sums(steps, keys, [F.desc("score")], ["pos", "neg", "step"]).drop("step")
    # One row per group and horizon.
    totals = outcomes.groupBy(*keys).agg(
        F.sum("churned").alias("all_pos"), F.sum(1 - F.col("churned")).alias("all_neg")
    )
    return summed.join(F.broadcast(totals), keys)


def discrimination(steps: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """AUC (ties count half) and average precision (step-wise sum)."""
    area = F.sum(F.col("neg") * (2 * F.col("cum_pos") - F.col("pos")))
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return steps.groupBy(*by, "box_width", "all_pos", "all_neg").agg(
        area.alias("area"), F.sum(F.col("pos") * precision).alias("weighted_precision")
    ).select(
        *by, "box_width",
        F.try_divide("area", (2 * F.col("all_pos") * F.col("all_neg")).cast("double")).alias("auc"),
        F.try_divide("weighted_precision", F.col("all_pos").cast("double")).alias("ap"),
    )


def _with_end_point(points: DataFrame, keys: list[str], end: dict, names: list[str]) -> DataFrame:
    """Add a curve's fixed end beside the point of its highest score."""
    point = F.struct("threshold", *names)
    fixed = F.struct(
        F.lit(None).cast("double").alias("threshold"), *[F.lit(end[n]).alias(n) for n in names]
    )
    both = F.when(F.col("cum_step") == 1, F.array(fixed, point)).otherwise(F.array(point))
    return points.select(*keys, F.explode(both).alias("p")).select(*keys, "p.*")


def roc_points(steps: DataFrame, by: tuple[str, ...] = (), drop_collinear: bool = True) -> DataFrame:
    """ROC curve from (0, 0); points between two equal moves lie on a line and are left out."""
    keys = [*by, "box_width"]
    kept = steps
    if drop_collinear:
        turns = (
            F.col("next_pos").isNull()
            | (F.col("cum_step") == 1)
            | (F.col("next_pos") != F.col("pos"))
            | (F.col("next_neg") != F.col("neg"))
        )
        kept = next_values(steps, keys, [F.asc("cum_step")], ["pos", "neg"]).where(turns)
    points = kept.select(
        *keys, "cum_step", F.col("score").alias("threshold"),
        F.try_divide("cum_neg", "all_neg").alias("fpr"),
        F.try_divide("cum_pos", "all_pos").alias("tpr"),
    )
    return _with_end_point(points, keys, {"fpr": 0.0, "tpr": 0.0}, ["fpr", "tpr"])


def pr_points(steps: DataFrame, by: tuple[str, ...] = (), to_full_recall: bool = True) -> DataFrame:
    """Precision-recall curve and its end (0, 1); thresholds beyond the first full recall are left out if wanted."""
    keys = [*by, "box_width"]
    before_full = F.col("cum_pos") - F.col("pos") < F.col("all_pos")
    points = (steps.where(before_full) if to_full_recall else steps).select(
        *keys, "cum_step", F.col("score").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.try_divide("cum_pos", "all_pos").alias("recall"),
    )
    return _with_end_point(points, keys, {"precision": 1.0, "recall": 0.0}, ["precision", "recall"])


def box_shares(outcomes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return outcomes.groupBy(*by, "box_width").agg(
        F.avg(1 - F.col("churned")).alias("frac_in_box"),
        F.count(F.lit(1)).alias("observations"),
    )


def horizon_metrics(outcomes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per group and horizon. ``outcomes`` is read three times: store it first."""
    keys = [*by, "box_width"]
    return (
        discrimination(score_steps(outcomes, by), by)
        .join(calibration_error(probability_bins(outcomes, by), by), keys)
        .join(box_shares(outcomes, by), keys)
    )


def mean_metrics(metrics: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Means over the horizons; an undefined horizon leaves the mean undefined."""

    def mean_of(c):
        return F.when(F.count(c) == F.count(F.lit(1)), F.avg(c))

    means = metrics.groupBy(*by).agg(
        mean_of("auc").alias("mean_auc"), mean_of("ap").alias("mean_ap"),
        mean_of("ece").alias("mean_ece"), F.count(F.lit(1)).alias("n_widths"),
    )
    return means.where("n_widths > 0").drop("n_widths")


# --- comparing two models ---------------------------------------------------------


def student_cdf(t, df, n_intervals: int = 2000) -> Column:
    """P(T <= t); meant for the single row of a test result.

    With x = sqrt(df) tan(angle) the density becomes cos(angle)^(df - 1), so the tail beyond |t| is
    an integral over a part of [0, pi / 2], whatever t: Simpson's rule there has no large steps.
    """
    quarter = 1.5707963267948966

    def integral(low):
        width = (F.lit(quarter) - low) / n_intervals

        def weight(i):
            inner = F.when(i % 2 == 1, F.lit(4.0)).otherwise(2.0)
            return F.when((i == 0) | (i == n_intervals), F.lit(1.0)).otherwise(inner)

        # The angle is measured from pi / 2, where its cosine is the sine of a small, exact number.
        total = F.aggregate(
            F.sequence(F.lit(0), F.lit(n_intervals)),
            F.lit(0.0),
            lambda acc, i: acc + weight(i) * F.pow(F.sin(i * width), df - 1),
        )
        return total * width / 3

    beyond = F.atan2(F.sqrt(df), F.abs(t))  # pi / 2 - atan(|t| / sqrt(df)), exact for large t
    tail = 0.5 * integral(F.lit(quarter) - beyond) / integral(F.lit(0.0))
    return F.when(df < 1, None).when(t < 0, tail).otherwise(1 - tail)


def paired_t_test(folds: DataFrame, champion: str, challenger: str) -> DataFrame:
    """One-sided paired test that the champion's fold scores are below the challenger's.

    ``folds`` has one row per fold with one score column per model. If all gaps are equal, their sign
    decides (infinite statistic); equal scores, or fewer than two folds, have no statistic.
    """
    gap = F.col(champion) - F.col(challenger)
    summary = folds.agg(
        F.avg(champion).alias("mean_champion"), F.avg(challenger).alias("mean_challenger"),
        F.avg(gap).alias("gap"), F.stddev_samp(gap).alias("spread"),
        F.count(gap).alias("n_folds"),
    )
    # Gaps that differ by rounding alone are equal.
    constant = F.col("spread") <= 1e-14 * F.greatest(F.abs("gap"), F.lit(1e-300))
    t = (
        F.when(F.col("n_folds") < 2, None)
        .when((F.col("gap") == 0) & (F.col("spread") == 0), None)
        .when(constant, F.signum("gap") * float("inf"))
        .otherwise(F.col("gap") / (F.col("spread") / F.sqrt("n_folds")))
    )
    return summary.withColumn("statistic", t).withColumn(
        "p_value", F.when(F.col("statistic").isNotNull(), student_cdf(F.col("statistic"), F.col("n_folds") - 1))
    )


def promotion(test: DataFrame, level: float) -> DataFrame:
    """promote / keep; without any champion score the challenger wins by default."""
    return test.withColumn(
        "decision",
        F.when(F.col("mean_champion").isNull(), "default")
        .when(F.col("p_value") <= level, "promote")
        .otherwise("keep"),
    )


def best_run(runs: DataFrame, now, max_age_hours: float, metric: str = "mean_auc") -> DataFrame:
    """Highest-scoring run among the recent ones whose metric is known."""
    age = (F.unix_timestamp(now) - F.unix_timestamp("start_time")) / 3600
    known = F.col(metric).isNotNull() & ~F.isnan(metric)
    return runs.where(known & (age <= max_age_hours)).orderBy(F.desc(metric)).limit(1)
