"""Weibull parameters by maximum likelihood per household segment, and scoring.

A segment is what is known about a household before the step to predict: region, weeks
since the last purchase, and purchase frequency. The rows collapse to a histogram of
(segment, time to event, censoring), whose size depends on the number of weeks and
segments but not on the number of households; the optimiser sees only that.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopspan.functions import weibull
from shopspan.operators.calendar import WeekSpan
from shopspan.schemas import STORE_FEATURE

# Candidate segmentations, coarse to fine.
CANDIDATES = {
    "overall": (),
    "behaviour": ("recency_bin", "frequency_bin"),
    "regional": ("region_id", "recency_bin", "frequency_bin"),
}


def init_alpha(rows: DataFrame) -> DataFrame:
    """Start value of alpha from the mean time to event and the uncensored share."""
    return rows.agg(F.avg("tte").alias("mean_tte"), F.avg("u").alias("mean_u")).withColumn(
        "init_alpha",
        -1 / F.ln(1 - 1 / (F.col("mean_tte") + 1)) / F.col("mean_u"),
    )


# --- segments ----------------------------------------------------------------------


def _recency_bin(weeks) -> Column:
    """0, 1-2, 3-6, 7-14, ... weeks since the last purchase."""
    return F.floor(F.log2(weeks + 1)).cast("int")


def _frequency_bin(n_events, n_steps) -> Column:
    """Fifths of the share of weeks with a purchase."""
    return F.least(F.floor(n_events * 5 / n_steps), F.lit(4)).cast("int")


def with_bins(df: DataFrame) -> DataFrame:
    """Add the bins of ``recency`` and of ``n_events`` in ``n_steps``."""
    return df.withColumns(
        {
            "recency_bin": _recency_bin(F.col("recency")),
            "frequency_bin": _frequency_bin(F.col("n_events"), F.col("n_steps")),
        }
    )


def with_step_segments(paired: DataFrame) -> DataFrame:
    """Segment of every (features, next target) row, from earlier steps only."""
    ordered = Window.partitionBy("hhn").orderBy("t")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Step 0 is the first purchase and has no target row of its own.
    last_event = F.coalesce(F.max(F.when(F.col("event") == 1, F.col("t"))).over(before), F.lit(0))
    known_region = F.when(F.col(STORE_FEATURE) > 0, F.col(STORE_FEATURE))
    return with_bins(
        paired.withColumns(
            {
                "recency": F.col("t") - 1 - last_event,
                "n_events": F.coalesce(F.sum("event").over(before), F.lit(0)) + 1,
                "n_steps": F.col("t"),
                "region_id": F.last(known_region, ignorenulls=True).over(so_far).cast("int"),
            }
        )
    )


def current_segments(features: DataFrame, axis: WeekSpan) -> DataFrame:
    """Segment of each household as of the axis end, straight from its active weeks."""
    active = F.col("n_transaction") > 0
    week = F.col("week_ending_date")
    return with_bins(
        features.groupBy("hhn").agg(
            (F.datediff(F.lit(axis.last), F.max(F.when(active, week))) / 7).cast("int").alias("recency"),
            F.count(F.when(active, 1)).alias("n_events"),
            (F.datediff(F.lit(axis.last), F.min(week)) / 7 + 1).cast("int").alias("n_steps"),
            F.max_by(STORE_FEATURE, "week_ending_date").cast("int").alias("region_id"),
        )
    )


def tte_histogram(rows: DataFrame, by, weight: str | None = None) -> DataFrame:
    amount = F.sum(weight) if weight else F.count(F.lit(1)).cast("double")
    return rows.groupBy(*by, "tte", "u").agg(amount.alias("weight"))


# --- maximum likelihood ------------------------------------------------------------


def _loglik(theta, t, u, w):
    a, b = np.exp(theta)
    before, after = (t / a) ** b, ((t + 1) / a) ** b
    step = np.maximum(after - before, 1e-300)
    log_hit = step + np.log(-np.expm1(-step))
    return float(np.sum(w * (u * log_hit - after)))


def _gradient(theta, t, u, w):
    a, b = np.exp(theta)
    before, after = (t / a) ** b, ((t + 1) / a) ** b
    step = np.maximum(after - before, 1e-300)
    pull = u / -np.expm1(-step)
    log_before = np.log(np.maximum(t, 1e-300) / a)
    d_before = np.array([-b * before, np.where(t > 0, b * before * log_before, 0.0)])
    d_after = np.array([-b * after, b * after * np.log((t + 1) / a)])
    return ((d_after - d_before) * pull - d_after) @ w


@dataclass(frozen=True)
class FitBounds:
    """Where the optimiser may go and when it is done.

    ``max_beta`` belongs to the model; the other bounds only keep the search away from where the
    likelihood is flat to machine precision. A fit on a bound says so.
    """

    alpha: tuple[float, float] = (1e-3, 1e6)
    beta: tuple[float, float] = (0.05, 5.0)
    tolerance: float = 1e-7
    max_steps: int = 200

    def logs(self) -> tuple[np.ndarray, np.ndarray]:
        return np.log([self.alpha[0], self.beta[0]]), np.log([self.alpha[1], self.beta[1]])


class Fit(NamedTuple):
    alpha: float
    beta: float
    mean_loglik: float
    gradient_norm: float
    converged: bool
    at_bound: bool


def _free_slope(theta, slope, lower, upper):
    """The gradient without what points out of the bounds."""
    stuck = ((theta <= lower) & (slope < 0)) | ((theta >= upper) & (slope > 0))
    return np.where(stuck, 0.0, slope), stuck


class Prior(NamedTuple):
    """Where (ln alpha, ln beta) is expected to lie, and the variances around it."""

    centre: np.ndarray
    spread: np.ndarray


def curvature(gradient, theta, h: float = 1e-5) -> np.ndarray:
    """Second derivatives from a gradient function."""
    curve = np.array([(gradient(theta + h * e) - gradient(theta - h * e)) / (2 * h) for e in np.eye(2)])
    return (curve + curve.T) / 2


def sampling_variances(fit: Fit, t, u, w) -> np.ndarray | None:
    """Variances of (ln alpha, ln beta) by the observed information; None where a fit has none."""
    if not fit.converged or fit.at_bound:
        return None
    curve = curvature(lambda at: _gradient(at, t, u, w), np.log([fit.alpha, fit.beta]))
    return np.diag(np.linalg.inv(-curve)) if np.linalg.eigvalsh(curve)[-1] < -1e-10 else None


def maximise(
    t, u, w, start_alpha: float, bounds: FitBounds = FitBounds(), start_beta: float = 1.0, prior: Prior | None = None
) -> Fit:
    """Damped Newton ascent in (ln alpha, ln beta), of the likelihood or, with a prior, of the posterior.

    Converged means that the free part of the gradient per row is below the tolerance.
    """
    pull = np.zeros(2) if prior is None else 1 / (prior.spread * w.sum())
    centre = np.zeros(2) if prior is None else prior.centre
    w = w / w.sum()

    def value_at(at):
        return _loglik(at, t, u, w) - float(pull @ (at - centre) ** 2) / 2

    def slope_at(at):
        return _gradient(at, t, u, w) - pull * (at - centre)

    lower, upper = bounds.logs()
    theta = np.clip(np.log([start_alpha, start_beta]), lower, upper)
    value = value_at(theta)
    for _ in range(bounds.max_steps):
        slope, stuck = _free_slope(theta, slope_at(theta), lower, upper)
        if np.linalg.norm(slope) < bounds.tolerance:
            break
        curve = curvature(slope_at, theta)
        curve[stuck, :] = curve[:, stuck] = 0.0
        curve[stuck, stuck] = -1.0
        if np.linalg.eigvalsh(curve)[-1] < -1e-10:
            move = -np.linalg.solve(curve, slope)
        else:
            move = slope
        size = 1.0
        while size > 1e-10:
            trial = np.clip(theta + size * move, lower, upper)
            reached = value_at(trial)
            # Near the top the likelihood is flat to rounding; there a smaller gradient is progress.
            flat = abs(reached - value) <= 1e-13 * max(1.0, abs(value))
            less = np.linalg.norm(_free_slope(trial, slope_at(trial), lower, upper)[0]) < np.linalg.norm(slope)
            if reached > value and not flat or flat and less:
                theta, value = trial, reached
                break
            size /= 2
        else:
            break
    slope, _ = _free_slope(theta, slope_at(theta), lower, upper)
    norm = float(np.linalg.norm(slope))
    at_bound = bool(((theta <= lower) | (theta >= upper)).any())
    alpha, beta = np.exp(theta)
    return Fit(float(alpha), float(beta), _loglik(theta, t, u, w), norm, norm < bounds.tolerance, at_bound)


def fit_weibull(histogram: DataFrame, by, start_alpha: float, bounds: FitBounds = FitBounds()) -> DataFrame:
    """(alpha, beta) per segment of a ``tte_histogram``; segments without events get none.

    ``converged``, ``gradient_norm`` and ``at_bound`` tell how each fit ended.
    """
    by = list(by)
    kinds = {f.name: f.dataType.simpleString() for f in histogram.schema.fields}
    fields = [f"{c} {kinds[c]}" for c in by]
    schema = ", ".join([
        *fields, "alpha double", "beta double", "mean_loglik double", "gradient_norm double",
        "converged boolean", "at_bound boolean", "n_rows double", "n_events double",
    ])

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        t, u, w = (group[c].to_numpy(dtype=float) for c in ("tte", "u", "weight"))
        events = float((u * w).sum())
        if events <= 0:
            return pd.DataFrame(columns=[f.split()[0] for f in schema.split(", ")])
        head = {c: [group[c].iloc[0]] for c in by}
        fitted = {k: [v] for k, v in maximise(t, u, w, start_alpha, bounds)._asdict().items()}
        return pd.DataFrame({**head, **fitted, "n_rows": [float(w.sum())], "n_events": [events]})

    # At most two rows per week of the axis in each group.
    return histogram.groupBy(*by).applyInPandas(solve, schema)


def candidate_histograms(rows: DataFrame) -> DataFrame:
    """Histograms of every candidate segmentation, the coarser ones as sums of the finest.

    Columns a candidate does not use are null.
    """
    keys = CANDIDATES["regional"]
    levels = F.array(*[
        F.struct(F.lit(name).alias("candidate"),
                 *[(F.col(k) if k in used else F.lit(None).cast("int")).alias(k) for k in keys])
        for name, used in CANDIDATES.items()
    ])
    stacked = tte_histogram(rows, keys).select("tte", "u", "weight", F.explode(levels).alias("level")).select(
        "level.*", "tte", "u", "weight"
    )
    return stacked.groupBy("candidate", *keys, "tte", "u").agg(F.sum("weight").alias("weight"))


def fit_candidates(rows: DataFrame, start_alpha: float, bounds: FitBounds = FitBounds()) -> DataFrame:
    """Every candidate segmentation, from one pass over the rows.

    Every segment with an event keeps its fit, whatever its size; scoring falls back only where a
    segment has no event at all.
    """
    return fit_weibull(candidate_histograms(rows), ["candidate", *CANDIDATES["regional"]], start_alpha, bounds)


def fit_optimality(histogram: DataFrame, fitted: DataFrame, bounds: FitBounds = FitBounds(), step: float = 0.01) -> DataFrame:
    """Whether no neighbour at ``step`` inside the bounds has a higher likelihood, from the histogram itself."""
    keys = ["candidate", *CANDIDATES["regional"]]
    kept = [F.col(f"f.{c}").alias(c) for c in (*keys, "alpha", "beta", "converged", "n_rows", "n_events")]
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"h.{c}")) for c in keys]
    rows = histogram.alias("h").join(fitted.alias("f"), same).select(*kept, "h.tte", "h.u", "h.weight")
    moves = {"centre": (1, 1), "up_a": (1 + step, 1), "down_a": (1 - step, 1), "up_b": (1, 1 + step), "down_b": (1, 1 - step)}
    sums = rows.groupBy(*keys, "alpha", "beta", "converged", "n_rows", "n_events").agg(*[
        (F.sum(F.col("weight") * F.when(
            F.col("u") == 1, weibull.discrete_loglik(F.col("tte"), F.col("alpha") * a, F.col("beta") * b, F.lit(1))
        ).otherwise(-weibull.cumulative_hazard(F.col("tte") + 1, F.col("alpha") * a, F.col("beta") * b)))
         / F.sum("weight")).alias(name)
        for name, (a, b) in moves.items()
    ])
    inside = {
        "up_a": F.col("alpha") * (1 + step) <= bounds.alpha[1], "down_a": F.col("alpha") * (1 - step) >= bounds.alpha[0],
        "up_b": F.col("beta") * (1 + step) <= bounds.beta[1], "down_b": F.col("beta") * (1 - step) >= bounds.beta[0],
    }
    best = F.lit(True)
    for name, allowed in inside.items():
        best = best & (~allowed | (F.col(name) <= F.col("centre") + 1e-12))
    return sums.select(*keys, "n_rows", "n_events", "converged", best.alias("best"))


def score(rows: DataFrame, fitted: DataFrame, candidate: str = "regional") -> DataFrame:
    """Add alpha and beta of the finest fitted segment at or above ``candidate``.

    ``fitted`` has one row per segment (regions x two small bin counts).
    """
    names = list(CANDIDATES)
    usable = names[: names.index(candidate) + 1][::-1]
    scored = rows
    for name in usable:
        keys = list(CANDIDATES[name])
        level = fitted.where(F.col("candidate") == name).select(
            *keys, F.struct("alpha", "beta").alias(f"by_{name}")
        )
        if keys:
            scored = scored.join(F.broadcast(level), keys, "left")
        else:
            scored = scored.withColumn(f"by_{name}", level.select(f"by_{name}").scalar())
    chosen = F.coalesce(*[F.col(f"by_{name}") for name in usable])
    return scored.withColumns(
        {"alpha": chosen["alpha"], "beta": chosen["beta"]}
    ).drop(*[f"by_{name}" for name in usable])
