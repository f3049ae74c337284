"""Weibull parameters from a household's features: two linear heads behind the bounded output layer.

Both heads are linear in the standardised features; ``functions.weibull.output_transform`` turns them into alpha
and beta. The censored discrete likelihood, less a ridge, is maximised by Newton steps. A step is one aggregate over
rows with their numbers (most weeks are empty, and alike but for the history): every task adds up the likelihood, its gradient and its curvature over its rows and hands back one row, so
what is shuffled depends on the number of features and tasks, never on households or weeks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopspan.functions import weibull
from shopspan.operators.calendar import WeekSpan
from shopspan.operators.fitting import current_segments
from shopspan.schemas import NUMERIC_FEATURES, RESCALED_FEATURES
from shopspan.sources.staging import staged

#: What the rows say beside the week's features: weeks since the last purchase (log) and share of weeks with one.
HISTORY = ("log_recency", "purchase_share")
INPUTS = NUMERIC_FEATURES + HISTORY
HEADS = ("alpha", "beta")
MAX_BETA = 5.0


def with_history(rows: DataFrame) -> DataFrame:
    """Adds ``HISTORY`` to rows with recency, n_events and n_steps (see ``fitting.with_step_segments``)."""
    return rows.withColumns({
        "log_recency": F.log1p(F.col("recency").cast("double")),
        "purchase_share": F.col("n_events") / F.col("n_steps").cast("double"),
    })


def current_inputs(features: DataFrame, axis: WeekSpan) -> DataFrame:
    """``INPUTS`` and segments of each household as of the axis end; features of a week without a row are zero."""
    at_end = F.col("week_ending_date") == F.lit(axis.last)
    last = features.groupBy("hhn").agg(*[
        F.coalesce(F.max(F.when(at_end, F.log1p(c) if c in RESCALED_FEATURES else F.col(c))), F.lit(0.0)).alias(c)
        for c in NUMERIC_FEATURES
    ])
    return with_history(current_segments(features, axis).join(last, "hhn"))


@dataclass(frozen=True)
class Scales:
    """Means and spreads of the inputs; a constant input has spread 1."""

    mean: np.ndarray
    spread: np.ndarray


def scales(rows: DataFrame) -> Scales:
    found = rows.agg(*[f(F.col(c).cast("double")).alias(f"{k}{c}") for c in INPUTS for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([found[f"m{c}"] or 0.0 for c in INPUTS])
    spread = np.array([found[f"s{c}"] or 0.0 for c in INPUTS])
    return Scales(mean, np.where(spread > 1e-9, spread, 1.0))


def alike_rows(rows: DataFrame) -> DataFrame:
    """INPUTS, tte and u of ``rows`` with ``n_alike``, the number of rows that each stands for.

    Weeks whose features are all zero differ by history and target only and are counted; all others stand for themselves.
    There are no more different empty weeks than histories in a window, however many households there are.
    """
    empty = F.lit(True)
    for c in NUMERIC_FEATURES:
        empty = empty & F.coalesce(F.col(c) == 0, F.lit(False))
    needed = rows.select(*INPUTS, "tte", "u")
    counted = needed.where(empty).groupBy(*HISTORY, "tte", "u").agg(F.count(F.lit(1)).cast("double").alias("n_alike"))
    zeros = counted.select(*[F.lit(0).cast(needed.schema[c].dataType).alias(c) for c in NUMERIC_FEATURES], *counted.columns)
    return needed.where(~empty).withColumn("n_alike", F.lit(1.0)).unionByName(zeros)


@dataclass(frozen=True)
class Sums:
    """Over all rows: how many, their log-likelihood, its gradient and its curvature in both heads' weights."""

    n: float
    loglik: float
    gradient: np.ndarray
    curvature: np.ndarray


def row_derivatives(t, u, x0, x1, start_alpha: float):
    """Log-likelihood of each row and its first and second derivatives in the two raw scores."""
    log_alpha = math.log(start_alpha) + x0
    beta = MAX_BETA / (1 + np.exp(-(x1 - math.log(MAX_BETA - 1))))
    slope = beta * (1 - beta / MAX_BETA)
    bend = slope * (1 - 2 * beta / MAX_BETA)

    def hazard(at):
        """Cumulative hazard at ``at`` with derivatives: value, in x0, in x1, in x0 x0, x0 x1, x1 x1."""
        ahead = np.log(np.maximum(at, 1e-300)) - log_alpha
        h = np.where(at > 0, np.exp(np.minimum(beta * ahead, 50.0)), 0.0)
        ahead = np.where(at > 0, ahead, 0.0)
        return h, -beta * h, h * ahead * slope, beta**2 * h, -h * (1 + beta * ahead) * slope, h * ahead * (ahead * slope**2 + bend)

    after, before = hazard(t + 1), hazard(t)
    step = [a - b for a, b in zip(after, before)]
    s = np.maximum(step[0], 1e-12)
    pull = -1 / np.expm1(-s)
    turn = pull - pull**2
    loglik = u * (s + np.log(-np.expm1(-s))) - after[0]
    first = [u * pull * step[k] - after[k] for k in (1, 2)]
    second = [u * (pull * step[k] + turn * step[i] * step[j]) - after[k] for k, i, j in ((3, 1, 1), (4, 1, 2), (5, 2, 2))]
    return loglik, first, second


def _adder(weights: np.ndarray, scale: Scales, start_alpha: float):
    size = len(INPUTS) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0.0
        gradient, curvature = np.zeros(2 * size), np.zeros((2 * size, 2 * size))
        for batch in batches:
            t, u, w = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("tte", "u", "n_alike"))
            raw = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in INPUTS], axis=1)
            x = np.concatenate([np.ones((len(t), 1)), (raw - scale.mean) / scale.spread], axis=1)
            loglik, first, second = row_derivatives(t, u, x @ weights[:size], x @ weights[size:], start_alpha)
            (g0, g1), (h00, h01, h11) = [w * g for g in first], [w * h for h in second]
            n, total = n + float(w.sum()), total + float(w @ loglik)
            gradient += np.concatenate([x.T @ g0, x.T @ g1])
            mixed = x.T @ (x * h01[:, None])
            curvature += np.block([[x.T @ (x * h00[:, None]), mixed], [mixed, x.T @ (x * h11[:, None])]])
        values = np.concatenate([[n, total], gradient, curvature.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["place", "value"])

    return run


def likelihood_sums(rows: DataFrame, weights: np.ndarray, scale: Scales, start_alpha: float) -> Sums:
    """One aggregate over ``rows`` (INPUTS, tte, u, and n_alike if they stand for several); ``weights`` holds intercept and
    inputs of alpha, then of beta."""
    size = 2 * (len(INPUTS) + 1)
    counted = rows if "n_alike" in rows.columns else rows.withColumn("n_alike", F.lit(1.0))
    inputs = counted.select(*[F.col(c).cast("double").alias(c) for c in (*INPUTS, "tte", "u", "n_alike")])
    found = (
        inputs.mapInArrow(_adder(weights, scale, start_alpha), "place int, value double")
        .groupBy("place").agg(F.sum("value").alias("value")).collect()
    )
    values = np.zeros(2 + size + size * size)
    for r in found:
        values[r.place] = r.value
    return Sums(values[0], values[1], values[2: 2 + size], values[2 + size:].reshape(size, size))


@dataclass(frozen=True)
class HeadFit:
    weights: np.ndarray
    scale: Scales
    start_alpha: float
    ridge: float
    mean_loglik: float
    gradient_norm: float
    converged: bool
    n_rows: float

    def table(self, spark) -> DataFrame:
        """One row per head and input: its mean, spread and weight."""
        names = ("intercept", *INPUTS)
        mean, spread = [0.0, *self.scale.mean.tolist()], [1.0, *self.scale.spread.tolist()]
        fit = (self.start_alpha, self.ridge, self.mean_loglik, self.gradient_norm, self.converged, self.n_rows)
        return spark.createDataFrame(
            [(head, name, mean[k], spread[k], float(self.weights[h * len(names) + k]), *fit)
             for h, head in enumerate(HEADS) for k, name in enumerate(names)],
            "head string, input string, mean double, spread double, weight double, start_alpha double, ridge double, "
            "mean_loglik double, gradient_norm double, converged boolean, n_rows double",
        )


def heads_of(table: DataFrame) -> HeadFit:
    """The fit that ``HeadFit.table`` wrote down."""
    rows = {(r["head"], r["input"]): r for r in table.collect()}
    names = ("intercept", *INPUTS)
    if set(rows) != {(h, c) for h in HEADS for c in names}:
        raise ValueError("these heads were fitted to other inputs")
    of = lambda field, inputs: np.array([rows["alpha", c][field] for c in inputs])
    one = rows["alpha", "intercept"]
    return HeadFit(
        np.array([rows[h, c]["weight"] for h in HEADS for c in names]), Scales(of("mean", INPUTS), of("spread", INPUTS)),
        one["start_alpha"], one["ridge"], one["mean_loglik"], one["gradient_norm"], one["converged"], one["n_rows"],
    )


def _penalty(ridge: float) -> np.ndarray:
    """The ridge on every weight but the intercepts."""
    one = np.full(len(INPUTS) + 1, ridge)
    one[0] = 0.0
    return np.concatenate([one, one])


def fit_heads(rows: DataFrame, start_alpha: float, ridge: float = 1e-3, tolerance: float = 1e-6, max_steps: int = 40) -> HeadFit:
    """Weights at the highest mean log-likelihood less ``ridge / 2`` times their squares.

    ``rows`` should be stored: they are read for their scales and to be counted; every step reads ``alike_rows``. Converged means that the gradient per row is below ``tolerance``.
    A step that does not climb is damped more and tried again, so the value never falls. No rows: no fit (an error).
    """
    scale, penalty = scales(rows), _penalty(ridge)
    rows = staged(alike_rows(rows), "alike-rows")
    theta = np.zeros(2 * (len(INPUTS) + 1))
    now = likelihood_sums(rows, theta, scale, start_alpha)
    if not now.n:
        raise ValueError("no rows to fit")
    value = lambda sums, w: sums.loglik / sums.n - (penalty * w * w).sum() / 2
    damping = 0.0
    for _ in range(max_steps):
        slope = now.gradient / now.n - penalty * theta
        if np.linalg.norm(slope) < tolerance:
            break
        curve = -(now.curvature / now.n) + np.diag(penalty)
        lowest = float(np.linalg.eigvalsh(curve)[0])
        lift = damping + max(0.0, 1e-6 - lowest)
        trial = theta + np.linalg.solve(curve + lift * np.eye(len(theta)), slope)
        reached = likelihood_sums(rows, trial, scale, start_alpha)
        if value(reached, trial) > value(now, theta) - 1e-13:
            theta, now, damping = trial, reached, damping / 10 if damping > 1e-6 else 0.0
        else:
            damping = max(10 * damping, 1e-3)
    norm = float(np.linalg.norm(now.gradient / now.n - penalty * theta))
    return HeadFit(theta, scale, float(start_alpha), ridge, float(now.loglik / now.n), norm, norm < tolerance, float(now.n))


def _raw(weights: np.ndarray, scale: Scales) -> Column:
    out = F.lit(float(weights[0]))
    for k, c in enumerate(INPUTS):
        out = out + (F.col(c) - float(scale.mean[k])) / float(scale.spread[k]) * float(weights[k + 1])
    return out


def score_heads(rows: DataFrame, fit: HeadFit) -> DataFrame:
    """Add alpha and beta to rows with ``INPUTS``; plain expressions, no join."""
    size = len(INPUTS) + 1
    x0, x1 = _raw(fit.weights[:size], fit.scale), _raw(fit.weights[size:], fit.scale)
    alpha, beta = weibull.output_transform(x0, x1, fit.start_alpha, MAX_BETA)
    return rows.withColumns({"alpha": alpha, "beta": beta})


def head_gradient(rows: DataFrame, fit: HeadFit) -> DataFrame:
    """(head, input, gradient) per row of the penalised likelihood, from the likelihood's own expressions.

    Each derivative is a central difference of ``discrete_loglik`` in one raw score times the input, in one aggregate.
    """
    size, h = len(INPUTS) + 1, 1e-4
    x0, x1 = _raw(fit.weights[:size], fit.scale), _raw(fit.weights[size:], fit.scale)

    def loglik(d0: float, d1: float) -> Column:
        alpha, beta = weibull.output_transform(F.col("x0") + d0, F.col("x1") + d1, fit.start_alpha, MAX_BETA)
        hit = weibull.discrete_loglik(F.col("tte"), alpha, beta, F.lit(1))
        return F.when(F.col("u") == 1, hit).otherwise(-weibull.cumulative_hazard(F.col("tte") + 1, alpha, beta))

    sloped = rows.withColumns({"x0": x0, "x1": x1}).withColumns({
        "alpha_slope": (loglik(h, 0) - loglik(-h, 0)) / (2 * h), "beta_slope": (loglik(0, h) - loglik(0, -h)) / (2 * h),
    })
    inputs = [F.lit(1.0)] + [(F.col(c) - float(m)) / float(s) for c, m, s in zip(INPUTS, fit.scale.mean, fit.scale.spread)]
    names, penalty = ("intercept", *INPUTS), _penalty(fit.ridge)
    sums = sloped.agg(*[
        F.avg(F.col(f"{head}_slope") * x).alias(f"{head}_{k}") for head in HEADS for k, x in enumerate(inputs)
    ])
    return sums.select(F.explode(F.array(*[
        F.struct(F.lit(head).alias("head"), F.lit(name).alias("input"),
                 (F.col(f"{head}_{k}") - float(penalty[k] * fit.weights[i * size + k])).alias("gradient"))
        for i, head in enumerate(HEADS) for k, name in enumerate(names)
    ])).alias("g")).select("g.*")
