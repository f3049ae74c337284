"""Segment fits pooled through the tree overall > behaviour > regional.

A segment with one event has a likelihood of its own, but hardly any evidence. Here every segment's (ln alpha, ln beta) is
drawn towards its parent's by a normal prior. How strongly is estimated from the data, one variance a level and parameter:
the spread of the segments around their parents beyond what sampling explains. The same rule holds for segments of all sizes;
large ones keep their own maximum because their likelihood outweighs the prior. Segments without any event have a fit too.

A segment is one row with its histogram in arrays (at most two entries per week of the axis), so all tables here have as many
rows as there are segments, whatever the number of households.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopspan.functions import weibull
from shopspan.operators.fitting import CANDIDATES, Fit, FitBounds, Prior, maximise, sampling_variances
from shopspan.sources.staging import staged

KEYS = ("candidate", *CANDIDATES["regional"])
PARAMETERS = ("alpha", "beta")
#: Levels below the root, each with its parent.
PARENTS = {"behaviour": "overall", "regional": "behaviour"}
#: A level never counts as without any spread: a prior needs a variance.
LEAST_SPREAD = 1e-6


def segment_rows(histogram: DataFrame) -> DataFrame:
    """One row per segment of ``candidate_histograms``: n_rows, n_events and the entries as arrays tte, u and weight."""
    entries = F.sort_array(F.collect_list(F.struct("tte", "u", "weight")))
    return histogram.groupBy(*KEYS).agg(
        F.sum("weight").alias("n_rows"), F.sum(F.col("weight") * F.col("u")).alias("n_events"), entries.alias("entries")
    ).select(*KEYS, "n_rows", "n_events", *[F.col("entries")[c].alias(c) for c in ("tte", "u", "weight")])


def _numbers(row) -> tuple[np.ndarray, ...]:
    return tuple(np.asarray(v, dtype=float) for v in (row.tte, row.u, row.weight))


def own_estimates(segments: DataFrame, start_alpha: float, bounds: FitBounds = FitBounds()) -> DataFrame:
    """Add each segment's own maximum, ln_alpha and ln_beta, and its sampling variances.

    All four are null without events; the variances also where the fit lies on a bound or its likelihood has no curvature.
    """
    names = [f"{kind}_{p}" for kind in ("ln", "variance") for p in PARAMETERS]

    def solve(batches):
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False):
                t, u, w = _numbers(row)
                if not (u * w).sum() > 0:
                    found.append([np.nan] * 4)
                    continue
                fit = maximise(t, u, w, start_alpha, bounds)
                variances = sampling_variances(fit, t, u, w)
                found.append([np.log(fit.alpha), np.log(fit.beta), *([np.nan] * 2 if variances is None else variances)])
            yield pd.concat([batch, pd.DataFrame(found, columns=names, dtype=float)], axis=1)

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in segments.schema.fields] + [f"{c} double" for c in names])
    return segments.mapInPandas(solve, schema).withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in names})


def level_spread(level: DataFrame) -> DataFrame:
    """One row: for each parameter the variance of the segments around their parents, by moments in two steps.

    With gaps d to the parents and sampling variances v, the mean of d^2 - v has the wanted variance as its expectation. It is
    weighted by 1 / v first, then by 1 / (v + what that gave). Segments without a variance say nothing about the spread.
    """
    known = level.select(*[
        F.when(F.col(f"variance_{p}") > 0, F.struct(
            F.col(f"variance_{p}").alias("v"), F.pow(F.col(f"ln_{p}") - F.col(f"centre_{p}"), 2).alias("d2"),
        )).alias(p)
        for p in PARAMETERS
    ])

    def mean(weight):
        return lambda p: F.greatest(
            F.coalesce(F.sum(weight(p) * (F.col(p)["d2"] - F.col(p)["v"])) / F.sum(weight(p)), F.lit(0.0)), F.lit(LEAST_SPREAD)
        )

    first = mean(lambda p: 1 / F.col(p)["v"])
    once = known.agg(F.struct(*[first(p).alias(f"first_{p}") for p in PARAMETERS]).alias("once"))
    second = mean(lambda p: 1 / (F.col(p)["v"] + F.col("once")[f"first_{p}"]))
    return known.withColumn("once", once.scalar()).agg(
        *[F.count(F.col(p)).alias(f"n_{p}") for p in PARAMETERS],
        *[second(p).alias(f"spread_{p}") for p in PARAMETERS],
    )


def shrunk(own, variance, centre, spread) -> Column:
    """Mean of a normal estimate under a normal prior; the centre where there is no estimate."""
    return F.coalesce((own / variance + centre / spread) / (1 / variance + 1 / spread), centre)


def pooled(estimates: DataFrame, refine=None) -> DataFrame:
    """Every segment's ln_alpha and ln_beta after pooling, from the root down; nothing if the root has no estimate.

    ``estimates`` needs KEYS, ln_* and variance_* of both parameters. Added are centre_* and spread_*, the prior of each segment (null at
    the root, which keeps its estimate). ``refine`` may replace the closed form of a level by a better posterior.
    """
    estimates = staged(estimates, "estimates")
    refine = refine or (lambda level: level)
    no_prior = {f"{kind}_{p}": F.lit(None).cast("double") for kind in ("centre", "spread") for p in PARAMETERS}
    root = estimates.where((F.col("candidate") == "overall") & F.col("ln_alpha").isNotNull())
    parts = [staged(refine(root.withColumns(no_prior)), "pooled")]
    for name, parent in PARENTS.items():
        keys = list(CANDIDATES[parent])
        centres = parts[-1].select(*keys, F.struct(*[F.col(f"ln_{p}").alias(p) for p in PARAMETERS]).alias("centre"))
        level = estimates.where(F.col("candidate") == name)
        # Without keys the parent is the one row of the root.
        level = level.join(centres, keys) if keys else level.withColumn("centre", centres.scalar()).where("centre IS NOT NULL")
        level = staged(level.withColumns({f"centre_{p}": F.col("centre")[p] for p in PARAMETERS}).drop("centre"), "level")
        spread = level_spread(level).select(F.struct(*[f"spread_{p}" for p in PARAMETERS])).scalar()
        level = level.withColumn("spread", spread).withColumns({f"spread_{p}": F.col("spread")[f"spread_{p}"] for p in PARAMETERS})
        closed = level.drop("spread").withColumns({
            f"ln_{p}": shrunk(*[F.col(f"{kind}_{p}") for kind in ("ln", "variance", "centre", "spread")]) for p in PARAMETERS
        })
        parts.append(staged(refine(closed), "pooled"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fit_pooled(histogram: DataFrame, start_alpha: float, bounds: FitBounds = FitBounds()) -> DataFrame:
    """Posterior modes of all segments of ``candidate_histograms``; columns as ``fitting.fit_weibull`` has them, and the priors.

    ``mean_loglik`` is the likelihood without the prior. Segments without events have a row. Without any event at all
    no segment has one. An empty histogram gives an empty result.
    """
    def mode(batches):
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False):
                prior = None
                if row.candidate != "overall":
                    prior = Prior(np.array([row.centre_alpha, row.centre_beta]), np.array([row.spread_alpha, row.spread_beta]))
                found.append(maximise(*_numbers(row), np.exp(row.ln_alpha), bounds, np.exp(row.ln_beta), prior))
            fits = pd.DataFrame(found, columns=Fit._fields)
            fits["ln_alpha"], fits["ln_beta"] = np.log(fits.alpha.astype(float)), np.log(fits.beta.astype(float))
            yield pd.concat([batch.drop(columns=["ln_alpha", "ln_beta"]), fits], axis=1)

    def refine(level: DataFrame) -> DataFrame:
        kept = [f"{f.name} {f.dataType.simpleString()}" for f in level.schema.fields if f.name not in ("ln_alpha", "ln_beta")]
        added = ["alpha double", "beta double", "mean_loglik double", "gradient_norm double", "converged boolean", "at_bound boolean",
                 "ln_alpha double", "ln_beta double"]
        return level.mapInPandas(mode, ", ".join(kept + added))

    own = own_estimates(segment_rows(histogram), start_alpha, bounds)
    return pooled(own, refine).select(
        *KEYS, "alpha", "beta", "mean_loglik", "gradient_norm", "converged", "at_bound", "n_rows", "n_events",
        *[f"{k}_{p}" for k in ("centre", "spread") for p in PARAMETERS],
    )


def row_loglik(scale_a: float = 1.0, scale_b: float = 1.0) -> Column:
    """Log-likelihood of a row's tte and u at its alpha and beta, or at multiples of them."""
    alpha, beta = F.col("alpha") * scale_a, F.col("beta") * scale_b
    hit = weibull.discrete_loglik(F.col("tte"), alpha, beta, F.lit(1))
    return F.when(F.col("u") == 1, hit).otherwise(-weibull.cumulative_hazard(F.col("tte") + 1, alpha, beta))


def pooled_optimality(histogram: DataFrame, fitted: DataFrame, bounds: FitBounds = FitBounds(), step: float = 0.01) -> DataFrame:
    """Whether no neighbour at ``step`` inside the bounds has a higher posterior, by the likelihood's own expressions."""
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"h.{c}")) for c in KEYS]
    priors = [f"{k}_{p}" for k in ("centre", "spread") for p in PARAMETERS]
    facts = [*KEYS, "alpha", "beta", "converged", "n_rows", "n_events", *priors]
    rows = histogram.alias("h").join(fitted.alias("f"), same).select(*[f"f.{c}" for c in facts], "h.tte", "h.u", "h.weight")
    moves = {"centre": (1.0, 1.0), "up_a": (1 + step, 1.0), "down_a": (1 - step, 1.0), "up_b": (1.0, 1 + step), "down_b": (1.0, 1 - step)}
    sums = rows.groupBy(*facts).agg(*[F.sum(F.col("weight") * row_loglik(a, b)).alias(name) for name, (a, b) in moves.items()])

    def penalty(a: float, b: float) -> Column:
        return sum((
            F.coalesce(F.pow(F.ln(F.col(p) * by) - F.col(f"centre_{p}"), 2) / (2 * F.col(f"spread_{p}")), F.lit(0.0))
            for p, by in zip(PARAMETERS, (a, b))
        ), F.lit(0.0))

    posterior = {name: (F.col(name) - penalty(a, b)) / F.col("n_rows") for name, (a, b) in moves.items()}
    best = F.lit(True)
    for name, (a, b) in moves.items():
        outside = ~(F.col("alpha") * a).between(*bounds.alpha) | ~(F.col("beta") * b).between(*bounds.beta)
        best = best & (outside | (posterior[name] <= posterior["centre"] + 1e-12))
    return sums.select(*KEYS, "n_rows", "n_events", "converged", best.alias("best"))
