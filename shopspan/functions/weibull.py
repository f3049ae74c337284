"""Weibull distribution as Column expressions.

``t`` is the time, ``a`` the scale (alpha), ``b`` the shape (beta). Logs of small
probabilities are taken from the hazards, so they stay finite where exp() would
underflow first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos approximation of the gamma function, g = 7, nine terms.
LANCZOS_G = 7
LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
    -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6,
    1.5056327351493116e-7,
)


def gamma(x) -> Column:
    """Gamma function for x >= 0.5."""
    series = F.lit(LANCZOS[0])
    for i, term in enumerate(LANCZOS[1:]):
        series = series + F.lit(term) / (x + i)
    base = x + (LANCZOS_G - 0.5)
    return F.pow(base, x - 0.5) * F.exp(-base) * series * math.sqrt(2 * math.pi)


def cumulative_hazard(t, a, b) -> Column:
    return F.pow(t / a, b)


def hazard(t, a, b) -> Column:
    return b / a * F.pow(t / a, b - 1)


def cdf(t, a, b) -> Column:
    return 1 - F.exp(-cumulative_hazard(t, a, b))


def pdf(t, a, b) -> Column:
    return hazard(t, a, b) * F.exp(-cumulative_hazard(t, a, b))


def cmf(t, a, b) -> Column:
    """Probability of an event within step ``t`` or earlier."""
    return cdf(t + 1, a, b)


def pmf(t, a, b) -> Column:
    return cdf(t + 1, a, b) - cdf(t, a, b)


def mode(a, b) -> Column:
    return F.when(b <= 1, F.lit(0.0)).otherwise(a * F.pow((b - 1) / b, 1 / b))


def mean(a, b) -> Column:
    return a * gamma(1 + 1 / b)


def quantile(a, b, p) -> Column:
    return a * F.pow(-F.ln(1 - F.lit(p)), 1 / b)


# --- distribution of the rest, given no event up to t ---------------------------


def excess_pdf(t, s, a, b) -> Column:
    gone, ahead = cumulative_hazard(t, a, b), cumulative_hazard(t + s, a, b)
    return hazard(t + s, a, b) * F.exp(gone - ahead)


def excess_cdf(t, s, a, b) -> Column:
    return 1 - F.exp(cumulative_hazard(t, a, b) - cumulative_hazard(t + s, a, b))


def excess_quantile(t, a, b, p) -> Column:
    """Inverse of ``excess_cdf`` in ``s``; equals ``quantile`` at t = 0."""
    return a * F.pow(cumulative_hazard(t, a, b) - F.ln(1 - F.lit(p)), 1 / b) - t


# --- censored log-likelihoods ----------------------------------------------------


def _log_expm1(x) -> Column:
    """ln(e^x - 1) without overflow."""
    return x + F.ln(-F.expm1(-x))


def discrete_loglik(t, a, b, u, equality: bool = False) -> Column:
    """u = 1: the event fell into step t; u = 0: nothing up to the end of step t."""
    before, after = cumulative_hazard(t, a, b), cumulative_hazard(t + 1, a, b)
    if equality:
        return u * (-before + F.ln(-F.expm1(before - after))) - (1 - u) * after
    return u * _log_expm1(after - before) - after


def continuous_loglik(t, a, b, u, equality: bool = False, epsilon: float = 0.0) -> Column:
    """Up to terms free of a and b unless ``equality``."""
    if equality:
        return u * F.ln(hazard(t, a, b)) - cumulative_hazard(t, a, b)
    scaled = (t + epsilon) / a
    return u * (F.ln(b) + b * F.ln(scaled)) - F.pow(scaled, b)


def training_loglik(t, a, b, u, epsilon: float = 1e-7) -> Column:
    """Discrete form used for fitting: ``epsilon`` keeps the log away from zero."""
    before = F.pow((t + epsilon) / a, b)
    after = F.pow((t + 1) / a, b)
    step = after - before
    return u * (step + F.ln(1 - (1 - epsilon) * F.exp(-step))) - after


def clipped_loss(loglik, clip_prob: float | None = 1e-6) -> Column:
    if clip_prob is None:
        return -loglik
    lo, hi = F.lit(math.log(clip_prob)), F.lit(math.log(1 - clip_prob))
    return -F.least(F.greatest(loglik, lo), hi)


def loss(t, a, b, u, kind: str = "discrete", clip_prob: float | None = 1e-6) -> Column:
    """Per-row loss; reduce it with ``avg``."""
    if kind == "discrete":
        return clipped_loss(training_loglik(t, a, b, u), clip_prob)
    if kind == "continuous":
        return clipped_loss(continuous_loglik(t, a, b, u, epsilon=1e-7), clip_prob)
    raise ValueError(f"unknown kind {kind!r}")


def output_transform(x0, x1, init_alpha: float = 1.0, max_beta: float = 5.0, scale: float | None = None):
    """Two raw scores -> (alpha, beta): alpha around its start value, beta bounded."""
    if scale is not None:
        x0, x1 = x0 * scale, x1 * scale
    if max_beta > 1.05:
        x1 = x1 - math.log(max_beta - 1.0)
    return init_alpha * F.exp(x0), max_beta / (1 + F.exp(-x1))
