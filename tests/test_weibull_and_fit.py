import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopspan.functions import weibull as wb
from shopspan.operators import fitting, quality
from shopspan.sources.staging import staged


def test_functions_match_closed_forms(spark):
    grid = [(t, a, b) for t in (0.0, 1.0, 5.0) for a in (2.0, 9.5) for b in (0.7, 1.0, 2.5)]
    df = spark.createDataFrame(grid, "t double, a double, b double")
    t, a, b = F.col("t"), F.col("a"), F.col("b")
    got = df.select(
        "t", "a", "b", wb.cdf(t, a, b).alias("cdf"), wb.pmf(t, a, b).alias("pmf"), wb.cmf(t, a, b).alias("cmf"),
        wb.mean(a, b).alias("mean"), wb.mode(a, b).alias("mode"), wb.quantile(a, b, 0.3).alias("q"),
        wb.excess_cdf(t, wb.excess_quantile(t, a, b, 0.3), a, b).alias("back"),
        wb.discrete_loglik(t, a, b, F.lit(1.0), equality=True).alias("ll1"),
        wb.discrete_loglik(t, a, b, F.lit(1.0)).alias("ll1p"),
        wb.discrete_loglik(t, a, b, F.lit(0.0)).alias("ll0"),
    ).collect()
    for r in got:
        def surv(x):
            return math.exp(-((x / r.a) ** r.b))
        assert math.isclose(r.cdf, 1 - surv(r.t), abs_tol=1e-12)
        assert math.isclose(r.pmf, surv(r.t) - surv(r.t + 1), abs_tol=1e-12)
        assert math.isclose(r.cmf, 1 - surv(r.t + 1), abs_tol=1e-12)
        assert math.isclose(r["mean"], r.a * math.gamma(1 + 1 / r.b), rel_tol=1e-12)
        want = 0 if r.b <= 1 else r.a * ((r.b - 1) / r.b) ** (1 / r.b)
        assert math.isclose(r["mode"], want, abs_tol=1e-12)
        assert math.isclose(1 - surv(r.q), 0.3, abs_tol=1e-12) and math.isclose(r.back, 0.3, abs_tol=1e-9)
        assert math.isclose(r.ll1, math.log(r.pmf), abs_tol=1e-9)
        assert math.isclose(r.ll1, r.ll1p, abs_tol=1e-9)
        assert math.isclose(r.ll0, math.log(surv(r.t + 1)), abs_tol=1e-9)


def test_loglik_stays_finite_and_loss_is_clipped(spark):
    df = spark.createDataFrame([(500.0, 1.0, 3.0, 1.0), (500.0, 1.0, 3.0, 0.0)], "t double, a double, b double, u double")
    args = [F.col(c) for c in "tabu"]
    r = df.agg(
        F.max(F.isnan(wb.training_loglik(*args)).cast("int")).alias("nan"),
        F.avg(wb.loss(*args, clip_prob=1e-5)).alias("loss"),
    ).first()
    assert r.nan == 0 and math.isclose(r.loss, -math.log(1e-5))


def test_output_transform(spark):
    a, b = wb.output_transform(F.lit(0.0), F.lit(0.0), init_alpha=7.0, max_beta=5.0)
    r = spark.range(1).select(a.alias("a"), b.alias("b")).first()
    assert math.isclose(r.a, 7.0) and math.isclose(r.b, 1.0)


def _draws(spark, alpha, beta, n, seed, **segment):
    rng = np.random.default_rng(seed)
    full = np.floor(alpha * rng.weibull(beta, n)).astype(int)
    horizon = rng.integers(1, 40, n)
    u = (full < horizon).astype(int)
    tte = np.minimum(full, horizon - 1)
    rows = [(int(a), int(b)) for a, b in zip(tte, u)]
    return spark.createDataFrame(rows, "tte int, u int").withColumns({k: F.lit(v) for k, v in segment.items()})


def test_fit_recovers_known_parameters(spark):
    rows = _draws(spark, 12.0, 1.4, 20000, 1, seg=1).unionByName(_draws(spark, 5.0, 0.8, 20000, 2, seg=2))
    fitted = {r.seg: r for r in fitting.fit_weibull(fitting.tte_histogram(rows, ["seg"]), ["seg"], 8.0).collect()}
    assert abs(fitted[1].alpha - 12) < 0.4 and abs(fitted[1].beta - 1.4) < 0.05
    assert abs(fitted[2].alpha - 5) < 0.25 and abs(fitted[2].beta - 0.8) < 0.04


def test_segment_without_events_is_left_out(spark):
    rows = spark.createDataFrame([(1, 3, 0), (1, 2, 0), (2, 1, 1), (2, 4, 1), (2, 2, 0)], "seg int, tte int, u int")
    got = fitting.fit_weibull(fitting.tte_histogram(rows, ["seg"]), ["seg"], 5.0).collect()
    assert [r.seg for r in got] == [2]


def test_scores_fall_back_to_coarser_segments(spark):
    rows = (
        _draws(spark, 12.0, 1.4, 4000, 1, region_id=1, recency_bin=0, frequency_bin=1)
        .unionByName(_draws(spark, 4.0, 1.0, 10, 2, region_id=2, recency_bin=0, frequency_bin=1))
        .unionByName(spark.createDataFrame([(3, 0)], "tte int, u int").selectExpr(
            "tte", "u", "3 AS region_id", "0 AS recency_bin", "1 AS frequency_bin"))
    )
    fitted = staged(fitting.fit_candidates(rows, 8.0), "fitted")
    # Ten rows are enough to keep a segment; one without an event has no fit.
    assert {(r.candidate, r.region_id) for r in fitted.collect()} == {
        ("overall", None), ("behaviour", None), ("regional", 1), ("regional", 2)}
    current = spark.createDataFrame(
        [(1, 1, 0, 1), (2, 2, 0, 1), (3, 3, 0, 1), (4, 2, 5, 4)], "hhn bigint, region_id int, recency_bin int, frequency_bin int")
    level = {(r.candidate, r.region_id): r.alpha for r in fitted.collect()}
    got = {r.hhn: r.alpha for r in fitting.score(current, fitted).collect()}
    assert got == {1: level["regional", 1], 2: level["regional", 2], 3: level["behaviour", None], 4: level["overall", None]}
    coarse = {r.hhn: r.alpha for r in fitting.score(current, fitted, "overall").collect()}
    assert set(coarse.values()) == {level["overall", None]}


def test_fits_tell_how_they_ended(spark):
    rows = _draws(spark, 12.0, 1.4, 4000, 1, region_id=1, recency_bin=0, frequency_bin=1)
    histogram = staged(fitting.candidate_histograms(rows), "histogram")
    by = ["candidate", *fitting.CANDIDATES["regional"]]
    fitted = staged(fitting.fit_weibull(histogram, by, 8.0), "fitted")
    assert all(r.converged and not r.at_bound and r.gradient_norm < 1e-7 for r in fitted.collect())
    assert all(r.best for r in fitting.fit_optimality(histogram, fitted).collect())
    moved = fitted.withColumn("beta", F.col("beta") * 1.1)
    assert not any(r.best for r in fitting.fit_optimality(histogram, moved).collect())
    stopped = fitting.fit_weibull(histogram, by, 300.0, fitting.FitBounds(max_steps=1))
    assert not any(r.converged for r in stopped.collect())
    with pytest.raises(quality.QualityError, match="converged"):
        quality.require(quality.check_fits(stopped), "fitted")
    # All events in the same step: the likelihood rises up to the largest beta.
    steep = spark.createDataFrame([(6, 1)] * 5, "tte int, u int").selectExpr(
        "tte", "u", "1 AS region_id", "0 AS recency_bin", "1 AS frequency_bin")
    at_top = fitting.fit_candidates(steep, 8.0).collect()
    assert all(r.converged and r.at_bound and abs(r.beta - 5) < 1e-9 for r in at_top)


def test_init_alpha(spark):
    r = fitting.init_alpha(spark.createDataFrame([(1, 1), (3, 0)], "tte int, u int")).first()
    assert math.isclose(r.init_alpha, -1 / math.log(1 - 1 / 3) / 0.5)
