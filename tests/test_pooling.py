import numpy as np
import pytest
from pyspark.sql import functions as F

from shopspan.operators import fitting, pooling
from shopspan.sources.staging import staged


def _drawn(spark, segments, seed=5, horizon=200):
    """Rows of segments (region, recency, frequency, alpha, beta, n)."""
    draw = np.random.default_rng(seed)
    rows = []
    for region, recency, frequency, alpha, beta, n in segments:
        full = np.floor(alpha * draw.weibull(beta, n)).astype(int)
        u = (full < horizon).astype(int)
        rows += [(region, recency, frequency, int(t), int(e)) for t, e in zip(np.minimum(full, horizon - 1), u)]
    return spark.createDataFrame(rows, "region_id int, recency_bin int, frequency_bin int, tte int, u int")


@pytest.fixture(scope="module")
def tree(spark):
    """Thirty regions whose ln alpha varies by 0.3 around the behaviour's, some large and some tiny."""
    draw = np.random.default_rng(9)
    truth = {r: 8 * np.exp(0.3 * draw.standard_normal()) for r in range(1, 31)}
    sizes = {r: 2000 if r % 3 == 0 else 3 for r in truth}
    rows = _drawn(spark, [(r, 0, 1, a, 1.2, sizes[r]) for r, a in truth.items()])
    histogram = staged(fitting.candidate_histograms(rows), "histogram")
    return truth, sizes, histogram, staged(pooling.fit_pooled(histogram, 8.0), "fitted")


def test_large_segments_keep_their_fit_and_small_ones_lean_on_the_parent(spark, tree):
    truth, sizes, histogram, fitted = tree
    own = {r.region_id: r for r in fitting.fit_weibull(histogram, list(pooling.KEYS), 8.0).collect() if r.candidate == "regional"}
    got = {r.region_id: r for r in fitted.collect() if r.candidate == "regional"}
    assert set(got) == set(truth) and all(r.converged for r in got.values())
    large = [r for r in truth if sizes[r] == 2000]
    small = [r for r in truth if sizes[r] == 3]
    assert max(abs(np.log(got[r].alpha / own[r].alpha)) for r in large) < 0.02

    def error(fits, regions):
        return np.mean([np.log(fits[r].alpha / truth[r]) ** 2 for r in regions])

    assert error(got, small) < 0.5 * error(own, small)
    # Drawn with a variance of 0.09. All shapes are equal, but above the parent's, which mixes scales: (ln 1.2 - 0.07)^2 = 0.0125.
    assert 0.04 < got[3].spread_alpha < 0.2 and 0.005 < got[3].spread_beta < 0.03


def test_no_neighbour_has_a_higher_posterior(spark, tree):
    _, _, histogram, fitted = tree
    found = pooling.pooled_optimality(histogram, fitted).collect()
    assert len(found) == 32 and all(r.best for r in found)
    moved = fitted.withColumn("alpha", F.col("alpha") * 1.05)
    assert not any(r.best for r in pooling.pooled_optimality(histogram, moved).collect())


def test_held_out_likelihood_is_not_below_the_own_fits(spark, tree):
    truth, _, histogram, fitted = tree
    fresh = staged(_drawn(spark, [(r, 0, 1, a, 1.2, 300) for r, a in truth.items()], seed=77), "fresh")
    own = staged(fitting.fit_weibull(histogram, list(pooling.KEYS), 8.0), "own")
    means = [fitting.score(fresh, f).agg(F.avg(pooling.row_loglik())).first()[0] for f in (fitted, own)]
    assert means[0] > means[1]


def test_segments_without_events_take_a_fit_from_their_parent(spark):
    rows = _drawn(spark, [(1, 0, 1, 10.0, 1.0, 500), (2, 0, 1, 10.0, 1.0, 500)]).unionByName(
        spark.createDataFrame([(3, 0, 1, 4, 0), (None, 0, 1, 2, 0), (None, 0, 1, 2, 0)],
                              "region_id int, recency_bin int, frequency_bin int, tte int, u int"))
    got = {(r.candidate, r.region_id): r for r in pooling.fit_pooled(fitting.candidate_histograms(rows), 8.0).collect()}
    assert set(got) == {("overall", None), ("behaviour", None), ("regional", 1), ("regional", 2), ("regional", 3), ("regional", None)}
    parent = got["behaviour", None]
    # Nothing bought in the steps seen: a little longer than the parent, not without end.
    assert parent.alpha <= got["regional", 3].alpha < 2 * parent.alpha
    # A level with one segment has no spread beyond the least.
    assert parent.spread_alpha == pytest.approx(pooling.LEAST_SPREAD)


def test_no_events_and_no_rows_give_no_fits(spark):
    none = spark.createDataFrame([(1, 0, 1, 4, 0)], "region_id int, recency_bin int, frequency_bin int, tte int, u int")
    assert pooling.fit_pooled(fitting.candidate_histograms(none), 8.0).count() == 0
    assert pooling.fit_pooled(fitting.candidate_histograms(none.limit(0)), 8.0).count() == 0


def test_spread_and_mean_by_hand(spark):
    rows = [(0.5, 0.1, 0.0), (-0.7, 0.2, 0.0), (0.1, None, 0.0)]
    level = spark.createDataFrame(
        [(d, v, c, 0.0, 0.5, c) for d, v, c in rows],
        "ln_alpha double, variance_alpha double, centre_alpha double, ln_beta double, variance_beta double, centre_beta double")
    got = pooling.level_spread(level).first()
    d2, v = np.array([0.25, 0.49]), np.array([0.1, 0.2])
    first = np.average(d2 - v, weights=1 / v)
    assert got.spread_alpha == pytest.approx(np.average(d2 - v, weights=1 / (v + first)))
    assert (got.n_alpha, got.n_beta, got.spread_beta) == (2, 3, pooling.LEAST_SPREAD)
    mean = level.select(pooling.shrunk(F.col("ln_alpha"), F.col("variance_alpha"), F.col("centre_alpha"), F.lit(0.1))).collect()
    assert [r[0] for r in mean] == pytest.approx([0.25, -0.7 / 3, 0.0])
