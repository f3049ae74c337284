import numpy as np
import pytest
from pyspark.sql import functions as F

from shopspan.operators import regression as reg


def _rows(spark, n=4000, seed=3):
    """Households whose alpha grows with one feature and whose beta falls with another."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, len(reg.INPUTS)))
    alpha, beta = 6 * np.exp(0.5 * x[:, 0] - 0.3 * x[:, 4]), 1.2 * np.exp(-0.15 * x[:, 2])
    full = np.floor(alpha * rng.weibull(beta)).astype(int)
    horizon = rng.integers(1, 60, n)
    u, tte = (full < horizon).astype(int), np.minimum(full, horizon - 1)
    x[:, 7] = 3.0  # a constant input
    data = [(*map(float, x[k]), int(tte[k]), int(u[k]), k) for k in range(n)]
    return spark.createDataFrame(data, ", ".join(f"{c} double" for c in reg.INPUTS) + ", tte int, u int, hhn int")


def test_derivatives_against_differences():
    rng = np.random.default_rng(1)
    t, u = rng.integers(0, 30, 50).astype(float), rng.integers(0, 2, 50).astype(float)
    x0, x1, h = rng.normal(0, 0.6, 50), rng.normal(0, 0.6, 50), 1e-5
    value = lambda a, b: reg.row_derivatives(t, u, a, b, 8.0)
    _, first, second = value(x0, x1)
    for k, (da, db) in enumerate(((h, 0), (0, h))):
        up, down = value(x0 + da, x1 + db), value(x0 - da, x1 - db)
        np.testing.assert_allclose((up[0] - down[0]) / (2 * h), first[k], rtol=1e-4, atol=1e-6)
        np.testing.assert_allclose((up[1][k] - down[1][k]) / (2 * h), second[2 * k], rtol=1e-4, atol=1e-5)
        np.testing.assert_allclose((up[1][1 - k] - down[1][1 - k]) / (2 * h), second[1], rtol=1e-4, atol=1e-5)


def test_fit_finds_the_features_that_matter(spark):
    rows = _rows(spark).cache()
    fit = reg.fit_heads(rows, 6.0)
    assert fit.converged and fit.n_rows == 4000
    weights = {(r["head"], r["input"]): r["weight"] for r in fit.table(spark).collect()}
    assert abs(weights["alpha", reg.INPUTS[0]] - 0.5) < 0.06 and abs(weights["alpha", reg.INPUTS[4]] + 0.3) < 0.06
    assert weights["beta", reg.INPUTS[2]] < -0.1
    assert abs(weights["alpha", reg.INPUTS[7]]) < 1e-6  # constant: no say
    others = [w for (h, c), w in weights.items() if h == "alpha" and c not in ("intercept", reg.INPUTS[0], reg.INPUTS[4])]
    assert max(map(abs, others)) < 0.08
    assert max(abs(r["gradient"]) for r in reg.head_gradient(rows, fit).collect()) < 1e-4
    flat = reg.likelihood_sums(rows, np.zeros_like(fit.weights), fit.scale, 6.0)
    assert fit.mean_loglik > flat.loglik / flat.n + 0.02
    again = reg.heads_of(fit.table(spark))
    assert again.weights.tolist() == fit.weights.tolist() and again.scale.spread.tolist() == fit.scale.spread.tolist()
    with pytest.raises(ValueError):
        reg.heads_of(fit.table(spark).where("input <> 'intercept'"))
    scored = reg.score_heads(rows, fit).agg({"alpha": "min", "beta": "max"}).first()
    assert scored[0] > 0 and scored[1] < reg.MAX_BETA


def test_sums_do_not_depend_on_partitions(spark):
    rows = _rows(spark, 500)
    w = np.linspace(-0.2, 0.2, 2 * (len(reg.INPUTS) + 1))
    scale = reg.scales(rows)
    one, many = (reg.likelihood_sums(r, w, scale, 5.0) for r in (rows.coalesce(1), rows.repartition(7)))
    np.testing.assert_allclose(one.curvature, many.curvature, rtol=1e-9, atol=1e-9)
    assert one.n == many.n == 500 and abs(one.loglik - many.loglik) < 1e-8


def test_no_rows(spark):
    with pytest.raises(ValueError):
        reg.fit_heads(_rows(spark, 20).limit(0), 5.0)


def test_empty_weeks_are_counted_and_give_the_same_sums(spark):
    some = _rows(spark, 300)
    empty = spark.range(5000).selectExpr(
        *[f"0D AS {c}" for c in reg.NUMERIC_FEATURES], "log1p(CAST(id % 4 AS double)) AS log_recency",
        "1 / (1 + id % 3) AS purchase_share", "CAST(id % 5 AS int) AS tte", "CAST(id % 2 AS int) AS u", "CAST(id AS int) AS hhn")
    unknown = empty.limit(7).withColumn(reg.NUMERIC_FEATURES[0], F.lit(None).cast("double"))
    rows = some.unionByName(empty)
    alike = reg.alike_rows(rows)
    assert alike.count() == 300 + 60 and alike.agg({"n_alike": "sum"}).first()[0] == 5300
    assert reg.alike_rows(rows.unionByName(unknown)).count() == 300 + 60 + 7
    w, scale = np.linspace(-0.2, 0.2, 2 * (len(reg.INPUTS) + 1)), reg.scales(rows)
    one, all_ = (reg.likelihood_sums(r, w, scale, 5.0) for r in (alike, rows))
    assert one.n == all_.n == 5300 and abs(one.loglik - all_.loglik) < 1e-8 * abs(all_.loglik)
    np.testing.assert_allclose(one.gradient, all_.gradient, rtol=1e-8, atol=1e-7)
    np.testing.assert_allclose(one.curvature, all_.curvature, rtol=1e-8, atol=1e-7)


def test_steps_read_counted_rows(spark, monkeypatch):
    rows, read, sums = _rows(spark, 50), [], reg.likelihood_sums
    empty = rows.selectExpr(*[f"0D AS {c}" for c in reg.NUMERIC_FEATURES], "0D AS log_recency", "1D AS purchase_share", "tte", "u", "hhn")
    monkeypatch.setattr(reg, "likelihood_sums", lambda r, *a: read.append(r.count()) or sums(r, *a))
    fit = reg.fit_heads(rows.unionByName(empty), 6.0)
    assert fit.n_rows == 100 and max(read) == 50 + empty.select("tte", "u").distinct().count() < 100
