import math
import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopspan.operators import evaluation as ev
from shopspan.operators import reports


def _auc(label, score):
    pos, neg = score[label == 1], score[label == 0]
    if not len(pos) or not len(neg):
        return None
    d = pos[:, None] - neg[None, :]
    return float(((d > 0) + 0.5 * (d == 0)).mean())


def _steps(label, score):
    """(false positives, true positives) down the distinct scores."""
    return [((score >= s)[label == 0].sum(), (score >= s)[label == 1].sum()) for s in sorted(set(score), reverse=True)]


def _ap(label, score):
    total, last, out = label.sum(), 0, 0.0
    for fp, tp in _steps(label, score):
        out += (tp - last) / total * tp / (tp + fp)
        last = tp
    return float(out)


def _ece(label, prob, bins=10):
    edge, out = -1.0, 0.0
    for i in range(bins):
        right = (i + 1) / bins
        inside = (prob > edge) & (prob <= right)
        if inside.any():
            out += inside.mean() * abs(label[inside].mean() - prob[inside].mean())
        edge = right
    return float(out)


@pytest.fixture(scope="module")
def outcomes(spark):
    rng = random.Random(3)
    rows = []
    for width in (10, 11):
        for h in range(700):
            # Many ties, exact bin edges and one very common score.
            score = 0.4 if h % 3 == 0 else round(rng.random(), 2)
            rows.append((h, width, int(rng.random() < score), score))
    rows += [(h, 12, 1, 0.5 + h / 100) for h in range(5)]
    return spark.createDataFrame(rows, "hhn bigint, box_width int, churned int, score double").cache()


def _arrays(outcomes, width):
    rows = outcomes.where(F.col("box_width") == width).collect()
    return np.array([r.churned for r in rows]), np.array([r.score for r in rows])


def test_metrics_match_brute_force(outcomes):
    got = {r.box_width: r for r in ev.horizon_metrics(outcomes).collect()}
    for width in (10, 11):
        label, score = _arrays(outcomes, width)
        r = got[width]
        assert math.isclose(r.auc, _auc(label, score), abs_tol=1e-12)
        assert math.isclose(r.ap, _ap(label, score), abs_tol=1e-12)
        assert math.isclose(r.ece, _ece(label, score), abs_tol=1e-12)
        assert math.isclose(r.frac_in_box, 1 - label.mean()) and r.observations == 700
    assert got[12].auc is None
    # An undefined horizon leaves the mean undefined.
    mean = ev.mean_metrics(ev.horizon_metrics(outcomes)).first()
    assert mean.mean_auc is None and mean.mean_ece is not None
    assert ev.mean_metrics(ev.horizon_metrics(outcomes.where("false"))).count() == 0


def test_curves(outcomes):
    steps = ev.score_steps(outcomes.where("box_width = 10"))
    label, score = _arrays(outcomes, 10)
    walk = np.array(_steps(label, score), dtype=float)
    keep = [0] + [i for i in range(1, len(walk) - 1) if (walk[i + 1] - 2 * walk[i] + walk[i - 1]).any()] + [len(walk) - 1]
    want = [(0.0, 0.0)] + [tuple(walk[i] / [(label == 0).sum(), label.sum()]) for i in keep]
    got = sorted((r.fpr, r.tpr) for r in ev.roc_points(steps).collect())
    assert np.allclose(got, sorted(want)) and len(got) == len(want)
    assert ev.roc_points(steps, drop_collinear=False).count() == len(walk) + 1
    full = next(i for i, (_, tp) in enumerate(walk) if tp == label.sum())
    want = sorted([(tp / label.sum(), tp / (tp + fp)) for fp, tp in walk[: full + 1]] + [(0.0, 1.0)])
    got = sorted((r.recall, r.precision) for r in ev.pr_points(steps).collect())
    assert np.allclose(got, want)


def test_auc_only_depends_on_order(outcomes):
    moved = outcomes.withColumn("score", F.pow("score", F.lit(3.0)))
    a, b = (
        {r.box_width: r.auc for r in ev.discrimination(ev.score_steps(o)).collect()} for o in (outcomes, moved)
    )
    assert a.keys() == b.keys() and all(a[w] == b[w] or math.isclose(a[w], b[w]) for w in a)


def test_probability_bin_edges(spark):
    values = [0.0, 0.1, 0.1000001, 0.3, 0.30000000000000004, 0.7, 0.7000000000000001, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    assert [r[0] for r in df.select(ev.probability_bin(F.col("p"), 10)).collect()] == [1, 1, 2, 3, 4, 7, 8, 10]


def test_frame_and_widths(spark):
    rows = [  # hhn 2 has no earlier event; hhn 3 has no row at the start step
        (1, 4, 2, 5.0, 1.0), (1, 5, 0, 5.0, 1.0), (1, 6, 3, 6.0, 1.1),
        (2, 6, 1, 7.0, 1.0), (3, 5, 0, 1.0, 1.0),
    ]
    df = spark.createDataFrame(rows, "hhn bigint, k int, tte int, alpha double, beta double")
    got = ev.evaluation_frame(df, 6, True).collect()
    assert [(r.hhn, r.tte, r.since, r.alpha) for r in got] == [(1, 3, 0, 6.0)]
    assert {r.hhn for r in ev.evaluation_frame(df, 6, False).collect()} == {1, 2}
    assert ev.box_widths(17, 10, True) == list(range(10, 17)) and ev.box_widths(5, 10, True) == [4]
    assert ev.box_widths(13, 0, True)[0] == 1 and ev.box_widths(13, 0, False)[0] == 0
    boxes = ev.box_outcomes(ev.evaluation_frame(df, 6, True), 5, 2, True).collect()
    assert {(r.box_width, r.churned) for r in boxes} == {(2, 1), (3, 0), (4, 0)}


def test_paired_t_test(spark):
    folds = [(0, 0.70, 0.74), (1, 0.71, 0.73), (2, 0.69, 0.74), (3, 0.72, 0.73), (4, 0.70, 0.72)]
    df = spark.createDataFrame(folds, "fold int, champion double, challenger double")
    r = ev.promotion(ev.paired_t_test(df, "champion", "challenger"), 0.05).first()
    d = np.array([a - b for _, a, b in folds])
    t = d.mean() / (d.std(ddof=1) / math.sqrt(5))
    p = 0.5 + t * (t * t + 6) / (2 * (t * t + 4) ** 1.5)  # exact for four degrees of freedom
    assert math.isclose(r.statistic, t, rel_tol=1e-9) and math.isclose(r.p_value, p, abs_tol=1e-9)
    assert r.decision == "promote"
    worse = ev.paired_t_test(df, "challenger", "champion")
    assert ev.promotion(worse, 0.05).first().decision == "keep"
    nobody = ev.promotion(ev.paired_t_test(df.where("false"), "champion", "challenger"), 0.05)
    assert nobody.first().decision == "default"


def test_paired_t_test_edges(spark):
    def outcome(gaps):
        folds = [(k, 0.5, 0.5 + g) for k, g in enumerate(gaps)]
        df = spark.createDataFrame(folds, "fold int, champion double, challenger double")
        return ev.promotion(ev.paired_t_test(df, "champion", "challenger"), 0.05).first()

    for gaps, want in (([0.125] * 5, "promote"), ([-0.125] * 5, "keep"), ([0.0] * 5, "keep"), ([0.125], "keep")):
        assert outcome(gaps).decision == want
    assert outcome([0.125] * 5).p_value == 0 and outcome([-0.125] * 5).p_value == 1
    assert outcome([0.1, 0.1, 0.1]).decision == "promote"  # equal but for rounding
    tiny = outcome([0.125 + k * 3.2e-5 for k in range(5)])
    assert 0 <= tiny.p_value < 1e-9 and tiny.decision == "promote"
    for t in (0.0, 0.5, 10.0, 1e3, 1e6):
        exact = 0.5 - t * (t * t + 6) / (2 * (t * t + 4) ** 1.5)  # upper tail, four degrees of freedom
        row = spark.range(1).select(ev.student_cdf(F.lit(-t), F.lit(4)).alias("low"), ev.student_cdf(F.lit(t), F.lit(4)).alias("high")).first()
        assert math.isclose(row.low, exact, abs_tol=1e-12) and math.isclose(row.high, 1 - exact, abs_tol=1e-12)
        if t >= 1e3:
            assert math.isclose(row.low, 3 / t**4, rel_tol=1e-3)
    one = spark.range(1).select(ev.student_cdf(F.lit(-1.0), F.lit(1)).alias("p")).first()  # Cauchy
    assert math.isclose(one.p, 0.25, abs_tol=1e-9)


def test_best_run(spark):
    now = datetime(2022, 5, 5, 12)
    rows = [("a", 0.8, datetime(2022, 5, 5, 1)), ("b", 0.9, datetime(2022, 5, 3)), ("c", None, now),
            ("d", float("nan"), now), ("e", 0.7, now)]
    runs = spark.createDataFrame(rows, "run string, mean_auc double, start_time timestamp")
    assert ev.best_run(runs, F.lit(now), 24).first().run == "a"


def test_reports(spark, outcomes):
    one = outcomes.where("box_width = 10")
    label, score = _arrays(outcomes, 10)
    for n in (4, 10):
        edges = reports.bin_edges(n)
        place = np.array([next((i for i, e in enumerate(edges) if e > s), n - 1) for s in score])
        got = {r.segment: r for r in reports.risk_report(one, n).collect()}
        assert set(got) == set(place)
        for i, r in got.items():
            inside = place == i
            assert (r.total_count, r.churned) == (inside.sum(), label[inside].sum())
            assert math.isclose(r.median_prob, np.median(score[inside]), abs_tol=1e-12)
            assert math.isclose(r.percent_of_total_churned, 100 * label[inside].sum() / label.sum())
    check = reports.risk_report_check(one, 10).collect()
    assert sum(r.total_count for r in check) == 700 and len(check) == 10
    counts = np.histogram(score, 10)[0]
    hist = {(r.series, r.bin): r.n for r in reports.score_histogram(one).collect()}
    assert sum(v for (s, _), v in hist.items() if s == "model") == counts.sum()
    assert hist["truth", 0] + hist["truth", 9] == 700 and len(hist) == 20
    assert reports.score_histogram(one.where("false")).collect() == []
    names = reports.risk_report(one, 4, reports.FOUR_BIN_NAMES).collect()
    assert [r.segment_name for r in names] == ["At Risk", "High", "Medium", "Low"]
    df = spark.createDataFrame([(0.0, 0), (0.25, 1), (0.999, 3), (1.0, 3)], "p double, want int")
    assert df.where(reports.risk_bin(F.col("p"), 4) != F.col("want")).count() == 0
