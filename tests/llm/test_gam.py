import numpy as np

from shopspan.llm import gam
from tests.llm.conftest import words_of


def test_interaction_is_learned():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert (0, 3) in [(i, j) for i, j, _ in model.pairs]
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.85


def test_tree_picks_the_best_split():
    grad = np.array([1.0, 1, 1, -1, -1, -1, -1, -1])
    leaf, gain = gam.shallow_tree(grad, np.ones(8), 1)
    assert leaf[:3].ptp() == 0 if hasattr(leaf, "ptp") else np.ptp(leaf[:3]) == 0
    assert leaf[0] == 3 / (3 + gam.SMOOTH) and leaf[7] == -5 / (5 + gam.SMOOTH)
    both = [grad[:k].sum() ** 2 / (k + gam.SMOOTH) + grad[k:].sum() ** 2 / (8 - k + gam.SMOOTH) for k in range(1, 8)]
    assert abs(gain - max(both)) < 1e-12


def test_features_by_hand(prose):
    texts = ["", "A b b b.\nC1 #!", prose(1, 500), "naïve ß " * 3]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(r) for r in raw])
    got = gam.features(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert not got[0].any()
    for row, text, r in zip(got, texts, raw):
        named, w = dict(zip(gam.FEATURES, row)), words_of(text)
        if not w:
            continue
        assert named["log_words"] == np.log1p(len(w)) and named["log_bytes"] == np.log1p(len(r))
        assert np.isclose(named["distinct_words"], len(set(w)) / len(w))
        assert np.isclose(named["same_as_before"], sum(a == b for a, b in zip(w, w[1:])) / len(w))
        assert np.isclose(named["commonest_word"], max(w.count(x) for x in set(w)) / len(w))
        assert np.isclose(named["digits"], sum(48 <= b < 58 for b in r) / len(r))


def test_held_out_quality_and_odd_rows(spark, prose, odd_docs):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for k in range(500):
        bad = rng.random() < 0.3
        text = prose(k, int(rng.integers(20, 80)))
        rows.append((k, " ".join(f"{w}!!" for w in text.split()) if bad else text))
        labels.append((k, None if k % 50 == 7 else int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in gam.score_quality(docs, marks).collect()}
    held = [(r.predicted, labels[d][1]) for d, r in got.items() if r.held_out and labels[d][1] is not None]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    odd = gam.score_quality(odd_docs, marks).collect()
    assert len(odd) == len(odd_docs.collect())
    assert all(r.held_out for r in odd if r.doc_id is None)
    assert {r.score for r in gam.score_quality(odd_docs, marks.limit(0)).collect()} == {0.5}
    assert gam.score_quality(odd_docs.limit(0), marks).count() == 0
