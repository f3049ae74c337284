import zlib

import numpy as np

from shopspan.llm import language


def texts_of(vocabulary, seed, n):
    rng = np.random.default_rng(seed)
    a, b = [w + "tion" for w in vocabulary[:400]], [w + "ung" for w in vocabulary[:400]]
    return [(k, " ".join(rng.choice(a if k % 2 else b, rng.integers(3, 60))), "aa" if k % 2 else "bb") for k in range(n)]


def test_held_out_accuracy_and_flags(spark, vocabulary):
    docs = spark.createDataFrame(texts_of(vocabulary, 1, 400), "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    held = [r for r in got.values() if r.held_out]
    assert np.mean([r.lang_pred == ("aa" if r.doc_id % 2 else "bb") for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_no_input_but_the_text(spark, vocabulary):
    rows = texts_of(vocabulary, 1, 200)
    changed = [(d, t, None if zlib.crc32(str(d).encode()) % 5 == 0 else lang) for d, t, lang in rows]
    one, two = ({r.doc_id: r for r in language.identify(
        spark.createDataFrame(x, "doc_id long, text string, lang string")).collect()} for x in (rows, changed))
    assert one == two


def test_odd_rows(odd_docs, spark):
    got = language.identify(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r.doc_id: r for r in got}
    assert all((by_id[d].lang_pred, by_id[d].score) == ("und", 0.0) for d in (1, 2, 3))
    assert by_id[None].held_out
    assert {r.lang_pred for r in got} <= {"en", "de", "und"}
    assert language.identify(odd_docs.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, "word", None), (2, "123 _", "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language.identify(blank.where("doc_id = 1")).collect()} == {"und"}
    assert {r.doc_id: r.lang_pred for r in language.identify(blank).collect()}[2] == "und"


def test_counts_by_hand():
    text = "ab ab".encode()
    counts = language.trigram_counts(np.frombuffer(text, np.uint8), np.array([0, 5]))
    assert counts.sum() == 5 and sorted(counts[counts > 0].tolist()) == [1, 2, 2]


def test_centroids_of_clear_groups():
    rng = np.random.default_rng(0)
    centres = np.eye(3)
    x = np.abs(np.repeat(centres, 20, axis=0) + rng.normal(0, 0.01, (60, 3)))
    got = language.cluster(x / np.linalg.norm(x, axis=1, keepdims=True), 3)
    assert (got @ centres.T).max(axis=0).min() > 0.99
    assert len(language.cluster(np.ones((4, 3)) / 3**0.5, 3)) == 1
