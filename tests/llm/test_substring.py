import collections
import hashlib
import random

import pytest

from shopspan.llm.substring import repeated_passages, without_repeats
from tests.llm.conftest import words_of


def brute(texts, length):
    words = [words_of(t) for t in texts]
    seen = collections.Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        keep = [True] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                keep[i:i + length] = [False] * length
        out.append((len(w), keep.count(False), " ".join(x for x, k in zip(w, keep) if k)))
    return out


@pytest.mark.parametrize("length", [35, 9, 3])
def test_equals_counting_all_windows(spark, prose, length):
    rng = random.Random(length)
    shared = [prose(500 + k, rng.choice([34, 35, 36, 80])) for k in range(6)]
    texts = []
    for d in range(50):
        parts = [prose(600 + d, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), prose(9000 + d, rng.randint(0, 5))]
        texts.append(rng.choice([" ", "\n", "\t  "]).join(parts))
    texts += ["the the " * 60, "a " * 40, "a " * 34, texts[3], texts[3].replace(" ", "  ")]
    got = repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), length).collect()
    want = brute(texts, length)
    for r in got:
        n, removed, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, removed, hashlib.sha256(kept.encode()).hexdigest())
        assert r.kept_text == (kept if removed else None)


def test_odd_rows(odd_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    want = sorted(brute([r.text for r in rows], 35))
    got = sorted((r.n_words, r.n_removed, r.kept_sha256) for r in repeated_passages(odd_docs).collect())
    assert got == sorted((n, k, hashlib.sha256(t.encode()).hexdigest()) for n, k, t in want)


def test_stage_changes_only_repeats(odd_docs):
    new = without_repeats(odd_docs)
    assert new.columns == odd_docs.columns and new.count() == odd_docs.count()
    texts = {r.doc_id: r.text for r in new.collect() if r.doc_id is not None}
    old = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    assert texts[1] is None and all(texts[d] == old[d] for d in (2, 3, 4, 6, 9, 12, 13))
    assert all(texts[d] == "" for d in (7, 8, 10, 11))


def test_empty_table(odd_docs):
    assert repeated_passages(odd_docs.limit(0)).count() == 0
    assert without_repeats(odd_docs.limit(0)).count() == 0
