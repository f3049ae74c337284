import random
import re
from collections import Counter

import pytest

from shopspan.llm.divergence import _tokens, divergence, source_counts

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, least=10, top=10):
    """The definitions, over every kept term of every pair of sources."""
    rows = [(lang or "", source or "", terms_of(text)) for lang, source, text in docs]
    out = []
    for lang in {r[0] for r in rows}:
        seen = Counter(t for k, _, terms in rows if k == lang for t in set(terms))
        kept = sorted(t for t, n in seen.items() if n >= least)
        counts = {None: Counter()}
        for k, source, terms in rows:
            if k == lang:
                found = [t for t in terms if seen[t] >= least]
                counts.setdefault(source, Counter()).update(found)
                counts[None].update(found)
        share = {}
        for source, c in counts.items():
            total = sum(c.values()) + 2 * len(kept)
            share[source] = {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}
        apart = lambda p, q: (p - q) ** 2 // (p + q)
        for a in set(counts) - {None}:
            parts = {
                "pair": [(b, sum(apart(share[a][t], share[b][t]) for t in kept)) for b in set(counts) - {None, a}],
                "term": [(t, apart(share[a][t], share[None][t])) for t in kept if counts[a][t] and share[a][t] > share[None][t]],
            }
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, a, part, item, v, k + 1) for k, (item, v) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = ["Wort", "été", "naïve", "the", "of", "A", "b", "don't", "x1y", "日本", "Éa"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
    out = []
    for k in range(300):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s1", "s1", "s2", "S3", None, ""])
        some = words[: 40 + 10 * rng.randint(0, 8)]
        out.append((lang, source, " ".join(rng.choice(some) for _ in range(rng.randint(0, 60)))))
    out += [("fr", "s1", "seul ici")] * 9 + [("fr", "s2", None)]  # no term in ten documents
    out += [("it", "s1", "a b c")] * 3 + [("es", "only", "uno dos uno")] * 12 + [("pt", "s1", None), ("pt", "s2", "")]
    out += [("en", "empty", "1 2 3"), ("en", "one", "w" * 100_000)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows, with_clashes):
    return with_clashes(spark.createDataFrame(rows, "lang string, source string, text string"), "source")


def test_equals_brute_force(docs, rows):
    assert sorted(tuple(r) for r in divergence(docs).collect()) == brute(rows)


def test_several_vectorizers_a_language_give_the_same(docs, rows, monkeypatch):
    monkeypatch.setattr("shopspan.llm.divergence._PICK", 1)
    assert sorted(tuple(r) for r in divergence(docs, least_documents=3, top=4, terms_at_once=40).collect()) == brute(rows, 3, 4)


def test_counts_are_sparse_and_exact(docs, rows):
    groups, counts = source_counts(docs)
    assert groups.count() == len({(a or "", b or "") for a, b, _ in rows})
    got = {(r.lang, r.source, r.term): r.n for r in counts.collect()}
    want = Counter((a or "", b or "", t) for a, b, text in rows for t in terms_of(text))
    assert got and all(want[k] == n > 0 for k, n in got.items())


def test_empty(docs):
    got = divergence(docs.limit(0))
    assert got.count() == 0 and got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_no_vector_per_document(docs, monkeypatch):
    """A source's counts come from sums of whole blocks, so the vectorizer only gives the vocabulary."""
    from pyspark.ml.feature import CountVectorizerModel

    monkeypatch.setattr(CountVectorizerModel, "transform", lambda *a: pytest.fail("documents turned into vectors"))
    assert source_counts(docs)[1].count() > 0
    batch = docs.select("lang", "source", "text").fillna("").where("source = 's1'").limit(50).toArrow().combine_chunks().to_batches()[0]
    found = list(_tokens([batch]))
    summed = {(r["lang"], r["source"], t): n for b in found for r in b.to_pylist() if r["summed"] for t, n in zip(r["terms"], r["counts"])}
    assert summed == Counter((r["lang"], r["source"], t) for r in batch.to_pylist() for t in terms_of(r["text"]))
