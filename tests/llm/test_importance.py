import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from shopspan.llm import importance
from shopspan.llm.importance import FrequentKeys, buckets, empty_head, fit_head, resample, words_of

TOKEN = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def features(text, ngrams):
    words = TOKEN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[k: k + n]) for n in range(1, ngrams + 1) for k in range(len(words) - n + 1)]


def brute(docs, target, ngrams=1, percent=10, least=20, n_buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % n_buckets
    s, t = (Counter(bucket(f) for text in texts for f in features(text, ngrams)[1]) for texts in ([x for _, x in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + n_buckets) / ((s[b] + 1) * (all_t + n_buckets)))) for b in {*s, *t}}
    rows = []
    for d, text in docs:
        words, found = features(text, ngrams)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in found)
        rows.append([d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words)])
    eligible = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = {id(r): k + 1 for k, r in enumerate(eligible[: len(eligible) * percent // 100])}
    return sorted(((*r[:4], drawn.get(id(r))) for r in rows), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("ngrams", [1, 2])
def test_equals_brute_force(spark, odd_docs, prose, with_clashes, ngrams):
    more = [(100 + k, prose(k, 10 + 3 * k) + " É-ß x2x " + "z" * 700) for k in range(60)]
    docs = odd_docs.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    target = [prose(5, 300), None, "", prose(20, 80).upper()]
    got = resample(with_clashes(docs), with_clashes(spark.createDataFrame([(t,) for t in target], "text string")), percent=50, ngrams=ngrams)
    assert rows_of(got) == brute([(r.doc_id, r.text) for r in docs.collect()], target, ngrams, percent=50)


def test_head_and_tail_give_the_same_buckets(spark, prose, monkeypatch):
    texts = [prose(k, 400) for k in range(20)] + ["a b a b " * 50, "a", "", "a\x7fb"]
    head = fit_head(spark.createDataFrame([(t,) for t in texts], "text string"), ngrams=2)
    assert (head.words.low > 0).sum() > 1000 and (head.pairs.low > 0).sum() > 1000
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    data, words = words_of(data, offsets)
    with_head, without = (buckets(data, words, h, 2, 10_000) for h in (head, empty_head()))
    want = [[], []]
    for t in texts:
        w = features(t, 1)[0]
        want[0] += [zlib.crc32(x.encode()) % 10_000 for x in w]
        want[1] += [zlib.crc32(f"{a} {b}".encode()) % 10_000 for a, b in zip(w, w[1:])]
    for n in (0, 1):
        assert with_head[n][0].tolist() == without[n][0].tolist() == want[n]


def test_frequent_keys_keep_every_heavy_one():
    rng = random.Random(1)
    stream = [rng.choice([7, 8, 9]) if rng.random() < 0.2 else rng.randint(100, 10**6) for _ in range(20_000)]
    sketch = FrequentKeys(40)
    for k in range(0, len(stream), 500):
        part = np.array(stream[k: k + 500], dtype=np.uint64)
        sketch.add(part, part * np.uint64(0))
    assert len(sketch.keys) <= 40 and {7, 8, 9} <= set(sketch.keys["low"].tolist())


def test_nothing_drawn_from_nothing(spark, odd_docs):
    target = spark.createDataFrame([("a b",)], "text string")
    assert resample(odd_docs.limit(0), target).count() == 0
    got = resample(odd_docs.select("doc_id", "text"), target.limit(0), percent=100).collect()
    assert sum(r.rank is not None for r in got) == sum(r.n_features >= 20 for r in got)
    with pytest.raises(ValueError):
        importance.importance_weights(odd_docs, target, ngrams=3)
