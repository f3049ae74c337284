import random

import pytest

from shopspan.llm.neardup import near_duplicates, without_near_duplicates
from tests.llm.conftest import words_of


def shingles(text, k):
    w = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent):
    """component of every row by all pairs"""
    sets = [shingles(t, k) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return {d: min(rows[j][0] for j in range(len(rows)) if group[j] == group[i]) for i, (d, _) in enumerate(rows)}


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_components_equal_all_pairs(spark, prose, vocabulary, k, percent):
    rng, rows = random.Random(k), []
    for base in range(8):
        words = prose(100 + base, 150).split()
        for _ in range(base * 3 + 1):
            new = list(words)
            for _ in range(rng.randint(0, 8)):
                new[rng.randrange(len(new))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 1009, " ".join(new)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows, k, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert {r.doc_id: r.n_shingles for r in got} == {d: len(shingles(t, k)) for d, t in rows}


def test_odd_rows(odd_docs):
    got = near_duplicates(odd_docs, 3, 85).collect()
    assert len(got) == odd_docs.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert (by_id[1].n_shingles, by_id[2].n_shingles, by_id[3].n_shingles, by_id[4].n_shingles) == (0, 0, 0, 1)
    assert {by_id[d].component_id for d in (1, 2, 3)} == {1, 2, 3}
    assert by_id[5].component_id == 4 and not by_id[5].kept and by_id[4].kept
    assert {by_id[d].component_id for d in (7, 8, 9)} == {7}
    assert by_id[10].kept and by_id[12].n_shingles == 1 and by_id[11].n_shingles == 1
    nameless = sorted((r.component_id or -1, r.kept) for r in got if r.doc_id is None)
    assert nameless == [(-1, True), (7, False)]


def test_stage_keeps_one_of_each_group(odd_docs):
    kept = without_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 4, 6, 7, 10, 11, 12, 13]


def test_empty_table(odd_docs):
    assert near_duplicates(odd_docs.limit(0)).collect() == []
    assert without_near_duplicates(odd_docs.limit(0)).count() == 0


def test_large_group_in_blocks(spark, prose, vocabulary, monkeypatch):
    from shopspan.llm import neardup

    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 2000)
    rng, base = random.Random(3), prose(55, 100).split()
    rows = []
    for d in range(60):
        new = list(base)
        for _ in range(rng.randint(1, 5)):
            new[rng.randrange(len(new))] = rng.choice(vocabulary)
        rows.append((d, " ".join(new)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 3, 85)


def test_band_width_and_keys(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from shopspan.llm import neardup

    assert [neardup.band_width(p) for p in (50, 80, 85, 95)] == [3, 6, 8, 8]
    raw = np.random.default_rng(0).integers(0, 256, neardup.VALUES, dtype=np.uint8)
    row = spark.createDataFrame([(raw.view(np.int64).tolist(),)], "values array<long>")
    for width in (1, 5, 6, 7, 8):
        got = np.array(row.select(F.array(*neardup._band_keys(width)).alias("k")).first().k, dtype=np.int64).view(np.uint64)
        want = [int.from_bytes(raw[a:a + width].tobytes(), "little") for a in range(0, neardup.VALUES - width + 1, width)]
        assert got.tolist() == want


def test_rows_without_id_keep_one_of_each_class(spark, prose):
    a, b, c = prose(71, 120), prose(72, 120), prose(73, 120)
    near = b.split()
    near[60] = "changed"
    rows = [(7, a), (None, a), (None, b), (None, b), (None, " ".join(near)), (None, c), (None, None), (None, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in without_near_duplicates(docs).collect()]
    assert len(kept) == 5 and {(7, a), (None, c), (None, None), (None, " ")} <= set(kept)
    assert len({b, " ".join(near)} & {t for _, t in kept}) == 1
    got = [(r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted([(7, 7, True), (None, 7, False), *[(None, None, False)] * 2, *[(None, None, True)] * 4], key=repr)


def test_texts_of_a_repeated_id_are_judged_on_their_own(spark, prose):
    a, b, c = prose(81, 120), prose(82, 120), prose(83, 120)
    rows = [(1, a), (5, a), (5, b), (5, b), (9, b + " end"), (9, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in without_near_duplicates(docs).collect()) == sorted([(1, a), (5, b), (9, c)])
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == [(1, 1, True), (5, 1, False), (5, 5, True), (5, 5, True), (9, 5, False), (9, 9, True)]


def test_large_group_has_few_links(spark, prose, vocabulary, monkeypatch):
    """Near copies of one text link in the first bands; in the others their group counts as one."""
    from shopspan.llm import neardup

    rng, rows, size = random.Random(5), [], 250
    words = prose(77, 300).split()
    for d in range(size):
        new = list(words)
        for _ in range(rng.randint(1, 6)):
            new[rng.randrange(len(new))] = rng.choice(vocabulary)
        rows.append((d, " ".join(new)))
    docs, counted, linked = spark.createDataFrame(rows, "doc_id long, text string"), [], neardup.connected_components

    def counting(links):
        counted.append(links.count())
        return linked(links)

    monkeypatch.setattr(neardup, "connected_components", counting)
    got = near_duplicates(docs, 5, 80).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 5, 80)
    assert max(counted) <= 4 * size
