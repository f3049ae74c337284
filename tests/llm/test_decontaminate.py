import random

import numpy as np

from shopspan.llm import decontaminate as d


def words(n, seed):
    return np.random.default_rng(seed).integers(1, 2**62, n, dtype=np.int64) | 1


def least_edits(item, window):
    """Edits to a beginning of the window by the textbook recurrence."""
    row = list(range(len(window) + 1))
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(window):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def ascii_case(text, low):
    return "".join((c.lower() if low else c.upper()) if c.isascii() else c for c in text)


def edited(text, edits, vocabulary, rng, first=1):
    w = text.split()
    for _ in range(edits):
        p, kind = rng.randrange(first, len(w)), rng.randrange(3)
        if kind == 0:
            w[p] = rng.choice(vocabulary) + "q"
        elif kind == 1:
            w.insert(p, rng.choice(vocabulary) + "q")
        else:
            del w[p]
    return " ".join(w)


def test_alignment_equals_the_recurrence():
    rng = random.Random(1)
    items, windows = [], []
    for k in range(200):
        item = words(rng.randint(8, 30), k).tolist()
        window = list(item)
        for _ in range(rng.randint(0, 4)):
            p = rng.randrange(len(window))
            window[p:p + rng.randrange(2)] = words(rng.randrange(2), 1000 + k).tolist()
        items.append(np.array(item)), windows.append(np.array(window + words(rng.randrange(6), 99).tolist()))
    got, length = d.edit_distances(items, windows)
    for k, (a, b) in enumerate(zip(items, windows)):
        want = least_edits(a, b)
        if want <= d.edits_allowed(len(a)):
            assert got[k] == want and least_edits(a, b[: length[k]]) == want
        else:
            assert got[k] > d.edits_allowed(len(a))


def test_filters_lose_no_match():
    for low, high in ((8, 8), (9, 10), (19, 20), (42, 46)):
        assert d._pairs_kept(low, high) == min(n - 1 - 2 * (n * 20 // 100) for n in range(low, high + 1))


def test_recall_of_walks_at_the_edit_limit():
    rng = random.Random(2)
    for n in (10, 20, 40, 60):
        found = 0
        for k in range(60):
            a = words(n, k).astype(np.uint64).tolist()
            b = list(a)
            for _ in range(d.edits_allowed(n)):
                p = rng.randrange(1, len(b))
                b[p:p + rng.randrange(2)] = words(rng.randrange(2), 5000 + k).astype(np.uint64).tolist()
            text = np.array(a + b + words(30, k + 9).astype(np.uint64).tolist(), dtype=np.uint64)
            w, first = d.with_pads(text, np.array([0, n, len(text)]))
            lows = d.size_classes(n + 1)
            kind = np.full(2, np.searchsorted(lows, n, "right") - 1)
            keys = d.walk_keys(w, first, kind, lows)
            found += bool((keys[0] == keys[1]).any())
        assert found >= 0.9 * 60


def test_planted_passages(spark, prose, vocabulary, with_clashes):
    rng = random.Random(3)
    items = [(k, prose(700 + k, rng.choice([8, 15, 22, 40, 59, 150]))) for k in range(30)]
    docs, want = [], set()
    for n in range(120):
        parts = [prose(2000 + n, rng.randint(0, 200))]
        if n % 2:
            k, text = rng.choice(items)
            edits = rng.randint(0, d.edits_allowed(len(text.split())) // 2)
            parts.append(ascii_case(edited(text, edits, vocabulary, rng), 0) if n % 5 else text)
            want.add((n, k))
        parts.append(prose(3000 + n, rng.randint(0, 50)))
        docs.append((n, "\n".join(parts)))
    table = with_clashes(spark.createDataFrame(docs, "doc_id long, text string"))
    bench = with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    got = d.contaminated(table, bench).collect()
    hits = {(r.doc_id, r.item_id) for r in got}
    assert {(n, k) for n, k in want if n % 5 == 0} <= hits
    assert not {n for n, _ in hits} - {n for n, _ in want}
    texts = dict(docs)
    assert len(want - hits) <= 1
    for r in got:
        near = ascii_case(texts[r.doc_id], 1).split()[r.start: r.start + r.length]
        assert least_edits(dict(items)[r.item_id].split(), near) == r.edits
    clean = d.decontaminated(table, bench)
    assert clean.columns == table.columns
    assert {r.doc_id for r in clean.collect()} == set(range(120)) - {n for n, _ in hits}


def test_odd_rows(spark, odd_docs):
    item = odd_docs.where("doc_id = 7").first().text
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (None, item), (5, item), (5, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.edits) for r in d.contaminated(odd_docs, bench).collect()}
    # The item of one word is matched too, word for word.
    one = {(r.doc_id, 3, 0) for r in odd_docs.collect() if "one" in (r.text or "").lower().split()}
    assert one and got == one | {(x, y, 0) for x in (7, 8, 9, None) for y in (None, 5)}
    assert {r.doc_id for r in d.decontaminated(odd_docs, bench).collect()} == {None, 1, 2, 3, 6, 10, 11, 12, 13}
    assert d.contaminated(odd_docs, bench.limit(0)).count() == 0
    assert d.contaminated(odd_docs.limit(0), bench).count() == 0
    assert d.decontaminated(odd_docs, bench.limit(0)).count() == odd_docs.count()


def test_recall_of_walks_with_edits_at_every_position():
    """A passage whose first word is edited is found from a later word of the item."""
    rng = random.Random(2)
    for n in (10, 20, 40):
        found = 0
        for k in range(60):
            a = words(n, k).astype(np.uint64).tolist()
            b = list(a)
            for _ in range(d.edits_allowed(n)):
                p = rng.randrange(len(b))
                b[p:p + rng.randrange(2)] = words(rng.randrange(2), 5000 + k).astype(np.uint64).tolist()
            text = np.array(a + b + words(30, k + 9).astype(np.uint64).tolist(), dtype=np.uint64)
            w, first = d.with_pads(text, np.array([0, n, len(text)]))
            later = [first[1] + j for j in range(d.edits_allowed(n) + 1) if b[j] in a]
            starts = np.array([first[0], *later])
            lows = d.size_classes(n + 1)
            keys = d.walk_keys(w, starts, np.full(len(starts), np.searchsorted(lows, n, "right") - 1), lows)
            found += bool((keys[1:] == keys[0]).any())
        assert found >= 0.9 * 60


def test_short_items_match_word_for_word(spark, prose, vocabulary, with_clashes):
    rng = random.Random(9)
    items = [(n, " ".join(f"Short{n}x{j}" for j in range(n))) for n in range(1, 8)] + [(8, ""), (9, None), (10, "  "), (11, "end7x0 end7x1")]
    docs, want = [], set()
    for k in range(80):
        n = rng.randint(1, 7)
        text = dict(items)[n].split()
        kind = k % 4
        if kind == 1:  # one word changed
            text[rng.randrange(n)] = "other"
        elif kind == 2 and n > 1:  # cut short, and the rest of it in the next document
            text = text[:-1]
        elif kind == 3:
            text = [w.upper() for w in text] * 2
        lead = prose(5000 + k, rng.randint(0, 30)).split()
        docs.append((k, " ".join(lead + text)))
        shown = [w.lower() for w in lead + text]
        for m, item in items:
            wanted = (item or "").lower().split()
            places = [p for p in range(len(shown) - len(wanted) + 1) if wanted and shown[p: p + len(wanted)] == wanted]
            if places:
                want.add((k, m, places[0], len(wanted), 0))
    docs += [(100, None), (101, ""), (102, "a END7x0"), (103, "end7X1 b")]
    table = with_clashes(spark.createDataFrame(docs, "doc_id long, text string"))
    got = d.contaminated(table, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(want) > 30 and {(r.doc_id, r.item_id, r.start, r.length, r.edits) for r in got} == want


def test_whole_query_at_the_edit_limit(spark, prose, vocabulary):
    """Every item against every text by the recurrence: what is found is right, and nine tenths of what is there are found."""
    rng = random.Random(12)
    items = [(100 * n + k, prose(9000 + 100 * n + k, n)) for n in (10, 20, 40) for k in range(4)]
    docs = []
    for n, (item_id, text) in enumerate(items * 5):
        size = len(text.split())
        docs.append((n, " ".join([prose(40000 + n, 12), edited(text, d.edits_allowed(size), vocabulary, rng, 0), prose(50000 + n, 12)])))
    got = {(r.doc_id, r.item_id): r for r in d.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    there = {}
    for doc_id, text in docs:
        shown = text.split()
        for item_id, item in items:
            wanted = item.split()
            # Least edits to any passage: the recurrence with a free start.
            row = [0] * (len(shown) + 1)
            for i, a in enumerate(wanted):
                new = [i + 1]
                for j, b in enumerate(shown):
                    new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
                row = new
            if min(row) <= d.edits_allowed(len(wanted)):
                there[doc_id, item_id] = min(row)
    assert set(got) <= set(there) and all(got[k].edits >= there[k] for k in got)
    for n in (10, 20, 40):
        of_size = [k for k in there if k[1] // 100 == n]
        assert len(of_size) >= 20 and sum(k in got for k in of_size) >= 0.9 * len(of_size)
