"""Documents that hold a benchmark item, up to a fifth of its words edited.

The CGK random walk reads a word sequence with a pointer that at every step emits the word under it and
then stays or advances by one, as a random bit of (step, word) says. Two sequences at a small edit distance
soon walk in step again, so edit distance becomes Hamming distance between the emitted sequences. Bit
sampling turns a walk into hash keys: each key takes a few of its steps. Several walks with several keys
each reach the wanted recall. Windows of documents that share a key with an item of their size are
candidates, and a candidate counts only after its exact edit distance is computed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopspan.llm.substring import text_key
from shopspan.llm.words import LOWER, as_long, find_words, lists, mix, signed, text_blocks, word_hashes
from shopspan.sources.staging import staged

#: Share of an item's words that may be edited.
EDIT_PERCENT = 20
#: Shorter items allow too few edits for walks: they are matched word for word, by a hash of their whole word sequence.
LEAST_WORDS = 8
WALKS, KEYS, STEPS_IN_KEY = 8, 12, 3
#: Steps of a walk that a key may sample, per word of the item: a pointer advances every other step.
STEPS_PER_WORD = 1.6
#: Every filter has so many bits, whatever the benchmark's size; more items only let more windows pass.
FILTER_BITS = 22
KEY_FILTER_BITS = 24  # keys set and test two bits
#: Walks done at once, over 64 bytes of text each: a walk's steps cost the same for few windows as for many, but a start has
#: WALKS * KEYS keys of eight bytes in several arrays. The pipeline, whose workers hold more beside them, takes fewer.
CHUNK, SMALL_CHUNK = 1 << 16, 1 << 14
#: Cells of alignments at once.
ALIGN_CELLS = 1 << 22
#: Item sizes of one class differ by less than this factor.
CLASS_RATIO = 1.12

_SEEDS = np.random.default_rng(20240510).integers(1, 2**63, WALKS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NEXT = np.uint64(0x9E3779B97F4A7C15)


def edits_allowed(words):
    return words * EDIT_PERCENT // 100 * (words >= LEAST_WORDS)


def size_classes(largest: int) -> np.ndarray:
    """Smallest item size of every class up to ``largest``."""
    out = [LEAST_WORDS]
    while out[-1] < largest:
        out.append(max(int(out[-1] * CLASS_RATIO), out[-1] + 1))
    return np.array(out)


def sampled_steps(low: int) -> np.ndarray:
    """Steps that the keys of a class take: (walk, key, step in key)."""
    rng = np.random.default_rng(low)
    most = max(int(low * STEPS_PER_WORD), STEPS_IN_KEY)
    return np.stack([
        np.stack([np.sort(rng.choice(most, STEPS_IN_KEY, replace=False)) for _ in range(KEYS)]) for _ in range(WALKS)
    ])


def with_pads(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with a zero after every text, where walks stop; and where each text starts."""
    counts = np.diff(first)
    out = np.zeros(len(hashes) + len(counts), dtype=np.uint64)
    out[np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)] = hashes | np.uint64(1)
    return out, first[:-1] + np.arange(len(counts))


def walk_keys(words: np.ndarray, starts: np.ndarray, kinds: np.ndarray, lows: np.ndarray) -> np.ndarray:
    """Keys of the walks from ``starts`` for the size class of each: a row of WALKS x KEYS per start."""
    out = np.empty((len(starts), WALKS * KEYS), dtype=np.uint64)
    order = np.argsort(-kinds, kind="stable")
    starts, kinds = starts[order], kinds[order]
    present = np.unique(kinds)
    plan = {int(k): sampled_steps(int(lows[k])) for k in present}
    bounds = {k: (int(np.searchsorted(-kinds, -k, "left")), int(np.searchsorted(-kinds, -k, "right"))) for k in plan}
    longest = {k: int(p.max()) for k, p in plan.items()}
    pad = words == 0
    for w in range(WALKS):
        bits = np.where(pad, np.uint64(0), mix(words * _SEEDS[w]))
        at, active = starts.copy(), len(starts)
        wanted: dict[int, list] = {}
        for k, steps in plan.items():
            for key in range(KEYS):
                for t in steps[w, key].tolist():
                    wanted.setdefault(t, []).append((k, key))
        sums = {k: np.full((b - a, KEYS), np.uint64(k * 131 + w + 1)) for k, (a, b) in bounds.items()}
        for t in range(max(longest.values(), default=-1) + 1):
            active = max(bounds[k][1] for k in plan if longest[k] >= t)
            if t and t % 64 == 0:
                bits = np.where(pad, np.uint64(0), mix(bits + _NEXT))
            for k, key in wanted.get(t, ()):
                a, b = bounds[k]
                sums[k][:, key] = mix(sums[k][:, key] * _NEXT + words[at[a:b]] + np.uint64(t))
            here = at[:active]
            here += ((bits[here] >> np.uint64(t % 64)) & np.uint64(1)).astype(np.int64)
        for k, (a, b) in bounds.items():
            out[order[a:b], w * KEYS: (w + 1) * KEYS] = mix(sums[k] + np.arange(KEYS, dtype=np.uint64) * _SEEDS[0])
    return out


def pairs(words: np.ndarray) -> np.ndarray:
    """A hash of every word and the next one; zero beside a pad."""
    out = np.zeros(len(words), dtype=np.uint64)
    out[:-1] = np.where((words[:-1] != 0) & (words[1:] != 0), mix(words[:-1] * _NEXT + words[1:]), np.uint64(0))
    return out


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` words from each place on; meaningless where a pad is among them."""
    out = np.full(max(0, len(words) - n + 1), np.uint64(n))
    for j in range(n):
        out = mix(out * _NEXT + words[j: j + len(out)])
    return out


def _slot(values: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    return (values >> np.uint64(64 - bits)).astype(np.int64)


def _pairs_kept(low: int, high: int) -> int:
    """Least pairs of neighbours that a match keeps of an item of ``low`` to ``high`` words."""
    sizes = np.arange(low, high + 1)
    return int((sizes - 1 - 2 * edits_allowed(sizes)).min())


def _embed(batches):
    schema = pa.schema([("item_id", pa.int64()), ("item", pa.list_(pa.int64())), ("pairs", pa.list_(pa.int64())),
                        ("keys", pa.list_(pa.int64()))])
    for rows, data, offsets in text_blocks(batches, "text"):
        data = LOWER[data]
        found = find_words(data, offsets)
        n = found.counts
        words, starts = with_pads(word_hashes(data, found), found.first)
        lows = size_classes(int(n.max(initial=0)) + 1)
        ids, item, two = as_long(rows.column("item_id")), lists(signed(words[words != 0]), n), lists(signed(pairs(words)[words != 0]), n)

        def of(use, keys):
            return pa.RecordBatch.from_arrays(
                [*(x.filter(pa.array(use)) for x in (ids, item, two)), lists(signed(keys.ravel()), np.full(len(keys), keys.shape[1]))],
                schema=schema,
            )

        use = n >= LEAST_WORDS
        kinds = np.searchsorted(lows, n, "right") - 1
        yield of(use, walk_keys(words, starts[use], kinds[use], lows))
        for size in range(1, LEAST_WORDS):
            if (n == size).any():
                yield of(n == size, runs(words, size)[starts[n == size]][:, None])


def _scan(vocabulary: bytes, couples: bytes, slots: bytes, sizes: list[int], chunk: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("start", pa.int64()),
                        ("keys", pa.list_(pa.int64())), ("near", pa.list_(pa.int64()))])
    lows = size_classes(max(sizes, default=0) + 1)
    walked, short = [n for n in sizes if n >= LEAST_WORDS], [n for n in sizes if 0 < n < LEAST_WORDS]
    kinds_used = sorted(set((np.searchsorted(lows, walked, "right") - 1).tolist()))

    def run(batches):
        known, coupled, hit = (
            np.unpackbits(np.frombuffer(b, np.uint8), bitorder="little").astype(bool) for b in (vocabulary, couples, slots)
        )
        for rows, data, offsets in text_blocks(batches, "text", 64 * chunk):
            data = LOWER[data]
            found = find_words(data, offsets)
            words, first = with_pads(word_hashes(data, found), found.first)
            ends = first + found.counts
            member = known[_slot(mix(words))] & (words != 0)
            two = pairs(words)
            total = np.concatenate([[0], np.cumsum(member)])
            total_two = np.concatenate([[0], np.cumsum(coupled[_slot(two)] & (two != 0))])
            ids, text_keys = as_long(rows.column("doc_id")), rows.column("text_key")
            for n in short:
                keys = runs(words, n)
                at = np.flatnonzero(hit[_slot(keys, KEY_FILTER_BITS)] & hit[_slot(keys << np.uint64(32), KEY_FILTER_BITS)])
                doc = np.searchsorted(first, at, "right") - 1
                inside = at + n <= ends[doc]
                at, doc = at[inside], doc[inside]
                # The first of equal runs of a text stands for all: it is the one that the result names.
                at, doc = (x[np.sort(np.unique(np.stack([doc, keys[at].view(np.int64)]), axis=1, return_index=True)[1])] for x in (at, doc))
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(doc)), text_keys.take(pa.array(doc)), pa.array(at - first[doc]),
                    lists(signed(keys[at]), np.ones(len(at), np.int64)),
                    lists(signed(words[(at[:, None] + np.arange(n)).ravel()]), np.full(len(at), n)),
                ], schema=schema)
            starts = np.flatnonzero(member)
            owner = np.searchsorted(first, starts, "right") - 1
            ahead = ends[owner]
            got, kind = [], []
            for k in kinds_used:
                low, high = int(lows[k]), int(lows[k + 1]) - 1
                until = np.minimum(starts + high + edits_allowed(high), ahead)
                edits = edits_allowed(low)
                enough = np.flatnonzero((total[until] - total[starts] >= low - edits)
                                        & (total_two[until - 1] - total_two[starts] >= _pairs_kept(low, high)))
                got.append(enough)
                kind.append(np.full(len(enough), k))
            which, kind = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (got, kind))
            for part in range(0, len(which), chunk):
                chosen, kinds = which[part: part + chunk], kind[part: part + chunk]
                keys = walk_keys(words, starts[chosen], kinds, lows)
                passed = hit[_slot(keys, KEY_FILTER_BITS)] & hit[_slot(keys << np.uint64(32), KEY_FILTER_BITS)]
                some = np.flatnonzero(passed.any(axis=1))
                if not len(some):
                    continue
                chosen, high, passed = chosen[some], lows[kinds[some] + 1] - 1, passed[some]
                begin, doc = starts[chosen], owner[chosen]
                length = np.minimum(begin + high + edits_allowed(high), ahead[chosen]) - begin
                near = np.arange(int(length.sum())) + np.repeat(begin - (np.cumsum(length) - length), length)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(doc)), text_keys.take(pa.array(doc)),
                    pa.array(begin - first[doc]), lists(signed(keys[some][passed]), passed.sum(axis=1)),
                    lists(signed(words[near]), length),
                ], schema=schema)

    return run


def _grid(rows: list[np.ndarray], sizes: np.ndarray, fill: int) -> np.ndarray:
    out = np.full((len(rows), int(sizes.max(initial=1))), fill, dtype=np.int64)
    for k, x in enumerate(rows):
        out[k, : len(x)] = x
    return out


def edit_distances(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Least edits that turn each item into a beginning of its window, and how long that beginning is.

    Pairs that share too few words for any allowed distance are not aligned; they get a large number.
    """
    n, m = np.array([len(x) for x in items]), np.array([len(x) for x in windows])
    rows, grid = _grid(items, n, 0), _grid(windows, m, 2)  # word hashes are odd
    far = np.int32(1 << 20)
    edits, length = np.full(len(items), far), np.zeros(len(items), dtype=np.int64)
    common = (rows[:, :, None] == grid[:, None, :]).any(axis=2).sum(axis=1)
    near = np.flatnonzero(common >= n - edits_allowed(n))
    if not len(near):
        return edits, length
    rows, grid, n, m = rows[near], grid[near], n[near], m[near]
    columns = np.arange(grid.shape[1] + 1, dtype=np.int32)
    outside = columns[None, :] > m[:, None]
    now = np.where(outside, far, columns[None, :]).astype(np.int32)
    last = now.copy()
    for i in range(rows.shape[1]):
        step = np.empty_like(now)
        step[:, 0] = i + 1
        step[:, 1:] = np.minimum(now[:, :-1] + (grid != rows[:, i: i + 1]), now[:, 1:] + 1)
        now = np.minimum.accumulate(step - columns, axis=1) + columns
        now[outside] = far
        done = n == i + 1
        last[done] = now[done]
    edits[near], length[near] = last.min(axis=1), last.argmin(axis=1)
    return edits, length


def _verify(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("item_id", pa.int64()),
                        ("start", pa.int64()), ("length", pa.int64()), ("edits", pa.int64())])
    for batch in batches:
        size = [batch.column(c).value_lengths().to_numpy().max(initial=1) for c in ("item", "near")]
        at_once = max(1, ALIGN_CELLS // int(size[0] * size[1]))
        for at in range(0, batch.num_rows, at_once):
            rows = batch.slice(at, at_once)
            items, near = ([x.values.to_numpy() for x in rows.column(c)] for c in ("item", "near"))
            edits, length = edit_distances(items, near)
            n = np.array([len(x) for x in items])
            ok = pa.array(edits <= edits_allowed(n))
            yield pa.RecordBatch.from_arrays([
                *(rows.column(c).filter(ok) for c in ("doc_id", "text_key", "item_id", "start")),
                pa.array(length.astype(np.int64)).filter(ok), pa.array(edits.astype(np.int64)).filter(ok),
            ], schema=schema)


def _filter_bits(values: DataFrame, bits: int = FILTER_BITS, probes: int = 1) -> bytes:
    """Bits for the upper halves (one probe) or both halves of all values; at most 2**bits / 64 rows are collected."""
    both = [F.shiftrightunsigned(F.shiftleft("value", 32 * k), 64 - bits) for k in range(probes)]
    rows = values.select(F.explode(F.array(*both)).alias("slot")).groupBy(F.shiftright("slot", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")
    ).collect()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    for r in rows:
        out[r["at"]] = r["bits"]
    return out.tobytes()


def _spread(batches):
    """Values of the word filter: the words' hashes mixed once more."""
    for batch in batches:
        words = batch.column("item").flatten().to_numpy().view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(signed(mix(words)))], ["value"])


def contaminated(docs: DataFrame, benchmark: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Passages of ``docs`` that match a benchmark item with at most a fifth of the item's words edited.

    Needs doc_id and text of ``docs``, item_id and text of ``benchmark``; other columns are not read.
    Returns one row per (doc_id, text_key, item_id): start (word), length (words) and edits of the best
    passage; fewer edits, then the earlier start win a tie. Words are compared with A-Z lower-cased. Null
    or empty texts match nothing, items of fewer than LEAST_WORDS words match only word for word, repeated rows
    give the row once, null ids are kept. Either table empty: an empty result.

    Scale: whole documents stream through one scan. A match keeps at least 80 % of the item's words and, as an
    edit breaks two pairs of neighbours, 60 % of its pairs less one, so only windows with that many words and
    pairs of the benchmark start a walk; words, pairs and keys are tested against three bit sets of fixed size. The windows left meet the items in a join on keys, which Spark broadcasts only
    below its size limit, and skew of a popular item is split at run time.
    """
    items = staged(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
        .mapInArrow(_embed, "item_id long, item array<long>, pairs array<long>, keys array<long>"), "items",
    )
    sizes = [r[0] for r in items.select(F.size("item")).distinct().collect()]
    slots = _filter_bits(items.select(F.explode("keys").alias("value")), KEY_FILTER_BITS, 2)
    long_items = items.where(F.size("item") >= LEAST_WORDS)
    vocabulary = _filter_bits(long_items.select("item").mapInArrow(_spread, "value long"))
    couples = _filter_bits(long_items.select(F.explode("pairs").alias("value")).where("value <> 0"))
    windows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_key", text_key())
        .mapInArrow(_scan(vocabulary, couples, slots, sizes, chunk),
                    "doc_id long, text_key long, start long, keys array<long>, near array<long>")
    )
    by_key = items.select("item_id", "item", F.explode(F.array_distinct("keys")).alias("key"))
    return (
        windows.select("doc_id", "text_key", "start", "near", F.explode("keys").alias("key"))
        .join(by_key, "key")
        .dropDuplicates(["doc_id", "text_key", "start", "item_id", "near"])
        .select("doc_id", "text_key", "item_id", "start", "item", "near")
        .mapInArrow(_verify, "doc_id long, text_key long, item_id long, start long, length long, edits long")
        .groupBy("doc_id", "text_key", "item_id")
        .agg(F.min(F.struct("edits", "start", "length")).alias("best"))
        .select("doc_id", "text_key", "item_id", "best.start", "best.length", "best.edits")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item."""
    found = contaminated(docs, benchmark, SMALL_CHUNK).select(F.col("text_key").alias("found_key")).distinct()
    return docs.join(found, text_key() == found["found_key"], "left_anti")
