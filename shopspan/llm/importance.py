"""Resampling of documents towards a target distribution by hashed n-grams.

Every feature, a run of one or two words, falls into a bucket by the CRC-32 of its bytes. Bucket totals of the whole corpus and of the
whole target give each bucket a gain; a document's weight is the sum over its features, and weights with Gumbel noise
are drawn from the top, which samples without replacement in proportion to exp(weight).

The vocabulary has a head and a tail. The words that a mergeable frequency sketch of all documents keeps form the head: their exact CRC
states, and the buckets of frequent pairs, are broadcast as direct-mapped tables of fixed size. Every other feature takes its CRC directly,
a pair's from the state of its first word. Both ways give the same bucket, so totals and weights are exact.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopspan.llm.words import LOWER, Words, as_long, mix, text_blocks
from shopspan.operators.ordering import ordered_positions

BUCKETS = 10_000
#: Slots of the head's tables (words, pairs). A frequent word longer than 16 bytes, or without a slot, belongs to the tail.
WORD_SLOTS, PAIR_SLOTS = 1 << 15, 1 << 16
#: Entries a task keeps while it looks for frequent words or pairs.
SKETCH = 1 << 14

#: Bytes of words: digits, small letters (after lower-casing) and everything outside ASCII.
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
_START = np.uint32(0xFFFFFFFF)
#: The CRC state that each byte leads to from state 0; a state is a CRC-32 with all bits flipped.
_T = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], dtype=np.uint32)
#: Longer words go through the library one by one.
_LONG_WORD = 256


def words_of(data: np.ndarray, offsets: np.ndarray, of_words: np.ndarray = _INSIDE) -> tuple[np.ndarray, Words]:
    """The lower-cased bytes of a block and its words, runs of the bytes ``of_words``."""
    data = LOWER[data]
    inside = of_words[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(opens)
    return data, Words(start, np.flatnonzero(closes) + 1 - start, np.searchsorted(start, offsets))


def extend(states: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC states after the words' bytes, one byte of all words at a time."""
    states = states.copy()
    for k in np.flatnonzero(length > _LONG_WORD).tolist():
        word = data[start[k]: start[k] + length[k]]
        states[k] = zlib.crc32(word, int(states[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    short = np.flatnonzero(length <= _LONG_WORD)
    order = short[np.argsort(-length[short], kind="stable")]
    falling = -length[order]
    where, now = start[order], states[order]
    for at in range(int(-falling[0]) if len(order) else 0):
        n = int(np.searchsorted(falling, -at, side="left"))
        now[:n] = _T[(now[:n] ^ data[where[:n] + at]) & np.uint32(0xFF)] ^ (now[:n] >> np.uint32(8))
    states[order] = now
    return states


def _space(states: np.ndarray) -> np.ndarray:
    return _T[(states ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (states >> np.uint32(8))


def word_keys(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes as two 64-bit numbers, zero padded, exact up to 16 bytes; longer words have the key (0, 0)."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray((len(data) + 9,), dtype="<u8", buffer=padded.data, strides=(1,))
    low = eight[words.start] & _MASKS[np.minimum(words.length, 8)]
    high = eight[words.start + 8] & _MASKS[np.clip(words.length - 8, 0, 8)]
    long = words.length > 16
    low[long] = high[long] = 0
    return low, high


def _slot(low: np.ndarray, high: np.ndarray, slots: int) -> np.ndarray:
    return (mix(low ^ (high * _SECOND)) >> np.uint64(20)).astype(np.int64) & (slots - 1)


@dataclass
class Slots:
    """A direct-mapped table: a slot holds one key and its value, or the key (0, 0), which no word or pair has."""

    low: np.ndarray
    high: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, low: np.ndarray, high: np.ndarray, value: np.ndarray, slots: int) -> Slots:
        """Keys in order of importance: the first one takes the slot."""
        at = _slot(low, high, slots)
        _, first = np.unique(at, return_index=True)
        table = cls(np.zeros(slots, np.uint64), np.zeros(slots, np.uint64), np.zeros(slots, np.uint32))
        table.low[at[first]], table.high[at[first]], table.value[at[first]] = low[first], high[first], value[first]
        return table

    def find(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot, whether the key is there)."""
        at = _slot(low, high, len(self.low))
        return at, (self.low[at] == low) & (self.high[at] == high) & ((low != 0) | (high != 0))


@dataclass
class Head:
    """CRC states of frequent words, and buckets of frequent pairs by the slots of their words."""

    words: Slots
    pairs: Slots


def empty_head() -> Head:
    none = np.zeros(0, np.uint64)
    return Head(Slots.of(none, none, none.astype(np.uint32), WORD_SLOTS), Slots.of(none, none, none.astype(np.uint32), PAIR_SLOTS))


def _pairs(words: Words) -> np.ndarray:
    """Positions of all words that another one of the same text follows."""
    lasts = words.first[1:][words.counts > 0] - 1
    follows = np.ones(int(words.first[-1]), dtype=bool)
    follows[lasts] = False
    return np.flatnonzero(follows)


def _pair_keys(slot: np.ndarray, known: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(both words are in the head, low part of the key); the high part is 0."""
    both = known[at] & known[at + 1]
    low = (slot[at].astype(np.uint64) << np.uint64(32)) | (slot[at + 1].astype(np.uint64) + np.uint64(1))
    return both, low


def buckets(data: np.ndarray, words: Words, head: Head, ngrams: int, n_buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length of features: (bucket of each, position of its first word), in order of position."""
    low, high = word_keys(data, words)
    slot, known = head.words.find(low, high)
    states = head.words.value[slot]
    tail = np.flatnonzero(~known)
    states[tail] = extend(np.full(len(tail), _START), data, words.start[tail], words.length[tail])
    out = [((states ^ _START) % np.uint32(n_buckets), np.arange(len(states)))]
    if ngrams == 2:
        at = _pairs(words)
        both, key = _pair_keys(slot, known, at)
        none = np.zeros(len(at), np.uint64)
        place, listed = head.pairs.find(key, none)
        listed &= both
        found = head.pairs.value[place]
        rest = np.flatnonzero(~listed)
        ends = extend(_space(states[at[rest]]), data, words.start[at[rest] + 1], words.length[at[rest] + 1])
        found[rest] = (ends ^ _START) % np.uint32(n_buckets)
        out.append((found, at))
    return out


class FrequentKeys:
    """Counts of the most frequent two-part keys, by a mergeable summary.

    Once more than ``size`` keys are held, the count after the ``size`` largest is taken off all of them. A key whose share
    of all is above 1 / size is never lost, however the rows are dealt to tasks and merged.
    """

    def __init__(self, size: int = SKETCH):
        self.size = size
        self.keys = np.zeros(0, dtype=[("low", "<u8"), ("high", "<u8")])
        self.counts = np.zeros(0, dtype=np.int64)

    def add(self, low: np.ndarray, high: np.ndarray, counts: np.ndarray | None = None) -> None:
        both = np.empty(len(low), dtype=self.keys.dtype)
        both["low"], both["high"] = low, high
        keys = np.concatenate([self.keys, both])
        counts = np.concatenate([self.counts, np.ones(len(low), np.int64) if counts is None else counts])
        order = np.lexsort((keys["high"], keys["low"]))
        keys, counts = keys[order], counts[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(new)
        keys, counts = keys[at], np.add.reduceat(counts, at) if len(at) else counts
        if len(keys) > self.size:
            counts = counts - np.partition(counts, len(counts) - self.size - 1)[len(counts) - self.size - 1]
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts


def _frequent(kind: str, head: Head | None):
    """Frequent words, or frequent pairs of words of the head, of a task's texts."""
    schema = pa.schema([("low", pa.int64()), ("high", pa.int64()), ("seen", pa.int64())])

    def run(batches):
        sketch = FrequentKeys()
        for _, data, offsets in text_blocks(batches, "text"):
            data, words = words_of(data, offsets)
            low, high = word_keys(data, words)
            if kind == "words":
                short = (low != 0) | (high != 0)
                sketch.add(low[short], high[short])
            else:
                at = _pairs(words)
                slot, known = head.words.find(low, high)
                both, key = _pair_keys(slot, known, at)
                sketch.add(key[both], np.zeros(int(both.sum()), np.uint64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(sketch.keys["low"].view(np.int64)), pa.array(sketch.keys["high"].view(np.int64)), pa.array(sketch.counts)],
            schema=schema)

    return run


def _most_frequent(texts: DataFrame, kind: str, most: int, head: Head | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys by falling count. At most ``most`` rows reach the driver, whatever the number of documents."""
    found = (
        texts.mapInArrow(_frequent(kind, head), "low long, high long, seen long")
        .groupBy("low", "high").agg(F.sum("seen").alias("seen"))
        .orderBy(F.desc("seen"), "low", "high").limit(most).select("low", "high").toArrow()
    )
    low, high = (found.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("low", "high"))
    return low, high


def _key_bytes(low: int, high: int) -> bytes:
    return (int(low).to_bytes(8, "little") + int(high).to_bytes(8, "little")).rstrip(b"\0")


def fit_head(texts: DataFrame, ngrams: int = 1, n_buckets: int = BUCKETS) -> Head:
    """The head of ``texts(text)``; its size does not depend on them."""
    head = empty_head()
    low, high = _most_frequent(texts, "words", WORD_SLOTS)
    states = np.array([zlib.crc32(_key_bytes(a, b)) ^ 0xFFFFFFFF for a, b in zip(low, high)], dtype=np.uint32)
    head.words = Slots.of(low, high, states, WORD_SLOTS)
    if ngrams == 2:
        key, none = _most_frequent(texts, "pairs", PAIR_SLOTS, head)
        first = (key >> np.uint64(32)).astype(np.int64)
        second = (key & np.uint64(0xFFFFFFFF)).astype(np.int64) - 1
        spoken = [
            _key_bytes(head.words.low[a], head.words.high[a]) + b" " + _key_bytes(head.words.low[b], head.words.high[b])
            for a, b in zip(first, second)
        ]
        value = np.array([zlib.crc32(s) % n_buckets for s in spoken], dtype=np.uint32)
        head.pairs = Slots.of(key, none, value, PAIR_SLOTS)
    return head


def _totals(head, ngrams: int, n_buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("features", pa.int64())])

    def run(batches):
        totals = np.zeros(n_buckets, dtype=np.int64)
        for _, data, offsets in text_blocks(batches, "text"):
            data, words = words_of(data, offsets)
            for bucket, _ in buckets(data, words, head.value, ngrams, n_buckets):
                totals += np.bincount(bucket, minlength=n_buckets)
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(totals[seen])], schema=schema)

    return run


def bucket_totals(texts: DataFrame, head, ngrams: int, n_buckets: int) -> np.ndarray:
    """Features per bucket of all texts, exact. At most ``n_buckets`` rows a task are shuffled."""
    rows = (
        texts.mapInArrow(_totals(head, ngrams, n_buckets), "bucket int, features long")
        .groupBy("bucket").agg(F.sum("features").alias("features")).collect()
    )
    totals = np.zeros(n_buckets, dtype=np.int64)
    for r in rows:
        totals[r.bucket] = r.features
    return totals


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of the bucket's shares in target and source)."""
    n, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1) * (all_source + n) / ((s + 1) * (all_target + n))))
        for s, t in zip(source.tolist(), target.tolist())
    ], dtype=np.int64)


def _weigher(head, gain, ngrams: int, n_buckets: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def run(batches):
        for rows, data, offsets in text_blocks(batches, "text"):
            data, words = words_of(data, offsets)
            features, weight = np.zeros((2, len(rows)), dtype=np.int64)
            for bucket, at in buckets(data, words, head.value, ngrams, n_buckets):
                ends = np.searchsorted(at, words.first)
                sums = np.concatenate([[0], np.cumsum(gain.value[bucket])])
                features += np.diff(ends)
                weight += sums[ends[1:]] - sums[ends[:-1]]
            yield pa.RecordBatch.from_arrays(
                [as_long(rows.column("doc_id")), pa.array(words.counts.astype(np.int64)), pa.array(features), pa.array(weight)], schema=schema)

    return run


def importance_weights(docs: DataFrame, target: DataFrame, ngrams: int = 1, n_buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs(doc_id, text)`` against ``target(text)``."""
    if ngrams not in (1, 2):
        raise ValueError("features are runs of one word, or of one and two")
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts, wanted = rows.select("text"), target.select(F.col("text").cast("string").alias("text"))
    head = spark.sparkContext.broadcast(fit_head(texts, ngrams, n_buckets))
    gain = spark.sparkContext.broadcast(gains(
        bucket_totals(texts, head, ngrams, n_buckets), bucket_totals(wanted, head, ngrams, n_buckets)
    ))
    return rows.mapInArrow(_weigher(head, gain, ngrams, n_buckets), "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024,
             ngrams: int = 1, n_buckets: int = BUCKETS) -> DataFrame:
    """Every row's doc_id, n_features, weight, score and rank; rank is null for rows that are not drawn.

    ``docs`` needs doc_id and text, ``target`` text; other columns are not read. Words are runs of A-Z (lower-cased), a-z,
    digits and characters outside ASCII; features are all runs of 1 to ``ngrams`` (1 or 2) words, joined by a space, repeats counted.
    Of the N rows with ``least_words`` words or more, the floor(percent N / 100) with the highest scores are drawn; ties go to the smaller
    doc_id, a null id last. The noise is a hash of ``seed`` and doc_id, so a repeated id has the same noise and its rows rank one after
    the other by their features and weight; equal rows take either rank. A null id counts as empty in the hash. Null, empty and blank texts have
    no features and weight 0. An empty target or table of documents only has smoothed gains, or no rows.

    Scale: three passes over the texts (frequent words, totals, weights) without a shuffle of texts; a task holds a block and
    tables of fixed size. The driver sees ``WORD_SLOTS`` words, ``PAIR_SLOTS`` pairs and ``n_buckets`` totals. Ranks come from Spark's range sort,
    so equal scores or a large share of drawn rows never meet in one task.
    """
    weighed = importance_weights(docs, target, ngrams, n_buckets)
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    noise = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    scored = weighed.withColumn(
        "score", F.col("weight") + F.floor(-1000 * F.log(-F.log((noise + 0.5) / F.lit(4294967296.0)))).cast("long")
    )
    eligible = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    # Rows with too few words form a group of their own, so that one sort numbers all and nothing is joined.
    placed = ordered_positions(scored.withColumn("short", ~eligible), ["short"], order)
    drawn = F.col("n_drawn") > F.col("position")
    counted = placed.where("not short").agg(F.floor(F.count(F.lit(1)) * percent / 100).cast("long").alias("n_drawn"))
    return placed.withColumn("n_drawn", counted.select("n_drawn").scalar()).select(
        "doc_id", "n_features", "weight", "score", F.when(~F.col("short") & drawn, F.col("position") + 1).alias("rank")
    )


#: The query with single words; CRC-32 of every distinct word's bytes by a table.
ORACLE_SQL = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
                          lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v
    FROM (SELECT unnest(range(256)) AS i))
),
texts AS (
  SELECT 's' AS side, row_number() OVER () AS rid, doc_id, text FROM documents
  UNION ALL SELECT 't', 0, NULL, text FROM benchmark
),
words AS (
  SELECT side, rid, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM texts
),
buckets AS (
  SELECT word, xor(list_reduce(
           list_transform(range(1, len(h), 2), lambda p: CAST('0x' || substr(h, p, 2) AS BIGINT)),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)), crc_table
),
totals AS (
  SELECT b AS bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t
  FROM (SELECT unnest(range(10000)) AS b) LEFT JOIN (buckets JOIN words USING (word)) ON bucket = b GROUP BY b
),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM (SELECT bucket, CAST(s AS DOUBLE) AS s, CAST(t AS DOUBLE) AS t FROM totals),
       (SELECT CAST(sum(s) AS DOUBLE) AS all_s, CAST(sum(t) AS DOUBLE) AS all_t FROM totals)
),
weights AS (
  SELECT rid, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight
  FROM words JOIN buckets USING (word) JOIN gains USING (bucket) WHERE side = 's' GROUP BY rid
),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(
           '0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT) AS score
  FROM texts LEFT JOIN weights USING (rid) WHERE side = 's'
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id, n_features, weight) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS eligible
  FROM scored
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= eligible * 10 // 100 THEN place END AS rank
FROM ranked
"""
