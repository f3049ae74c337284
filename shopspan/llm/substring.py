"""Removal of passages that occur more than once, by seed and extend.

Winnowing picks the smallest eight-word hash in every window of the threshold length, so two equal
windows always pick the same seed at the same place. Documents meet on seeds that occur twice; each such
seed is extended to the left and right over all windows that picked it, and windows whose word sequence
occurs again are merged into maximal repeats.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopspan.llm.words import (
    BASES, Sequences, Words, as_long, find_words, lists, mix, signed, text_blocks, window_starts, word_hashes,
)
from shopspan.sources.staging import staged

SEED_WORDS = 8
_PLACE_BITS = np.uint64(24)
_PLACE = np.uint64((1 << 24) - 1)


def text_key() -> Column:
    """Equal for equal texts; null texts count as empty."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def winnow(hashes: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, windows per text, the seed each window picks, and the hashes of seeds by start."""
    seed = min(SEED_WORDS, length)
    starts, counts = window_starts(first, length)
    last = max(len(hashes) - seed + 1, 0)
    at = np.arange(last)
    seeds = Sequences(hashes).of(at, at + seed)
    low = (seeds & ~_PLACE) | (_PLACE - (at.astype(np.uint64) & _PLACE))
    span, wide = length - seed + 1, 1
    while 2 * wide <= span:
        low = np.minimum(low[: len(low) - wide], low[wide:])
        wide *= 2
    if span > wide:
        low = np.minimum(low[: len(low) - (span - wide)], low[span - wide:])
    place = _PLACE - (low[starts] & _PLACE)
    picked = starts + ((place - starts.astype(np.uint64)) & _PLACE).astype(np.int64)
    return starts, counts, picked, seeds


def _digest(data: np.ndarray) -> str:
    return hashlib.sha256(data.tobytes()).hexdigest()


def kept_bytes(data: np.ndarray, words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of all texts, each word followed by one space, and where each text ends."""
    size = np.where(keep, words.length, 0)
    ends = np.cumsum(size + keep)
    total = int(ends[-1]) if len(ends) else 0
    out = np.full(total, 0x20, dtype=np.uint8)
    length = words.length[keep]
    to = (ends - size - 1)[keep]
    within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(to, length) + within] = data[np.repeat(words.start[keep], length) + within]
    return out, np.concatenate([[0], ends])[words.first]


def _texts(out: np.ndarray, ends: np.ndarray):
    return [out[a: max(b - 1, a)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _seeds(length: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("node", pa.int64()),
        ("kept_sha256", pa.string()), ("seeds", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())),
    ])

    def run(batches):
        for rows, data, offsets in text_blocks(batches, "text"):
            words = find_words(data, offsets)
            hashes = word_hashes(data, words)
            one, two = (Sequences(hashes, b).of(words.first[:-1], words.first[1:]) for b in BASES)
            _, counts, picked, seeds = winnow(hashes, words.first, length)
            new = np.ones(len(picked), dtype=bool)
            new[1:] = picked[1:] != picked[:-1]
            owner = np.repeat(np.arange(rows.num_rows), counts)[new]
            places = picked[new]
            per_text = np.bincount(owner, minlength=rows.num_rows)
            sha = [_digest(t) for t in _texts(*kept_bytes(data, words, np.ones(len(hashes), dtype=bool)))]
            yield pa.RecordBatch.from_arrays([
                as_long(rows.column("doc_id")), rows.column("text_key"), pa.array(words.counts.astype(np.int64)),
                pa.array(signed(mix(one ^ mix(two)))), pa.array(sha, pa.string()),
                lists(signed(seeds[places]), per_text), lists((places - words.first[owner]).astype(np.int32), per_text),
            ], schema=schema)

    return run


def _extend(length: int):
    schema = pa.schema([("node", pa.int64()), ("text", pa.string()),
                        ("windows", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32()))])

    def run(batches):
        for rows, data, offsets in text_blocks(batches, "text"):
            words = find_words(data, offsets)
            hashes = word_hashes(data, words)
            starts, counts, picked, _ = winnow(hashes, words.first, length)
            repeated = np.zeros(len(hashes) + 1, dtype=bool)
            places = rows.column("places")
            owner = np.repeat(np.arange(rows.num_rows), places.value_lengths().to_numpy())
            repeated[words.first[owner] + places.flatten().to_numpy()] = True
            chosen = repeated[picked]
            owner = np.repeat(np.arange(rows.num_rows), counts)[chosen]
            begin = starts[chosen]
            per_text = np.bincount(owner, minlength=rows.num_rows)
            values = Sequences(hashes, BASES[1]).of(begin, begin + length)
            text = rows.column("text").cast(pa.string())
            yield pa.RecordBatch.from_arrays([
                rows.column("node"), text, lists(signed(values), per_text),
                lists((begin - words.first[owner]).astype(np.int32), per_text),
            ], schema=schema)

    return run


def _cut(length: int):
    schema = pa.schema([("node", pa.int64()), ("n_removed", pa.int64()), ("new_sha256", pa.string()),
                        ("kept_text", pa.string())])

    def run(batches):
        for rows, data, offsets in text_blocks(batches, "text"):
            words = find_words(data, offsets)
            n = len(words.start)
            starts = rows.column("starts")
            owner = np.repeat(np.arange(rows.num_rows), starts.value_lengths().to_numpy())
            begin = words.first[owner] + starts.flatten().to_numpy()
            cover = np.bincount(begin, minlength=n + 1)[: n + 1] - np.bincount(begin + length, minlength=n + 1)[: n + 1]
            keep = np.cumsum(cover)[:n] == 0
            removed = words.counts - np.diff(np.concatenate([[0], np.cumsum(keep)])[words.first])
            kept = _texts(*kept_bytes(data, words, keep))
            yield pa.RecordBatch.from_arrays([
                rows.column("node"), pa.array(removed.astype(np.int64)),
                pa.array([_digest(t) for t in kept], pa.string()),
                pa.array([t.tobytes().decode() for t in kept], pa.string()),
            ], schema=schema)

    return run


def repeated_passages(docs: DataFrame, length: int = 35) -> DataFrame:
    """What is left of every text when all words of repeated windows of ``length`` words go.

    ``docs`` needs doc_id and text; other columns are not read. One row per row: doc_id, text_key (of the
    text), n_words, n_removed, kept_sha256 (of the kept words joined by one space) and kept_text (null where
    nothing goes). A window goes wherever its word sequence also starts elsewhere, in another row or in the
    same text. Null texts are empty; texts shorter than ``length`` words stay whole; repeated rows are
    occurrences of each other, so they lose all their words; null ids are kept as they are. There are no ties
    to break. An empty table gives an empty result.

    Scale: seeds and windows are counted with partial sums before their shuffles and joined on hashes, so a
    passage in a third of all documents is one counter per task and a join side that is split; no pair of
    documents is ever formed. Rows with equal words count as one text: they are decided by their number alone.
    Only texts with repeated seeds are read again for the extension.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_key", text_key())
    sketches = staged(rows.mapInArrow(_seeds(length), (
        "doc_id long, text_key long, n_words long, node long, kept_sha256 string, seeds array<long>, places array<int>"
    )), "seeds")
    long_enough = sketches.where(F.col("n_words") >= length)
    nodes = long_enough.groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("text_key", "doc_id")).alias("sample")
    )
    seeds = long_enough.select("node", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select(
        "node", F.col("s.seeds").alias("seed"), F.col("s.places").alias("place")
    )
    # Staged, so that the joins below read both sides from plain shuffles, whose hot keys Spark can split.
    repeated = staged(seeds.groupBy("seed").agg(
        F.min("node").alias("n0"), F.max("node").alias("n1"), F.min("place").alias("p0"), F.max("place").alias("p1")
    ).where("n0 <> n1 or p0 <> p1").select("seed"), "repeated-seeds")
    places = seeds.join(repeated, "seed").groupBy("node").agg(F.collect_set("place").alias("places"))
    wanted = places.join(nodes, "node").select("node", "places", "sample.*")
    texts = (
        rows.join(wanted, (rows.text_key == wanted.text_key) & rows.doc_id.eqNullSafe(wanted.doc_id))
        .select("node", "places", F.coalesce("text", F.lit("")).alias("text"))
    )
    extended = staged(
        texts.mapInArrow(_extend(length), "node long, text string, windows array<long>, starts array<int>"), "extended"
    )
    windows = extended.select("node", F.explode(F.arrays_zip("windows", "starts")).alias("w")).select(
        "node", F.col("w.windows").alias("window"), F.col("w.starts").alias("start")
    )
    again = staged(windows.groupBy("window").agg(
        F.min("node").alias("n0"), F.max("node").alias("n1"), F.min("start").alias("s0"), F.max("start").alias("s1")
    ).where("n0 <> n1 or s0 <> s1").select("window"), "repeated-windows")
    starts = windows.join(again, "window").groupBy("node").agg(F.collect_set("start").alias("starts"))
    cut = (
        extended.select("node", "text").join(starts, "node")
        .mapInArrow(_cut(length), "node long, n_removed long, new_sha256 string, kept_text string")
        .groupBy("node").agg(F.max("n_removed").alias("n_removed"), F.first("new_sha256").alias("new_sha256"),
                             F.first("kept_text").alias("kept_text"))
    )
    # Copies are settled by a table of nodes alone, whose hot keys Spark can split; what is left has unique nodes.
    copied = staged(nodes.where("copies > 1").select("node", F.lit(True).alias("copied")), "copied")
    judged = staged(
        sketches.drop("seeds", "places").join(copied, "node", "left").withColumn("copied", F.col("copied").isNotNull()),
        "judged",
    )
    whole = judged.where("copied").select(
        "doc_id", "text_key", "n_words", F.col("n_words").alias("n_removed"),
        F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"), F.lit("").alias("kept_text"),
    )
    return judged.where("not copied").join(cut, "node", "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("new_sha256", "kept_sha256").alias("kept_sha256"), "kept_text",
    ).unionByName(whole)


def without_repeats(docs: DataFrame, length: int = 35) -> DataFrame:
    """``docs`` with the texts that :func:`repeated_passages` leaves; other texts and columns unchanged."""
    found = repeated_passages(docs, length).where("kept_text is not null")
    new = found.groupBy(F.col("text_key").alias("changed_key")).agg(F.first("kept_text").alias("changed_text"))
    joined = docs.join(new, text_key() == new["changed_key"], "left")
    text = F.coalesce(new["changed_text"], docs["text"]).alias("text")
    return joined.select(*[text if c == "text" else docs[c] for c in docs.columns])


#: The query with 35 words: all windows counted as texts.
ORACLE_SQL = r"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
windows AS (
  SELECT rid, i, array_to_string(words[i:i + 34], ' ') AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 33)) AS i FROM base WHERE len(words) >= 35)
),
twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY win) > 1),
covered AS (SELECT DISTINCT rid, i + k AS pos FROM twice, (SELECT unnest(range(0, 35)) AS k)),
singles AS (SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM base),
kept AS (
  SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS body FROM singles ANTI JOIN covered USING (rid, pos) GROUP BY rid
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM base LEFT JOIN kept USING (rid)
"""
