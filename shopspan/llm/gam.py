"""Quality of texts by a generalised additive model with pairwise interactions.

Features of whole texts are cut into quantile bins. Boosting visits the features in turn, again and again;
each visit fits a shallow tree on the bins of one feature and adds it to that feature's lookup table. Then the
pairs of features that explain most of what is left are boosted the same way on coarse grids. A score is the
logistic function of a sum of looked-up numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopspan.llm.language import held_out
from shopspan.llm.words import as_long, find_words, lists, text_blocks, word_hashes
from shopspan.sources.staging import staged

#: Labelled rows that are learned from, about; chosen by a hash of the id.
TRAIN_ROWS = 20_000
BINS, COARSE = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 40, 6
RATE, SMOOTH = 0.15, 5.0
DEPTH = 2
THRESHOLD = 0.3

FEATURES = (
    "log_bytes", "log_words", "bytes_per_word", "upper", "digits", "symbols", "exclaims", "points", "beyond_ascii",
    "lines_per_word", "same_as_before", "distinct_words", "commonest_word", "long_words",
)
# Classes of bytes, a bin each: upper, lower, digit, symbol, ! and ?, . and , and ; and :, line feed, beyond ASCII, other.
_CLASS = np.full(256, 8, dtype=np.int64)
_CLASS[ord("A"): ord("Z") + 1], _CLASS[ord("a"): ord("z") + 1], _CLASS[ord("0"): ord("9") + 1] = 0, 1, 2
_CLASS[list(b"#*$%&|<>@~^_=+\\{}[]")], _CLASS[list(b"!?")], _CLASS[list(b".,;:")], _CLASS[10] = 3, 4, 5, 6
_CLASS[0x80:] = 7


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for every text; all zero for empty texts."""
    size = np.diff(offsets)
    n = len(size)
    owner = np.repeat(np.arange(n), size)
    kinds = np.bincount(owner * 9 + _CLASS[data], minlength=9 * n).reshape(n, 9).astype(float)
    found = find_words(data, offsets)
    hashes, words = word_hashes(data, found), found.counts
    of = np.repeat(np.arange(n), words)
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    ordered = hashes.copy()
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        ordered[a:b].sort()
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = (ordered[1:] != ordered[:-1]) | (of[1:] != of[:-1])
    runs = np.diff(np.append(np.flatnonzero(new), len(ordered)))
    most = np.zeros(n)
    np.maximum.at(most, of[new], runs)
    letters, some, bytes_ = np.maximum(kinds[:, 0] + kinds[:, 1], 1), np.maximum(words, 1), np.maximum(size, 1)
    return np.stack([
        np.log1p(size), np.log1p(words), np.bincount(of, found.length, minlength=n) / some, kinds[:, 0] / letters,
        kinds[:, 2] / bytes_, kinds[:, 3] / bytes_, kinds[:, 4] / bytes_, kinds[:, 5] / bytes_, kinds[:, 7] / bytes_,
        kinds[:, 6] / some, np.bincount(of[same], minlength=n) / some, np.bincount(of[new], minlength=n) / some,
        most / some, np.bincount(of, found.length > 15, minlength=n) / some,
    ], axis=1)


@dataclass
class Additive:
    """Bin edges and a table per feature, and a table per chosen pair."""

    base: float
    edges: list[np.ndarray]
    tables: np.ndarray
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            total += table[bins[:, k]]
        for i, j, table in self.pairs:
            total += table[bins[:, i] * COARSE // BINS, bins[:, j] * COARSE // BINS]
        return 1 / (1 + np.exp(-total))


def shallow_tree(grad: np.ndarray, weight: np.ndarray, depth: int) -> tuple[np.ndarray, float]:
    """Leaf values on a grid of bins (any dimension) by greedy splits along its axes, and the gain."""
    g, h = grad.sum(), weight.sum()
    value = np.full(grad.shape, g / (h + SMOOTH))
    if not depth:
        return value, g * g / (h + SMOOTH)
    best, where = g * g / (h + SMOOTH) + 1e-9, None
    for axis in range(grad.ndim):
        others = tuple(a for a in range(grad.ndim) if a != axis)
        left_g, left_h = (np.cumsum(m.sum(axis=others))[:-1] for m in (grad, weight))
        if not len(left_g):
            continue
        gain = left_g**2 / (left_h + SMOOTH) + (g - left_g) ** 2 / (h - left_h + SMOOTH)
        if gain.max() > best:
            best, where = gain.max(), (axis, int(gain.argmax()) + 1)
    if where is None:
        return value, g * g / (h + SMOOTH)
    parts = [shallow_tree(a, b, depth - 1) for a, b in zip(
        *(np.split(m, [where[1]], axis=where[0]) for m in (grad, weight)))]
    return np.concatenate([p[0] for p in parts], axis=where[0]), sum(p[1] for p in parts)


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """The model of labels 0 and 1; without rows every score is one half."""
    width = len(FEATURES)
    if not len(y):
        return Additive(0.0, [np.zeros(0)] * width, np.zeros((width, BINS)), [])
    rate = (y.sum() + 0.5) / (len(y) + 1)
    edges = [np.unique(np.quantile(x[:, k], np.arange(1, BINS) / BINS)) for k in range(width)]
    model = Additive(float(np.log(rate / (1 - rate))), edges, np.zeros((width, BINS)), [])
    bins, total = model.bins(x), np.full(len(y), model.base)

    def boost(cells: np.ndarray, table: np.ndarray, total: np.ndarray) -> None:
        p = 1 / (1 + np.exp(-total))
        grad, weight = (np.bincount(cells, v, minlength=table.size).reshape(table.shape) for v in (y - p, p * (1 - p)))
        step = RATE * np.clip(shallow_tree(grad, weight, DEPTH)[0], -4, 4)
        table += step
        total += step.ravel()[cells]

    for _ in range(ROUNDS):
        for k in range(width):
            boost(bins[:, k], model.tables[k], total)
    coarse = bins * COARSE // BINS
    p = 1 / (1 + np.exp(-total))
    ranked = []
    for i in range(width):
        for j in range(i + 1, width):
            grad, weight = (np.bincount(coarse[:, i] * COARSE + coarse[:, j], v, minlength=COARSE**2).reshape(COARSE, COARSE)
                            for v in (y - p, p * (1 - p)))
            ranked.append((-shallow_tree(grad, weight, DEPTH)[1], i, j))
    model.pairs = [(i, j, np.zeros((COARSE, COARSE))) for _, i, j in sorted(ranked)[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            boost(coarse[:, i] * COARSE + coarse[:, j], table, total)
    return model


def _measure(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])
    for rows, data, offsets in text_blocks(batches, "text"):
        x = features(data, offsets)
        yield pa.RecordBatch.from_arrays(
            [as_long(rows.column("doc_id")), lists(x.ravel(), np.full(len(x), x.shape[1]))], schema=schema
        )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), len(FEATURES))


def _score(model: Additive):
    def run(batches):
        for rows in batches:
            score = model.score(_matrix(rows.column("x")))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return run


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (probability of quality 1) and predicted (score >= THRESHOLD) of every row.

    Needs doc_id and text of ``docs``, doc_id and quality of ``labels``; other columns are not read. Learns
    from labelled rows that are not held out; labels and doc_id take no part in a score. Null texts are empty and
    scored like any other; null labels are left out; null ids are held out; repeated rows are scored, and
    learned from, each time. Without labels every score is one half. Equal gains: the first split or pair
    wins. An empty table gives an empty result.

    Scale: one scan measures every text; a few numbers a row are staged. About TRAIN_ROWS of the labelled
    ones come to the driver, the lookup tables go back with the tasks.
    """
    measured = staged(docs.select("doc_id", "text").mapInArrow(_measure, "doc_id long, x array<double>"), "features")
    known = labels.where("quality is not null and doc_id is not null").select(
        F.col("doc_id").alias("labelled"), F.col("quality").cast("double").alias("y")
    ).where(~held_out(F.col("labelled")))
    rows = known.count()
    share = int(min(1.0, TRAIN_ROWS / max(rows, 1)) * (1 << 20))
    chosen = known.where(F.pmod(F.xxhash64("labelled"), F.lit(1 << 20)) < share)
    sample = measured.join(chosen, F.col("doc_id") == F.col("labelled")).select("x", "y").collect()
    order = sorted(range(len(sample)), key=lambda k: (sample[k]["x"], sample[k]["y"]))
    x = np.array([sample[k]["x"] for k in order]).reshape(len(order), len(FEATURES))
    model = fit(x, np.array([sample[k]["y"] for k in order]))
    return measured.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "x").mapInArrow(
        _score(model), "doc_id long, held_out boolean, score double, predicted int"
    )
