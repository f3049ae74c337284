"""Language of texts by the nearest of several centroids per language.

A text is a vector of hashed letter trigrams, TF-IDF weighted and scaled to length one. Inverse document
frequencies come from all training rows; the centroids are spherical k-means clusters of a bounded sample.
A text gets the language of the centroid with the largest cosine. Texts farther from it than almost all
sampled texts of that language are marked as rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopspan.llm.words import as_long, text_blocks

DIMENSIONS = 4096
CENTROIDS = 3
#: Rows of each language from which centroids are learned, about; chosen by a hash of the id.
SAMPLE_ROWS = 300
#: A text is rejected below this share of the distance that a hundredth of the sampled texts stay under.
REJECT_SHARE = 0.8
NO_LANGUAGE = "und"
#: Up to so many languages their sample shares are broadcast; more are joined by a shuffle.
FEW_LANGUAGES = 1000
_TEXTS_AT_ONCE = 512

_SYMBOL = np.full(256, 0x20, dtype=np.uint8)
_SYMBOL[ord("a"): ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_SYMBOL[ord("A"): ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_SYMBOL[0x80:] = np.arange(0x80, 0x100)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: those whose CRC-32 of the id's text is divisible by five, or without id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def trigram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed trigrams, a row per text; a text is framed by spaces."""
    counts = np.diff(offsets)
    framed = np.full(len(data) + 2 * len(counts), 0x20, dtype=np.uint32)
    framed[np.arange(len(data)) + np.repeat(2 * np.arange(len(counts)) + 1, counts)] = _SYMBOL[data]
    grams = framed[:-2] | framed[1:-1] << 8 | framed[2:] << 16
    slots = (grams * np.uint32(2654435761)) >> np.uint32(32 - 12)
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(data)) + 2 * owner
    flat = np.bincount(owner * DIMENSIONS + slots[inside], minlength=len(counts) * DIMENSIONS)
    return flat.reshape(len(counts), DIMENSIONS)


def _slices(batches):
    for rows, data, offsets in text_blocks(batches, "text"):
        for at in range(0, rows.num_rows, _TEXTS_AT_ONCE):
            part = offsets[at: at + _TEXTS_AT_ONCE + 1]
            yield rows.slice(at, _TEXTS_AT_ONCE), trigram_counts(data[part[0]: part[-1]], part - part[0])


def _frequencies(batches):
    total, texts = np.zeros(DIMENSIONS, dtype=np.int64), 0
    for rows, counts in _slices(batches):
        total += (counts > 0).sum(axis=0)
        texts += rows.num_rows
    slots = np.arange(DIMENSIONS + 1)
    yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(np.append(total, texts))], ["slot", "texts"])


def _vectors(batches):
    for rows, counts in _slices(batches):
        yield pa.RecordBatch.from_arrays(
            [rows.column("lang"), pa.array([c.astype(np.float32).tobytes() for c in np.log1p(counts)], pa.binary())],
            ["lang", "vector"],
        )


@dataclass
class Centroids:
    idf: np.ndarray
    languages: list[str]  # of each centroid
    vectors: np.ndarray
    least: np.ndarray  # cosine under which a text is rejected, by centroid

    def weigh(self, logs: np.ndarray) -> np.ndarray:
        v = logs * self.idf
        return v / np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-12)


def cluster(vectors: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """Spherical k-means from far-apart starts; fewer centroids if there are fewer different vectors."""
    centres = [vectors.mean(axis=0)]
    while len(centres) < k:
        near = np.max(vectors @ np.array(centres).T, axis=1)
        if near.min() > 0.999999:
            break
        centres.append(vectors[near.argmin()])
    out = np.array(centres)
    for _ in range(rounds):
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
        owner = (vectors @ out.T).argmax(axis=1)
        new = np.array([vectors[owner == c].mean(axis=0) if (owner == c).any() else out[c] for c in range(len(out))])
        if np.allclose(new, out):
            break
        out = new
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def learn(training: DataFrame) -> Centroids:
    """Centroids from rows (doc_id, text, lang); needs a pass over all texts and one over a sample."""
    frequency = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for r in training.select("text").mapInArrow(_frequencies, "slot long, texts long").groupBy("slot").agg(
        F.sum("texts").alias("texts")
    ).collect():
        frequency[r["slot"]] = r["texts"]
    idf = (np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1).astype(np.float32)
    sizes = training.groupBy("lang").agg(
        F.least(F.lit(1.0), F.lit(SAMPLE_ROWS) / F.count(F.lit(1))).alias("share")
    )
    few = sizes.limit(FEW_LANGUAGES + 1).count() <= FEW_LANGUAGES
    chosen = training.join(F.broadcast(sizes) if few else sizes, "lang").where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.col("share") * (1 << 20)
    )
    sample: dict[str, list[np.ndarray]] = {}
    for r in chosen.select("lang", "text").mapInArrow(_vectors, "lang string, vector binary").collect():
        sample.setdefault(r["lang"], []).append(np.frombuffer(r["vector"], np.float32))
    model = Centroids(idf, [], np.zeros((0, DIMENSIONS), np.float32), np.zeros(0))
    parts, least = [], []
    for lang in sorted(sample):
        vectors = model.weigh(np.array(sorted(sample[lang], key=lambda v: v.tobytes())))
        centres = cluster(vectors, CENTROIDS)
        cosine = (vectors @ centres.T).max(axis=1)
        parts.append(centres)
        least += [REJECT_SHARE * float(np.quantile(cosine, 0.01))] * len(centres)
        model.languages += [lang] * len(centres)
    if parts:
        model.vectors, model.least = np.concatenate(parts).astype(np.float32), np.array(least)
    return model


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _predict(model: Centroids):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                        ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches):
        names = np.array(model.languages + [NO_LANGUAGE], dtype=object)
        for rows, counts in _slices(batches):
            letters = np.array([_has_letter(t.as_py()) for t in rows.column("text")], dtype=bool)
            best, score = np.full(rows.num_rows, len(model.languages)), np.zeros(rows.num_rows)
            rejected = np.ones(rows.num_rows, dtype=bool)
            if model.languages:
                cosine = model.weigh(np.log1p(counts).astype(np.float32)) @ model.vectors.T
                best = np.where(letters, cosine.argmax(axis=1), len(model.languages))
                score = np.where(letters, np.clip(cosine.max(axis=1), 0, 1), 0.0)
                rejected = ~letters | (score < model.least[cosine.argmax(axis=1)])
            yield pa.RecordBatch.from_arrays([
                as_long(rows.column("doc_id")), rows.column("held_out"), pa.array(names[best], pa.string()),
                pa.array(score.astype(np.float64)), pa.array(rejected),
            ], schema=schema)

    return run


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every row of ``docs``.

    Needs doc_id, text and lang; other columns are not read. Rows with a lang that are not held out are
    learned from; neither lang nor doc_id takes part in a prediction. ``score`` is the cosine with the nearest
    centroid. A null text or one without a letter is ``und`` with score 0, as is every text when nothing could
    be learned. Of equal cosines the language first by name wins. Repeated rows are judged and learned from
    each time; null ids are held out. An empty table gives an empty result.

    Scale: passes without a text shuffle. Frequencies are summed per task into a vector of fixed size; the
    sample sent to the driver is bounded by SAMPLE_ROWS a language, and the model by CENTROIDS a language.
    """
    training = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    model = learn(training)
    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(
        _predict(model), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    )
