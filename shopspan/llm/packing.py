"""Packing of documents into sequences by bounded-space online best fit.

A fixed number of bins is open at a time. A bit set holds one bit per amount of free space for which a bin
is open, so the tightest bin that takes a piece is the lowest set bit from the piece's length on. When a new
bin would exceed the number, the fullest open bin closes.
"""

from __future__ import annotations

import json
import zlib
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopspan.llm.words import as_long, lists

CAPACITY = 2048
#: Open bins of a task. Each holds a number and its free space, so memory is fixed.
OPEN_BINS = 512
#: Sequence numbers of one task.
_TASK_BITS = 40
#: Fixed value: the split pattern that byte-level vocabularies of this kind use before merging.
SPLIT_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


class Encoder:
    """Ids of ``tokenizers`` for a vocabulary file.

    Plain byte-level vocabularies, whose ids stand in merge order, run through the merge loop of tiktoken,
    which gives the same ids in a third of the time; other files, texts that contain the string of an added
    token, and single texts whose white space is too long for the loop's pattern go through ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.fast = self._fast(spec)

    def _fast(self, spec: dict) -> tiktoken.Encoding | None:
        split = spec["pre_tokenizer"] or {}
        model = spec["model"]
        if (split.get("type"), split.get("add_prefix_space"), split.get("use_regex")) != ("ByteLevel", False, True):
            return None
        if spec["normalizer"] or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
            return None
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(visible)]
        byte_of = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
        words = {t: i for t, i in model["vocab"].items() if t not in self.added}
        merged = [words.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
        if merged != sorted(set(merged)) or len(words) != 256 + len(merged) or set("".join(words)) - set(byte_of):
            return None
        ranks = {bytes(byte_of[c] for c in t): i for t, i in words.items()}
        return tiktoken.Encoding("file", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def reference(self) -> Tokenizer:
        """Loaded when a text first needs it, since a worker keeps it from then on."""
        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype="<u4")
        if self.fast is None or any(t in text for t in self.added):
            return np.array(self.reference.encode(text, add_special_tokens=False).ids, dtype="<u4")
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        except ValueError:  # the split pattern's look-ahead gives up on very long white space
            return np.array(self.reference.encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class OpenBins:
    """Best fit over a fixed number of open bins; a bin is (number, free space)."""

    def __init__(self, capacity: int, most: int, first_number: int = 0):
        self.capacity, self.most, self.next_number = capacity, most, first_number
        self.bits, self.open = 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1 to ``capacity`` tokens."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            number, free = self.next_number, self.capacity
            self.next_number += 1
        rest = free - size
        if rest:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            self.by_free[rest].append(number)
            self.bits |= 1 << rest
            self.open += 1
        return number, self.capacity - free


def pieces(tokens: int, capacity: int) -> list[int]:
    """Piece lengths of a document: whole sequences, after a shorter first piece if needed."""
    first = (tokens - 1) % capacity + 1
    return [first] + [capacity] * ((tokens - first) // capacity)


def _packer(path: str, capacity: int, open_bins: int, end_id: int, with_ids: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                        *([("ids", pa.list_(pa.int32()))] if with_ids else [])])

    def run(batches):
        encode = encoder(path).ids
        end = np.array([end_id], dtype="<u4")
        bins = OpenBins(capacity, open_bins, TaskContext.get().partitionId() << _TASK_BITS)
        for batch in batches:
            owner, number, start, length, ids, sums = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text")):
                tokens = np.concatenate([encode(text.as_py() or ""), end])
                at = 0
                for k, size in enumerate(pieces(len(tokens), capacity)):
                    owner.append(row), number.append(k), start.append(at), length.append(size)
                    sums.append(zlib.crc32(tokens[at: at + size]))
                    if with_ids:
                        ids.append(tokens[at: at + size])
                    at += size
            if not owner:
                continue
            sizes = np.array(length)
            places = np.empty((len(owner), 2), dtype=np.int64)
            for k in np.argsort(-sizes, kind="stable").tolist():
                places[k] = bins.place(length[k])
            columns = [
                as_long(batch.column("doc_id")).take(pa.array(owner)), pa.array(number, pa.int32()),
                pa.array(start, pa.int64()), pa.array(sizes), pa.array(sums, pa.int64()),
                pa.array(places[:, 0]), pa.array(places[:, 1]),
            ]
            if with_ids:
                columns.append(lists(np.concatenate(ids).view(np.int32), sizes))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """Token pieces of all documents, placed in sequences of at most ``capacity`` tokens.

    ``docs`` needs doc_id and text; other columns are not read. A document is its ids and then ``end_id``.
    Longer documents are cut into pieces of ``capacity`` tokens after a first piece with the remainder. Returns
    per piece doc_id, piece, start, length, ids_crc32, sequence_id, offset and, unless switched off, ids. Null texts are empty and
    consist of ``end_id``; null ids and repeated rows are packed like others; pieces of equal length keep their
    order. An empty table gives an empty result. The vocabulary file must be readable on every executor.

    Scale: one pass, no shuffle. A task packs its own rows, an Arrow batch at a time, longest pieces first; its
    memory is a batch and ``open_bins`` numbers. A sequence lies within one task, so numbers need no agreement,
    and a task that runs again on the same input places every piece as before.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(
        _packer(tokenizer_path, capacity, open_bins, end_id, with_ids), schema + ", ids array<int>" * with_ids
    )
