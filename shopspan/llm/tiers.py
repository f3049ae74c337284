"""Hierarchical packing of documents into sequences of several lengths.

Context sizes form tiers. A document is routed to the shortest tier that holds it; whole windows of the longest
tier are cut off longer ones first. Tiers are packed from long to short: a window of a tier takes one of its
tier's documents and fills the gap from shorter tiers, the longest that fits first, and a last gap with the head of one more document.
So every window but the last of a buffer is exactly full, and that last one is cut at powers of two. Windows of a tier
are then dealt to step groups of equal numbers of tokens so that the groups' attention costs are alike.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopspan.llm.words import as_long, lists

#: Context sizes, powers of two from long to short.
CONTEXTS = (2048, 1024, 512, 256)
#: Tokens a task holds before it packs them.
BUFFER_TOKENS = 1 << 22
#: Tokens of a step group: so many windows of the longest context, or as many tokens in shorter ones.
GROUP_WINDOWS = 8
#: Chunks and words whose ids a task remembers: this many recent ones, and as many before them, none of them longer.
KNOWN, KNOWN_CHARS = 150_000, 40
#: Sequence and group numbers of one task.
_TASK_BITS = 40

#: How vocabularies of this kind normalise a text and part it into words.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

#: Unicode's White_Space, at which chunks part.
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: ``str.split`` also parts at these.
_NOT_WHITE = re.compile("[\x1c-\x1f]")
#: Chunks of other characters are left to ``tokenizers``.
_LATIN = re.compile("[\x00-ɏ]*")
_WORDS = regex.compile(WORD_PATTERN)
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: The printable stand-in of every byte, as in all byte-level vocabularies.
_BYTES = dict(zip(sorted(set(range(256)) - set(_VISIBLE)), range(256, 512)))


class Recent:
    """The values of recent keys, in two generations of bounded size."""

    def __init__(self, compute, most: int = KNOWN, longest: int = KNOWN_CHARS):
        self.compute, self.most, self.longest = compute, most, longest
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, key: str) -> bytes:
        """The value of a key that is not in ``young``."""
        found = self.old.get(key)
        if found is None:
            found = self.compute(key)
        if len(key) <= self.longest:
            if len(self.young) >= self.most:
                self.old, self.young = self.young, {}
            self.young[key] = found
        return found


def _bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class ChunkEncoder:
    """Ids of ``tokenizers`` as little-endian bytes, remembering those of chunks between white space and of words.

    Holds for lower-casing vocabularies with ``NORMALIZER`` and ``WORD_PATTERN``, whose tokens never cross white space;
    other files, and texts that may hold an added token, are encoded whole by ``tokenizers``.
    """

    def __init__(self, path: str):
        self.reference = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = [{k: v for k, v in p.items() if k != "trim_offsets"} for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.by_chunk = (
            (spec["normalizer"] or {}).get("normalizers") == NORMALIZER and split == [
                {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True},
                {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False},
            ] and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
        )
        self.marks = {t["content"][:2] for t in spec["added_tokens"]}
        self.model = self.reference.model
        self.words = Recent(self._word)
        self.chunks = Recent(self._chunk)

    def _whole(self, text: str) -> bytes:
        return _bytes(self.reference.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        return _bytes([t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(_BYTES))])

    def _chunk(self, chunk: str) -> bytes:
        if not _LATIN.fullmatch(chunk):
            return self._whole(chunk)
        out = []
        for word in _WORDS.findall(unicodedata.normalize("NFC", chunk).lower()):
            found = self.words.young.get(word)
            out.append(self.words.missing(word) if found is None else found)
        return b"".join(out)

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_chunk or any(m in text for m in self.marks):
            return self._whole(text)
        chunks = _WHITE.split(text) if _NOT_WHITE.search(text) else text.split()
        out = list(map(self.chunks.young.get, chunks))
        for k in [k for k, found in enumerate(out) if found is None]:
            found = self.chunks.young.get(chunks[k])
            out[k] = self.chunks.missing(chunks[k]) if found is None else found
        return b"".join(out)


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


class Piece(NamedTuple):
    document: int
    start: int
    length: int


class Supply:
    """Pieces by length; a bit set tells which lengths are there, so the longest one up to a bound is one bit scan."""

    def __init__(self, longest: int):
        self.bits = 0
        self.by_length: list[list[Piece]] = [[] for _ in range(longest + 1)]

    def add(self, piece: Piece) -> None:
        self.by_length[piece.length].append(piece)
        self.bits |= 1 << piece.length

    def longest(self, most: int) -> int:
        """Length of the longest piece of at most ``most`` tokens, 0 if there is none."""
        return max((self.bits & ((1 << (most + 1)) - 1)).bit_length() - 1, 0)

    def shortest(self, least: int) -> int:
        """Length of the shortest piece of at least ``least`` tokens, 0 if there is none."""
        above = self.bits >> least
        return least + (above & -above).bit_length() - 1 if above else 0

    def take(self, length: int) -> Piece:
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            self.bits &= ~(1 << length)
        return piece


def powers_of_two(tokens: int) -> list[int]:
    """The powers of two that add up to ``tokens``, longest first."""
    return [1 << k for k in range(tokens.bit_length() - 1, -1, -1) if tokens >> k & 1]


def _cut(pieces: list[Piece], sizes: list[int]) -> list[list[Piece]]:
    """The row of pieces as windows of the given sizes."""
    windows, rest = [], pieces[::-1]
    for size in sizes:
        window = []
        while size:
            p = rest.pop()
            if p.length > size:
                rest.append(Piece(p.document, p.start + size, p.length - size))
                p = Piece(p.document, p.start, size)
            window.append(p)
            size -= p.length
        windows.append(window)
    return windows


def windows_of(tokens: list[int], contexts: tuple[int, ...] = CONTEXTS) -> list[tuple[int, list[Piece]]]:
    """(size, pieces) of full windows that hold every token of the documents exactly once.

    All sizes are contexts but those of at most one window, whose tokens are fewer than there are in a context and go
    into windows of powers of two.
    """
    longest = contexts[0]
    supply, windows = Supply(longest), []
    for d, n in enumerate(tokens):
        at = 0
        while n - at >= longest:
            windows.append((longest, [Piece(d, at, longest)]))
            at += longest
        if n > at:
            supply.add(Piece(d, at, n - at))
    for size, shorter in zip(contexts, [*contexts[1:], 0]):
        # The tier's own documents, longest first; what their windows cut off falls to the tier of its length.
        while (first := supply.longest(size)) > shorter:
            window = [supply.take(first)]
            gap = size - first
            while gap and (fits := supply.longest(gap)):
                window.append(supply.take(fits))
                gap -= fits
            if gap and (over := supply.shortest(gap + 1)):
                p = supply.take(over)
                window.append(Piece(p.document, p.start, gap))
                supply.add(Piece(p.document, p.start + gap, p.length - gap))
                gap = 0
            if gap:  # nothing is left
                windows += zip(powers_of_two(size - gap), _cut(window, powers_of_two(size - gap)))
            else:
                windows.append((size, window))
    return windows


def step_groups(costs: list[int], windows_in_group: int) -> list[int]:
    """A group for each window: as many groups as the windows fill, sizes that differ by one at most, costs alike.

    The costliest window goes first, to the group with the lowest cost that has room.
    """
    if not costs:
        return []
    groups = max(len(costs) // windows_in_group, 1)
    least, more = divmod(len(costs), groups)
    # The first ``more`` groups to reach the common size may take one window above it.
    open_groups = [(0, g, 0) for g in range(groups)]
    out = [0] * len(costs)
    for k in sorted(range(len(costs)), key=lambda k: (-costs[k], k)):
        while True:
            cost, g, n = heapq.heappop(open_groups)
            if n < least:
                break
            if more:
                more -= 1
                break
        out[k] = g
        if n + 1 <= least:
            heapq.heappush(open_groups, (cost + costs[k], g, n + 1))
    return out


def _packer(path: str, contexts: tuple[int, ...], end_id: int, buffer_tokens: int, with_ids: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                        ("context", pa.int32()), ("step_group", pa.int64()), *([("ids", pa.list_(pa.int32()))] if with_ids else [])])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = chunk_encoder(path).ids
        sequence = group = TaskContext.get().partitionId() << _TASK_BITS
        owners: list[pa.Array] = []
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, group
            owner = pa.concat_arrays(owners)
            windows = windows_of([len(t) for t in held], contexts)
            groups = [0] * len(windows)
            for size in sorted({s for s, _ in windows}, reverse=True):
                of_tier = [k for k, (s, _) in enumerate(windows) if s == size]
                cost = [sum(p.length**2 for p in windows[k][1]) for k in of_tier]
                dealt = step_groups(cost, GROUP_WINDOWS * contexts[0] // size)
                for k, g in zip(of_tier, dealt):
                    groups[k] = group + g
                group += max(dealt) + 1
            at = 0
            while at < len(windows):
                stop, rows = at, 0
                while stop < len(windows) and rows < 20_000:
                    rows += len(windows[stop][1])
                    stop += 1
                part = windows[at:stop]
                pieces = [p for _, w in part for p in w]
                counts = np.array([len(w) for _, w in part])
                lengths = np.array([p.length for p in pieces], dtype=np.int64)
                ends = np.cumsum(lengths)
                sizes = np.array([s for s, _ in part], dtype=np.int64)
                starts = np.repeat(np.cumsum(sizes) - sizes, counts)
                ids = [held[p.document][p.start: p.start + p.length] for p in pieces]
                columns = [
                    owner.take(pa.array([p.document for p in pieces])), pa.array([p.start for p in pieces], pa.int64()), pa.array(lengths),
                    pa.array([zlib.crc32(i) for i in ids], pa.int64()), pa.array([len(held[p.document]) for p in pieces], pa.int64()),
                    pa.array(np.repeat(sequence + np.arange(at, stop), counts)), pa.array(ends - lengths - starts),
                    pa.array(np.repeat(sizes, counts).astype(np.int32)), pa.array(np.repeat(np.array(groups[at:stop], dtype=np.int64), counts)),
                ]
                if with_ids:
                    columns.append(lists(np.concatenate(ids).view(np.int32), lengths))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                at = stop
            sequence += len(windows)
            owners.clear(), held.clear()

        waiting = 0
        for batch in batches:
            owner = as_long(batch.column("doc_id"))
            for row, text in enumerate(batch.column("text")):
                tokens = np.frombuffer(encode(text.as_py() or "") + end, dtype="<u4")
                owners.append(owner.slice(row, 1)), held.append(tokens)
                waiting += len(tokens)
                if waiting >= buffer_tokens:
                    yield from flush()
                    waiting = 0
        if held:
            yield from flush()

    return run


def pack_tiers(docs: DataFrame, tokenizer_path: str, contexts: tuple[int, ...] = CONTEXTS, end_id: int = 1,
               buffer_tokens: int = BUFFER_TOKENS, with_ids: bool = True) -> DataFrame:
    """Token pieces of all documents, placed in full sequences of the lengths ``contexts``.

    ``docs`` needs doc_id and text; other columns are not read. ``contexts`` are descending powers of two. A document is its ids and
    then ``end_id``. Returns per piece doc_id, start (its document's ids before it), length, ids_crc32, doc_tokens, sequence_id, offset,
    context (the sequence's length), step_group (a number; the group's sequences have one context, about
    ``GROUP_WINDOWS * contexts[0]`` tokens together, and costs like those of the other groups) and, unless switched off, ids. Sequences
    need no padding: they are full, and the last tokens of a buffer lie in sequences of powers of two. Null texts are empty and consist
    of ``end_id``; null ids and repeated rows are packed like others; among pieces of equal length the latest goes first. An empty table
    gives an empty result. The vocabulary file must be readable on every executor.

    Scale: one pass, no shuffle. A task packs its own rows; it holds ``buffer_tokens`` ids, one document beyond them, and a bounded
    table of known chunks. Sequences and groups lie within one task, and a task that runs again places every piece as before.
    """
    if list(contexts) != sorted(contexts, reverse=True) or any(c < 1 or c & (c - 1) for c in contexts):
        raise ValueError("contexts must be descending powers of two")
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
              "context int, step_group long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(
        _packer(tokenizer_path, tuple(contexts), end_id, buffer_tokens, with_ids), schema + ", ids array<int>" * with_ids
    )
