"""Words of whole texts as arrays.

A word is a run of bytes outside the ASCII white space 0x20 and 0x09-0x0D. UTF-8 never uses
those bytes inside a longer character, so words are cut on the encoded bytes, without decoding.
A batch of texts is one byte buffer; every step below is a pass over that buffer or its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of text handled at once; longer single texts form a block of their own.
BLOCK_BYTES = 1 << 20

_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Odd bases of the polynomial sequence hashes, and their inverses modulo 2**64.
BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (bijective)."""
    h = (h ^ (h >> np.uint64(32))) * _B
    return h ^ (h >> np.uint64(29))


def text_blocks(
    batches: Iterator[pa.RecordBatch], text: str, block_bytes: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets of the rows' texts in them) in blocks of bounded size; null texts are empty."""
    for batch in batches:
        column = batch.column(text)
        if column.null_count:
            column = column.fill_null("")
        wide = pa.types.is_large_string(column.type)
        size = len(column)
        if not size:
            continue
        _, offsets, data = column.buffers()
        where = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
        where = where[column.offset : column.offset + size + 1].astype(np.int64)
        whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < size:
            end = int(np.searchsorted(where, where[at] + block_bytes, side="right")) - 1
            end = min(max(end, at + 1), size)
            yield batch.slice(at, end - at), whole[where[at] : where[end]], where[at : end + 1] - where[at]
            at = end


@dataclass
class Words:
    """The words of a block: text d has words first[d] .. first[d + 1] - 1."""

    start: np.ndarray
    length: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~WHITE[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(start, end - start, np.searchsorted(start, offsets))


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit hash of every word, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    length = words.length
    h = mix((eight[words.start] & _MASKS[np.minimum(length, 8)]) + length.astype(np.uint64) * _A)
    more, at = np.flatnonzero(length > 8), 8
    while len(more):
        part = eight[words.start[more] + at] & _MASKS[np.minimum(length[more] - at, 8)]
        h[more] = mix((h[more] * _A) ^ part)
        at += 8
        more = more[length[more] > at]
    return h


def powers(count: int, base: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out) if count else out


class Sequences:
    """Hashes of word sequences from prefix sums, whatever their length."""

    def __init__(self, hashes: np.ndarray, base: int = BASES[0]):
        self.inverse = powers(len(hashes) + 1, pow(base, -1, 2**64))
        self.sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * powers(len(hashes), base), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def window_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``size`` words inside one text, and how many each text has."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    ends = np.cumsum(counts)
    shift = np.repeat(first[:-1] - (ends - counts), counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + shift, counts


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark longs."""
    return np.ascontiguousarray(values).view(np.int64)


def lists(values: pa.Array | np.ndarray, counts: np.ndarray) -> pa.Array:
    """One list per row from the values of all rows."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def as_long(column: pa.Array) -> pa.Array:
    return column.cast(pa.int64())
