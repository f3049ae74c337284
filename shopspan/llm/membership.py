"""A test of membership of fixed size, to keep rows out of a shuffle that cannot matter there."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64-bit words of the largest filter (one megabyte). With many more keys than bits it lets everything through and saves nothing.
MOST_WORDS = 1 << 17
#: Bits for each key, below that size.
BITS_PER_KEY = 16


def _positions(value: Column, words: int) -> list[Column]:
    return [F.shiftrightunsigned(value, by).bitwiseAND(F.lit(64 * words - 1)) for by in (0, 20, 40)]


def may_be_in(keys: DataFrame) -> Callable[[Column], Column]:
    """A condition on 64-bit hashes that holds for all of ``keys``' only column, and for few other values (a Bloom filter).

    The bits are gathered by an aggregate of at most ``MOST_WORDS`` rows, however many keys there are.
    """
    key = F.col(keys.columns[0])
    words = min(max(keys.count() * BITS_PER_KEY // 64, 64), MOST_WORDS)
    words = 1 << (words - 1).bit_length()
    at = keys.select(F.explode(F.array(*_positions(key, words))).alias("at"))
    found = (
        at.groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()
    )
    bits = np.zeros(words, dtype=np.int64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    table = keys.sparkSession.createDataFrame(pa.table({"bits": pa.array([bits], pa.list_(pa.int64()))}))
    bits = table.select("bits").scalar()

    def holds(value: Column) -> Column:
        out = F.lit(True)
        for p in _positions(value, words):
            out = out & (F.getbit(bits[F.shiftright(p, 6).cast("int")], p.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return out

    return holds
