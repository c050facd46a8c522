"""Bounded membership filters, so that a few rows can be picked out of many without a shuffle.

A filter is a bit field of at most ``MOST_BITS`` bits, set by a few positions per key. It never
misses a key and takes about one other in a hundred, so what it picks still goes through an exact join,
and what it leaves is certain. It is built by Spark; the driver holds the bit field alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES, BITS_PER_KEY = 4, 10
MOST_BITS = 1 << 27  # 16 MB
_PART = 1 << 15  # bits of one of Spark's bitmaps


def _positions(key: Column, bits: int) -> list[Column]:
    first, second = key.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(key, 32).bitwiseOR(F.lit(1))
    return [(first + i * second).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)]


class PossibleMembers:
    """A filter: a test on a column of longs, or, inside a task, on an array of them."""

    def __init__(self, field: Broadcast, bits: int) -> None:
        self.field, self.bits = field, bits

    def holds(self, keys: np.ndarray) -> np.ndarray:
        values, field = keys.astype(np.int64, copy=False).view(np.uint64), self.field.value
        first, second = values & np.uint64(0xFFFFFFFF), values >> np.uint64(32) | np.uint64(1)
        found = np.ones(len(values), bool)
        for i in range(PROBES):
            at = (first + np.uint64(i) * second) & np.uint64(self.bits - 1)
            found &= (field[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found

    def __call__(self, key: Column) -> Column:
        holds = self.holds

        @F.arrow_udf("boolean")
        def held(key: pa.Array) -> pa.Array:
            return pa.array(holds(key.to_numpy(zero_copy_only=False)))

        return held(key)


def possible_members(keys: DataFrame) -> PossibleMembers | None:
    """The filter of ``keys`` (one column of longs, stored), or None if they are too many."""
    number = keys.count()
    if number * BITS_PER_KEY > MOST_BITS:
        return None
    bits = max(_PART, 1 << (number * BITS_PER_KEY - 1).bit_length() if number else 0)
    at = keys.select(F.explode(F.array(*_positions(F.col(keys.columns[0]), bits))).alias("at"))
    part, within = F.shiftright("at", 15).alias("part"), F.col("at").bitwiseAND(F.lit(_PART - 1))
    field = np.zeros(bits // 8, np.uint8)
    for row in at.groupBy(part).agg(F.bitmap_construct_agg(within).alias("set")).toLocalIterator():
        held = np.frombuffer(row["set"], np.uint8)
        start = row["part"] * _PART // 8
        field[start : start + len(held)] = held[: len(field) - start]
    return PossibleMembers(keys.sparkSession.sparkContext.broadcast(field), bits)
