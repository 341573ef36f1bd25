"""A set of strings as a bit table of fixed size, small enough to broadcast whatever it was made from.

A member is always found; a stranger is found if its bit was set by another, so users must be right with either.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_BITS = 25


def hashes(strings: Iterable[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(s) for s in strings], np.uint64)


def places(hashed: np.ndarray, width: int) -> np.ndarray:
    """Bit numbers in a table of 2^width bits."""
    return (hashed >> np.uint64(64 - width)).astype(np.int64)


@dataclass
class BitTable:
    bits: np.ndarray

    @staticmethod
    def empty() -> BitTable:
        return BitTable(np.zeros(1 << TABLE_BITS - 6, np.uint64))

    @property
    def width(self) -> int:
        return (len(self.bits) * 64).bit_length() - 1

    def members(self) -> int:
        return int(np.bitwise_count(self.bits).sum())

    def holds(self, hashed: np.ndarray) -> np.ndarray:
        place = places(hashed, self.width)
        return (self.bits[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def grown(self, more: DataFrame) -> BitTable:
        """Also the bit numbers in the column ``place``: at most 2^(width - 6) words reach the driver."""
        words = more.groupBy(F.expr("place div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits"))
        found = words.toArrow()
        bits = self.bits.copy()
        bits[found["word"].to_numpy()] |= found["bits"].to_numpy().view(np.uint64)
        return BitTable(bits)
