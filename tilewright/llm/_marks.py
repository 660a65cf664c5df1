"""A bitmap of fixed size over 64-bit values: what it marks by mistake costs work and never changes a result."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK_BITS = 24


def marked(marks: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value (uint64) is marked."""
    at = values & np.uint64((1 << MARK_BITS) - 1)
    return (marks[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def bitmap(values: DataFrame, column: str) -> np.ndarray:
    """2**MARK_BITS bits (2 MB) at any size of input, with the bit of each value of a bigint column set."""
    at = F.col(column).bitwiseAND((1 << MARK_BITS) - 1)
    bit = F.expr("shiftleft(cast(1 as bigint), cast(at & 63 as int))")
    found = values.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(1 << (MARK_BITS - 6), np.uint64)
    for word, bits in found.collect():  # 2**18 rows at most
        out[word] = bits & ((1 << 64) - 1)
    return out
