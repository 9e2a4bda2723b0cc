"""Bit filters of fixed size: they let through every hash they were built from, and few others."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SHIFTS = (0, 19, 38)


def bit_filter(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """A filter of 2**bits bits, three set for each value of a long column; its 2**bits / 8 bytes come to the driver."""
    last = F.lit((1 << bits) - 1).cast("long")
    spots = F.explode(F.array(*(F.shiftrightunsigned(column, s).bitwiseAND(last) for s in _SHIFTS)))
    words = hashes.select(spots.alias("spot")).groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("value")).toArrow()
    table = np.zeros(max(1, (1 << bits) >> 6), np.int64)
    table[words["word"].to_numpy()] = words["value"].to_numpy()
    return table.view(np.uint8)


def passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the unsigned 64-bit hashes that may be in the filter."""
    last = np.uint64(len(table) * 8 - 1)
    at = np.arange(len(hashes))
    for shift in _SHIFTS:
        spot = (hashes[at] >> np.uint64(shift)) & last
        at = at[(table[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return at
