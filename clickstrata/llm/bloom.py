"""A Bloom filter of bounded size over 64-bit codes, put together by Spark."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

# A filter has up to this many bits (16 MB), and 16 for each code if it can.
MOST_BITS = 1 << 27
_BUCKET = 32768
_SHIFTS = (0, 31)


class Bloom:
    """Two bits for each code: has all that were put in, and some others."""

    def __init__(self, bits: int, set_bytes: np.ndarray):
        self.bits, self.set_bytes = np.uint64(bits), set_bytes

    def has(self, codes: np.ndarray) -> np.ndarray:
        out = np.ones(len(codes), dtype=bool)
        for shift in _SHIFTS:
            at = (codes >> np.uint64(shift)) & (self.bits - np.uint64(1))
            byte = self.set_bytes[(at >> np.uint64(3)).astype(np.int64)]
            out &= (byte >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def bloom(codes: DataFrame) -> Bloom:
    """The filter of a table's column ``code``, put together from parts of 32768 bits."""
    rows, bits = codes.count(), _BUCKET
    while bits < min(16 * rows, MOST_BITS):
        bits *= 2
    places = codes.select(
        F.explode(
            F.array(*[F.expr(f"shiftrightunsigned(code, {s}) & {bits - 1}") for s in _SHIFTS])
        ).alias("at")
    )
    parts = places.groupBy(F.expr("bitmap_bucket_number(at + 1) - 1").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(at + 1))").alias("part")
    )
    filled = np.zeros(bits // 8, dtype=np.uint8)
    # At most MOST_BITS / 32768 rows of 4 KB, whatever the table.
    for row in parts.collect():
        at = row["bucket"] * (_BUCKET // 8)
        filled[at : at + _BUCKET // 8] = np.frombuffer(row["part"], dtype=np.uint8)
    return Bloom(bits, filled)
