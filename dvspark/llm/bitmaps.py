"""A set of 64-bit hashes as a bitmap of bounded size: no member is missed, a few others pass.

Built by Spark's bitmap aggregates, one bucket of 4 KB a row.  The size grows
with the number of members up to ``2**MOST_BITS`` bits, which bounds what the
driver and a worker hold; beyond that more others pass, so a user must get
right results whatever passes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dvspark.llm.shared_files import mapped, put
from dvspark.session import work_path

#: Bits of a bucket of Spark's bitmap functions.
BUCKET = 1 << 15
#: The largest bitmap: 128 MB.
MOST_BITS = 30


class Bitmap:
    """Members' first bits, in a file of the shared folder that workers map."""

    def __init__(self, path: str, bits: int):
        self.path, self.bits, self._bytes = path, bits, None

    def __getstate__(self):
        return self.path, self.bits

    def __setstate__(self, state):
        self.path, self.bits = state
        self._bytes = None

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if self._bytes is None:
            self._bytes = mapped(self.path, "u1")
        at = hashes >> np.uint64(64 - self.bits)
        return (self._bytes[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0


def bitmap_of(members: DataFrame, column: str) -> Bitmap:
    """``column``: the hashes as long, unsigned by their bits."""
    spark = members.sparkSession
    n = members.select(F.approx_count_distinct(column)).first()[0]
    bits = min(MOST_BITS, max(15, (24 * n).bit_length()))
    place: Column = F.shiftrightunsigned(column, 64 - bits) + 1  # from 1, as the functions count
    rows = members.where(F.col(column).isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    whole = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows.collect():  # at most 2**MOST_BITS bits
        whole[(r.bucket - 1) * BUCKET // 8 : r.bucket * BUCKET // 8] = np.frombuffer(r.bits, np.uint8)
    path = work_path(spark, "bitmap")
    put(path, whole.tobytes())
    return Bitmap(path, bits)
