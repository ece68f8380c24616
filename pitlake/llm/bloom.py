"""A Bloom filter of 64-bit hashes, built inside tasks and joined by slices, of a size that is known beforehand."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BITS = 1 << 19  # 64 kB
SMALLEST, LARGEST = 1 << 19, 1 << 28  # 64 kB to 32 MB
SEEDS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def size_for(entries: int) -> int:
    """Bits for so many entries: 16 each or more, a power of two; beyond ``LARGEST`` more hashes pass, none is lost."""
    return min(LARGEST, max(SMALLEST, 1 << (16 * max(1, entries) - 1).bit_length()))


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    h = hashes.astype(np.uint64, copy=False)
    return np.stack([mixed(h + np.uint64(s)) & np.uint64(bits - 1) for s in SEEDS]).astype(np.int64)


def may_hold(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False only for hashes that the filter (an array of bytes) was not built from."""
    at = places(hashes, 8 * len(filled))
    return ((filled[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def build(hashed: DataFrame, bits: int, column: str = "hash") -> np.ndarray:
    """The filter of a column of longs; at most ``bits / 8`` bytes come to the driver."""

    def slices(batches):
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.unique(places(batch[column].to_numpy(np.int64).view(np.uint64), bits).ravel())
            for i in np.unique(at // SLICE_BITS):
                part = at[(at // SLICE_BITS) == i] % SLICE_BITS
                held = own.setdefault(int(i), np.zeros(SLICE_BITS // 8, np.uint8))
                np.bitwise_or.at(held, part >> 3, np.left_shift(1, part & 7).astype(np.uint8))
        if own:
            yield pd.DataFrame({"slice": list(own), "bytes": [x.tobytes() for x in own.values()]})

    def joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(b, np.uint8) for b in rows["bytes"]]
        return pd.DataFrame({"slice": [key[0]], "bytes": [np.bitwise_or.reduce(parts).tobytes()]})

    # A slice has a piece of 64 kB from each task; they are joined in lots first, so that no group holds many.
    rows = hashed.select(column).mapInPandas(slices, "slice long, bytes binary")
    rows = rows.withColumn("lot", F.spark_partition_id() % 64).groupBy("slice", "lot").applyInPandas(joined, "slice long, bytes binary")
    rows = rows.groupBy("slice").applyInPandas(joined, "slice long, bytes binary")
    filled = np.zeros(bits // 8, np.uint8)
    for r in rows.collect():
        filled[r.slice * SLICE_BITS // 8 :][: SLICE_BITS // 8] = np.frombuffer(r.bytes, np.uint8)
    return filled
