"""A Bloom filter of bounded size, to leave most rows out of a shuffle before an exact join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from crestline.llm.spans import mix64

MOST_BITS = 1 << 26  # 8 MB, whatever the number of keys; fuller filters let more rows through
HASHES = 4


def _bases(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    base = mix64(keys.astype(np.int64).view(np.uint64))
    return base, mix64(base ^ np.uint64(0x5BF03635)) | np.uint64(1)


def _place(base: np.ndarray, step: np.ndarray, i: int, bits: int) -> np.ndarray:
    """The bit of one of the hashes; the number of bits is a power of two."""
    return ((base + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64)


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    base, step = _bases(keys)
    return np.stack([_place(base, step, i, bits) for i in range(HASHES)])


def build(keys: DataFrame) -> np.ndarray:
    """Bits of the one long column of ``keys``; parts are put together on the executors."""
    bits = 1 << 12
    n = keys.count()
    while bits < min(MOST_BITS, 16 * n):
        bits *= 2

    def fill(batches):
        own = np.zeros(bits, bool)
        for b in batches:
            own[_places(b.column(0).to_numpy(zero_copy_only=False), bits)] = True
        packed = np.packbits(own)
        for at in range(0, len(packed), 1 << 16):
            part = packed[at : at + (1 << 16)]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([part.tobytes()], pa.binary())], names=["at", "part"])

    def merge(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(p, np.uint8) for p in table["part"].to_pylist()]
        return pa.table({"at": table["at"][:1], "part": pa.array([np.bitwise_or.reduce(parts).tobytes()], pa.binary())})

    # A task for each core: every task writes a filter of its own, whatever its share of the keys.
    own_tasks = keys.sparkSession.sparkContext.defaultParallelism
    spread = keys.coalesce(own_tasks).mapInArrow(fill, "at long, part binary")
    out = np.zeros(max(bits // 8, 1), np.uint8)
    for r in spread.groupBy("at").applyInArrow(merge, "at long, part binary").collect():
        part = np.frombuffer(r.part, np.uint8)
        out[r.at : r.at + len(part)] = part
    return out


def maybe(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the filter; those left out surely are not."""
    base, step = _bases(keys)
    out = np.ones(len(keys), bool)
    left = np.arange(len(keys))
    for i in range(HASHES):  # of those that have had all bits so far
        at = _place(base, step, i, len(filter_) * 8)
        hit = ((filter_[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)
        out[left[~hit]] = False
        left, base, step = left[hit], base[hit], step[hit]
    return out
