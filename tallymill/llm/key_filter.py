"""A filter of bounded size that tells which keys a table certainly does not hold.

It goes ahead of a join with a long list of keys: rows whose key cannot be in the list
are dropped where they are read, and the join behind it decides about the others. The
filter is a blocked Bloom filter. Each key sets a few bits of one block; blocks are
filled on the executors, each by one task, and only the finished blocks, at most
``MOST_BLOCKS`` of them, go through the driver. A list too long for the filter makes it
let more rows pass, and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Bits of a block (their log2): 64 KB; and blocks of the largest filter: 64 MB.
_BLOCK_LOG2 = 19
MOST_BLOCKS = 1 << 10
#: Bits for each key, as long as there is room, and bits that a key sets.
_BITS_PER_KEY = 12
_PROBES = 4


def _places(keys: np.ndarray) -> np.ndarray:
    """The bits of its block that each key sets: (probes x keys)."""
    mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    step = (mixed >> np.uint64(40)) | np.uint64(1)
    mask = np.uint64((1 << _BLOCK_LOG2) - 1)
    return np.stack([(mixed + np.uint64(i) * step) & mask for i in range(_PROBES)])


@dataclass(frozen=True)
class KeyFilter:
    """Bits of all blocks, one after the other. The number of blocks is a power of two."""

    bits: np.ndarray
    blocks: int

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key (unsigned 64-bit) may be in the list."""
        base = (keys & np.uint64(self.blocks - 1)) << np.uint64(_BLOCK_LOG2)
        found = np.ones(len(keys), bool)
        for place in _places(keys):
            at = base + place
            found &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def key_filter(keys: DataFrame) -> KeyFilter:
    """The filter of the long integers in column ``key``, which are taken to be hashes."""
    wanted = keys.count() * _BITS_PER_KEY >> _BLOCK_LOG2
    blocks = min(1 << wanted.bit_length(), MOST_BLOCKS)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled: dict[int, np.ndarray] = {}
        for batch in batches:
            found = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            block = found & np.uint64(blocks - 1)
            for which in np.unique(block).tolist():
                bits = filled.setdefault(which, np.zeros(1 << (_BLOCK_LOG2 - 3), np.uint8))
                at = _places(found[block == which]).ravel()
                np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(filled), pa.int32()), pa.array([b.tobytes() for b in filled.values()], pa.binary())], names=["block", "bits"]
        )

    dealt = keys.select("key", F.col("key").bitwiseAND(F.lit(blocks - 1)).alias("block")).repartition("block").select("key")
    bits = np.zeros(blocks << (_BLOCK_LOG2 - 3), np.uint8)
    # 64 MB at most, however long the list.
    for row in dealt.mapInArrow(fill, "block int, bits binary").collect():
        size = len(row["bits"])
        bits[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return KeyFilter(bits, blocks)
