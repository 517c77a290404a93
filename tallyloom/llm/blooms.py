"""Blocked Bloom filters that Spark fills and a bounded broadcast carries.

A filter is an array of 64-bit blocks; a member sets ``BITS`` bits of the one block its
hash names.  Tasks turn hashes into (block, mask), Spark joins the masks of a
block by ``bit_or``, and the driver gets one row per block in use, so its size is
bounded by the blocks that were asked for, however many members there are.  More
members than planned for only mean more false positives; none is missed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 5
#: Bytes that filters of one operator may have together.
MOST_BYTES = 32 << 20


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes spread over all 64 bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def blocks_for(members: int, bits_each: int = 16, most_bytes: int = MOST_BYTES) -> int:
    """A power of two of blocks."""
    blocks = 1
    while blocks * 64 < members * bits_each and blocks * 16 <= most_bytes:
        blocks *= 2
    return blocks


def place(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and mask of each (mixed) hash."""
    block = (h >> np.uint64(32)) & np.uint64(blocks - 1)
    mask = np.zeros(h.shape, np.uint64)
    for i in range(BITS):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return block.astype(np.int64), mask


def has(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes may be members."""
    if not len(filter_):
        return np.zeros(h.shape, bool)
    block, mask = place(h, len(filter_))
    return (filter_[block] & mask) == mask


def collected(marks: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """Filters by shard from rows (shard, block, mask); ``sizes`` are the blocks of each."""
    rows = marks.groupBy("shard", "block").agg(F.bit_or("mask").alias("mask")).toPandas()
    filters = {s: np.zeros(n, np.uint64) for s, n in sizes.items()}
    for shard, own in rows.groupby("shard"):
        filters[int(shard)][own["block"].to_numpy(np.int64)] = own["mask"].to_numpy(np.int64).view(np.uint64)
    return filters
