"""Sharding along a Hilbert curve.

Metadata dimensions become ranks (cut at approximate quantiles), the ranks one
index on a Hilbert curve, and the order along the curve is cut into shards of
equal row counts.  Neighbours on the curve are close in every dimension, so each
shard spans a narrow range of each, and ``shards_matching`` prunes by any of them.

Nulls: a null dimension has rank 0, before all values.  Ties on the curve go by
``tie_breaks``; rows equal in these too may swap places, which no result shows.
An empty table gives no rows.  Columns of the input that are named like an
output column are left out of the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import cut_lineage


def hilbert_index(ranks: np.ndarray, bits: int) -> np.ndarray:
    """Index on the curve of points given as rows of ``bits``-bit ranks."""
    axes = [ranks[:, i].astype(np.int64) for i in range(ranks.shape[1])]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(len(axes)):
            up = (axes[i] & bit) != 0
            swap = np.where(up, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(up, axes[0] ^ low, axes[0]) ^ swap
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros(len(ranks), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    index = np.zeros(len(ranks), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            index = (index << 1) | (((axis ^ flip) >> level) & 1)
    return index


def ordered_number(column: Column, kind: T.DataType) -> Column:
    """A double that sorts like the column; of texts, the first six bytes count."""
    if not isinstance(kind, T.StringType):
        return column.cast("double")
    prefix = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0")
    return F.conv(prefix, 16, 10).cast("double")


def on_curve(df: DataFrame, dims: Sequence[str], bits: int = 6, name: str = "curve") -> DataFrame:
    """Adds the index on the curve.  The cut points are at most 2^bits quantiles a dimension."""
    if len(dims) * bits > 62:
        raise ValueError("too many dimensions or bits for one index")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numbers = {d: ordered_number(F.col(f"`{d}`"), kinds[d]) for d in dims}
    probes = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.select(*[numbers[d].alias(f"v{i}") for i, d in enumerate(dims)]).approxQuantile(
        [f"v{i}" for i in range(len(dims))], probes, 0.25 / (1 << bits)
    )
    cuts = [np.unique(np.array(f, float)) for f in found]

    @F.pandas_udf("long")
    def place(*columns: pd.Series) -> pd.Series:
        ranks = []
        for cut, values in zip(cuts, columns, strict=True):
            v = values.to_numpy(float)
            rank = np.minimum(np.searchsorted(cut, v, side="left") + 1, (1 << bits) - 1)
            ranks.append(np.where(np.isnan(v), 0, rank))
        return pd.Series(hilbert_index(np.stack(ranks, 1), bits))

    return df.withColumn(name, place(*[numbers[d] for d in dims]))


def in_order(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """Rows with ``position`` 0, 1, 2 ... along ``order``, and their number.

    The range partitions are checkpointed, so place and partition of a row are
    fixed; a row's position is its place plus the sizes of the partitions before.
    The driver sees one count per partition.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fixed = cut_lineage(df.repartitionByRange(parts, *order).sortWithinPartitions(*order))
    place = F.monotonically_increasing_id()
    placed = fixed.withColumn("__part", F.shiftright(place, 33)).withColumn("__nth", place.bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = sorted(placed.groupBy("__part").count().collect())
    starts, total = [], 0
    for part, count in sizes:
        starts.append((part, total))
        total += count
    table = df.sparkSession.createDataFrame(starts, "__part long, __start long")
    out = placed.join(F.broadcast(table), "__part").withColumn("position", F.col("__start") + F.col("__nth"))
    return out.drop("__part", "__nth", "__start"), total


def hilbert_shards(
    df: DataFrame, dims: Sequence[str], shards: int, tie_breaks: Sequence[str] = (), bits: int = 6
) -> DataFrame:
    """Adds ``curve``, ``shard`` (0 to shards - 1, row counts at most one apart) and ``slot`` (gapless from 0)."""
    clean = df.drop("curve", "shard", "slot", "position")
    placed, total = in_order(on_curve(clean, dims, bits), ["curve", *tie_breaks])
    shard = F.floor(F.col("position") * shards / F.lit(max(1, total)))
    exact = F.expr(f"(position * {shards}L) div {max(1, total)}L") if total else shard
    first = F.expr(f"(shard * {max(1, total)}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("shard", exact.cast("int")).withColumn("slot", (F.col("position") - first).cast("long")).drop("position")


def shard_ranges(sharded: DataFrame, dims: Sequence[str]) -> DataFrame:
    """One row per shard: its row count and the least and greatest value of each dimension."""
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(F.col(f"`{d}`")).alias(f"{n}_{d}") for d in dims for n, f in (("least", F.min), ("most", F.max))],
    )


def shards_matching(ranges: DataFrame, wanted: Mapping[str, tuple]) -> DataFrame:
    """Shards that can hold a row with every dimension in its (low, high) range."""
    hit = F.lit(True)
    for dim, (low, high) in wanted.items():
        hit = hit & (F.col(f"`most_{dim}`") >= F.lit(low)) & (F.col(f"`least_{dim}`") <= F.lit(high))
    return ranges.where(hit).select("shard")


def write_shards(sharded: DataFrame, path: str, shards: int) -> None:
    """One folder per shard, rows along the curve; a reader of some shards opens their folders only."""
    ordered = sharded.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.mode("overwrite").partitionBy("shard").parquet(path)
