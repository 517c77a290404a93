"""Exact best inner products in three phases with a uniform threshold.

Rows lie in blocks; the components of a vector in ``SEGMENTS`` segments, each a list
of partial scores that adds to the whole.  Phase 1: each block gathers, for each
query, its best entries by each segment's list and their whole scores; the k-th
best of all gathered is a safe cutoff, no more than the true k-th score.
Phase 2: the cutoff goes back with the query, and a block collects the entries
of which some segment reaches cutoff / segments; any entry whose score reaches
the cutoff does.  Phase 3: their scores are resolved exactly, those below the
cutoff go, and the k best remain.

Queries are a stated set and meet all rows block by block; a task holds one
block of each.  Vectors that are null or hold a null, NaN or infinity take no
part; vectors meet only those of their own length.  Repeated rows count
once.  Ties go to the smaller id.  A table without rows or queries gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tallyloom.session import cut_lineage

SEGMENTS, BLOCK_CELLS, QUERY_ROWS = 4, 1 << 18, 512
FOUND = "query_id long, vec_id long, score long"


def whole_numbers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(scale * x.cast("double")))


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def in_blocks(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """One row per block of vectors of one length: ids, cutoffs and the vectors' components one after another."""
    dealt = rows.withColumn(name, F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)))
    members = dealt.groupBy("dim", name).agg(F.collect_list(F.struct("id", "cutoff", "vector")).alias("m"))
    return members.select(
        "dim", name, F.col("m.id").alias(f"{name}_ids"), F.col("m.cutoff").alias(f"{name}_cuts"), F.flatten(F.col("m.vector")).alias(f"{name}_flat")
    )


def segment_scores(queries: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Partial scores per segment; whole numbers throughout, as floats while these hold them exactly."""
    most = float(max(np.abs(queries).max(initial=0), 1)) * float(max(np.abs(rows).max(initial=0), 1)) * max(1, queries.shape[1])
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    q, r = queries.astype(kind), rows.astype(kind)
    cuts = np.linspace(0, q.shape[1], min(SEGMENTS, max(1, q.shape[1])) + 1).astype(int)
    return [q[:, a:b] @ r[:, a:b].T for a, b in zip(cuts, cuts[1:], strict=False)]


def gathered(lists: list[np.ndarray], row_ids: np.ndarray, own: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phase 1: each segment's best entries with their whole scores, ``take`` of them a query."""
    take = min(take, len(row_ids))
    at = np.concatenate([np.argpartition(-s, take - 1, axis=1)[:, :take] for s in lists], axis=1)
    at.sort(axis=1)
    score = sum(np.take_along_axis(s, at, 1).astype(np.int64) for s in lists)
    valid = np.ones(at.shape, bool)
    valid[:, 1:] = at[:, 1:] != at[:, :-1]
    valid &= row_ids[at] != own[:, None]
    query, column = np.nonzero(valid)
    return best(query, row_ids[at[query, column]], score[query, column], take)


def resolved(lists: list[np.ndarray], row_ids: np.ndarray, own: np.ndarray, cutoff: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phases 2 and 3: entries with a segment at its share of the cutoff, their exact scores, the k best at or above the cutoff."""
    share = (cutoff / len(lists))[:, None]
    collected = lists[0] >= share
    for s in lists[1:]:
        collected |= s >= share
    collected &= row_ids[None, :] != own[:, None]
    query, column = np.nonzero(collected)
    score = sum(s[query, column].astype(np.int64) for s in lists)
    enough = score >= cutoff[query]
    return best(query[enough], row_ids[column[enough]], score[enough], k)


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    first = np.searchsorted(query, query)
    keep = np.arange(len(query)) - first < k
    return query[keep], ids[keep], score[keep]


def met(queries: DataFrame, rows: DataFrame, blocks: int, pairs: int, k: int, take: int | None) -> DataFrame:
    """Every query block with every row block; phase 1 if ``take`` is given, else phases 2 and 3."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, q_cuts, q_flat, r_ids, r_flat = (
                    batch.column(n)[i].values.to_numpy(zero_copy_only=False) for n in ("q_ids", "q_cuts", "q_flat", "r_ids", "r_flat")
                )
                dim = batch.column("dim")[i].as_py()
                lists = segment_scores(q_flat.reshape(len(q_ids), dim), r_flat.reshape(len(r_ids), dim))
                if not dim:
                    lists = [np.zeros((len(q_ids), len(r_ids)))]
                if take is not None:
                    at, ids, score = gathered(lists, r_ids, q_ids, take)
                else:
                    at, ids, score = resolved(lists, r_ids, q_ids, q_cuts.astype(float), k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(ids), pa.array(score)], names=["query_id", "vec_id", "score"])

    dealt = queries.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
    both = dealt.join(rows, ["dim", "r"]).select("dim", "q_ids", "q_cuts", "q_flat", "r_ids", "r_flat")
    return both.repartition(pairs).mapInArrow(work, FOUND)


def exact_topk(
    df: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its k best other rows by integer inner product."""
    kind = df.schema[vector_col].dataType
    vector = F.col(f"`{vector_col}`").cast(T.ArrayType(T.DoubleType())) if not isinstance(kind, T.ArrayType) else F.col(f"`{vector_col}`")
    clean = df.where(F.col(f"`{id_col}`").isNotNull() & usable(vector)).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), whole_numbers(vector, scale).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asked")
    )
    clean = cut_lineage(clean.withColumn("dim", F.size("vector")).withColumn("cutoff", F.lit(None).cast("long")).distinct())
    sizes = clean.agg(F.count(F.lit(1)), F.sum(F.col("asked").cast("long")), F.max("dim")).first()
    total, asked, longest = sizes[0], sizes[1] or 0, sizes[2] or 1
    spark = df.sparkSession
    if not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = max(1, -(-total * longest // BLOCK_CELLS))
    query_blocks = max(1, -(-asked // QUERY_ROWS))
    pairs = blocks * query_blocks
    rows = cut_lineage(in_blocks(clean, blocks, "r").drop("r_cuts"))
    questions = clean.where("asked")
    first = met(in_blocks(questions, query_blocks, "q"), rows, blocks, pairs, k, max(2, -(-2 * k // blocks)))
    place = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    cutoffs = first.distinct().withColumn("n", F.row_number().over(place)).where(F.col("n") == k).select(F.col("query_id").alias("id"), F.col("score").alias("cutoff"))
    lowest = F.coalesce("cutoff", F.lit(-(1 << 62)))
    asked_again = questions.drop("cutoff").join(cutoffs, "id", "left").withColumn("cutoff", lowest)
    found = met(in_blocks(asked_again, query_blocks, "q"), rows, blocks, pairs, k, None)
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
