"""Quantile-scaled matrices in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.profiling import melt
from tallyloom.operators.quantiles import value_ranks
from tallyloom.operators.slices import Ordered


def quantile_scale(cells: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Adds ``q_value`` in [0, 1] to (..., value) cells, by rank inside ``within`` (row, column, or everything).

    Ties share their mean rank; the largest value maps to 1, the smallest to 0,
    and a constant group to 0.
    """
    keys = list(within)
    r = value_ranks(cells, keys, "value")
    low, high = F.col("min_rank") == 1, F.col("max_rank") == F.col("n_total")
    q = (
        F.when(low, 0.0).when(high, 1.0).otherwise((F.col("avg_rank") - 1) / F.greatest(F.col("n_total") - 1, F.lit(1)))
    )
    return cells.join(r.select(*keys, "value", q.alias("q_value")), [*keys, "value"], "left")


def matrix_long(df: DataFrame, key: str, columns: Sequence[str], within: str = "row", cluster: str | None = None) -> DataFrame:
    """(key, feature, value, q_value[, cluster]) of a wide matrix; ``within`` is row, column or global."""
    scopes = {"row": [key], "column": ["feature"], "global": []}
    ids = [key, cluster] if cluster else [key]
    return quantile_scale(melt(df, columns, ids), scopes[within])


def cluster_row_order(df: DataFrame, key: str, columns: Sequence[str], clusters: int = 6, seed: int = 1) -> DataFrame:
    """(key, cluster, row_mean, place): rows ordered by cluster, then by row mean."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="__v").transform(df)
    model = KMeans(k=clusters, seed=seed, featuresCol="__v", predictionCol="cluster", maxIter=10).fit(vectors)
    mean = sum((F.col(c) for c in columns[1:]), F.col(columns[0])) / len(columns)
    placed = model.transform(vectors).select(key, "cluster", mean.alias("row_mean"))
    # The few clusters come one after the other; inside each the rows are ordered in slices.
    inside = Ordered.per_key(placed, ["cluster"], ["row_mean", key]).row_number("__in").result()
    sizes = sorted((r["cluster"], r["count"]) for r in placed.groupBy("cluster").count().collect())
    offset, before = F.lit(0).cast("long"), 0
    for c, n in sizes:
        offset = F.when(F.col("cluster") == c, F.lit(before).cast("long")).otherwise(offset)
        before += n
    return inside.withColumn("place", F.col("__in") + offset).drop("__in")


def selected_rows(cells: DataFrame, place: str, label: str) -> DataFrame:
    """(position, quoted): labels of the rows that have a selected cell, once each, in row order."""
    rows = cells.groupBy(place).agg(F.min(label).alias("__label"))
    numbered = Ordered.overall(rows, [place]).row_number("position").result()
    return numbered.select("position", F.concat(F.lit('"'), F.col("__label").cast("string"), F.lit('"')).alias("quoted"))
