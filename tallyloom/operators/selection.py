"""Cluster assignment, score reports, model distances and top weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.functions.numeric import kl_term
from tallyloom.operators.metrics import best_threshold, threshold_curve
from tallyloom.operators.profiling import adaptive_histogram, quantile_clip


def label_distribution(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Percent of each label inside a cluster."""
    counts = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("__n"))
    whole = F.sum("__n").over(W.partitionBy(cluster))
    return counts.select(cluster, label, (F.col("__n") * 100.0 / whole).alias("percent"))


def assign_cluster(assigned: DataFrame, selected: DataFrame, cluster: str) -> DataFrame:
    """Move the selected ids into ``cluster``; the latest assignment wins."""
    kept = assigned.join(selected.select("id").distinct(), "id", "left_anti")
    return kept.unionByName(selected.select("id").distinct().withColumn("cluster", F.lit(cluster)))


def remove_from_cluster(assigned: DataFrame, selected: DataFrame) -> DataFrame:
    return assigned.join(selected.select("id").distinct(), "id", "left_anti")


def score_report(df: DataFrame, label: str, score: str, metric: str = "f1") -> dict[str, DataFrame]:
    """Per-class histogram of clipped scores, metric curve, and best threshold."""
    curve = threshold_curve(df, label, score, metric)
    clipped = quantile_clip(df, [score])
    return {"histogram": adaptive_histogram(clipped, score, label), "curve": curve, "best": best_threshold(curve)}


def kl_distances(importance: DataFrame, model: str, feature: str, weight: str, most_models: int = 1000) -> DataFrame:
    """Symmetric guarded KL distance of every two models' normalised importances.

    One vector per model; the number of models is checked, their pairs are the result.
    """
    totals = importance.groupBy(model).agg(F.sum(weight).alias("total"))
    models = [r[0] for r in totals.select(model).limit(most_models + 1).collect()]
    if len(models) > most_models:
        raise ValueError(f"more than {most_models} models")
    features = sorted(r[0] for r in importance.select(feature).distinct().collect())
    wide = importance.groupBy(model).agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col(feature) == f, F.col(weight))), F.lit(0)) / F.sum(weight) for f in features]).alias("p")
    )
    a = wide.select(F.col(model).alias("model_a"), F.col("p").alias("pa"))
    b = wide.select(F.col(model).alias("model_b"), F.col("p").alias("pb"))
    pairs = a.join(F.broadcast(b), F.col("model_a") < F.col("model_b"))
    terms = F.zip_with("pa", "pb", lambda p, q: kl_term(p, q) + kl_term(q, p))
    return pairs.select("model_a", "model_b", F.aggregate(terms, F.lit(0.0), lambda s, x: s + x).alias("distance"))


def top_abs_weights(weights: DataFrame, k: int = 5, smallest: bool = False) -> DataFrame:
    """Features by absolute weight."""
    size = F.abs("weight")
    order = size.asc() if smallest else size.desc()
    return weights.withColumn("absolute_weight", size).orderBy(order, "feature").limit(k)
