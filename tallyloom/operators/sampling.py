"""Seeded sampling, splits and folds.  Equal seeds give equal rows on any cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import mixed, uniform
from tallyloom.operators.slices import Ordered

TAKE_ORDERED = 100_000


def hash_order(df: DataFrame, key: str, seed: int, name: str = "__pos") -> DataFrame:
    """Rows numbered 1.. in seeded hash order, ties by key."""
    mixed_up = df.withColumn("__mix", mixed(F.col(key), seed))
    return Ordered.overall(mixed_up, ["__mix", key]).row_number(name).result().drop("__mix")


def sample_rows(
    df: DataFrame, key: str, size: int | None = None, fraction: float | None = None, seed: int = 0
) -> DataFrame:
    """Exactly ``size`` rows (or the rounded share) without replacement."""
    if (size is None) == (fraction is None):
        raise ValueError("give either size or fraction")
    if fraction is not None:
        if not 0 < fraction <= 1:
            raise ValueError("fraction must be in (0, 1]")
        size = max(1, round(df.count() * fraction))
    elif size <= 0:
        raise ValueError("size must be positive")
    if size <= TAKE_ORDERED:
        return df.orderBy(mixed(F.col(key), seed), F.col(key)).limit(size)
    return hash_order(df, key, seed).where(F.col("__pos") <= size).drop("__pos")


def train_test_split(df: DataFrame, key: str, fraction: float, seed: int = 0, label: str = "is_test") -> DataFrame:
    """Flags round(n * fraction) rows, at least one and at most n - 1, as test."""
    n = df.count()
    tests = min(max(1, int(n * fraction + 0.5)), max(n - 1, 0))
    return hash_order(df, key, seed).withColumn(label, (F.col("__pos") <= tests).cast("int")).drop("__pos")


def stratified_folds(df: DataFrame, key: str, label: str, folds: int = 5, seed: int = 0) -> DataFrame:
    """Shuffled folds with every class spread evenly: position in hash order within the class, modulo ``folds``."""
    mixed_up = df.withColumn("__mix", mixed(F.col(key), seed))
    placed = Ordered.per_key(mixed_up, [label], ["__mix", key]).row_number("__pos").result()
    return placed.withColumn("fold", (F.col("__pos") - 1) % folds).drop("__mix", "__pos")


def shuffle_column(df: DataFrame, key: str, column: str, seed: int = 0) -> DataFrame:
    """Permute one column; the other columns stay with their key."""
    kept = Ordered.overall(df, [key]).row_number("__pos").result().drop(column)
    moved = hash_order(df.select(key, column), key, seed).select("__pos", column)
    return kept.join(moved, "__pos").select(*df.columns)


def bootstrap_rows(df: DataFrame, key: str, fraction: float = 1.0, seed: int = 0, replace: bool = True) -> DataFrame:
    """int(n * fraction) rows; with replacement each draw picks a uniform position."""
    n = df.count()
    draws = int(n * fraction)
    if not replace:
        return hash_order(df, key, seed).where(F.col("__pos") <= draws).drop("__pos").withColumn("draw", F.lit(None).cast("long"))
    picks = df.sparkSession.range(draws).select(
        F.col("id").alias("draw"), (F.floor(uniform(F.col("id"), seed) * n) + 1).alias("__pos")
    )
    numbered = Ordered.overall(df, [key]).row_number("__pos").result()
    return picks.join(numbered, "__pos").drop("__pos")


def sample_features(columns: Sequence[str], fraction: float, seed: int = 0) -> list[str]:
    """int(n * fraction) column names in a seeded order."""
    import random

    return random.Random(seed).sample(list(columns), int(len(columns) * fraction))
