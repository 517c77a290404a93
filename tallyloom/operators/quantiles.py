"""Exact quantiles and ranks without gathering a group in one task.

Rows are first counted per distinct value (map-side combined), then the counts
are summed along the sorted values slice by slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.slices import HOT_ROWS, Ordered, by_key, by_range


def value_counts(df: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """Rows (or the sum of ``weight``) per distinct value."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("__n"))


def cumulative_counts(
    df: DataFrame, keys: list[str], value: str, limit: int = HOT_ROWS, weight: str | None = None
) -> DataFrame:
    """One row per (keys, value): count, rows up to and including it, rows of the key."""
    counts = value_counts(df, keys, value, weight)
    sliced = by_key(counts, keys, value, limit) if keys else by_range(counts, value)
    out = Ordered(sliced, keys, [F.col(value)]).running_sum(__upto="__n").result()
    if keys:
        return out.join(counts.groupBy(*keys).agg(F.sum("__n").alias("__total")), keys)
    total = counts.agg(F.sum("__n")).first()[0]  # one number
    return out.withColumn("__total", F.lit(total).cast("long"))


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], limit: int = HOT_ROWS,
    weight: str | None = None,
) -> DataFrame:
    """Quantiles with linear interpolation, one column per entry of ``probabilities``."""
    ranked = cumulative_counts(df, keys, value, limit, weight)
    first = F.col("__upto") - F.col("__n")  # zero-based position of the value's first copy
    last = F.col("__upto") - 1
    picks: list[Column] = []
    for name, p in probabilities.items():
        place = F.lit(p) * (F.col("__total") - 1)
        lower, upper = F.floor(place), F.ceil(place)
        picks += [
            F.max(F.when((first <= lower) & (lower <= last), F.col(value))).alias(f"__lo_{name}"),
            F.max(F.when((first <= upper) & (upper <= last), F.col(value))).alias(f"__hi_{name}"),
            F.max(place - lower).alias(f"__w_{name}"),
        ]
    found = ranked.groupBy(*keys).agg(*picks)
    return found.select(
        *keys,
        *[
            (
                F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__w_{n}")
            ).alias(n)
            for n in probabilities
        ],
    )


def value_ranks(df: DataFrame, keys: list[str], value: str, limit: int = HOT_ROWS) -> DataFrame:
    """One row per (keys, value) with min, max and average rank (1-based) and ECDF."""
    ranked = cumulative_counts(df, keys, value, limit)
    low, high = F.col("__upto") - F.col("__n") + 1, F.col("__upto")
    return ranked.select(
        *keys,
        value,
        F.col("__n").alias("n_equal"),
        low.alias("min_rank"),
        high.alias("max_rank"),
        ((low + high) / 2).alias("avg_rank"),
        (high / F.col("__total")).alias("ecdf"),
        F.col("__total").alias("n_total"),
    )
