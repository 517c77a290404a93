"""Column statistics, histograms and redundancy checks."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.quantiles import exact_quantiles, value_ranks


def nulled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN becomes null, so that there is one kind of missing number."""
    floats = {n for n, t in df.dtypes if t in ("double", "float")}
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns if c in floats})


def melt(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids, feature, value) with doubles."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(ids), list(columns), "feature", "value")


PROFILE_SCHEMA = (
    "feature string, nan_ratio double, zero_ratio double, skew double, max_ratio double, min_ratio double, "
    "max_val double, min_val double"
)


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two passes: moments and extremes first, then how often the extremes occur."""
    df = nulled(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns)
    first = []
    for c in columns:
        first += [F.count(c).alias(f"n_{c}"), F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"),
                  F.skewness(c).alias(f"skew_{c}"), F.count_if(F.col(c) == 0).alias(f"zero_{c}")]
    a = df.agg(F.count(F.lit(1)).alias("rows"), *first).first()
    known = [c for c in columns if a[f"n_{c}"] >= 10]
    b = df.agg(
        F.lit(0).alias("none"),
        *[F.count_if(F.col(c) == a[f"hi_{c}"]).alias(f"hi_{c}") for c in known],
        *[F.count_if(F.col(c) == a[f"lo_{c}"]).alias(f"lo_{c}") for c in known],
    ).first()
    out = []
    for c in columns:
        n = a[f"n_{c}"]
        if c not in known:
            out.append((c, 0.0, 0.0, 0.0, 0.0, 0.0, None, None))
            continue
        out.append(
            (c, 1 - n / a["rows"], a[f"zero_{c}"] / n, a[f"skew_{c}"], b[f"hi_{c}"] / n, b[f"lo_{c}"] / n, a[f"hi_{c}"], a[f"lo_{c}"])
        )
    return df.sparkSession.createDataFrame(out, PROFILE_SCHEMA)


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with at most one distinct value, a null counting as a value."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[(F.min(c) == F.max(c)).alias(f"same_{c}") for c in columns],
    ).first()
    found = [c for c in columns if row[f"n_{c}"] == 0 or (row[f"same_{c}"] and row[f"n_{c}"] == row["rows"])]
    return df.sparkSession.createDataFrame([(c,) for c in found], "feature string")


def duplicate_columns(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(feature, duplicate): equal fingerprints first, then an exact comparison of those pairs."""
    prints = df.agg(*[F.bit_xor(F.xxhash64(F.col(key), F.col(c).cast("string"))).alias(c) for c in columns]).first()
    leaders: dict[int, str] = {}
    pairs = []
    for c in columns:
        if prints[c] in leaders:
            pairs.append((leaders[prints[c]], c))
        else:
            leaders[prints[c]] = c
    if pairs:
        equal = df.agg(*[F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]).first()
        pairs = [p for i, p in enumerate(pairs) if equal[f"p{i}"] == 0]
    return df.sparkSession.createDataFrame(pairs, "feature string, duplicate string")


def _rank_table(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    long = melt(df, columns, [key])
    ranks = value_ranks(long, ["feature"], "value").select("feature", "value", "avg_rank")
    ranked = long.join(ranks, ["feature", "value"])
    return ranked.groupBy(key).agg(*[F.max(F.when(F.col("feature") == c, F.col("avg_rank"))).alias(c) for c in columns])


def spearman_matrix(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(a, b, rho) for a < b in the given order, each pair over its complete rows.

    Columns without nulls are ranked together; a column with nulls is ranked with
    them again over its own rows, and two columns with nulls over their common rows.
    """
    df = nulled(df, columns)
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    full = [c for c in columns if gaps[c] == 0]
    holed = [c for c in columns if gaps[c] > 0]
    rho: dict[frozenset, float | None] = {}

    def add(rows: DataFrame, group: list[str], pairs: list[tuple[str, str]]) -> None:
        if pairs:
            found = _rank_table(rows, key, group).agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]).first()
            rho.update({frozenset(p): found[f"r{i}"] for i, p in enumerate(pairs)})

    add(df, full, list(combinations(full, 2)))
    for h in holed:
        add(df.where(F.col(h).isNotNull()), [h, *full], [(h, c) for c in full])
    for a, b in combinations(holed, 2):
        add(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()), [a, b], [(a, b)])
    out = [(a, b, rho[frozenset((a, b))]) for a, b in combinations(columns, 2)]
    return df.sparkSession.createDataFrame(out, "a string, b string, rho double")


def high_corr_columns(matrix: DataFrame, columns: Sequence[str], threshold: float, mode: str = "members") -> DataFrame:
    """Greedy groups of columns with |rho| >= threshold.

    ``members`` lists (leader, feature) for every column to drop; ``leaders``
    lists the leaders themselves.
    """
    rho = {(r["a"], r["b"]): r["rho"] for r in matrix.collect()}  # columns squared, a small table
    covered: set[str] = set()
    rows = []
    for i, a in enumerate(columns):
        if a in covered:
            continue
        group = [b for b in columns[i + 1:] if (r := rho.get((a, b))) is not None and abs(r) >= threshold]
        if group:
            covered.update([a, *group])
            rows += [(a, b) for b in group] if mode == "members" else [(a, a)]
    return matrix.sparkSession.createDataFrame(rows, "leader string, feature string")


def robust_box(df: DataFrame, columns: Sequence[str], low: float = 0.05, high: float = 0.95, expand: float = 1.5) -> DataFrame:
    """Median, tail quantiles, spread and an expanded box per feature."""
    long = melt(df, columns)
    quantiles = exact_quantiles(long, ["feature"], "value", {"q_low": low, "median": 0.5, "q_high": high})
    spread = long.groupBy("feature").agg(F.stddev_pop("value").alias("std"))
    half = (F.col("q_high") - F.col("q_low")) / 2
    half = F.when(half > 1e-12, half).otherwise(F.col("std"))
    return quantiles.join(spread, "feature").withColumn("half_width", half).withColumns(
        {"box_low": F.col("median") - expand * F.col("half_width"), "box_high": F.col("median") + expand * F.col("half_width")}
    )


def range_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    long = melt(df, columns)
    ends = long.groupBy("feature").agg(F.min("value").alias("min"), F.max("value").alias("max"))
    return ends.join(exact_quantiles(long, ["feature"], "value", {"median": 0.5}), "feature")


def quantile_bounds(df: DataFrame, value: str, low: float, high: float, iqr_k: float | None = None) -> tuple[float, float] | None:
    """Quantile interval, narrowed by the IQR fence if asked; None for fewer than 10 values."""
    clean = nulled(df.select(F.col(value).cast("double").alias(value)), [value]).where(F.col(value).isNotNull())
    if clean.limit(10).count() < 10:
        return None
    q = exact_quantiles(clean, [], value, {"lo": low, "hi": high, "q1": 0.25, "q3": 0.75}).first()
    lo, hi = q["lo"], q["hi"]
    iqr = q["q3"] - q["q1"]
    if iqr_k is not None and iqr > 0:
        lo, hi = max(lo, q["q1"] - iqr_k * iqr), min(hi, q["q3"] + iqr_k * iqr)
    return lo, hi


def quantile_clip(
    df: DataFrame, columns: Sequence[str], low: float = 0.002, high: float = 0.998, iqr_k: float | None = None
) -> DataFrame:
    """Rows whose values all lie inside their column's quantile interval."""
    keep = F.lit(True)
    for c in columns:
        bounds = quantile_bounds(df, c, low, high, iqr_k)
        keep = keep & (F.col(c).between(*bounds) if bounds else F.col(c).isNotNull())
    return df.where(keep)


def bin_edges(
    df: DataFrame, value: str, min_bins: int = 20, max_bins: int = 80, min_width: float | None = 0.08
) -> tuple[float, float, int]:
    """Freedman-Diaconis bins with a floor on the width and a clamp on the number."""
    clean = nulled(df.select(F.col(value).cast("double").alias(value)), [value])
    s = clean.agg(F.min(value), F.max(value), F.count(value)).first()
    lo, hi, n = s[0], s[1], s[2]
    if not n:
        return -1.0, 1.0, min_bins
    if hi <= lo:
        eps = 1e-6 if lo == 0 else abs(lo) * 1e-6
        return lo - eps, hi + eps, min_bins
    q = exact_quantiles(clean, [], value, {"q1": 0.25, "q3": 0.75}).first()
    iqr = q["q3"] - q["q1"]
    width = 2 * iqr / math.cbrt(n) if iqr > 0 else (hi - lo) / math.sqrt(n)
    if min_width is not None:
        width = max(width, min_width)
    return lo, hi, min(max(math.ceil((hi - lo) / width), min_bins), max_bins)


def bin_index(value: Column, lo: float, hi: float, bins: int) -> Column:
    """0-based bin of equal width; the last bin includes the upper edge."""
    return F.least(F.floor((value - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")


def adaptive_histogram(df: DataFrame, value: str, label: str, **options) -> DataFrame:
    lo, hi, bins = bin_edges(df, value, **options)
    counted = df.where(F.col(value).isNotNull()).groupBy(bin_index(F.col(value), lo, hi, bins).alias("bin"), label).agg(
        F.count(F.lit(1)).alias("n")
    )
    step = (hi - lo) / bins
    return counted.select("bin", label, "n", (F.lit(lo) + F.col("bin") * step).alias("left_edge"), (F.lit(lo) + (F.col("bin") + 1) * step).alias("right_edge"))


def density_histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """(bin, left, right, density) for all bins, empty ones included."""
    s = df.agg(F.min(value), F.max(value), F.count(value)).first()
    lo, hi, n = float(s[0]), float(s[1]), s[2]
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins
    counted = df.where(F.col(value).isNotNull()).groupBy(bin_index(F.col(value), lo, hi, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * step).alias("left_edge"), (F.lit(lo) + (F.col("bin") + 1) * step).alias("right_edge"),
        (F.coalesce("n", F.lit(0)) / (n * step)).alias("density"),
    )


def grid_bins(df: DataFrame, x: str, y: str, min_bins: int = 25, max_bins: int = 80) -> tuple[int, int]:
    """Bins per axis from the row count and the number of distinct values."""
    row = df.agg(F.count(F.lit(1)), F.count_distinct(F.round(x, 8)), F.count_distinct(F.round(y, 8))).first()
    base = min(max(int(math.sqrt(max(row[0], 1)) / 3.0), min_bins), max_bins)
    return tuple(min(max(min(base, max(10, u // 3)), min_bins), max_bins) for u in (row[1], row[2]))


def histogram_2d(df: DataFrame, x: str, y: str, label: str, clip: tuple[float, float] = (0.002, 0.998), **bins) -> DataFrame:
    """Counts per class on an adaptive grid, both axes clipped to their quantile interval."""
    inside = quantile_clip(df, [x, y], *clip)
    nx, ny = grid_bins(inside, x, y, **bins)
    e = inside.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    return inside.groupBy(
        bin_index(F.col(x), e[0], e[1], nx).alias("x_bin"), bin_index(F.col(y), e[2], e[3], ny).alias("y_bin"), label
    ).agg(F.count(F.lit(1)).alias("n"))
