"""Fitted column transforms: statistics are fitted in one aggregate, then applied as expressions."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.numeric import inverse_normal
from tallyloom.operators.profiling import column_profile, melt, nulled
from tallyloom.operators.quantiles import exact_quantiles, value_ranks
from tallyloom.operators.slices import Ordered

Fitted = dict[str, tuple[float, float]]  # column -> (centre, scale)


def _one_row(df: DataFrame, columns: Sequence[str], **aggs) -> dict[str, tuple]:
    row = df.agg(*[fn(F.col(c)).alias(f"{n}_{c}") for c in columns for n, fn in aggs.items()]).first()
    return {c: tuple(row[f"{n}_{c}"] for n in aggs) for c in columns}


def column_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float]) -> dict[str, dict[str, float]]:
    found = exact_quantiles(melt(nulled(df, columns), columns), ["feature"], "value", dict(probabilities)).collect()
    by_name = {r["feature"]: {n: r[n] for n in probabilities} for r in found}  # one row per column
    return {c: by_name.get(c, {n: None for n in probabilities}) for c in columns}


def fit_scaler(df: DataFrame, columns: Sequence[str], kind: str = "standard") -> Fitted:
    """(centre, scale) per column; a zero scale counts as 1."""
    if kind == "standard":
        fitted = _one_row(df, columns, centre=F.avg, scale=F.stddev_pop)
    elif kind == "minmax":
        ends = _one_row(df, columns, lo=F.min, hi=F.max)
        fitted = {c: (lo, None if lo is None else hi - lo) for c, (lo, hi) in ends.items()}
    elif kind == "maxabs":
        fitted = {c: (0.0, m[0]) for c, m in _one_row(df, columns, m=lambda x: F.max(F.abs(x))).items()}
    elif kind == "robust":
        q = column_quantiles(df, columns, {"q1": 0.25, "mid": 0.5, "q3": 0.75})
        fitted = {c: (v["mid"], None if v["q1"] is None else v["q3"] - v["q1"]) for c, v in q.items()}
    else:
        raise ValueError(f"unknown scaler {kind}")
    return {c: (float(centre or 0.0), float(scale or 1.0)) for c, (centre, scale) in fitted.items()}


def scale(df: DataFrame, fitted: Fitted) -> DataFrame:
    return df.withColumns({c: (F.col(c) - centre) / width for c, (centre, width) in fitted.items()})


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Median per column; 0 where every value is missing."""
    return {c: float(v["mid"] or 0.0) for c, v in column_quantiles(df, columns, {"mid": 0.5}).items()}


def fit_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    return {c: float(v[0] or 0.0) for c, v in _one_row(nulled(df, columns), columns, m=F.avg).items()}


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per text column, the smallest on ties."""
    long = df.select(*columns).unpivot([], list(columns), "feature", "value").where("value IS NOT NULL")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    most = counts.groupBy("feature").agg(F.max("n").alias("n"))
    best = counts.join(most, ["feature", "n"]).groupBy("feature").agg(F.min("value").alias("value"))
    return {r["feature"]: r["value"] for r in best.collect()}  # one row per column


def impute(df: DataFrame, values: Mapping[str, float | str]) -> DataFrame:
    return nulled(df, list(values)).na.fill(dict(values)) if values else df


def impute_mean_mode(train: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fills ``other`` with the means and modes of ``train``."""
    kinds = dict(train.dtypes)
    texts = [c for c in columns if kinds[c] == "string"]
    numbers = [c for c in columns if c not in texts]
    values: dict = fit_means(train, numbers) if numbers else {}
    if texts:
        values |= fit_modes(train, texts)
    return impute(other.withColumns({c: F.col(c).cast("double") for c in numbers}), values)


def drop_sparse_columns(df: DataFrame, columns: Sequence[str], most_missing: int = 1) -> DataFrame:
    """Drops columns with more than ``most_missing`` gaps; fills the rest with the mean of all their cells."""
    df = nulled(df, columns)
    row = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"gap_{c}") for c in columns],
        *[F.sum(c).alias(f"sum_{c}") for c in columns],
        *[F.count(c).alias(f"n_{c}") for c in columns],
    ).first()
    kept = [c for c in columns if row[f"gap_{c}"] <= most_missing]
    cells = sum(row[f"n_{c}"] for c in kept)
    mean = sum((row[f"sum_{c}"] or 0.0) for c in kept) / cells if cells else 0.0
    out = df.drop(*[c for c in columns if c not in kept])
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(mean)) for c in kept})


def categorical_columns(df: DataFrame, columns: Sequence[str], fewer_than: int = 10) -> DataFrame:
    """(feature, n_distinct, is_categorical)."""
    row = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    data = [(c, row[c], int(row[c] < fewer_than)) for c in columns]
    return df.sparkSession.createDataFrame(data, "feature string, n_distinct bigint, is_categorical int")


def categories(df: DataFrame, column: str, most: int = 10_000) -> list:
    """Sorted distinct values; refuses columns that would make too many output columns."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} categories")
    return sorted(found)


def one_hot(df: DataFrame, column: str, values: Sequence, prefix: str | None = None) -> DataFrame:
    """0/1 columns per fitted category; unknown values give all zeros."""
    prefix = column if prefix is None else prefix
    flags = {f"{prefix}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)) for v in values}
    return df.withColumns(flags)


def fit_quantile_bins(df: DataFrame, column: str, bins: int = 6) -> list[float]:
    """The bins - 1 inner edges of equal-frequency bins; repeated edges leave empty bins."""
    names = {f"e{i}": i / bins for i in range(1, bins)}
    row = exact_quantiles(df.select(column), [], column, names).first()
    return [row[n] for n in names]


def quantile_bin(column: Column, edges: Sequence[float]) -> Column:
    """1-based bin; a value on an edge belongs to the bin above."""
    out = F.lit(1)
    for i, e in enumerate(edges):
        out = F.when(column >= e, F.lit(i + 2)).otherwise(out)
    return out


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight) with weight = n / (classes * count)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__c"))
    rows = counts.collect()  # one row per class
    n, k = sum(r["__c"] for r in rows), len(rows)
    return counts.select(label, (F.lit(float(n)) / (F.col("__c") * k)).alias("weight"))


# --- automatic standardisation --------------------------------------------------------


def auto_standardize_fit(
    df: DataFrame, columns: Sequence[str] | None = None, skew_threshold: float = 1.5, cap_share: float = 0.05, zero_share: float = 0.5
) -> DataFrame:
    """Profile plus the chosen transform per float column: log, cap, zero or none."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    kind = (
        F.when(F.col("skew") > skew_threshold, "log")
        .when(F.col("max_ratio") > cap_share, "cap")
        .when(F.col("zero_ratio") > zero_share, "zero")
        .otherwise("none")
    )
    return column_profile(df, columns).withColumn("transform", kind)


def auto_standardize(df: DataFrame, fitted: DataFrame, indicators: bool = True, to_drop: Sequence[str] = ()) -> DataFrame:
    """Apply the fitted transforms; missing values stay missing."""
    out = nulled(df, [n for n, t in df.dtypes if t in ("double", "float")])
    added: dict[str, Column] = {}
    for r in fitted.collect():  # one row per column
        c = r["feature"]
        if c not in df.columns:
            continue
        x = F.col(c)
        if r["transform"] == "log":
            added[c] = F.log1p(x)
        elif r["transform"] == "cap":
            if indicators:
                added[f"{c}_is_capped"] = F.coalesce((x == r["max_val"]).cast("double"), F.lit(0.0))
            added[c] = F.when(x > r["max_val"] - 1, F.lit(r["max_val"] - 1)).otherwise(x)
        elif r["transform"] == "zero":
            if indicators:
                added[f"{c}_is_zero"] = F.coalesce((x == 0).cast("double"), F.lit(0.0))
            added[c] = F.log1p(x)
        if indicators:
            added[f"{c}_is_nan"] = x.isNull().cast("double")
    return out.withColumns(added).drop(*to_drop) if added else out.drop(*to_drop)


# --- towards a normal distribution -----------------------------------------------------


def normal_scores(train: DataFrame, columns: Sequence[str], eps: float = 1e-3) -> DataFrame:
    """(feature, value, ecdf, p, score) for every distinct training value of every column."""
    ranks = value_ranks(melt(nulled(train, columns), columns), ["feature"], "value")
    squeezed = ranks.withColumn("p", F.col("ecdf") * (1 - 2 * eps) + eps)
    return squeezed.withColumn("score", inverse_normal(F.col("p")))


def ks_normal_test(df: DataFrame, column: str) -> float:
    """p-value of the Kolmogorov-Smirnov test against the standard normal."""
    from pyspark.ml.stat import KolmogorovSmirnovTest

    known = df.select(F.col(column).cast("double").alias("x")).where("x IS NOT NULL")
    return float(KolmogorovSmirnovTest.test(known, "x", "norm", 0.0, 1.0).first()["pValue"])


def kolmogorov_p_value(distance: float, n: int) -> float:
    """Tail of the Kolmogorov distribution (asymptotic series)."""
    x = distance * math.sqrt(n)
    if x < 0.04:
        return 1.0
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))))


def to_normal_fit(train: DataFrame, columns: Sequence[str], fewer_than: int = 10, alpha: float = 0.01) -> DataFrame:
    """(feature, is_categorical, p_value, use): which columns may be mapped to normal scores.

    The normal distribution function of a score is ``p``, so the distance of the
    scores from a normal sample follows from ``p`` and the ECDF alone.
    """
    kinds = {r["feature"]: r["is_categorical"] for r in categorical_columns(train, columns, fewer_than).collect()}
    before = F.col("ecdf") - F.col("n_equal") / F.col("n_total")
    gap = F.greatest(F.abs(F.col("p") - F.col("ecdf")), F.abs(F.col("p") - before))
    gaps = normal_scores(train, columns).groupBy("feature").agg(F.max(gap).alias("d"), F.max("n_total").alias("n"))
    found = {r["feature"]: kolmogorov_p_value(r["d"], r["n"]) for r in gaps.collect()}  # one row per column
    rows = [(c, kinds[c], found.get(c), int(not kinds[c] and found.get(c, 0.0) >= alpha)) for c in columns]
    return train.sparkSession.createDataFrame(rows, "feature string, is_categorical int, p_value double, use int")


def to_normal(
    train: DataFrame, df: DataFrame, fitted: DataFrame, key: str, quantile_fallback: bool = False, scaler: str | None = None
) -> DataFrame:
    """Replace accepted columns by normal scores of the training distribution.

    A value not seen in training takes the score of the nearest lower training
    value (the lowest score below the range).  Rejected columns become ECDF
    values with ``quantile_fallback``.
    """
    choices = {r["feature"]: (r["is_categorical"], r["use"]) for r in fitted.collect()}  # one row per column
    used = [c for c, (categorical, use) in choices.items() if not categorical and (use or quantile_fallback)]
    if not used:
        return df
    normal = [c for c in used if choices[c][1]]
    table = normal_scores(train, used).select(
        "feature", "value", F.when(F.col("feature").isin(normal), F.col("score")).otherwise(F.col("ecdf")).alias("s")
    )
    cells = melt(nulled(df, used), used, [key]).where("value IS NOT NULL")
    unseen = cells.select("feature", "value").distinct().join(table, ["feature", "value"], "left_anti")
    line = table.unionByName(unseen.withColumn("s", F.lit(None).cast("double")))
    scored = Ordered.per_key(line, ["feature"], ["value"]).last_known(score="s").result()
    lowest = {r["feature"]: r["s"] for r in table.groupBy("feature").agg(F.min("s").alias("s")).collect()}
    floor = F.create_map(*[F.lit(x) for c in used for x in (c, float(lowest[c]))])[F.col("feature")]
    scored = scored.select("feature", "value", F.coalesce("score", floor).alias("score"))
    wide = cells.join(scored, ["feature", "value"]).groupBy(key).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("score"))).alias(c) for c in used]
    )
    out = df.drop(*used).join(wide, key, "left").select(*df.columns)
    return scale(out, fit_scaler(out, used, scaler)) if scaler else out


# --- degree-2 terms ------------------------------------------------------------------------


def poly2(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Constant, the columns, and all their pairwise products."""
    out = {"one": F.lit(1.0)}
    for i, a in enumerate(columns):
        for b in columns[i:]:
            out[f"{a}_x_{b}"] = F.col(a) * F.col(b)
    return df.withColumns(out)
