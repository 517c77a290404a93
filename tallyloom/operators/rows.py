"""Row and column preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tallyloom.operators.slices import Ordered


def ensure_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """All expected columns as text without nulls; missing ones are empty."""
    made = {
        c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("") for c in expected
    }
    return df.withColumns(made)


def ensure_unique_id(df: DataFrame, order: str, id_col: str = "unique_id") -> DataFrame:
    """Text ids; missing or blank ones get the row's position in ``order`` (from 0)."""
    numbered = Ordered.overall(df, [order]).row_number("__pos").result()
    position = (F.col("__pos") - 1).cast("string")
    if id_col in df.columns:
        known = F.col(id_col).cast("string")
        made = F.when(F.trim(known) != "", known).otherwise(position)
    else:
        made = position
    return numbered.withColumn(id_col, made).drop("__pos")


def person_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.fill("", [c for c in columns if c in df.columns])


def birthdate_parse(text: Column, sentinel: str = "1900-01-01") -> Column:
    """ISO date after removing all white space; anything else becomes the sentinel."""
    bare = F.regexp_replace(text, r"(?U)\s+", "")
    parsed = F.when(bare.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(bare, "y-M-d"))
    return F.coalesce(parsed, F.lit(sentinel).cast("date"))


def snake_case(names: Sequence[str]) -> list[str]:
    return ["_".join(w.lower() for w in n.split(" ") if w != "-") for n in names]


def map_labels(label: Column) -> Column:
    return F.when(label == 0, -1).when(label == 1, 1)


def mod_split(key: Column, threshold: int = 7) -> Column:
    """True for the test part."""
    return F.pmod(key, F.lit(10)) >= threshold


def every_nth(df: DataFrame, order: str, n: int) -> DataFrame:
    """Systematic 1-in-n sample along ``order``, starting with the first row."""
    numbered = Ordered.overall(df, [order]).row_number("__pos").result()
    return numbered.where((F.col("__pos") - 1) % n == 0).drop("__pos")


def combo_flag(*conditions: Column) -> Column:
    met = F.lit(True)
    for c in conditions:
        met = met & c
    return F.coalesce(met, F.lit(False)).cast("int")


def null_out_of_range(df: DataFrame, columns: Sequence[str], bound: float = 10) -> DataFrame:
    """Cells with absolute value at or above ``bound`` become null; rows with any null drop out."""
    return df.withColumns({c: F.when(F.abs(c) < bound, F.col(c)) for c in columns}).na.drop(subset=list(columns))


def conditional_multiply(a: Column, b: Column) -> Column:
    return F.when(b > 0, a * b).otherwise(a)


def round_dedup(df: DataFrame, columns: Sequence[str], decimals: int = 12) -> DataFrame:
    return df.select(*[(F.round(F.col(c), decimals) + F.lit(0.0)).alias(c) for c in columns]).distinct()


def drop_feature_list(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*names)


def infer_feature_kinds(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, kind, avg_length, n_distinct) for text and array columns.

    Text is free text when longer than 20 characters on average with over 20
    distinct values; otherwise categorical.  Arrays are embeddings.
    """
    chosen = [f for f in df.schema.fields if columns is None or f.name in columns]
    texts = [f.name for f in chosen if isinstance(f.dataType, T.StringType)]
    arrays = [f.name for f in chosen if isinstance(f.dataType, T.ArrayType)]
    spark = df.sparkSession
    schema = "feature string, kind string, avg_length double, n_distinct bigint"
    out = spark.createDataFrame([(a, "embedding", None, None) for a in arrays], schema)
    if not texts:
        return out
    long = df.select(*texts).unpivot([], texts, "feature", "value").where("value IS NOT NULL")
    stats = long.groupBy("feature").agg(
        F.avg(F.length("value")).alias("avg_length"), F.count_distinct("value").alias("n_distinct")
    )
    names = spark.createDataFrame([(t,) for t in texts], "feature string")
    free = (F.col("avg_length") > 20) & (F.col("n_distinct") > 20)
    kinds = F.broadcast(names).join(stats, "feature", "left").select(
        "feature",
        F.when(free, "text").otherwise("categorical").alias("kind"),
        "avg_length",
        F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
    )
    return kinds.unionByName(out)


# --- set-like operations -------------------------------------------------------------


def stack_sources(first: DataFrame, second: DataFrame, label: str = "source") -> DataFrame:
    return first.withColumn(label, F.lit(0)).unionByName(second.withColumn(label, F.lit(1)))


def dedup_on_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key tuple, the first by ``order``; extra copies are cut before the shuffle."""
    first = W.partitionBy(*keys).orderBy(*[F.col(o).asc() for o in order])
    return df.withColumn("__rn", F.row_number().over(first)).where("__rn = 1").drop("__rn")


def unique_union(a: DataFrame, b: DataFrame, column: str, blank: Column | None = None) -> DataFrame:
    """Distinct non-blank values of a column over two tables (either may lack it)."""
    parts = [d.select(column) for d in (a, b) if column in d.columns]
    if not parts:
        raise ValueError(f"neither table has {column}")
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    both = both.distinct()
    return both.where(~blank) if blank is not None else both


def union_distinct_ids(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Sorted distinct union of two id lists, renumbered from 0."""
    both = a.select(column).unionByName(b.select(column)).distinct()
    numbered = Ordered.overall(both, [column]).row_number("__pos").result()
    return numbered.select((F.col("__pos") - 1).alias("id"), F.col(column).alias("orig_index"))


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b.select(key).distinct(), key, "left_anti")
