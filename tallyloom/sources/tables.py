"""Readers and writers for tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def read_csv_dates(
    spark: SparkSession, path: str, schema: T.StructType, dates: Sequence[str], key: str | None = None
) -> DataFrame:
    """CSV whose date columns parse to timestamps (unreadable ones to null), the key column first."""
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in dates else f.dataType) for f in schema.fields]
    )
    df = spark.read.csv(path, header=True, schema=as_text)
    df = df.withColumns({d: F.try_to_timestamp(F.col(d)).cast("timestamp_ntz") for d in dates})
    return df.select(key, *[c for c in df.columns if c != key]) if key else df


def write_parquet(df: DataFrame, path: str, compression: str = "zstd", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def append_points(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def load_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table at ``path``, or an empty frame with the same schema if there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def write_feature_lists(suggestions: DataFrame, path: str) -> None:
    """``suggestions(kind, feature, other)`` as JSON lines; one short line per feature."""
    suggestions.select("kind", "feature", "other").write.mode("overwrite").json(path)


def read_drop_list(spark: SparkSession, path: str) -> DataFrame:
    """Features to drop: constants, the second of each duplicate pair, correlated ones."""
    lists = spark.read.schema("kind string, feature string, other string").json(path)
    name = F.when(F.col("kind") == "duplicate", F.col("other")).otherwise(F.col("feature"))
    return lists.where(F.col("kind").isin("constant", "duplicate", "correlated")).select(name.alias("feature")).distinct()
