"""Session settings and small helpers the operators of this folder share."""

from __future__ import annotations

import importlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import configure

#: Rows and bytes handed to a Python worker at once; a few very long texts must not fill its memory.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; every operator that needs one takes the place as a parameter."""
    return importlib.import_module("public_tokenizers").path(name)


def fold(id_col: Column, folds: int) -> Column:
    """Fold of a row: CRC-32 of its id as text; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def unit_hash(*columns: Column) -> Column:
    """A number in [0, 1) that depends on nothing but the given values."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def keep_about(count: Column | int, bound: int, *columns: Column) -> Column:
    """True for about ``bound`` of ``count`` rows, chosen by hash: no shuffle, the same rows each time."""
    wanted = F.lit(float(bound)) / F.greatest(F.lit(1), count if isinstance(count, Column) else F.lit(count))
    return unit_hash(*columns) < wanted
