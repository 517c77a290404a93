"""Session settings the library relies on, and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every job of the library expects."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    return spark


def _checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master == "local" or context.master.startswith("local["):  # one process: any folder is shared
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared checkpoint folder, for intermediate tables."""
    _checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows, written to a new folder and read again: unlike a checkpoint's, small files are read together by one task."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
