"""The corpus pipeline: quality, toxicity, near copies, secrets, packing.

Each stage takes the documents its predecessor kept.  All but the last return
the columns of ``documents`` (extra columns stay); the last returns packed pieces.
Null texts have no words and go in the first stage.  Empty tables pass through.
Very long texts are worked on whole; ties go to the smallest id; of repeated rows
one stays; extra columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.llm import packing, quality, secrets, simhash, toxicity
from tallyloom.llm.common import prepare, table
from tallyloom.llm.queries import token_pieces
from tallyloom.session import cut_lineage, shared_folder


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the rules and are not odd."""
    prepare(spark)
    columns = docs.columns
    counted = quality.with_statistics(docs, name="__rules")
    path = shared_folder(spark, "rules")
    counted.write.parquet(path)  # counted once; the fit and the verdict read it
    counted = spark.read.schema(counted.schema).parquet(path)
    model = quality.fit_quality(counted.select("doc_id", F.col("__rules").alias("rules")), table(spark, folder, "labels"))
    return quality.judge(counted, model, "__rules", "__").where("__kept").select(*[F.col(f"`{c}`") for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that ``op9_toxicity`` would not call toxic."""
    prepare(spark)
    model = toxicity.fit_toxicity(docs, table(spark, folder, "labels"))
    scored = toxicity.with_toxicity(docs, model, name="__toxicity")
    return scored.where(F.col("__toxicity") < toxicity.LIMIT).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, 0.8 or more) the document with the smallest id; of its exact repeats one row.

    The fingerprints of ``op4_simhash`` and their links come first and are verified; what differs in more bits is found by its rarest shingles.
    """
    prepare(spark)
    groups = simhash.near_copies(docs)
    first = F.coalesce(F.min_by("text_hash", "least"), F.min("text_hash")).alias("__hash")
    kept = groups.groupBy("root").agg(F.min("least").alias("__id"), first).select("__id", "__hash")
    same = docs["doc_id"].eqNullSafe(kept["__id"]) & (F.xxhash64(docs["text"]) == kept["__hash"])
    left = docs.join(kept, same, "left_semi")
    row = ["doc_id", F.xxhash64("text").alias("__hash")]
    if docs.groupBy(*row).count().where("count > 1").isEmpty():  # no repeated rows: texts need not be dealt by row
        return left
    one = F.row_number().over(W.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(0)))
    return left.withColumn("__nth", one).where("__nth = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


def hide_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, each secret replaced by a mark; ``n_chars`` follows the text."""
    prepare(spark)
    found = secrets.with_secrets(docs, name="__secrets")
    text = secrets.masked(F.col("text"), F.col("__secrets"))
    found = found.withColumn("__text", text)
    changed = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.size("__secrets") > 0, F.length("__text").cast(kind)).otherwise(F.col("n_chars"))
    return found.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    prepare(spark)
    packed, _ = packing.pack_documents(token_pieces(docs))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", keep_good),
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("secrets", hide_secrets),
    ("packing", pack),
]
#: Hashes, compression and token vocabularies are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again, so a lost executor costs one stage."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = shared_folder(spark, f"stage{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
