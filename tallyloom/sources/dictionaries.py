"""Word lists for name correction, from text and JSON-lines files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import first_json_string, is_cyrillic, normalize_name_surface, suffix_is

# Keys a term may stand under, and suffixes of patronymics.
TERM_KEYS = ["name", "surname", "midname", "text", "value", "word"]
PATRONYMIC_SUFFIXES = ["вич", "вна", "ична", "оглы", "кызы"]


def read_text_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """One normalised term per non-blank line, without repeats."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(normalize_name_surface(F.col("value")).alias("term")).where("term <> ''").distinct()


def json_terms(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """(file, term) per line that is a JSON object with a usable string; other lines are skipped.

    ``file`` is the path below ``root``; without a root it begins with the last folder of ``path``.
    """
    base = (root or path.rstrip("/").rpartition("/")[0]).rstrip("/").rpartition(":")[2].lstrip("/")
    whole = F.input_file_name()
    below = F.when(F.contains(whole, F.lit(f"{base}/")), F.substring_index(whole, f"{base}/", -1)).otherwise(whole) if base else whole
    lines = spark.read.text(path).select(below.alias("file"), F.trim("value").alias("doc"))
    parsed = lines.where(F.try_parse_json("doc").isNotNull() & F.col("doc").startswith("{"))
    term = normalize_name_surface(first_json_string(F.col("doc"), TERM_KEYS))
    return parsed.select("file", term.alias("term")).where("term <> ''")


def read_jsonl_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return json_terms(spark, path).select("term").distinct()


# What the path of a word list says about its terms, the first match counting.
FILE_KINDS = {"midname": "patronymic", "surname": "surname", r"(^|/|_)names(\.|_|/)|names\.jsonl$": "name"}


def bucket_of(file: Column, term: Column) -> Column:
    """Kind of a term: by its file below the word lists' root, else patronymic by suffix, else a given name."""
    told = [F.when(F.rlike(F.lower(file), F.lit(pattern)), kind) for pattern, kind in FILE_KINDS.items()]
    return F.coalesce(*told, F.when(suffix_is(F.lower(term), PATRONYMIC_SUFFIXES), "patronymic"), F.lit("name"))


def route_terms(terms: DataFrame) -> DataFrame:
    """(bucket, term) without repeats; only terms with Cyrillic letters."""
    return (
        terms.where(is_cyrillic(F.col("term")))
        .select(bucket_of(F.col("file"), F.col("term")).alias("bucket"), "term")
        .distinct()
    )
