"""Dictionary correction of names: candidates through shared deletions, then distance and frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.similarity import edit_similarity, osa_distance
from tallyloom.functions.text import is_blank, is_cyrillic, normalize_name_surface, title_case_name

PREFIX = 7


def max_edits(token: Column, cap: int = 2) -> Column:
    """Edit budget of a token: short ones may change by one letter only."""
    return F.least(F.when(F.length(token) <= 4, 1).otherwise(2), F.lit(cap))


def value_counts_union(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """(term, n) of normalised values over two tables; empty values left out."""
    parts = [d.select(normalize_name_surface(F.col(column)).alias("term")) for d in (a, b) if column in d.columns]
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.where("term <> ''").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def merge_frequencies(external: DataFrame, counts: DataFrame, weight: int = 10) -> DataFrame:
    """(term, freq): 1 per external term plus ``weight`` times the in-domain count."""
    listed = external.select("term").distinct().select("term", F.lit(1).cast("long").alias("f"))
    seen = counts.select("term", (F.col("n") * weight).alias("f"))
    return listed.unionByName(seen).groupBy("term").agg(F.sum("f").alias("freq"))


def deletions(text: Column) -> Column:
    """The prefix of a word with up to two letters removed."""
    prefix = F.substring(text, 1, PREFIX)

    def without(word: Column) -> Column:
        n = F.length(word)
        cut = F.transform(
            F.sequence(F.lit(1), n), lambda i: F.concat(F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1, F.lit(PREFIX)))
        )
        return F.when(n > 0, cut).otherwise(F.array().cast("array<string>"))

    once = without(prefix)
    twice = F.flatten(F.transform(once, without))
    return F.array_distinct(F.concat(F.array(prefix), once, twice))


def correct_tokens(tokens: DataFrame, terms: DataFrame, min_ratio: int = 90, cap: int = 2) -> DataFrame:
    """(token, fixed) for tokens with an acceptable replacement.

    Two words within two edits share a deletion of their prefixes, so an equi-join
    on deletions finds all candidates.  The closest term wins, the more frequent
    one on ties; it is accepted when alike enough.
    """
    left = tokens.select("token", F.explode(deletions(F.col("token"))).alias("d"))
    right = terms.select("term", "freq", F.explode(deletions(F.col("term"))).alias("d"))
    near = F.abs(F.length("token") - F.length("term")) <= max_edits(F.col("token"), cap)
    pairs = left.join(right, "d").where(near).select("token", "term", "freq").distinct()
    scored = pairs.withColumn("edits", osa_distance("token", "term")).where(F.col("edits") <= max_edits(F.col("token"), cap))
    best = scored.groupBy("token").agg(F.min_by("term", F.struct("edits", -F.col("freq"), "term")).alias("fixed"))
    return best.where(edit_similarity("token", "fixed") >= min_ratio)


def correct_names(
    values: DataFrame, column: str, terms: DataFrame, known: DataFrame, min_ratio: int = 90, cap: int = 2
) -> DataFrame:
    """(value, corrected) for the distinct values of a column.

    Values and parts found in ``known(term)`` stay; every other Cyrillic part is
    replaced by the best term within its budget.  Blank values become empty.
    """
    distinct = values.select(F.col(column).alias("value")).where(F.col(column).isNotNull()).distinct()
    distinct = distinct.withColumn("norm", F.when(is_blank(F.col("value")), "").otherwise(normalize_name_surface(F.col("value"))))
    known = known.select(F.col("term").alias("k")).distinct()
    whole = distinct.join(known, F.col("norm") == F.col("k"), "left_semi").select("value", title_case_name(F.col("norm")).alias("corrected"))
    rest = distinct.join(known, F.col("norm") == F.col("k"), "left_anti")
    words = rest.select("value", F.posexplode(F.split("norm", " ")).alias("w", "word"))
    parts = words.select("value", "w", F.posexplode(F.split("word", "-")).alias("p", "token"))
    open_tokens = (
        parts.select("token").distinct().where((F.col("token") != "") & is_cyrillic(F.col("token")))
        .join(known, F.col("token") == F.col("k"), "left_anti")
    )
    fixes = correct_tokens(open_tokens, terms, min_ratio, cap)
    fixed = parts.join(fixes, "token", "left").select("value", "w", "p", F.coalesce("fixed", "token").alias("token"))
    by_word = fixed.where("token <> ''").groupBy("value", "w").agg(F.array_sort(F.collect_list(F.struct("p", "token"))).alias("t"))
    by_word = by_word.select("value", "w", F.array_join(F.transform("t", lambda x: x["token"]), "-").alias("word"))
    joined = by_word.groupBy("value").agg(F.array_sort(F.collect_list(F.struct("w", "word"))).alias("t"))
    joined = joined.select("value", F.array_join(F.transform("t", lambda x: x["word"]), " ").alias("text"))
    out = rest.select("value").join(joined, "value", "left").select(
        "value", title_case_name(F.coalesce("text", F.lit(""))).alias("corrected")
    )
    return whole.unionByName(out)


def correct_distinct_values(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Apply a (value, corrected) mapping; values without an entry stay."""
    renamed = mapping.select(F.col("value").alias("__v"), F.col("corrected").alias("__c"))
    out = df.join(renamed, F.col(column) == F.col("__v"), "left")
    return out.withColumn(column, F.coalesce("__c", column)).drop("__v", "__c")
