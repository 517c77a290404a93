"""Character and word TF-IDF as long tables, and a truncated SVD over them."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.functions.text import normalize_query
from tallyloom.functions.time import lookback
from tallyloom.operators.slices import Ordered
from tallyloom.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy


def char_grams(text: Column, n: int = 2) -> Column:
    """All character n-grams of a lower-cased text with white space collapsed."""
    clean = F.regexp_replace(F.lower(text), r"\s\s+", " ")
    last = F.length(clean) - (n - 1)
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(clean, i, F.lit(n)))).otherwise(
        F.array().cast("array<string>")
    )


def weigh(
    counts: DataFrame, doc: str, n_docs: int, min_df: int = 1, max_df: float = 1.0, max_features: int | None = None,
    sublinear: bool = False,
) -> DataFrame:
    """TF-IDF from (doc, term, tf): idf = ln((1 + n) / (1 + df)) + 1, rows scaled to length 1.

    Of the terms within the document-frequency limits the ``max_features`` with
    the largest corpus counts stay (ties by term).
    """
    words = vocabulary(counts, n_docs, min_df, max_df, max_features)
    return weights_of(counts, doc, words, sublinear, max_features is not None and max_features <= 100_000)


def vocabulary(counts: DataFrame, n_docs: int, min_df: int = 1, max_df: float = 1.0, max_features: int | None = None) -> DataFrame:
    """(term, idf) of the terms that stay."""
    stats = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    words = stats.where((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs))
    if max_features is not None:
        words = words.orderBy(F.col("total").desc(), "term").limit(max_features)
    idf = F.log(F.lit(1.0 + n_docs) / (1 + F.col("df"))) + 1
    return words.select("term", idf.alias("idf"))


def weights_of(counts: DataFrame, doc: str, words: DataFrame, sublinear: bool, few: bool) -> DataFrame:
    """(doc, term, weight), rows scaled to length 1; ``few``: at most 100,000 short rows of words, which are broadcast."""
    tf = 1 + F.log("tf") if sublinear else F.col("tf")
    raw = counts.join(F.broadcast(words) if few else words, "term").select(doc, "term", (tf * F.col("idf")).alias("w"))
    # A document has at most one row per vocabulary term.
    return raw.withColumn("weight", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(doc)))).drop("w")


def char_tfidf(docs: DataFrame, doc: str, text: str, max_features: int = 100_000, n: int = 2) -> DataFrame:
    counts = docs.select(doc, F.explode(char_grams(F.col(text), n)).alias("term")).groupBy(doc, "term").agg(
        F.count(F.lit(1)).alias("tf")
    )
    return weigh(counts, doc, docs.count(), max_features=max_features)


def user_word_counts(
    searches: DataFrame, end: str, days: int = 30, count_users: bool = True, known: DataFrame | None = None
) -> tuple[DataFrame, int | None]:
    """(user_id, term, tf) over word 1- and 2-grams of a user's joined queries, and the number of users.

    Bigrams across two consecutive queries come from the queries' last and first
    words, so that no user's text is ever put together.  ``known``: a bounded table of the only terms
    to count; other terms end where they are made, before anything is grouped.
    """
    rows = searches.where(lookback(F.col("ts"), end, days)).select(
        "user_id", "ts", "search_id", normalize_query(F.col("search_query")).alias("q")
    )
    users = rows.select("user_id").distinct().count() if count_users else None
    words = rows.withColumn("words", F.filter(F.split("q", " "), lambda x: F.length(x) >= 2)).where(F.size("words") > 0)
    ends = words.select(
        "user_id", "ts", "search_id", F.element_at("words", 1).alias("head"), F.element_at("words", -1).alias("tail")
    )
    seams = Ordered.per_key(ends, ["user_id"], ["ts", "search_id"]).previous(before="tail").result()
    seams = seams.where("before IS NOT NULL").select("user_id", F.concat_ws(" ", "before", "head").alias("term"))
    n = F.size("words")
    pairs = F.zip_with(
        F.slice("words", F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice("words", F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b)
    )
    pairs = F.when(n > 1, pairs).otherwise(F.array().cast("array<string>"))
    inside = words.select("user_id", F.explode(F.concat("words", pairs)).alias("term"))
    terms = inside.unionByName(seams)
    if known is not None:
        terms = terms.join(F.broadcast(known.select("term")), "term", "left_semi")
    counts = terms.groupBy("user_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    return counts, users


def word_tfidf(
    searches: DataFrame, end: str, days: int = 30, min_df: int = 5, max_df: float = 0.8, max_features: int = 5000
) -> DataFrame:
    counts, users = user_word_counts(searches, end, days)
    counts = cut_lineage(counts)  # used for the vocabulary and for the weights
    return weigh(counts, "user_id", users, min_df, max_df, max_features, sublinear=True)


class TextSvd:
    """Truncated SVD of a long (doc, term, weight) table by block power iteration.

    The term side (at most ``max_terms`` x components numbers) lives on the driver
    and travels to the tasks; documents stay distributed and are never shuffled
    between iterations.
    """

    def __init__(self, components: int = 8, iterations: int = 6, extra: int = 8, seed: int = 0, max_terms: int = 100_000):
        self.components, self.iterations, self.extra = components, iterations, extra
        self.seed, self.max_terms = seed, max_terms

    def _documents(self, weights: DataFrame, doc: str) -> DataFrame:
        """One row per document: term numbers and weights (bounded by the vocabulary)."""
        index = self.terms_frame
        return (
            weights.join(F.broadcast(index), "term")
            .groupBy(doc)
            .agg(F.collect_list(F.struct("idx", "weight")).alias("__v"))
            .select(doc, F.col("__v.idx").alias("idx"), F.col("__v.weight").alias("weight"))
        )

    def fit(self, weights: DataFrame, doc: str) -> "TextSvd":
        names = [r[0] for r in weights.select("term").distinct().orderBy("term").limit(self.max_terms + 1).collect()]
        if len(names) > self.max_terms:
            raise ValueError(f"more than {self.max_terms} terms")
        spark = weights.sparkSession
        self.terms = names
        self.terms_frame = spark.createDataFrame(list(zip(names, range(len(names)))), "term string, idx int")
        docs = self._documents(weights, doc).select("idx", "weight").persist()
        width = min(self.components + self.extra, len(names))
        basis, _ = np.linalg.qr(np.random.default_rng(self.seed).normal(size=(len(names), width)))
        for _ in range(self.iterations):
            basis, _ = np.linalg.qr(self._gram_times(docs, basis))
        product = self._gram_times(docs, basis)
        values, rotation = np.linalg.eigh(basis.T @ product)
        order = np.argsort(values)[::-1][: self.components]
        vectors = basis @ rotation[:, order]
        biggest = np.abs(vectors).argmax(axis=0)
        self.vectors = vectors * np.sign(vectors[biggest, np.arange(vectors.shape[1])])
        self.singular_values = np.sqrt(np.maximum(values[order], 0.0))
        docs.unpersist()
        return self

    @staticmethod
    def _gram_times(docs: DataFrame, basis: np.ndarray) -> np.ndarray:
        """A'A times ``basis``: partial sums per task, then one sum per term."""
        shared = docs.sparkSession.sparkContext.broadcast(basis)

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            v = shared.value
            total = np.zeros_like(v)
            for batch in batches:
                for idx, weight in zip(batch["idx"], batch["weight"]):
                    idx, weight = np.asarray(idx), np.asarray(weight)
                    total[idx] += np.outer(weight, weight @ v[idx])
            used = np.flatnonzero(total.any(axis=1))
            if len(used):
                yield pd.DataFrame({"idx": used.astype("int32"), "row": list(total[used])})

        parts = docs.mapInPandas(partial, "idx int, row array<double>")
        width = basis.shape[1]
        sums = parts.groupBy("idx").agg(F.array(*[F.sum(F.col("row")[i]) for i in range(width)]).alias("row"))
        out = np.zeros_like(basis)
        for r in sums.toLocalIterator():  # one row per term
            out[r["idx"]] = r["row"]
        shared.unpersist()
        return out

    def transform(self, weights: DataFrame, doc: str, name: str = "svd") -> DataFrame:
        """(doc, array of components)."""
        shared = weights.sparkSession.sparkContext.broadcast(self.vectors)

        def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = [list(np.asarray(w) @ shared.value[np.asarray(i)]) for i, w in zip(batch["idx"], batch["weight"])]
                yield pd.DataFrame({doc: batch[doc], name: rows})

        docs = self._documents(weights, doc)
        kind = docs.schema[doc].dataType.simpleString()
        return docs.mapInPandas(project, f"{doc} {kind}, {name} array<double>")


class TextModel:
    """Terms, their weights and their vectors, learnt from one period and applied to any other.

    ``table`` holds one row per term (term, idf, vector): at most ``max_features`` rows, so it is broadcast.
    """

    def __init__(self, table: DataFrame, days: int = 30):
        self.table, self.days = table, days
        self.width = len(table.select("vector").first()[0]) if table.head(1) else 0

    @classmethod
    def fit(
        cls, searches: DataFrame, end: str, components: int = 8, days: int = 30, min_df: int = 5, max_df: float = 0.8, max_features: int = 5000
    ) -> "TextModel":
        counts, users = user_word_counts(searches, end, days)
        counts = cut_lineage(counts)
        words = cut_lineage(vocabulary(counts, users, min_df, max_df, max_features))
        weights = cut_lineage(weights_of(counts, "user_id", words, True, True))
        if not weights.head(1):
            return cls(words.select("term", "idf", F.array().cast("array<double>").alias("vector")), days)
        svd = TextSvd(components).fit(weights, "user_id")
        rows = [(t, [float(x) for x in v]) for t, v in zip(svd.terms, svd.vectors)]  # one row per term of the vocabulary
        vectors = searches.sparkSession.createDataFrame(rows, "term string, vector array<double>")
        return cls(words.join(F.broadcast(vectors), "term").select("term", "idf", "vector"), days)

    def write(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @classmethod
    def read(cls, spark, path: str, days: int = 30) -> "TextModel":
        return cls(spark.read.parquet(path), days)

    def components(self, searches: DataFrame, end: str) -> DataFrame:
        """Feature block: one column per component; users without a known term have no row."""
        counts, _ = user_word_counts(searches, end, self.days, count_users=False, known=self.table)
        w = (1 + F.log("tf")) * F.col("idf")
        known = counts.join(F.broadcast(self.table), "term").select("user_id", w.alias("w"), "vector")
        length = F.sqrt(F.sum(F.col("w") * F.col("w")))
        return known.groupBy("user_id").agg(
            *[(F.sum(F.col("w") * F.col("vector")[i]) / length).alias(f"search_tfidf_svd_{i:02d}") for i in range(self.width)]
        )


def search_svd_block(searches: DataFrame, end: str, components: int = 8) -> DataFrame:
    """Feature block: one column per component of the users' query texts."""
    return TextModel.fit(searches, end, components).components(searches, end)
