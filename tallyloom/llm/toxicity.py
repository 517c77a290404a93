"""Toxicity by compression distance.

Two dictionaries are trained, one on windows of ordinary text, one on the
windows of toxic text that ordinary text does not explain.  Each window of a text
is compressed with the ordinary dictionary alone and with the toxic one before it.
The bytes that the toxic dictionary saves are the window's evidence; an
ordinary window saves none.  The savings of a text become its score through a
logistic curve fitted to labelled rows, so the limit on the score is calibrated.

A null or empty text has no window and gets the score of a text without evidence.
Repeated rows get equal scores.  Without labelled rows of both kinds every score is 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import fold, keep_about
from tallyloom.session import cut_lineage

WORDS = re.compile(r"[^\W\d_]+")
#: Words a window; bytes saved from which a window counts as a hit; least log-likelihood ratio of a toxic term.
WINDOW, GAIN, SURE = 16, 4, 25.0
#: Lengths of the word beginnings that count as terms beside whole words.
STEMS = (4, 5, 6)
#: Score from which a text is toxic.
LIMIT = 0.3
SPARK_WORD = r"[^\p{L}\p{M}]+"


def windows(text: str) -> list[bytes]:
    """Stretches of so many lower-case words."""
    words = WORDS.findall(text.lower())
    return [f" {' '.join(words[i : i + WINDOW])} ".encode() for i in range(0, len(words), WINDOW)]


def trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on the samples; too few samples are their own dictionary."""
    joined = b"".join(dict.fromkeys(samples))
    if len(joined) <= size:
        return joined
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=6).as_bytes()
    except zstandard.ZstdError:
        return joined[:size]


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray | None

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        settings = {"strategy": zstandard.STRATEGY_BTLAZY2, "min_match": 4, "search_log": 6, "hash_log": 17, "chain_log": 17, "window_log": 18}
        settings |= {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        both = []
        for content in (self.ordinary, self.toxic + self.ordinary):
            one = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            parameters = zstandard.ZstdCompressionParameters(**settings)
            one.precompute_compress(compression_params=parameters)
            both.append(zstandard.ZstdCompressor(dict_data=one, compression_params=parameters))
        return tuple(both)

    def savings(self, found: list[bytes], tools: tuple) -> np.ndarray:
        """Bytes that the toxic dictionary saves on each window."""
        if not found:
            return np.zeros(0, np.int64)
        plain, marked = (t.multi_compress_to_buffer(found) for t in tools)
        return np.fromiter((len(a) - len(b) for a, b in zip(plain, marked, strict=True)), np.int64, len(found))


def evidence(saved: np.ndarray) -> tuple[float, ...]:
    """Largest saving, second largest, the share of windows that save two bytes, and the logarithm of the number of hits."""
    if not len(saved):
        return 0.0, 0.0, 0.0, 0.0
    top = np.sort(saved)[::-1]
    hits = float(np.log1p(int((saved >= GAIN).sum())))
    return float(max(0, top[0])), float(max(0, top[1])) if len(top) > 1 else 0.0, float((saved >= 2).mean()), hits


EVIDENCE = ["most", "second", "share", "hits"]


def evidence_of(model: ToxicityModel, text: Column) -> Column:
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tools = model.compressors()
        for texts in batches:
            cut = [windows(t) if t else [] for t in texts]
            saved = model.savings([w for x in cut for w in x], tools)
            parts = np.split(saved, np.cumsum([len(x) for x in cut])[:-1])
            yield pd.DataFrame([evidence(p) for p in parts], columns=EVIDENCE, dtype=float)

    measure.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(measure, ", ".join(f"{c} double" for c in EVIDENCE))(text)


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 0.05, stands_for: np.ndarray | float = 1.0) -> np.ndarray:
    """Weights (the constant last) by Newton steps; ``stands_for`` is the number of rows that each was chosen from, so both kinds keep their shares."""
    a = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(a.shape[1])
    keep = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (stands_for * p * (1 - p))[:, None]).T @ a + keep, a.T @ (stands_for * (p - y)) + keep @ w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_of(model: ToxicityModel, found: Column) -> Column:
    if model.weights is None:
        return F.lit(0.0)
    total = F.lit(float(model.weights[-1]))
    for name, w in zip(EVIDENCE, model.weights, strict=False):
        total = total + F.lit(float(w)) * found[name]
    return 1 / (1 + F.exp(-total))


def toxic_terms(seen: DataFrame, plain: Column, marked: Column, n_plain: int, n_marked: int, most: int) -> list[tuple[str, int]]:
    """Terms found surely and far more often in toxic texts, with their counts there."""
    seen = seen.select("word", plain.alias("plain"), marked.alias("marked"))
    odds = F.log((F.col("marked") + 0.5) / n_marked) - F.log((F.col("plain") + 0.5) / n_plain)
    share = n_marked / (n_plain + n_marked)
    surplus = lambda c, part: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / ((F.col("plain") + F.col("marked")) * part))).otherwise(0.0)
    sure = 2 * (surplus("marked", share) + surplus("plain", 1 - share))
    strange = seen.where((sure > SURE) & (odds > 2.0)).orderBy(F.desc(F.col("marked") * odds), "word").limit(most)
    return [tuple(r) for r in strange.select("word", "marked").collect()]


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_texts: int = 3000, dictionary: int = 48_000,
    toxic_dictionary: int = 24_000, terms: int = 4000,
) -> ToxicityModel:
    """Dictionaries and curve from labelled rows.

    ``fit_texts`` bounds the whole toxic texts that are learnt from, four times it the
    ordinary ones, chosen by hash of the id.  Counts of their words and word
    beginnings are aggregated; those found surely and far more often in toxic texts
    (at most ``terms``) make the toxic samples, so a toxic text's ordinary part does
    not enter.  The curve is fitted to the evidence of each half under the terms of
    the other, each row weighted by the labelled rows it was chosen from.  About 5 * fit_texts rows of four numbers and 7 * ``terms`` words
    reach the driver.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("toxic"))
    sizes = {int(r[0]): r[1] for r in known.groupBy("toxic").count().collect()}
    chosen = F.lit(False)
    for kind, n in sizes.items():
        chosen = chosen | ((F.col("toxic") == kind) & keep_about(n, fit_texts * (4 - 3 * kind), F.col("__id"), F.lit("toxicity")))
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("__id"), F.col(f"`{text_col}`").alias("text")).where("text is not null")
    sample = cut_lineage(own.join(known.where(chosen), "__id").withColumn("half", fold(F.concat(F.col("__id").cast("string"), F.lit("half")), 2)))
    whole = F.array_distinct(F.filter(F.split(F.lower("text"), SPARK_WORD), lambda w: w != ""))

    def stems(n: int) -> Column:
        return F.transform(F.filter("whole", lambda w: F.length(w) > n), lambda w: F.concat(F.lit(" "), F.substring(w, 1, n)))

    words = F.array_distinct(F.concat(F.transform("whole", lambda w: F.concat(F.lit(" "), w, F.lit(" "))), *[stems(n) for n in STEMS]))
    # Near copies share their least word hash, so a text and its copies count once.
    kind = F.array_min(F.transform("whole", lambda w: F.xxhash64(w)))
    cut = sample.withColumn("whole", whole).where(F.size("whole") > 0).select("toxic", "half", kind.alias("kind"), words.alias("words"))
    counts = {tuple(r[:2]): r[2] for r in cut.groupBy("toxic", "half").agg(F.countDistinct("kind")).collect()}
    if any(counts.get((t, h), 0) == 0 for t in (0, 1) for h in (0, 1)):
        return ToxicityModel(b"", b"", None)
    each = cut.select("toxic", "half", "kind", F.explode("words").alias("word")).distinct()
    number = lambda t, h: F.sum(((F.col("toxic") == t) & (F.col("half") == h)).cast("long")).alias(f"n{t}{h}")
    seen = cut_lineage(each.groupBy("word").agg(*[number(t, h) for t in (0, 1) for h in (0, 1)]))
    usual = seen.where("n00 + n01 > 0 and word like '% '").orderBy(F.desc(F.expr("n00 + n01")), "word").limit(4 * terms)
    plain = [r[0].encode() for r in usual.select("word", F.expr("n00 + n01")).collect() for _ in range(min(r[1], 5))]
    ordinary = trained(plain, dictionary)

    def learnt(halves: tuple[int, ...]) -> ToxicityModel:
        rows, marked = (sum(counts[t, h] for h in halves) for t in (0, 1))
        found = toxic_terms(seen, F.expr(" + ".join(f"n0{h}" for h in halves)), F.expr(" + ".join(f"n1{h}" for h in halves)), rows, marked, terms)
        return ToxicityModel(ordinary, trained([w.encode() for w, n in found for _ in range(min(n, 20))], toxic_dictionary), None)

    model, parts = learnt((0, 1)), []
    for own in (0, 1):  # each half is measured with what the other half taught
        other = learnt((1 - own,))
        if other.toxic and ordinary:
            found = sample.where(F.col("half") == own).select("toxic", evidence_of(other, F.col("text")).alias("e")).select("toxic", "e.*")
            parts.append(found.toPandas().sort_values(["toxic", *EVIDENCE]))
    if parts and model.toxic:
        rows = pd.concat(parts)
        stands_for = rows["toxic"].map({t: max(1.0, n / (fit_texts * (4 - 3 * t))) for t, n in sizes.items()})
        model.weights = logistic(rows[EVIDENCE].to_numpy(float), rows["toxic"].to_numpy(float), stands_for=stands_for.to_numpy(float))
    return model


def with_toxicity(df: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """Adds the score, 0 to 1; a column of this name is replaced."""
    out = df.drop(name) if text_col != name else df
    out = out.withColumn("__evidence", evidence_of(model, F.col(f"`{text_col}`"))) if model.weights is not None else out
    return out.withColumn(name, score_of(model, F.col("__evidence"))).drop("__evidence")
