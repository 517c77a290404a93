"""Language of a text: known words first, then shorter and shorter character n-grams.

A word the model knows counts with the logarithm of its smoothed frequency in
each language.  A word it does not know counts with the mean over its longest
known character n-grams: all of length 5 that the model has, else of length 4,
and so on down to single letters.

A null text, or one without a letter, is ``und`` with score 0; so is every text
if nothing was learnt.  Ties between languages go to the first by name.
Repeated rows are learnt once per row and predicted alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import keep_about

#: A word: letters and the marks on them, one letter at least; learning and prediction cut texts alike.
LETTERS = regex.compile(r"\p{M}*\p{L}[\p{L}\p{M}]*")
LONGEST, CACHED = 5, 300_000


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word between two spaces; of single letters, without the spaces."""
    padded = word if n == 1 else f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class LanguageModel:
    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray

    def unknown(self, word: str) -> np.ndarray | None:
        for n in range(LONGEST, 0, -1):
            known = [self.grams[g] for g in grams_of(word, n) if g in self.grams]
            if known:
                return self.gram_scores[known].mean(0)
        return None

    def predict(self, text: str | None, cache: dict[str, np.ndarray | None]) -> tuple[str, float]:
        found = Counter(LETTERS.findall(text.lower())) if text else {}
        if not found or not self.languages:
            return "und", 0.0
        rows, times, total = [], [], np.zeros(len(self.languages))
        for word, n in found.items():
            row = self.words.get(word)
            if row is not None:
                rows.append(row)
                times.append(n)
                continue
            if word not in cache:
                cache[word] = self.unknown(word)
            if cache[word] is not None:
                total += n * cache[word]
        if rows:
            total += np.array(times, float) @ self.word_scores[rows]
        share = np.exp(total - total.max())
        best = int(share.argmax())
        return self.languages[best], float(share[best] / share.sum())


def log_shares(counts: pd.DataFrame, key: str, languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Index of each key and the logarithms of its shares per language, half a count added."""
    keys = sorted(counts[key].unique())
    index = {k: i for i, k in enumerate(keys)}
    table = np.full((len(keys), len(languages)), 0.5)
    place = {x: i for i, x in enumerate(languages)}
    np.add.at(table, (counts[key].map(index).to_numpy(int), counts["lang"].map(place).to_numpy(int)), counts["n"].to_numpy(float))
    return index, np.log(table / table.sum(0)) if keys else table


def fit_languages(
    rows: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", fit_texts: int = 4000,
    vocabulary: int = 60_000, grams: int = 120_000, most_languages: int = 400,
) -> LanguageModel:
    """Model from about ``fit_texts`` whole texts a language, chosen by hash of the id.

    ``vocabulary`` and ``grams`` bound the words and n-grams kept (the most
    frequent ones), hence the model that is sent to the executors.
    """
    known = rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(lang).count().limit(most_languages + 1).collect()}
    if len(sizes) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    languages = sorted(sizes)
    chosen = F.lit(False)
    for name in languages:
        chosen = chosen | ((F.col(lang) == name) & keep_about(sizes[name], fit_texts, F.col(id_col).cast("string"), F.lit("language")))
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}]+"), lambda w: w.rlike(r"\p{L}"))
    counted = (
        known.where(chosen).select(F.col(lang).alias("lang"), F.explode(words).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    )
    counted = counted.persist()
    best = counted.groupBy("word").agg(F.sum("n").alias("all")).where("all > 1").orderBy(F.desc("all"), "word").limit(vocabulary)
    top_words = counted.join(best.select("word"), "word").toPandas()
    padded, size = F.concat(F.lit(" "), "word", F.lit(" ")), F.length("word")


    def cut(n: int) -> Column:
        source, count = (F.col("word"), size) if n == 1 else (padded, size + 3 - n)
        return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.substr(source, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    every = F.concat(*[cut(n) for n in range(1, LONGEST + 1)])
    pieces = counted.select("lang", "n", F.explode(every).alias("gram"))
    pieces = pieces.groupBy("lang", "gram").agg(F.sum("n").alias("n")).persist()
    frequent = pieces.groupBy("gram").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "gram").limit(grams)
    top_grams = pieces.join(frequent.select("gram"), "gram").toPandas()
    pieces.unpersist()
    counted.unpersist()
    word_index, word_scores = log_shares(top_words, "word", languages)
    gram_index, gram_scores = log_shares(top_grams, "gram", languages)
    return LanguageModel(languages, word_index, word_scores, gram_index, gram_scores)


def language_of(model: LanguageModel, df: DataFrame, text: str = "text") -> Column:
    """Struct (lang_pred, score) of a text; the model, whose size is bounded, is broadcast."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache: dict[str, np.ndarray | None] = {}
        for texts in batches:
            if len(cache) > CACHED:
                cache.clear()
            yield pd.DataFrame([sent.value.predict(t, cache) for t in texts], columns=["lang_pred", "score"])

    predict.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(predict, "lang_pred string, score double")(F.col(f"`{text}`"))


def predict_language(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``; columns of these names are replaced."""
    out = df.drop("lang_pred", "score").withColumn("__language", language_of(model, df, text))
    return out.select(*[c for c in out.columns if c != "__language"], "__language.lang_pred", "__language.score")
