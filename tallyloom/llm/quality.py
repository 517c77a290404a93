"""Quality rules and isolation forests over their statistics.

``with_statistics`` counts, for each text, the facts that quality rules look at.
An isolation forest is grown on the ratios of each family of rules, and one on all
ratios: a document that few random splits set apart is odd.  Each forest's limit
of oddness is set on all labelled rows, so that next to none of the good ones
go; a forest that tells nothing about quality is never heard.  One forest over
all ratios alone would call every good text odd that has any rare trait.

A null text counts as empty: all counts are zero, and it fails the base rules
(fewer than 50 words).  Repeated rows get equal results.  Input columns named
like the added ones are replaced.  Without labels of both kinds nothing is odd.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import keep_about
from tallyloom.session import cut_lineage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits"]


def repeated_words(words: list[str]) -> int:
    """Words inside three-word windows that occur twice or more, the first ones included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, back, times = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = times[back] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= twice
    return int(inside.sum())


def statistics(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words),
        len(lines), sum(map(str.isupper, words)), text.count("!") + text.count("?"), sum(map(text.count, "0123456789")),
    )


def statistics_of(text: Column) -> Column:
    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def count(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t or "") for t in texts], columns=COUNTS, dtype=np.int64)

    return count(F.coalesce(text, F.lit("")))


def with_statistics(df: DataFrame, text_col: str = "text", name: str = "rules") -> DataFrame:
    """Adds a struct of the counts."""
    return df.withColumn(name, statistics_of(F.col(f"`{text_col}`")))


def base_failed(rules: str = "rules") -> Column:
    n = F.col(f"{rules}.n_words")
    return (n < 50) | (100 * F.col(f"{rules}.n_repeat_words") > 50 * n)


#: Columns of ``ratios`` that a forest looks at.
FAMILIES = {"symbols": [0], "repeats": [1, 2], "case": [3, 4], "shape": [5, 6], "all": [0, 1, 2, 3, 4, 5, 6]}


def ratios(counts: pd.DataFrame) -> np.ndarray:
    """What the forest sees: shares, so that length alone is not odd."""
    c = {k: counts[k].to_numpy(float) for k in COUNTS}
    words, chars, lines = (np.maximum(1, c[k]) for k in ("n_words", "word_chars", "n_lines"))
    return np.stack(
        [
            c["n_symbols"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["n_upper"] / words,
            c["n_marks"] / words, c["n_digits"] / chars, chars / words,
        ],
        axis=1,
    )


def usual_depth(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, float)
    more = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(more - 1) + 0.5772156649015329) - 2 * (more - 1) / more, np.where(n == 2, 1.0, 0.0))


@dataclass
class IsolationForest:
    """Trees as flat arrays: feature (-1: leaf), cut, first child, depth at a leaf."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    points: int

    @classmethod
    def grow(cls, rows: np.ndarray, trees: int = 128, points: int = 256, seed: int = 7) -> IsolationForest:
        rng = np.random.default_rng(seed)
        points = min(points, len(rows))
        limit = math.ceil(math.log2(max(2, points))) + 1
        grown = []
        for _ in range(trees):
            feature, cut, child, depth = [-1], [0.0], [0], [0.0]
            todo = [(0, rows[rng.choice(len(rows), points, replace=False)], 0)]
            while todo:
                at, own, level = todo.pop()
                low, high = own.min(0), own.max(0)
                spread = np.flatnonzero(high > low)
                if level >= limit or len(own) < 2 or not len(spread):
                    depth[at] = level + float(usual_depth(len(own)))
                    continue
                f = int(rng.choice(spread))
                value = float(rng.uniform(low[f], high[f]))
                left = own[:, f] <= value
                feature[at], cut[at], child[at] = f, value, len(feature)
                for part in (own[left], own[~left]):
                    todo.append((len(feature), part, level + 1))
                    for column, x in ((feature, -1), (cut, 0.0), (child, 0), (depth, 0.0)):
                        column.append(x)
            grown.append((np.array(feature), np.array(cut), np.array(child), np.array(depth)))
        return cls(grown, points)

    def oddness(self, rows: np.ndarray) -> np.ndarray:
        """Near 1: few splits set the row apart; 0.5: as many as usual."""
        total, index = np.zeros(len(rows)), np.arange(len(rows))
        for feature, cut, child, depth in self.trees:
            at = np.zeros(len(rows), np.int64)
            while (inner := feature[at] >= 0).any():
                step = child[at] + (rows[index, np.maximum(feature[at], 0)] > cut[at])
                at = np.where(inner, step, at)
            total += depth[at]
        return 2.0 ** (-total / max(1, len(self.trees)) / max(float(usual_depth(self.points)), 1e-9))


@dataclass
class QualityModel:
    """A forest and a limit of oddness for each family of rules."""

    forests: list[IsolationForest]
    limits: list[float]


def oddness_of(model: QualityModel, rules: str = "rules") -> Column:
    """Array with the oddness by each family."""
    forests = list(zip(model.forests, FAMILIES.values(), strict=False))

    @F.pandas_udf("array<double>")
    def score(counts: pd.DataFrame) -> pd.Series:
        rows = ratios(counts)
        return pd.Series(list(np.stack([f.oddness(rows[:, own]) for f, own in forests], 1)))

    return score(F.col(rules)) if forests else F.array().cast("array<double>")


def choose_limit(bins: list[tuple[int, int, int]], steps: int, good_loss: float) -> float:
    """Oddness from which rows go: most bad rows, five counted for a good one, and at most ``good_loss`` of the good.

    The limit lies half way to the next lower score that occurs.
    """
    good, bad = (sum(n for q, _, n in bins if q == k) for k in (1, 0))
    if not good or not bad:
        return 2.0
    at: dict[int, list[int]] = {}
    for q, b, n in bins:
        at.setdefault(b, [0, 0])[q] += n
    order = sorted(at, reverse=True)
    best, limit, lost, caught = 0, 2.0, 0, 0
    for b, lower in zip(order, [*order[1:], 0], strict=True):
        caught, lost = caught + at[b][0], lost + at[b][1]
        if lost > good_loss * good:
            break
        if caught - 5 * lost > best:
            best, limit = caught - 5 * lost, (b + lower + 1) / 2 / steps
    return limit


def fit_quality(
    counted: DataFrame, labels: DataFrame, id_col: str = "doc_id", fit_rows: int = 4000, odd_share: float = 0.05,
    good_loss: float = 0.002, steps: int = 2000,
) -> QualityModel:
    """Forests and limits from labelled rows that pass the base rules.

    ``fit_rows`` bounds the rows the forests are grown on: so many, bad ones being
    ``odd_share`` of them.  The limits are set on the scores of all labelled rows,
    counted per forest and score step (a bounded number of counts reaches the driver).
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").alias("quality"))
    one = counted.where(~base_failed()).select(F.col(f"`{id_col}`").cast("long").alias("__id"), "rules")
    scored = cut_lineage(one.join(known, "__id"))
    sizes = {int(q): n for q, n in scored.groupBy("quality").count().collect()}
    if len(sizes) < 2:
        return QualityModel([], [])
    wanted = {0: max(8, int(fit_rows * odd_share)), 1: int(fit_rows * (1 - odd_share))}
    chosen = F.lit(False)
    for q, n in wanted.items():
        chosen = chosen | ((F.col("quality") == q) & keep_about(sizes[q], n, F.col("__id"), F.lit("forest")))
    sample = scored.where(chosen).select("rules.*").toPandas().sort_values(COUNTS)
    if len(sample) < 2:
        return QualityModel([], [])
    rows = ratios(sample)
    model = QualityModel([IsolationForest.grow(rows[:, own]) for own in FAMILIES.values()], [])
    step = F.floor(F.col("oddness") * steps).cast("int")
    each = scored.select("quality", F.posexplode(oddness_of(model)).alias("family", "oddness"))
    bins = each.groupBy("family", "quality", step.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    for k in range(len(FAMILIES)):
        model.limits.append(choose_limit([(r["quality"], r["b"], r["n"]) for r in bins if r["family"] == k], steps, good_loss))
    return model


def judge(counted: DataFrame, model: QualityModel, rules: str = "rules", prefix: str = "") -> DataFrame:
    """Adds ``oddness`` (by family), ``base_failed`` and ``kept`` (false if the base rules fail or a forest finds the row odd), named with the prefix."""
    out = counted.withColumn(f"{prefix}oddness", oddness_of(model, rules)).withColumn(f"{prefix}base_failed", base_failed(rules))
    fine = ~F.col(f"{prefix}base_failed")
    for k, limit in enumerate(model.limits):
        fine = fine & (F.get(f"{prefix}oddness", F.lit(k)) < F.lit(limit))
    return out.withColumn(f"{prefix}kept", fine)
