"""Spelling variants: words one edit apart, and the frequent form each belongs to.

All words of the corpus are counted once.  The vocabulary fills blocked Bloom filters,
one for each word length (from ``LONGEST`` on one for all), whose size is bounded.  Tasks
generate the edits of their words by hash alone, whole lengths of words at a time:
each deletion, and each replacement by a greater letter.  An insertion is a deletion of
the other word, and a replacement by a lesser letter is the other word's, so
every pair is proposed once.  Only edits that a filter may hold become strings, and
an equi-join with the vocabulary removes its false positives.

A word's form is its most frequent near word (ties: the least), if that is ``TIMES`` as frequent or
more.  Frequency grows along forms, so they end; roots are found by doubling the steps.

A null text has no words; a null id counts as an empty one.  Repeated rows count as often as
they occur.  Columns beside the id and the text are never looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import blooms
from tallyloom.session import cut_lineage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Of the runs, one in so many loses a letter; least letters and occurrences of a word; how much more frequent a form is.
EVERY, LETTERS, OFTEN, TIMES = 97, 5, 3, 2
#: Words that a task counts before it hands them on; hashes tested at once; lengths from here on share a filter.
HELD, AT_ONCE, LONGEST = 200_000, 200_000, 48
STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 1 << 64)


def words_of(doc_id: int | None, text: str, every: int = EVERY) -> Iterator[tuple[str, int]]:
    """Different words of a text and how often they occur; the run whose hash ``every`` divides loses a letter."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    lowered = text.encode().lower().decode()
    for run, times in Counter(RUN.findall(lowered)).items():
        h = zlib.crc32(run.encode(), seed)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, times


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS) -> DataFrame:
    """(word, n) of all words of so many letters or more."""

    def batch_of(held: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                for word, times in words_of(doc_id.as_py(), text.as_py()):
                    if len(word) >= letters:
                        held[word] += times
                if len(held) > HELD:
                    yield batch_of(held)
                    held.clear()
        if held:
            yield batch_of(held)

    own = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text is not null")
    return own.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch of words by their length, with the code points as a table; never more than ``AT_ONCE`` code points unless one word has them."""
    words = batch.column(0)
    if not len(words):
        return
    codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words.to_pylist()), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(lengths, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        length = int(lengths[rows[0]])
        for k in range(0, len(rows), max(1, AT_ONCE // length)):
            some = rows[k : k + max(1, AT_ONCE // length)]
            yield some, codes[starts[some][:, None] + np.arange(length)]


def powers(length: int) -> np.ndarray:
    return np.append(np.uint64(1), np.cumprod(np.full(length - 1, STEP, np.uint64), dtype=np.uint64))


def shard(length: int) -> int:
    return min(length, LONGEST)


def filters_of(words: DataFrame) -> dict[int, np.ndarray]:
    """A filter for each length of the words."""
    counts = words.groupBy(F.least(F.length("word"), F.lit(LONGEST)).alias("shard")).count().collect()
    total = sum(r["count"] for r in counts)
    sizes = {r["shard"]: blooms.blocks_for(r["count"], most_bytes=max(64, blooms.MOST_BYTES * r["count"] // total)) for r in counts}

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, codes in by_length(batch):
                own = shard(codes.shape[1])
                block, mask = blooms.place(blooms.mixed((codes * powers(codes.shape[1])).sum(1, dtype=np.uint64)), sizes[own])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(block), own, np.int32)), pa.array(block), pa.array(mask.view(np.int64))], names=["shard", "block", "mask"])

    return blooms.collected(words.select("word").mapInArrow(mark, "shard int, block long, mask long"), sizes)


def likely_edits(codes: np.ndarray, alphabet: list[int], filters: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Row and place of deletions (letter -1) and replacements that a filter may hold."""
    length = codes.shape[1]
    power = powers(length)
    terms = codes * power
    sums = np.cumsum(terms, axis=1, dtype=np.uint64)
    shorter, same = filters.get(shard(length - 1)), filters.get(shard(length))
    if shorter is not None and length > 1:
        without = (sums - terms) + (sums[:, -1:] - sums) * np.uint64(BACK)
        first = np.ones(codes.shape, bool)
        first[:, 1:] = codes[:, 1:] != codes[:, :-1]
        yield *np.nonzero(first & blooms.has(shorter, blooms.mixed(without))), -1
    if same is not None:
        others = sums[:, -1:] - terms
        for letter in alphabet:
            fits = codes < np.uint64(letter)
            if fits.any():
                yield *np.nonzero(fits & blooms.has(same, blooms.mixed(others + np.uint64(letter) * power))), letter


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): each two words (word, n) that differ by one edit, once."""
    spark = words.sparkSession
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    alphabet = sorted(ord(r["c"]) for r in letters.collect())
    shared = spark.sparkContext.broadcast(filters_of(words))

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, often = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for rows, codes in by_length(batch):
                edits, owners = [], []
                for row, at, letter in likely_edits(codes, alphabet, shared.value):
                    put = "" if letter < 0 else chr(letter)
                    for k, i in zip(rows[row].tolist(), at.tolist(), strict=True):
                        edits.append(texts[k][:i] + put + texts[k][i + 1 :])
                        owners.append(k)
                if edits:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(edits, pa.string()), pa.array([texts[k] for k in owners], pa.string()), pa.array(often[owners])], names=["edit", "a", "a_n"]
                    )

    proposed = words.select("word", "n").mapInArrow(propose, "edit string, a string, a_n long")
    known = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    return proposed.join(known, proposed["edit"] == known["b"]).select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): the last word that forms lead to.  Steps double, so chains of d forms take log d rounds."""
    known = ahead = forms.select("word", F.col("form").alias("root"))
    done = known.limit(0)
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("__further"))
        found = cut_lineage(ahead.join(further, "root", "left"))
        done = done.unionByName(found.where("__further is null").select("word", "root"))
        ahead = found.where("__further is not null").select("word", F.col("__further").alias("root"))
        if ahead.isEmpty():
            return done
        known = done.unionByName(ahead)


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, often: int = OFTEN, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``letters`` letters and ``often`` occurrences."""
    words = cut_lineage(word_counts(df, id_col, text_col, letters).where(F.col("n") >= often))
    pairs = near_pairs(words)
    one = lambda word, n, near, near_n: F.struct(F.col(word).alias("word"), F.col(n).alias("n"), F.col(near).alias("near"), F.col(near_n).alias("near_n"))
    both = pairs.select(F.explode(F.array(one("a", "a_n", "b", "b_n"), one("b", "b_n", "a", "a_n"))).alias("p")).select("p.*")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.max("n").alias("__n"), best)
    enough = -F.col("best.less") >= times * F.col("__n")
    near = near.select("word", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))
    near = cut_lineage(near)
    out = words.join(near, "word", "left").join(roots(near.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
