"""Phrase collocations by dynamic itemset counting.

The texts are dealt into shards, which are scanned in turn, round and round.  Words are
counted from the first scan on.  A longer phrase becomes active before a scan if
both phrases that it has with a word less have reached the threshold by then, so lengths
are counted side by side; it is counted for one full cycle of shards from there.

What has reached the threshold goes into a Bloom filter of bounded size, one
state per scan.  A phrase is active if both its parts are in the latest state, and has had its
cycle if both are in the state of a cycle ago: a task needs those two states only, and
no list of phrases.  The texts are cut into words once; scans read their hashes.  Scans end when a cycle has brought nothing new.  A false
positive of the filter makes a phrase be counted in vain.  Scans count 64-bit hashes of
phrases, dealt into slices by ranges of hashes, many packed in a row; sums of hashes can only be too large, so the last scan counts the phrases of the
filter as words, exactly, and drops those below the threshold.  (A phrase is lost only
if its hash meets that of a phrase whose cycle ends inside its own.)

``collocations`` scores the phrases, and drops those inside a longer one of nearly their
frequency.  A null language is ``und``, a null text counts as empty.  Repeated rows
count as often as they occur.  Columns beside language, id and text are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.llm import blooms
from tallyloom.session import cut_lineage, shared_folder
from tallyloom.session import stored as written

#: Most words of a phrase, least occurrences, phrases returned, shards of a cycle, share in percent at which a longer phrase takes a shorter one's place.
WORDS, OFTEN, SHOWN, SHARDS, WITHIN = 4, 30, 2000, 3, 80
#: Characters of text cut into words at once, those a task gathers for that over all groups, and words whose numbers it remembers.
AT_ONCE, HELD, KNOWN = 2 << 20, 12 << 20, 600_000
#: Words of all texts for a slice of the counts, and most hashes in a row of them.
SLICE, IN_ROW = 2_000_000, 100_000
#: Counts of hashes, many packed in a row: 64-bit hashes, counts, and 32-bit numbers of the scans they began with.
COUNTED = "slice int, h binary, n binary, since binary"
WALL = b"\xff"
MARKS = b".,;:!?\n\x0b\x0c\r"
LOWERED = bytes(WALL[0] if b in MARKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
STEP = np.uint64(0x9E3779B97F4A7C15)


def words_in(data: bytes) -> list[bytes]:
    """Lower-case words (A-Z only); a wall stands where a piece ends."""
    return data.translate(LOWERED).replace(WALL, b" \xff ").split()


def stretches(texts: list[str]) -> Iterator[tuple[list[bytes], int]]:
    """Words of the texts in stretches, each led by the last words of the one before, and how many those are."""
    data = WALL.join(t.encode() for t in texts)
    carry: list[bytes] = []
    at = 0
    while at < len(data):
        end = data.find(b" ", at + AT_ONCE)
        end = len(data) if end < 0 else end
        words = words_in(data[at:end])
        yield carry + words, len(carry)
        carry = (carry + words)[-(WORDS - 1) :]
        at = end


class Numbered(dict):
    """Words to numbers (0 is the wall) and their hashes (0 for the wall alone)."""

    def __init__(self):
        super().__init__({WALL: 0})
        self.hashes = np.zeros(1 << 12, np.uint64)

    def __missing__(self, word: bytes) -> int:
        n = len(self)
        if n == len(self.hashes):
            self.hashes = np.append(self.hashes, np.zeros(n, np.uint64))
        self.hashes[n] = xxhash.xxh64_intdigest(word, 42) or 1
        self[word] = n
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def salts_of(lang: str) -> np.ndarray:
    """What sets phrases of each length and language apart."""
    return np.array([xxhash.xxh64_intdigest(lang.encode(), length) for length in range(WORDS + 1)], np.uint64)


def levels(own: np.ndarray, salts: np.ndarray, new: np.ndarray, old: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For hashes of words (0: wall) and each length: starts of its active phrases, their hashes, which are in the new state, which have had their cycle."""
    running = own
    places = np.flatnonzero(own)
    done = np.zeros(len(places), bool)
    for length in range(1, WORDS + 1):
        h = blooms.mixed(running[places] + salts[length])
        block, mask = blooms.place(h, len(new))  # both states have as many blocks
        inside = (new[block] & mask) == mask
        yield length, places, h, inside, done
        part, past = np.zeros(len(running), bool), np.zeros(len(running), bool)
        part[places] = inside
        if len(old):
            past[places] = inside if old is new else inside & ((old[block] & mask) == mask)
        running = running[:-1] * STEP + own[length:]
        places = np.flatnonzero(part[:-1] & part[1:])
        done = past[places] & past[places + 1]
        if not len(places):
            return


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str]]]:
    """Texts of a group from many batches, enough for a whole stretch if there are; so a phrase is counted once for all of them."""
    held: dict[tuple, list[str]] = {}
    sizes: dict[tuple, int] = {}
    for batch in batches:
        *keys, texts = (c.to_pylist() for c in batch.columns)
        for key, text in zip(zip(*keys, strict=True), texts, strict=True):
            held.setdefault(key, []).append(text)
            sizes[key] = sizes.get(key, 0) + len(text)
            if sizes[key] >= AT_ONCE:
                del sizes[key]
                yield key, held.pop(key)
        while sum(sizes.values()) > HELD:
            key = max(sizes, key=sizes.__getitem__)
            del sizes[key]
            yield key, held.pop(key)
    yield from held.items()


def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Numbered, list[bytes], int]]:
    """Stretches of words of each group; the last column is the text, the others name its group."""
    known = Numbered()
    for key, own in gathered(batches):
        for words, carried in stretches(own):
            if len(known) > KNOWN:
                known = Numbered()
            yield key, known, words, carried


def coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number from 0 for each value, equal ones alike, and one place of each number."""
    order = np.argsort(values)
    ranked = values[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]][: len(values)]
    code = np.empty(len(values), np.int64)
    code[order] = np.cumsum(new) - 1
    return code, order[new]


def dealt(texts: DataFrame) -> DataFrame:
    """(lang, shard, carried, words): texts (lang, shard, text) as stretches of 64-bit hashes of words, the first ``carried`` of which belong to the stretch before."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, shard), known, words, carried in by_group(batches):
            ids = known.numbers(words)  # before the hashes are looked at: new words may move them
            row = {"lang": [lang], "shard": [shard], "carried": [carried], "words": [known.hashes[ids].tobytes()]}
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), (pa.string(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=list(row))

    return texts.select("lang", "shard", "text").mapInArrow(cut, "lang string, shard int, carried int, words binary")


def by_slice(h: np.ndarray, n: np.ndarray, since: np.ndarray, slices: int) -> pa.RecordBatch:
    """Counts of ascending hashes as a row for each slice, a range of hashes."""
    own = ((h >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int32)
    cuts = np.flatnonzero(np.diff(own)) + 1
    starts = np.r_[0, cuts][: len(h)]
    columns = [[x.tobytes() for x in np.split(values, cuts)][: len(starts)] for values in (h, n, since)]
    return pa.RecordBatch.from_arrays([pa.array(own[starts]), *[pa.array(c, pa.binary()) for c in columns]], names=["slice", "h", "n", "since"])


def scanned(stored: DataFrame, new: np.ndarray, old: np.ndarray, with_words: bool, scan: int, slices: int) -> DataFrame:
    """(slice, h, n, since): the active phrases of stretches (lang, carried, words) that have not had their cycle, a row per stretch and slice."""
    state = stored.sparkSession.sparkContext.broadcast((new, old))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, old = state.value
        for batch in batches:
            for lang, carried, words in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found = []
                for length, places, h, _, done in levels(np.frombuffer(words, np.uint64), salts_of(lang), new, old):
                    if length > 1 or with_words:
                        found.append(h[~done & (places + length > carried)])
                if found:
                    h, n = np.unique(np.concatenate(found), return_counts=True)
                    yield by_slice(h, n.astype(np.int64), np.full(len(h), scan, np.int32), slices)

    return stored.select("lang", "carried", "words").mapInArrow(count, COUNTED)


def summed(rows: DataFrame, often: int, open_after: int) -> DataFrame:
    """Counts (slice, h, n, since) added up by hash, those that began after ``open_after``; ``hits`` has all hashes of ``often`` or more.  A task holds one slice at a time."""

    def result(own: int, h: np.ndarray, n: np.ndarray, since: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(h)
        h = h[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]][: len(h)])
        h, n, since = h[first], np.add.reduceat(n[order], first), np.minimum.reduceat(since[order], first)
        hits, live = h[n >= often], since > open_after
        h, n, since = h[live], n[live], since[live]
        for i in range(0, max(len(h), 1), IN_ROW):
            row = [own, *(x[i : i + IN_ROW].tobytes() for x in (h, n, since)), b"" if i else hits.tobytes()]
            kinds = [pa.int32(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=["slice", "h", "n", "since", "hits"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        joined = lambda: (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*held, strict=True), (np.uint64, np.int64, np.int32), strict=True))
        for batch in batches:
            for own, *counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != at and held:
                    yield from result(at, *joined())
                    held = []
                at = own
                if counts[0]:
                    held.append(counts)
        if held:
            yield from result(at, *joined())

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "slice").sortWithinPartitions("slice").mapInArrow(add, f"{COUNTED}, hits binary")


def spelled(texts: DataFrame, state: np.ndarray) -> DataFrame:
    """(lang, phrase, words, n): exact counts of the phrases in the state, and of all words of a language as the phrase ''."""
    shared = texts.sparkSession.sparkContext.broadcast(state)

    def rows(lang: str, length: int, phrases: list[str], n: np.ndarray) -> pa.RecordBatch:
        same = [pa.array([x], t).take(pa.array(np.zeros(len(phrases), np.int32))) for x, t in ((lang, pa.string()), (length, pa.int32()))]
        return pa.RecordBatch.from_arrays([same[0], pa.array(phrases, pa.string()), same[1], pa.array(n.astype(np.int64))], names=["lang", "phrase", "words", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        for (lang,), known, words, carried in by_group(batches):
            ids = known.numbers(words)
            yield rows(lang, 0, [""], np.array([(ids[carried:] > 0).sum()]))
            part = np.zeros(len(ids), np.int64)  # number of the phrase that begins there
            for length, places, _, inside, _ in levels(known.hashes[ids], salts_of(lang), state, state):
                own = places[inside]
                part[own], first = coded(part[own] * len(known) + ids[own + length - 1])
                times = np.bincount(part[own[own + length > carried]], minlength=len(first))
                first, times = own[first][times > 0], times[times > 0]
                yield rows(lang, length, [b" ".join(words[i : i + length]).decode() for i in first.tolist()], times)

    return texts.mapInArrow(count, "lang string, phrase string, words int, n long").groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))


def marks(summed: DataFrame, blocks: int) -> DataFrame:
    """(shard, block, mask) of the ``hits``, as ``blooms.place`` has them."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, mask = blooms.place(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64), blocks)
            shard = np.zeros(len(block), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(block), pa.array(mask.view(np.int64))], names=["shard", "block", "mask"])

    return summed.select("hits").mapInArrow(place, "shard int, block long, mask long")


def frequent_phrases(df: DataFrame, lang: Column, text: Column, deal: Column, often: int = OFTEN, shards: int = SHARDS) -> DataFrame:
    """(lang, phrase, words, n) of every phrase of up to ``WORDS`` words with ``often`` occurrences; the phrase '' is all words of a language.

    ``deal`` is any hash of a row; it says in which shard the row is scanned.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, "phrases")
    own = df.select(F.coalesce(lang, F.lit("und")).alias("lang"), text.alias("text"), F.pmod(deal, F.lit(shards)).cast("int").alias("shard"))
    own = own.where("text is not null")
    dealt(own).write.option("compression", "zstd").partitionBy("shard").parquet(f"{folder}/words")
    stored = spark.read.schema("lang string, carried int, words binary, shard int").parquet(f"{folder}/words")
    words = (stored.agg(F.sum(F.octet_length("words"))).first()[0] or 0) // 8
    blocks = blooms.blocks_for(words // 100)
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words // SLICE))
    states = [np.zeros(blocks, np.uint64)]
    live = None
    nothing = np.zeros(0, np.uint64)
    for scan in range(1 << 30):
        old = states[scan - shards] if scan >= shards else nothing
        if scan >= shards and np.array_equal(states[scan], old):
            break
        rows = scanned(stored.where(F.col("shard") == scan % shards), states[scan], old, scan < shards, scan, slices)
        rows = rows if live is None else rows.unionByName(live)
        merged = written(summed(rows, often, scan - shards + 1), f"{folder}/scan{scan}")
        states.append(states[scan] | blooms.collected(marks(merged, blocks), {0: blocks})[0])
        live = merged.drop("hits")
    counts = spelled(own.select("lang", "text"), states[-1])
    return cut_lineage(counts.where((F.col("n") >= often) | (F.col("words") == 0)))


def scored(counts: DataFrame, within: int = WITHIN) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words or more that are not inside a longer one of ``within`` percent of their occurrences."""
    exact = lambda c: c.cast("decimal(38,0)")
    listed = counts.where("words > 1").select("lang", "phrase", F.col("n").alias("a"), "words", F.split("phrase", " ", -1).alias("w"))
    joined = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cuts = listed.select("lang", "phrase", "a", "w", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    part = lambda side, n: counts.where("words > 0").select("lang", F.col("phrase").alias(side), F.col("n").alias(n))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    score = F.expr("(cast(2000000 as decimal(38,0)) * cast(a as decimal(28,0))) div (cast(l as decimal(38,0)) + cast(r as decimal(38,0)))")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    starts = lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: F.struct(i.alias("i"), m.alias("m")))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), starts))
    longer = listed.where("words > 2").select("lang", F.col("a").alias("n"), "w", F.explode(spans).alias("s"))
    longer = longer.select("lang", "n", F.array_join(F.slice("w", F.col("s.i"), F.col("s.m")), " ").alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("n").alias("longest"))
    kept = best.join(longer, ["lang", "phrase"], "left")
    kept = kept.where(F.col("longest").isNull() | (exact(F.lit(100)) * F.col("longest").cast("decimal(28,0)") < exact(F.lit(within)) * F.col("a").cast("decimal(28,0)")))
    return kept.select("lang", "phrase", "a", "b.l", "b.r", F.col("b.score").cast("long").alias("score"))


def collocations(df: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", often: int = OFTEN, shown: int = SHOWN, shards: int = SHARDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``shown`` phrases of each language."""
    lang, id_, text = (F.col(f"`{c}`") for c in (lang_col, id_col, text_col))
    counts = frequent_phrases(df, lang, text, F.xxhash64(id_, text), often, shards)
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = scored(counts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= shown)
    total = counts.where("words = 0").select("lang", "n")
    return first.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
