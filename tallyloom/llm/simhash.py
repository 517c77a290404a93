"""SimHash fingerprints and groups of near copies.

Two fingerprints are linked if they differ in few bits.  Each 64-bit fingerprint
is cut into 32 segments of two bits; its embedding is the bit count (0, 1 or 2)
of each.  The Manhattan distance of two embeddings never exceeds the Hamming
distance of the fingerprints, so a range join on the embeddings loses no link.
The join runs on a grid: with the segments in B blocks, embeddings at a distance
of at most 3 agree on B - 3 blocks or more, hence share a cell of the grid of one
of the choices of B - 3 blocks.  Inside a cell the distance of the embeddings
is checked, then that of the fingerprints.

A count is kept in unary, as 00, 01 or 11, so that the Manhattan distance is the
number of bits in which two codes differ.

Cells hand on a spanning forest of their links, never the pairs.  A cell of more
than ``CELL`` fingerprints is cut into chunks, and each two chunks meet in a task
of their own, so no cell is too large and no link is lost.

A null text counts as empty; a text without words has fingerprint 0 and is linked
like any other.  Copies share one fingerprint and are folded before the join.
Null ids keep their rows; a component of null ids only has a null id.

``near_copies`` finds all texts that share ``SIMILAR`` of their five-word shingles.
Every text goes through the fingerprints and their range join first: what is linked there is a
crowd, and in a crowd all texts are compared exactly.  Near copies that differ in more
bits are left to an exact second way.  A text with a near copy shares that part of its shingles with
other texts, so the rest goes after one count of all shingles.  Of the others, two
near copies share one of the rarest shingles of each (prefix filter: of n shingles,
with the rarest first, n - ceil(SIMILAR * n) + 1).  Texts with such a shingle in common
and sizes that allow it are chained, and what the chains connect is a crowd too, compared
between the groups that the first way has found, unless it is one of them.  Only verified links leave a crowd, so the
forest that is kept of them loses nothing.  A hash collision adds work only, except that
of the 64-bit hashes of whole texts and shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.linkage import connected_components
from tallyloom.session import cut_lineage

SEED, SHINGLE, NEAR = 42, 3, 3
SEGMENTS, CELL, CHUNK_ROWS = 32, 4096, 200_000
#: Words a shingle and least share of shingles of near copies.
LONG_SHINGLE, SIMILAR = 5, 0.8
#: Most hashes (8 bytes each) that are sent to every task; more meet the texts in a shuffle.
SMALL = 1_000_000
#: Shingles that a task packs at once, shingles a slice of the count, and shingles of a chunk of a crowd.
PACKED, SLICE, CROWD, NO_TEXT = 500_000, 1_000_000, 1_000_000, 65535
LOW = 0x5555555555555555


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingles' XXH64 hashes."""
    return fingerprint_of_words(normal_words(text), shingle)


def fingerprint_of_words(words: list[bytes], shingle: int = SHINGLE) -> int:
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist(), strict=False)), np.uint64, len(words) - size + 1
    )
    set_bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i : i + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(hashes)).tobytes(), "big")


def fingerprint_of(text: Column) -> Column:
    @F.pandas_udf("long")
    def compute(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return compute(F.coalesce(text, F.lit("")))


def unary_counts(fp: np.ndarray) -> np.ndarray:
    """Bit count of each two-bit segment, in unary."""
    low, high = fp & LOW, (fp >> np.uint64(1)) & LOW
    return (low | high) | ((low & high) << np.uint64(1))


def blocks_for(nodes: int) -> int:
    """Fewest blocks whose cells would hold a few of so many random fingerprints."""
    return next((b for b in range(5, 10) if nodes * (3 / 8) ** (SEGMENTS * (b - NEAR) / b) <= 4), 9)


def cell_masks(blocks: int) -> np.ndarray:
    """For each choice of blocks - 3 blocks, the bits of the code that make its cell."""
    cuts = [round(i * SEGMENTS / blocks) for i in range(blocks + 1)]
    masks = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    return np.array([sum(c) for c in combinations(masks, blocks - NEAR)], np.uint64)


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node on a link with the least node it reaches, roots left out."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[left], root[right]
        if (x == y).all():
            break
        least = np.minimum(x, y)
        np.minimum.at(root, x, least)
        np.minimum.at(root, y, least)
        while (root != (up := root[root])).any():
            root = up
    out = root != np.arange(len(nodes))
    return nodes[out], nodes[root[out]]


def links_in_runs(cell: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked fingerprints among rows of equal cells, which stand together."""
    code = unary_counts(fp)
    at, step, found = np.arange(len(cell) - 1), 1, []
    at = at[cell[at] == cell[at + 1]]
    while len(at):
        near = at[np.bitwise_count(code[at] ^ code[at + step]) <= NEAR]
        near = near[np.bitwise_count(fp[near] ^ fp[near + step]) <= NEAR]
        found.append((fp[near], fp[near + step]))
        step += 1
        at = at[at + step < len(cell)]
        at = at[cell[at] == cell[at + step]]
        if sum(len(x) for x, _ in found) > 4 * CHUNK_ROWS:  # keep a forest only
            found = [spanning_forest(*map(np.concatenate, zip(*found, strict=True)))]
    if not found:
        return fp[:0], fp[:0]
    return spanning_forest(*map(np.concatenate, zip(*found, strict=True)))


def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by cell, a forest of the links in each stretch of whole cells."""

    def result(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        a, b = links_in_runs(cell, fp.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        rows += batch.num_rows
        if rows >= CHUNK_ROWS:
            cell, fp = map(np.concatenate, zip(*held, strict=True))
            whole = int(np.argmax(cell == cell[-1]))
            if whole:
                yield result(cell[:whole], fp[:whole])
            held, rows = [(cell[whole:], fp[whole:])], len(cell) - whole
    if rows:
        yield result(*map(np.concatenate, zip(*held, strict=True)))


def cells_of(nodes: DataFrame, blocks: int) -> DataFrame:
    """(cell, fp) for each choice of blocks; cells of one member are of no use but harmless."""
    masks = cell_masks(blocks)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            code = unary_counts(fp)
            keys = (code[:, None] & masks[None, :]).ravel().view(np.int64)
            which = np.tile(np.arange(len(masks), dtype=np.int32), len(fp))
            yield pa.RecordBatch.from_arrays(
                [pa.array(which), pa.array(keys), pa.array(np.repeat(fp, len(masks)).view(np.int64))], names=["which", "key", "fp"]
            )

    found = nodes.select("fp").mapInArrow(cells, "which int, key long, fp long")
    return found.select(F.xxhash64("which", "key").alias("cell"), "fp")


def cut_large(cells: DataFrame, member: str) -> DataFrame:
    """The members of each cell of more than ``CELL`` in chunks; each two chunks make a cell of their own."""
    large = cut_lineage(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL))
    if large.isEmpty():
        return cells
    chunks = F.ceil(F.col("n") / F.lit(CELL // 2)).cast("int")
    own = F.pmod(F.xxhash64(member), chunks).cast("int")
    meet = F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: F.struct(F.least(c, own).alias("x"), F.greatest(c, own).alias("y")))
    split = cells.join(large, "cell").select(*cells.columns, F.explode(meet).alias("m"))
    split = split.withColumn("cell", F.xxhash64("cell", "m.x", "m.y")).select(*cells.columns)
    return cells.join(large.select("cell"), "cell", "left_anti").unionByName(split)


def near_links(nodes: DataFrame, count: int) -> DataFrame:
    """Edges (a, b) that connect what links of at most three bits connect."""
    cells = cut_large(cells_of(nodes, blocks_for(count)), "fp")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(forests, "a long, b long")


def near_groups(fingerprints: DataFrame, id_col: str = "doc_id", fp_col: str = "fp") -> DataFrame:
    """(fp, component_id): for each distinct fingerprint the smallest id its links reach."""
    nodes = cut_lineage(fingerprints.groupBy(F.col(fp_col).alias("fp")).agg(F.min(id_col).alias("least")))
    links = connected_components(near_links(nodes, nodes.count()), "a", "b")
    rooted = nodes.join(links.select(F.col("id").alias("fp"), "cluster_id"), "fp", "left")
    rooted = rooted.select("fp", "least", F.coalesce("cluster_id", "fp").alias("root"))
    whole = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(whole, "root").select("fp", "component_id")


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, fingerprint, component_id), one row per row of the table."""
    own = df.select(F.col(f"`{id_col}`").alias(id_col), fingerprint_of(F.col(f"`{text_col}`")).alias("fp"))
    own = cut_lineage(own)
    out = own.join(near_groups(own, id_col), "fp", "left")
    return out.select(id_col, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def mixed(h: np.ndarray, view: int) -> np.ndarray:
    """Another hash of the same values for each view."""
    h = h + np.uint64(0x9E3779B97F4A7C15 * (view + 1) % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def normal_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split()


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word, SEED)
        return out


def shingles(words: list[bytes], known: WordHashes) -> np.ndarray:
    """Set of the hashes of a text's shingles; a text of fewer words is one shingle."""
    if not words:
        return np.zeros(1, np.uint64)
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(LONG_SHINGLE, len(words))
    count = len(words) - size + 1
    total = each[:count]
    for i in range(1, size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + each[i : i + count]
    return np.unique(mixed(total, 0))


def text_key(words: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(words), SEED)


def key_of(text: Column) -> Column:
    """Hash of the normal text (``key``), its number of different shingles (``n``) and its fingerprint (``fp``)."""

    @F.pandas_udf("key long, n long, fp long")
    def compute(texts: pd.Series) -> pd.DataFrame:
        known = WordHashes()
        cut = [normal_words(t) for t in texts]
        keys, prints = (np.fromiter(map(f, cut), np.uint64, len(cut)).view(np.int64) for f in (text_key, fingerprint_of_words))
        return pd.DataFrame({"key": keys, "n": [len(shingles(w, known)) for w in cut], "fp": prints})

    return compute(F.coalesce(text, F.lit("")))


def shingles_of(text: Column) -> Column:
    """Set of the hashes of a text's shingles."""

    @F.pandas_udf("array<long>")
    def compute(texts: pd.Series) -> pd.Series:
        known = WordHashes()
        return pd.Series([shingles(normal_words(t), known).view(np.int64) for t in texts])

    return compute(F.coalesce(text, F.lit("")))


def least_shared(n: Column, similarity: float) -> Column:
    """Least shingles of n that a near copy has too."""
    return F.ceil(n * F.lit(similarity) - F.lit(1e-9))


def postings(texts: DataFrame, slices: int, counted: bool) -> DataFrame:
    """The shingles of texts (rows of ``text``, or of ``key`` and ``set``) dealt into slices by hash, many packed in a row: six bytes each and the place of the text.

    If ``counted``, a shingle that several texts of a pack share is counted for them at once (the row's ``own`` has the
    counts by text, in slice -1), and one posting without a text (place 65535) tells its slice that it is shared.  So a slice gets
    a shingle at most once per pack, however many texts have it.
    """

    def flush(held: list[tuple[int, np.ndarray]], pack: int) -> pa.RecordBatch:
        keys, number = np.unique(np.array([k for k, _ in held], np.uint64), return_index=True)
        sets = [held[i][1] for i in number]
        hashes = np.concatenate(sets)
        own = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(h) for h in sets])
        rows = []
        if counted:
            order = np.argsort(hashes, kind="stable")
            hashes, own = hashes[order], own[order]
            new = np.r_[True, hashes[1:] != hashes[:-1]]
            several = ~new
            several[:-1] |= ~new[1:]
            tally = np.bincount(own[several], minlength=len(sets))
            rows.append((-1, b"", b"", keys[tally > 0].tobytes(), tally[tally > 0].astype(np.int64).tobytes(), pack))
            left = ~several | new
            own = np.where(several, np.uint16(NO_TEXT), own)[left]
            hashes = hashes[left]
        part = (hashes % np.uint64(slices)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        short = (hashes // np.uint64(slices))[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        part, own = part[order], own[order]
        ends = np.r_[np.flatnonzero(np.diff(part)) + 1, len(part)]
        for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True):
            used, place = np.unique(own[a:b], return_inverse=True)
            there = used[used != NO_TEXT]
            place = np.where(place < len(there), place, NO_TEXT).astype(np.uint16)
            rows.append((int(part[a]), short[a:b].tobytes(), place.tobytes(), keys[there].tobytes(), b"", pack))
        kinds = [pa.int32(), *[pa.binary()] * 4, pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["slice", "left", "place", "keys", "own", "pack"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size, packs = WordHashes(), [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(batch.num_columns)), strict=True):
                if len(row) == 1:
                    words = normal_words(row[0].as_py() or "")
                    held.append((text_key(words), shingles(words, known)))
                else:
                    held.append((row[0].as_py() % 2**64, row[1].values.to_numpy().view(np.uint64)))
                size += len(held[-1][1])
                if size >= PACKED or len(held) >= 60_000:
                    yield flush(held, packs)
                    held, size, packs = [], 0, packs + 1
        if held:
            yield flush(held, packs)

    parts = max(slices, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    packed = texts.mapInArrow(pack, "slice int, left binary, place binary, keys binary, own binary, pack long")
    deal = F.when(F.col("slice") < 0, -1 - F.col("pack")).otherwise(F.col("slice"))
    return packed.repartition(parts, deal).sortWithinPartitions("slice")


def in_slice(rows: list[tuple[bytes, bytes, bytes]], counted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, key, row and number of texts of each posting whose shingle several texts have."""
    hashes, keys, none, row = [], [], [], []
    for i, (left, place, own) in enumerate(rows):
        wide = np.zeros((len(left) // 6, 8), np.uint8)
        wide[:, :6] = np.frombuffer(left, np.uint8).reshape(-1, 6)
        hashes.append(wide.view("<u8").ravel())
        at = np.frombuffer(place, np.uint16)
        none.append(at == NO_TEXT)
        keys.append(np.append(np.frombuffer(own, np.int64), 0)[np.where(at == NO_TEXT, len(own) // 8, at)])
        row.append(np.full(len(at), i, np.int32))
    h, key, none, row = map(np.concatenate, (hashes, keys, none, row))
    order = np.lexsort((none, key, h))
    h, key, none, row = h[order], key[order], none[order], row[order]
    new = np.r_[True, h[1:] != h[:-1]]
    run = np.cumsum(new) - 1
    once = new | np.r_[True, (key[1:] != key[:-1]) | none[1:]]
    df = np.bincount(run[once], minlength=run[-1] + 1 if len(run) else 0) + np.bincount(run[none], minlength=run[-1] + 1 if len(run) else 0)
    kept = (df[run] > 1) & ~none & (True if counted else once)
    return h[kept], key[kept], row[kept], df[run][kept]


def shared_postings(texts: DataFrame, slices: int, counted: bool) -> DataFrame:
    """Shingles that several texts have: (key, c), their number, if ``counted``, else each as (key, cell, df).

    Rows come by slice, and a task holds one slice at a time.  A slice returns its counts in a row per pack, whatever
    the texts, and a pack adds up what its slices counted.  Copies of a text in several packs keep
    accounts of their own, each of which is the text's number.
    """

    def packed(pack: list[int], keys: list[bytes], own: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pack, pa.int64()), pa.array(keys, pa.binary()), pa.array(own, pa.binary())], names=["pack", "keys", "own"])

    def counts(rows: list[tuple[bytes, bytes, bytes]], packs: list[int]) -> pa.RecordBatch:
        _, key, row, _ = in_slice(rows, True)
        order = np.lexsort((key, row))
        key, row = key[order], row[order]
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (row[1:] != row[:-1])][: len(key)])
        c = np.diff(np.append(first, len(key)))
        key, row = key[first], row[first]
        there, at = np.unique(row, return_index=True)
        cut = lambda x: [part.tobytes() for part in np.split(x, at[1:])][: len(there)]
        return packed([packs[i] for i in there.tolist()], cut(key), cut(c.astype(np.int64)))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(keys: list[bytes], own: list[bytes]) -> pa.RecordBatch:
            key, at = np.unique(np.frombuffer(b"".join(keys), np.int64), return_inverse=True)
            c = np.zeros(len(key), np.int64)
            np.add.at(c, at, np.frombuffer(b"".join(own), np.int64))
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(c)], names=["key", "c"])

        at, held = None, ([], [])
        for batch in batches:
            for pack, keys, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if pack != at and held[0]:
                    yield result(*held)
                    held = ([], [])
                at = pack
                held[0].append(keys)
                held[1].append(own)
        if held[0]:
            yield result(*held)

    def cells(rows: list[tuple[bytes, bytes, bytes]], own: int) -> pa.RecordBatch:
        h, key, _, df = in_slice(rows, False)
        cell = (h * np.uint64(slices) + np.uint64(own)).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(cell), pa.array(df.astype(np.int64))], names=["key", "cell", "df"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, packs = None, [], []
        for batch in batches:
            for own, left, place, keys, tally, pack in zip(*batch.columns, strict=True):
                own = own.as_py()
                if own < 0:
                    yield packed([pack.as_py()], [keys.as_py()], [tally.as_py()])
                    continue
                if own != at and rows:
                    yield counts(rows, packs) if counted else cells(rows, at)
                    rows, packs = [], []
                at = own
                rows.append((left.as_py(), place.as_py(), keys.as_py()))
                packs.append(pack.as_py())
        if rows:
            yield counts(rows, packs) if counted else cells(rows, at)

    found = postings(texts, slices, counted).mapInArrow(count, "pack long, keys binary, own binary" if counted else "key long, cell long, df long")
    if not counted:
        return found
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = found.repartition(parts, "pack").sortWithinPartitions("pack").mapInArrow(total, "key long, c long")
    return found.groupBy("key").agg(F.max("c").alias("c"))


def chains(cells: DataFrame, similarity: float) -> DataFrame:
    """(a, b) that connect any two texts of a cell (cell, n, key) whose sizes allow the similarity: neighbours by size do.

    Rows are dealt by range, so a large cell lies in several tasks; each also returns its
    first and last row, which are linked on the driver.
    """

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = [batch.column(i).to_numpy() for i in range(3)]
            first = [x[:1] for x in own] if first is None else first
            cell, n, key = own if last is None else map(np.concatenate, zip(last, own, strict=True))
            last = [x[-1:] for x in own]
            near = (cell[1:] == cell[:-1]) & (n[:-1] >= similarity * n[1:] - 1e-9)
            a, b = key[:-1][near], key[1:][near]
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(a), pa.array(b)], names=["cell", "n", "a", "b"])
        if last is not None:
            cell, n, key = map(np.concatenate, zip(first, last, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n), pa.array(key), pa.array(key)], names=["cell", "n", "a", "b"])

    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.select("cell", "n", "key").repartitionByRange(parts, "cell", "n", "key").sortWithinPartitions("cell", "n", "key")
    found = cut_lineage(dealt.mapInArrow(chain, "cell long, n long, a long, b long").distinct())
    ends = sorted(tuple(r) for r in found.where("cell is not null").select("cell", "n", "a").collect())
    joined = [(x[2], y[2]) for x, y in zip(ends, ends[1:], strict=False) if x[0] == y[0] and x[1] >= similarity * y[1] - 1e-9]
    return found.where("cell is null").select("a", "b").unionByName(cells.sparkSession.createDataFrame(joined, "a long, b long"))


def alike_in_crowd(key: np.ndarray, part: np.ndarray, values: np.ndarray, ends: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Exact links that connect what all links of these texts connect, beside those known: texts of one ``part`` are connected."""
    n, size = len(key), np.diff(ends)
    kinds, at = np.unique(values, return_inverse=True)
    df = np.bincount(at, minlength=len(kinds))
    starts = np.cumsum(df) - df
    owner = np.repeat(np.arange(n), size)[np.argsort(at, kind="stable")]
    part, a, b = np.unique(part, return_inverse=True)[1], [], []
    for i in range(n - 1):
        if (part == part[0]).all():
            break
        own = at[ends[i] : ends[i + 1]]
        own = own[df[own] > 1]
        shared = np.zeros(n, np.int64)
        step = max(1, 4_000_000 // n)
        for k in range(0, len(own), step):
            some = own[k : k + step]
            length = df[some]
            where = np.repeat(starts[some] - (np.cumsum(length) - length), length) + np.arange(length.sum())
            shared += np.bincount(owner[where], minlength=n)
        alike = shared / (size + size[i] - shared) >= similarity
        alike[: i + 1] = False
        for j in np.flatnonzero(alike & (part != part[i])).tolist():
            if part[j] != part[i]:
                part[part == part[j]] = part[i]
                a.append(key[i])
                b.append(key[j])
    return np.array(a, np.int64), np.array(b, np.int64)


def alike_links(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b) that connect the near copies of different parts among the texts (cell, key, part, set) of each cell."""

    def result(cell: np.ndarray, key: np.ndarray, part: np.ndarray, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cuts = np.r_[0, np.flatnonzero(np.diff(cell)) + 1, len(cell)].tolist()
        for x, y in zip(cuts, cuts[1:], strict=False):
            ends = np.r_[0, np.cumsum([len(s) for s in sets[x:y]])]
            a, b = alike_in_crowd(key[x:y], part[x:y], np.concatenate(sets[x:y]), ends, similarity)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, key, part, sets = *(np.zeros(0, np.int64) for _ in range(3)), []
        for batch in batches:
            cell, key, part = (np.r_[x, batch.column(i).to_numpy()] for i, x in enumerate((cell, key, part)))
            sets += [s.values.to_numpy() for s in batch.column(3)]
            whole = int(np.argmax(cell == cell[-1])) if len(cell) else 0
            if whole:
                yield from result(cell[:whole], key[:whole], part[:whole], sets[:whole])
                cell, key, part, sets = cell[whole:], key[whole:], part[whole:], sets[whole:]
        if len(cell):
            yield from result(cell, key, part, sets)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("cell", "key", "part", "set").repartition(parts, "cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(verify, "a long, b long")


def meeting(crowds: DataFrame) -> DataFrame:
    """(cell, key, part) of the texts (key, n, part, crowd): a crowd too large for a task is cut into chunks, each two of which meet in a cell; a crowd of one part has no links to find."""
    size = crowds.groupBy("crowd").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("total"), (F.min("part") < F.max("part")).alias("parts")).where("parts")
    fits = (F.col("texts") <= CELL) & (F.col("total") <= 2 * CROWD)
    chunks = F.when(fits, 1).otherwise(F.ceil(F.greatest(F.col("texts") / F.lit(CELL // 2), F.col("total") / F.lit(CROWD)))).cast("int")
    own = F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int")
    meet = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(F.least(c, own).alias("x"), F.greatest(c, own).alias("y")))
    split = crowds.join(size.select("crowd", chunks.alias("chunks")), "crowd").select("key", "part", "crowd", F.explode(meet).alias("m"))
    return split.select(F.xxhash64("crowd", "m.x", "m.y").alias("cell"), "key", "part")


def alike_by_fingerprint(nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b) that connect the near copies among the texts (key, fp) whose fingerprints are linked; ``sets`` (key, n, set) has all that can have one."""
    near = nodes.join(near_groups(nodes, "key"), "fp").select("key", F.col("component_id").alias("crowd"))
    crowds = cut_lineage(near.join(sets.select("key", "n"), "key").withColumn("part", F.col("key")))
    return cut_lineage(alike_links(meeting(crowds).join(sets.select("key", "set"), "key"), similarity))


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILAR) -> DataFrame:
    """(key, least, text_hash, root), one row per different text, ``root`` being one for a group of near copies.

    Texts of equal words in equal order, whatever their case and blanks, share a 64-bit
    ``key``.  ``least`` is the smallest id with that text, ``text_hash`` the XXH64 of a text
    that has it.  Two texts are near copies if their sets of five-word shingles share
    ``similarity`` or more of their union; groups are what near copies connect.  No
    link is missed, at any number of texts.
    """
    text = F.col(f"`{text_col}`")
    own = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_hash"), key_of(text).alias("v")).select("id", "text_hash", "v.*")
    first = F.coalesce(F.min_by("text_hash", "id"), F.min("text_hash")).alias("text_hash")
    nodes = cut_lineage(own.groupBy("key").agg(F.min("id").alias("least"), first, F.max("n").alias("n"), F.max("fp").alias("fp")))
    slices_for = lambda rows: max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(rows.agg(F.sum("n")).first()[0] or 0) // SLICE))
    often = shared_postings(df.select(text.alias("text")), slices_for(nodes), True)
    wanted = nodes.join(often, "key").where(F.col("c") >= least_shared(F.col("n"), similarity)).select("key", "text_hash", "n")
    wanted = cut_lineage(wanted)
    texts = df.select(text.alias("text")).withColumn("text_hash", F.xxhash64("text"))
    hashes = wanted.select("text_hash")
    texts = texts.join(F.broadcast(hashes) if hashes.count() <= SMALL else hashes, "text_hash", "left_semi").groupBy("text_hash").agg(F.first("text").alias("text"))
    sets = cut_lineage(texts.join(wanted, "text_hash").select("key", "n", shingles_of(F.col("text")).alias("set")))
    close = alike_by_fingerprint(nodes.select("key", "fp"), sets, similarity)
    known = connected_components(close, "a", "b").select(F.col("id").alias("key"), F.col("cluster_id").alias("part"))
    cells = shared_postings(sets.select("key", "set"), slices_for(wanted), False).join(wanted.select("key", "n"), "key")
    rarest, mine = W.partitionBy("key").orderBy("df", "cell"), W.partitionBy("key")
    cells = cells.withColumn("nth", F.row_number().over(rarest)).withColumn("c", F.count(F.lit(1)).over(mine))
    cells = cut_lineage(cells.where(F.col("nth") <= F.col("c") - least_shared(F.col("n"), similarity) + 1).select("cell", "n", "key"))
    crowds = connected_components(chains(cells, similarity), "a", "b").select(F.col("id").alias("key"), F.col("cluster_id").alias("crowd"))
    crowds = crowds.join(wanted.select("key", "n"), "key").join(known, "key", "left").withColumn("part", F.coalesce("part", "key"))
    alike = alike_links(meeting(cut_lineage(crowds)).join(sets.select("key", "set"), "key"), similarity)
    grouped = connected_components(alike.unionByName(close), "a", "b").select(F.col("id").alias("key"), F.col("cluster_id").alias("root"))
    return nodes.join(grouped, "key", "left").select("key", "least", "text_hash", F.coalesce("root", "key").alias("root"))
