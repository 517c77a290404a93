"""Documents into token sequences: best-fit decreasing, certified by lower bounds.

Pieces are dealt into groups of bounded size, and each group is packed by
best-fit decreasing.  Dual-feasible functions bound the bins a group needs from
below; a group that meets its bound is certified and gives up only its emptiest
bin.  A group with a gap gives up several of its emptiest bins for each bin too
many.  What was given up is dealt anew into fewer groups, so groups exchange
documents, and packed again, as long as the total falls and lies above the bound
of the whole table.

A null text counts as empty: one token, the end mark.  An empty table gives no
rows.  Repeated rows are packed once each.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage

#: Rows a group holds, rounds of exchange at most, and bins a group offers for each bin it has too many.
CAPACITY, GROUP_ROWS, ROUNDS, OFFERED = 2048, 8192, 6, 8
#: The split of a text before its byte pairs merge, and the end mark of the vocabulary: fixed values of the vocabulary file.
END = "<|endoftext|>"


def encoder(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """The byte-level vocabulary from its file of ranks; the end mark's text becomes its one id, as in the vocabulary's own file."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_pairs", pat_str=pattern, mergeable_ranks=ranks, special_tokens={END: len(ranks)})


def token_pieces(
    df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of each text's tokens and a closing 0; only the first piece may be short."""
    kind = df.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks_path, pattern)
        for batch in batches:
            rows: list[tuple] = []
            which: list[int] = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(coder.encode_to_numpy(text or "", allowed_special="all"), 0).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
                    start = max(0, end - capacity)
                    own = ids[start:end]
                    which.append(row)
                    rows.append((piece, start, len(own), zlib.crc32(own.tobytes()), own.astype(np.int32) if with_ids else None))
            columns = list(zip(*rows, strict=True))
            arrays = [batch.column(0).take(pa.array(which, pa.int64())), *[pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=False)]]
            yield pa.RecordBatch.from_arrays(
                [*arrays, *[pa.array(columns[4], pa.list_(pa.int32()))] * with_ids], names=[id_col, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
            )

    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(cut, schema)


def bins_needed(lengths_count: np.ndarray) -> int:
    """A lower bound of the bins for so many items of each length 0 .. capacity, by two families of dual-feasible functions."""
    capacity = len(lengths_count) - 1
    size = np.arange(capacity + 1)
    number, volume = np.cumsum(lengths_count), np.cumsum(lengths_count * size)
    below = lambda sums, at: np.where(at > 0, sums[np.maximum(at, 1) - 1], 0)  # noqa: E731  sums over lengths < at
    least = np.arange(0, capacity // 2 + 1)
    large = number[-1] - number[capacity - least]
    middle = volume[capacity - least] - below(volume, least)
    best = int((large + (middle + capacity - 1) // capacity).max())
    for k in range(1, 31):
        parts = (k + 1) * size
        exact = parts % capacity == 0
        value = np.where(exact, size * k, parts // capacity * capacity)  # times k * capacity
        best = max(best, int(((lengths_count * value).sum() + k * capacity - 1) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, longest first into the fullest bin that takes it; fill of each bin."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, free, fill = 0, 0, []
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            own = open_at[room].pop()
            if not open_at[room]:
                rooms &= ~(1 << room)
        else:
            room, own = capacity, free
            free += 1
            fill.append(0)
        bins[i], offsets[i] = own, fill[own]
        fill[own] += n
        if room > n:
            open_at[room - n].append(own)
            rooms |= 1 << (room - n)
    return bins, offsets, np.array(fill, np.int64)


def pack_groups(items: DataFrame, round_no: int, groups: int, capacity: int) -> DataFrame:
    """Packs each group; ``given_up`` marks the items of bins that go into the exchange."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rid")
        lengths = group["length"].to_numpy(np.int64)
        bins, offsets, fill = best_fit(lengths, capacity)
        gap = len(fill) - bins_needed(np.bincount(lengths, minlength=capacity + 1))
        loose = np.zeros(len(fill), bool)
        loose[np.argsort(fill, kind="stable")[: max(2, OFFERED * gap) if gap > 0 else 1]] = True
        loose &= fill < capacity
        code = (round_no << 56) + (int(group["grp"].iloc[0]) << 20)
        return pd.DataFrame({"rid": group["rid"].to_numpy(), "length": lengths, "sequence_id": code + bins, "offset": offsets, "given_up": loose[bins]})

    dealt = items.select("rid", "length", F.pmod(F.xxhash64("rid", F.lit(round_no)), F.lit(groups)).alias("grp"))
    return dealt.groupBy("grp").applyInPandas(pack, "rid long, length long, sequence_id long, offset long, given_up boolean")


def pack_lengths(items: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, rounds: int = ROUNDS) -> tuple[DataFrame, dict]:
    """(rid, sequence_id, offset) for items (rid, length) of at most ``capacity``, and the counts of bins and of the bound."""
    full = items.where(F.col("length") == capacity).select("rid", (F.col("rid") + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    histogram = np.zeros(capacity + 1, np.int64)
    for r in items.groupBy("length").count().collect():
        histogram[r[0]] = r[1]
    total, bound = int(histogram[capacity]), bins_needed(histogram)
    histogram[capacity] = 0
    pool, rows = items.where(F.col("length") < capacity), int(histogram.sum())
    settled, before, last = [full], None, None
    for round_no in range(rounds if rows else 0):
        packed = cut_lineage(pack_groups(pool, round_no, max(1, -(-rows // group_rows)), capacity))
        seen = {r[0]: r for r in packed.groupBy("given_up").agg(F.count(F.lit(1)), F.countDistinct("sequence_id")).collect()}
        kept, loose = seen.get(False, (0, 0, 0)), seen.get(True, (0, 0, 0))
        if before is not None and kept[2] + loose[2] >= before:
            break
        if last is not None:
            settled.append(last.where("not given_up"))
            total -= before
        total += kept[2] + loose[2]
        last, before, rows = packed, loose[2], loose[1]
        pool = packed.where("given_up").select("rid", "length")
        if total <= bound or loose[2] < 2:
            break
    if last is not None:
        settled.append(last)
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part.select("rid", "sequence_id", "offset"))
    return out, {"sequences": total, "bound": bound}


def pack_documents(pieces: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, dict]:
    """Adds ``sequence_id`` and ``offset`` to pieces; the second value tells the sequences used and the proven least."""
    fixed = cut_lineage(pieces.drop("rid", "sequence_id", "offset")).withColumn("rid", F.monotonically_increasing_id())
    places, report = pack_lengths(fixed.select("rid", "length"), capacity)
    return fixed.join(places, "rid").drop("rid"), report
