"""Encoding and decoding with a byte-pair vocabulary of pieces, in vectorised merge rounds.

All new words of a batch lie in one flat array of symbols.  A round finds the best
(lowest) rank among the neighbouring pairs of each word, merges the leftmost
pairs of that rank in all words at once, and closes the gaps; words without a
pair leave the array.  A merge after which a pair of no worse rank could appear is
done once per word and round, so the result is that of merging one by one.
Known words are looked up, so a batch encodes its new words only.

Words end before each run of spaces and at line ends: no piece reaches across.
Characters without a piece become byte pieces.  A null text counts as empty and
has no ids.  The vocabulary must be a byte-pair model with byte pieces, a
leading space, and no other normalisation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
NONE = np.iinfo(np.int32).max
KNOWN_WORDS = 300_000


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after another."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


@dataclass
class Vocabulary:
    pieces: list[str]
    symbols: dict[str, int]
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    pair_into: np.ndarray
    careful: np.ndarray
    byte_ids: np.ndarray
    piece_ids: np.ndarray
    text_bytes: np.ndarray
    text_starts: np.ndarray
    text_lengths: np.ndarray
    silent: frozenset[int]
    unknown: int
    bytes_at: dict[int, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize("ﬁ  x ") != f"{SPACE}ﬁ{SPACE * 2}x{SPACE}":
            raise ValueError("the vocabulary normalises texts")
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        if any(SPACE in pieces[i].lstrip(SPACE) or ("\n" in pieces[i] and len(pieces[i]) > 1) for i in plain):
            raise ValueError("a piece reaches across words")
        symbols = {pieces[i]: k for k, i in enumerate(plain)}
        piece_ids = list(plain)
        for c in sorted({c for i in plain for c in pieces[i]} - symbols.keys()):
            symbols[c] = len(piece_ids)
            piece_ids.append(-1)
        scores = sorted({-model.get_score(i) for i in plain})
        rank_of = {s: r for r, s in enumerate(scores)}
        ranks = {pieces[i]: rank_of[-model.get_score(i)] for i in plain}
        size, found, careful = len(symbols), [], np.zeros(len(symbols), bool)
        for text, rank in ranks.items():
            for cut in range(1, len(text)):
                a, b = text[:cut], text[cut:]
                if a in symbols and b in symbols:
                    found.append((symbols[a] * size + symbols[b], rank, symbols[text]))
                    for part in (a, b):
                        careful[symbols[part]] |= rank <= ranks.get(part, -1)
        found.sort()
        keys, pair_ranks, into = (np.array(x, np.int64) for x in zip(*found, strict=True))
        bytes_at = {i: int(pieces[i][3:5], 16) for i in range(n) if model.is_byte(i)}
        byte_ids = np.zeros(256, np.int32)
        for i, b in bytes_at.items():
            byte_ids[b] = i
        silent = frozenset(i for i in range(n) if model.is_control(i))
        texts = [b"" if i in silent else bytes([bytes_at[i]]) if i in bytes_at else pieces[i].replace(SPACE, " ").encode() for i in range(n)]
        lengths = np.array([len(x) for x in texts])
        return cls(
            pieces, symbols, keys, pair_ranks.astype(np.int32), into, careful, byte_ids, np.array(piece_ids, np.int32),
            np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths) - lengths, lengths, silent, model.unk_id(), bytes_at,
        )

    def rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair and the symbol it merges into; NONE where there is none."""
        key = np.where((a >= 0) & (b >= 0), a * len(self.symbols) + b, -1)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_ranks[at], NONE), np.where(hit, self.pair_into[at], -1)


@dataclass
class Encoder:
    vocabulary: Vocabulary
    words: dict[str, int] = field(default_factory=dict)
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    lengths: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))

    SPLIT = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n+|[^{SPACE}\n]+")

    def merged(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words one after another (a character without symbol as -1 - code point), and their number per word."""
        v = self.vocabulary
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        length = np.fromiter(map(len, words), np.int64, len(words))
        distinct, back = np.unique(points, return_inverse=True)
        symbol = np.array([v.symbols.get(chr(c), -1 - c) for c in distinct.tolist()], np.int64)[back]
        word = np.repeat(np.arange(len(words)), length)
        ends = lambda w: np.append(w[1:] != w[:-1], True)
        rank, into = v.rank(symbol, np.append(symbol[1:], -1))
        rank[ends(word)] = NONE
        out_symbol, out_word = [], []
        while len(symbol):
            begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, begin)
            size = np.diff(np.append(begin, len(word)))
            best = np.repeat(best, size)
            done = best == NONE
            if done.any():
                out_symbol.append(symbol[done])
                out_word.append(word[done])
                symbol, word, rank, into, best = (x[~done] for x in (symbol, word, rank, into, best))
                if not len(symbol):
                    break
            pick = np.flatnonzero(rank == best)
            run = np.append(True, np.diff(pick) != 1)
            place = np.arange(len(pick)) - np.maximum.accumulate(np.where(run, np.arange(len(pick)), 0))
            pick = pick[place % 2 == 0]
            slow = v.careful[into[pick]]
            if slow.any():
                held = np.unique(word[pick[slow]])
                first = np.append(True, word[pick][1:] != word[pick][:-1])
                pick = pick[first | ~np.isin(word[pick], held)]
            symbol[pick] = into[pick]
            keep = np.ones(len(symbol), bool)
            keep[pick + 1] = False
            moved = pick - np.arange(len(pick))
            symbol, word, rank, into = symbol[keep], word[keep], rank[keep], into[keep]
            again = np.unique(np.concatenate((moved, moved[moved > 0] - 1)))
            after = np.minimum(again + 1, len(symbol) - 1)
            new_rank, new_into = v.rank(symbol[again], symbol[after])
            same = (word[again] == word[after]) & (after > again)
            rank[again], into[again] = np.where(same, new_rank, NONE), new_into
        symbol, word = np.concatenate(out_symbol or [symbol]), np.concatenate(out_word or [word])
        order = np.argsort(word, kind="stable")
        return symbol[order], np.bincount(word, minlength=len(words))

    def learn(self, words: list[str]) -> None:
        """Adds the ids of new words."""
        v = self.vocabulary
        symbol, count = self.merged(words)
        ids = np.where(symbol >= 0, v.piece_ids[np.maximum(symbol, 0)], -1).astype(np.int64)
        bare = np.flatnonzero(ids < 0)
        width = np.ones(len(ids), np.int64)
        if len(bare):
            names = {k: c for c, k in v.symbols.items()} if (symbol[bare] >= 0).any() else {}
            coded = [(names[s] if s >= 0 else chr(-1 - s)).encode("utf-8", "replace") for s in symbol[bare].tolist()]
            width[bare] = [len(x) for x in coded]
            flat = np.repeat(ids, width)
            flat[np.repeat(ids < 0, width)] = v.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
            ids = flat
            owner = np.repeat(np.arange(len(words)), count)
            count = np.bincount(np.repeat(owner, width), minlength=len(words))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(count) - count))
        self.lengths = np.concatenate((self.lengths, count))
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
        base = len(self.words)
        self.words.update((w, base + i) for i, w in enumerate(words))

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text ends (beginning with 0)."""
        if len(self.words) > KNOWN_WORDS:
            self.words.clear()
            self.starts, self.lengths, self.ids = self.starts[:0], self.lengths[:0], self.ids[:0]
        split = [self.SPLIT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = {w for words in split for w in words if w not in self.words}
        if new:
            self.learn(list(new))
        known = self.words
        counts = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter((known[w] for words in split for w in words), np.int64, int(counts.sum()))
        sums = np.append(0, np.cumsum(self.lengths[at]))
        return gathered(self.ids, self.starts[at], self.lengths[at]), sums[np.append(0, np.cumsum(counts))]


def decode_ids(v: Vocabulary, ids: Sequence[int]) -> str:
    """Text of any ids: byte pieces that do not make a character become U+FFFD each, the unknown piece a mark."""
    out, run, first = [], bytearray(), True

    def flush() -> None:
        at = 0
        while at < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(bytes(run[at : at + n]).decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        run.clear()

    for i in map(int, ids):
        if i in v.bytes_at:
            run.append(v.bytes_at[i])
            first = False
            continue
        flush()
        if i in v.silent:
            continue
        piece = " ⁇ " if i == v.unknown else v.pieces[i]
        out.append((piece[1:] if first and piece.startswith(SPACE) else piece).replace(SPACE, " "))
        first = False
    flush()
    return "".join(out)


def decode_flat(v: Vocabulary, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Texts of many id lists at once; a list whose bytes are no text is decoded piece by piece."""
    raw = gathered(v.text_bytes, v.text_starts[ids], v.text_lengths[ids])
    sums = np.append(0, np.cumsum(v.text_lengths[ids]))[ends]
    starts, stops = sums[:-1].copy(), sums[1:]
    some = ends[1:] > ends[:-1]
    lead = np.zeros(len(starts), bool)
    lead[some] = np.fromiter((v.pieces[i].startswith(SPACE) for i in ids[ends[:-1][some]].tolist()), bool, int(some.sum()))
    starts += lead
    data = raw.tobytes()
    texts = []
    odd = set(np.flatnonzero(np.isin(ids, [*v.silent, v.unknown])).tolist())
    for k, (a, b) in enumerate(zip(starts.tolist(), stops.tolist(), strict=True)):
        try:
            if odd and any(ends[k] <= i < ends[k + 1] for i in odd):
                raise ValueError
            texts.append(data[a:b].decode())
        except ValueError:
            texts.append(decode_ids(v, ids[ends[k] : ends[k + 1]]))
    return pa.array(texts, pa.string())


def encode_of(text: Column, path: str) -> Column:
    """Struct (ids, decoded) of a text."""

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = Vocabulary.load(path)
        encoder = Encoder(vocabulary)
        for batch in batches:
            ids, ends = encoder.encode(batch.to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
            yield pa.StructArray.from_arrays([lists, decode_flat(vocabulary, ids, ends)], names=["ids", "decoded"])

    encode.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(encode, "ids array<int>, decoded string")(text)


def with_pieces(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Adds ``ids`` and ``decoded``; columns of these names are replaced."""
    out = df.drop("ids", "decoded") if text_col not in ("ids", "decoded") else df
    kept = [F.col(f"`{c}`") for c in out.columns if c not in ("ids", "decoded")]
    out = out.select(*kept, encode_of(F.col(f"`{text_col}`").cast("string"), path).alias("__pieces"))
    return out.select(*kept, "__pieces.ids", "__pieces.decoded")
