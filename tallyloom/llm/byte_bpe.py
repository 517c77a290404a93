"""Byte-level pair encoding by replaying the merges over a whole set of words, and decoding.

A text is cut into words by the vocabulary's pattern.  The new words of a stretch of
texts lie in one flat array of symbols, linked both ways, with a wall between two words.  An
inverted index leads from each merge (by its rank) to the places of the pairs that
it joins.  The merges are applied in the order of their ranks, each at all its
places at once, from left to right; only the two pairs beside a merged place are
looked up anew and filed under their ranks.  A place that no longer holds
its pair is passed over.

A merge can give rise to a pair of a better rank.  The word's other places then
wait until that pair is merged, so each word sees the merges it would see alone.
Words that are tokens as they stand are not merged at all.

Encoded words are remembered up to ``KNOWN_BYTES``; a very long text is worked off in
stretches of ``STRETCH`` words.  A null text counts as empty and has no ids.
Repeated rows get equal ids.  Input columns named like the added ones are replaced.
"""

from __future__ import annotations

import base64
import heapq
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words worked off together, and bytes of words and ids that a task remembers.
STRETCH, KNOWN_BYTES = 200_000, 48 << 20
WALL = -1


class Merges:
    """A vocabulary of byte strings by rank; the rank of a token is its id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values(), default=0) + 2
        self.token = dict(zip(ranks.values(), ranks, strict=True))
        #: The same by place, for looking up many; a gap in the ranks has no bytes to give.
        self.tokens = [self.token.get(i) for i in range(self.size - 1)]
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        #: Left and right token as one number, to the token they make.
        self.into: dict[int, int] = {}
        for whole, rank in ranks.items():
            for cut in range(1, len(whole)):
                left, right = ranks.get(whole[:cut]), ranks.get(whole[cut:])
                if left is not None and right is not None:
                    self.into[left * self.size + right] = rank
        self.first = np.full((256, 256), WALL, np.int64)
        for a in range(256):
            for b in range(256):
                self.first[a, b] = ranks.get(bytes([a, b]), WALL)

    @classmethod
    def load(cls, path: str) -> Merges:
        """From a file with a token in base 64 and its rank on each line."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def replay(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word (none empty)."""
        ids, ends = self.replayed(words)
        return np.split(ids, ends[:-1]) if len(words) else []

    def replayed(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and where those of each end."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        #: Slot 0 and the slot after each word are walls.
        starts = np.cumsum(lengths + 1) - lengths
        total = int(lengths.sum()) + len(words) + 1
        data = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8)
        walls = np.append(0, starts + lengths)
        symbols = self.byte[data]
        symbols[walls] = WALL
        pair = np.append(self.first[data[:-1], data[1:]], WALL)
        pair[walls] = pair[walls[1:] - 1] = WALL
        index = filed(pair)
        symbol, due = symbols.tolist(), pair.tolist()
        following, before = list(range(1, total + 1)), list(range(-1, total - 1))
        into, size, first_of = self.into.get, self.size, starts.tolist()
        queue = list(index)
        heapq.heapify(queue)
        while queue:
            rank = heapq.heappop(queue)
            places = sorted(index.pop(rank))
            before_rank = rank * size
            waiting: list[int] = []
            until = 0
            for place in places:
                if due[place] != rank:
                    continue
                if place < until:
                    waiting.append(place)
                    continue
                gone = following[place]
                right, left = following[gone], before[place]
                symbol[place], symbol[gone], due[gone] = rank, WALL, WALL
                following[place], before[right] = right, place
                best = other = WALL
                if symbol[right] != WALL:
                    best = into(before_rank + symbol[right], WALL)
                    if best != WALL:
                        if best in index:
                            index[best].append(place)
                        else:
                            index[best] = [place]
                            heapq.heappush(queue, best)
                due[place] = best
                if symbol[left] != WALL:
                    due[left] = other = into(symbol[left] * size + rank, WALL)
                    if other != WALL:
                        if other in index:
                            index[other].append(left)
                        else:
                            index[other] = [left]
                            heapq.heappush(queue, other)
                if WALL < best < rank or WALL < other < rank:
                    word = bisect_right(first_of, place) - 1
                    until = first_of[word] + len(words[word])
            if waiting:
                index.setdefault(rank, []).extend(waiting)
                heapq.heappush(queue, rank)
        left = np.array(symbol)
        kept = left != WALL
        counts = np.append(0, np.cumsum(kept))
        return left[kept], counts[starts + lengths]


def filed(pair: np.ndarray) -> dict[int, list[int]]:
    """Places of each rank, ascending."""
    places = np.flatnonzero(pair != WALL)
    order = places[np.argsort(pair[places], kind="stable")]
    ranks, at = np.unique(pair[order], return_index=True)
    return {int(r): p.tolist() for r, p in zip(ranks, np.split(order, at[1:]), strict=True)} if len(ranks) else {}


@cache
def loaded(path: str) -> Merges:
    return Merges.load(path)


class Encoder:
    """Encodes texts, and remembers words while they fit: in two halves, of which the one not used lately goes."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.pattern = merges, regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def learn(self, words: Iterable[str]) -> None:
        if self.held > KNOWN_BYTES // 2:
            self.older, self.known, self.held = self.known, {}, 0
        known, older = self.known, self.older
        new = set(words).difference(known)
        self.held += sum(map(len, new)) * 5 + 100 * len(new)
        if older:
            again = new.intersection(older)
            known.update(zip(again, map(older.__getitem__, again), strict=True))
            new -= again
        open_words, raw = [], []
        ranks = self.merges.ranks.get
        for word in new:
            data = word.encode()
            whole = ranks(data)
            if whole is None:
                open_words.append(word)
                raw.append(data)
            else:
                known[word] = whole.to_bytes(4, "little")
        if raw:
            ids, ends = self.merges.replayed(raw)
            coded, start = ids.astype("<u4").tobytes(), 0
            for word, end in zip(open_words, (4 * ends).tolist(), strict=True):
                known[word] = coded[start:end]
                start = end

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as unsigned 32-bit numbers, little end first."""
        out: list[list[bytes]] = [[] for _ in texts]
        stretch: list[tuple[int, list[str]]] = []
        size = 0

        def finish() -> None:
            self.learn(chain.from_iterable(words for _, words in stretch))
            for row, words in stretch:
                out[row].append(b"".join(map(self.known.__getitem__, words)))
            stretch.clear()

        for row, text in enumerate(texts):
            found = (m.group() for m in self.pattern.finditer(text)) if len(text) > STRETCH else iter(self.pattern.findall(text))
            while words := list(islice(found, STRETCH)):
                stretch.append((row, words))
                size += len(words)
                if size >= STRETCH:
                    finish()
                    size = 0
        finish()
        return [b"".join(parts) for parts in out]


def encode_of(text: Column, path: str, pattern: str) -> Column:
    """Struct (ids, decoded) of a text."""

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(loaded(path), pattern)
        for texts in batches:
            ids = encoder.encode(texts.tolist())
            decoded = [encoder.merges.decode(np.frombuffer(i, "<u4").tolist()) for i in ids]
            yield pd.DataFrame({"ids": ids, "decoded": decoded})

    encode.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(encode, "ids binary, decoded binary")(F.coalesce(text, F.lit("")))


def with_byte_bpe(df: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """Adds ``ids`` (unsigned 32-bit numbers, little end first) and ``decoded`` (the bytes the ids stand for)."""
    own = df.select("*", encode_of(F.col(f"`{text_col}`").cast("string"), path, pattern).alias("__coded"))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("ids", "decoded")]
    return own.select(*kept, "__coded.ids", "__coded.decoded")
