"""Phrase collocations against a plain version."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tallyloom.llm import blooms, phrases


def plain_counts(rows):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i : i + m])] += 1
    return f, n


def plain_collocations(rows, often, shown):
    counts, n = plain_counts(rows)
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if a >= often and len(p) > 1}
        inside = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        ranked = []
        for p, a in found.items():
            if p in inside and 100 * inside[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:shown], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made_rows(seed, n):
    rng, vocabulary = random.Random(seed), [*"abcdefgh", "Ab", "é", "\x1c", "\x85x", "x" * 300]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 60)):
            words += rng.choice([[rng.choice(vocabulary)], ["new", "York", "city", "hall"], ["of", "the"], ["new", "york"]])
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", "!"]) for w in words)))
    return [*rows, ("fr", None), ("fr", ""), ("fr", "  .,\n ")]


@pytest.mark.parametrize("shards, at_once, known, most", [(1, 4 << 20, 1_000_000, 32 << 20), (3, 50, 4, 16), (4, 200, 1_000_000, 32 << 20)])
def test_collocations(llm, monkeypatch, shards, at_once, known, most):
    """Any number of shards, short stretches, a small memory and a filter that is far too small give the same rows."""
    monkeypatch.setattr(phrases, "AT_ONCE", at_once)
    monkeypatch.setattr(phrases, "KNOWN", known)
    monkeypatch.setattr(blooms, "MOST_BYTES", most)
    rows = made_rows(1, 120)
    frame = llm.createDataFrame([(i, *r, "extra") for i, r in enumerate(rows)], "doc_id long, lang string, text string, phrase string")
    got = phrases.collocations(frame, often=8, shown=60, shards=shards)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain_collocations(rows, 8, 60)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 100


def test_counts_are_exact(llm):
    rows = made_rows(2, 60)
    frame = llm.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    counts = phrases.frequent_phrases(frame, frame["lang"], frame["text"], frame["doc_id"], 5, 3)
    got = {(r.lang, r.phrase): r.n for r in counts.collect() if r.words}
    f, _ = plain_counts(rows)
    assert got == {(lang, " ".join(p)): a for lang, own in f.items() for p, a in own.items() if a >= 5}


def test_scores_past_64_bits(llm):
    """Counts so large that products pass 64 bits."""
    big = 9 * 10**17
    rows = [("en", "", 0, big), ("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big - 2), ("en", "a b c", 3, big * 4 // 5 - 5), ("en", "c", 1, big), ("en", "b c", 2, big - 1)]
    got = {r.phrase: (r.a, r.l, r.r, r.score) for r in phrases.scored(llm.createDataFrame(rows, "lang string, phrase string, words int, n long")).collect()}
    assert got == {
        "a b": (big - 2, big, big - 1, 2_000_000 * (big - 2) // (2 * big - 1)),
        "b c": (big - 1, big - 1, big, 2_000_000 * (big - 1) // (2 * big - 1)),
        "a b c": (big * 4 // 5 - 5, big, big - 1, 2_000_000 * (big * 4 // 5 - 5) // (2 * big - 1)),
    }


def test_edges(odd_docs, no_docs):
    rows = [(r.lang, r.text) for r in odd_docs.select("lang", "text").collect()]
    got = sorted(tuple(r) for r in phrases.collocations(odd_docs, often=2).collect())
    assert got == plain_collocations(rows, 2, 2000) and got
    assert phrases.collocations(no_docs).collect() == []


@pytest.mark.parametrize("at_once, held, stretches", [(4 << 20, 24 << 20, 2), (4 << 20, 500, 40), (100, 24 << 20, 40)])
def test_stretches_gather_texts_of_many_batches(monkeypatch, at_once, held, stretches):
    """Small batches of two languages make one stretch each, unless the bounds ask for more; no word is lost."""
    monkeypatch.setattr(phrases, "AT_ONCE", at_once)
    monkeypatch.setattr(phrases, "HELD", held)
    batches = [pa.RecordBatch.from_pydict({"lang": ["de", "en"] * 3, "text": [f"a{i} b c, d", f"e{i} f"] * 3}) for i in range(40)]
    found = list(phrases.by_group(iter(batches)))
    words = Counter((key, w) for key, _, own, carried in found for w in own[carried:] if w != phrases.WALL)
    assert words == Counter(((r["lang"],), w) for b in batches for r in b.to_pylist() for w in r["text"].encode().replace(b",", b"").split())
    assert len(found) == 2 if stretches == 2 else len(found) > 2


def test_counts_travel_packed_by_slice(llm, monkeypatch):
    """A stretch makes a row per slice, however many phrases it has; a slice makes few rows; no count is lost."""
    monkeypatch.setattr(phrases, "IN_ROW", 300)
    words = [f"w{i % 977}" for i in range(5000)]
    texts = llm.createDataFrame([("en", 0, " ".join(words))], "lang string, shard int, text string").coalesce(1)
    nothing = phrases.np.zeros(0, phrases.np.uint64)
    rows = phrases.scanned(phrases.dealt(texts), phrases.np.zeros(1, phrases.np.uint64), nothing, True, 7, 3)
    assert rows.count() == 3
    again = rows.withColumn("since", rows["since"])
    out = phrases.summed(rows.unionByName(again), 12, 6).collect()
    assert len(out) == sum(max(1, -(-sum(len(r.h) // 8 for r in out if r.slice == s) // 300)) for s in range(3)) < 20
    n = phrases.np.concatenate([phrases.np.frombuffer(r.n, phrases.np.int64) for r in out])
    assert len(n) == 977 and n.sum() == 10_000 and sum(len(r.hits) for r in out) == 8 * (n >= 12).sum() > 0
    assert {s for r in out for s in phrases.np.frombuffer(r.since, phrases.np.int32).tolist()} == {7}
    closed = phrases.summed(rows, 6, 7).collect()
    assert not any(r.h for r in closed) and sum(len(r.hits) for r in closed) > 0
