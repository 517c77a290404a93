"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
from tallyloom.llm import blooms, variants

FOLDER = "/root/testdata/sf0.001"


def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def plain_variants(n):
    holes = defaultdict(set)
    for w in n:
        holes["=", w].add(w)
        for i in range(len(w)):
            holes["=", w[:i] + w[i + 1 :]].add(w)
            holes[i, w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for (kind, gap), words in holes.items():
        for a in words:
            for b in words if kind != "=" else [gap] if gap in words else []:
                if a != b:
                    near[a].add(b)
                    near[b].add(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda u: (-n[u], u))
        if n[best] >= 2 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def test_query(llm):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = entry.queries()["op11_spelling_variants"](llm, FOLDER)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    want = plain_variants(plain_words(docs))
    assert len(rows) == len(set(rows)) and set(rows) == want and sum(r[1] is not None for r in want) > 10


@pytest.mark.parametrize("most, held, at_once", [(64, 5, 7), (32 << 20, 200_000, 200_000)])
def test_dense(llm, monkeypatch, most, held, at_once):
    """Many near words, long chains of forms, long words; a filter that is much too small changes nothing."""
    for name, value in (("HELD", held), ("AT_ONCE", at_once)):
        monkeypatch.setattr(variants, name, value)
    monkeypatch.setattr(blooms, "MOST_BYTES", most)
    rng = random.Random(4)
    words = {"".join(rng.choices("abé", k=rng.randint(5, 7))): rng.randint(1, 40) for _ in range(400)}
    words |= {"z" * k: int(9 * 2.5 ** (k - 5)) for k in range(5, 13)} | {"q" * 6000: 3, "q" * 5999: 7, "q" * 3000 + "r" + "q" * 2999: 9}
    text = [w for w, k in words.items() for _ in range(k)]
    rng.shuffle(text)
    rows = [(i, " ".join(text[i::50]).upper() if i % 2 else " ".join(text[i::50])) for i in range(50)] + [(None, "nobody NOBODY nobody"), (7, None), (8, "")]
    got = variants.spelling_variants(llm.createDataFrame(rows, "doc_id long, text string"))
    want = plain_variants(plain_words([(i, t) for i, t in rows]))
    assert {tuple(r) for r in got.collect()} == want and any(r[2] == "z" * 12 and r[0] == "zzzzz" for r in want)


def test_edges(odd_docs, no_docs):
    got = variants.spelling_variants(odd_docs)
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert sorted(map(str, got.collect())) == sorted(f"Row(word={w!r}, form={f!r}, root={r!r}, n={n}, n_near={k}, form_n={m})" for w, f, r, n, k, m in plain_variants(plain_words(rows)))
    assert variants.spelling_variants(no_docs).collect() == []
