"""Each operator's query against a plain version, on the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tallyloom.llm import simhash

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()
BLANK = r"[^\x20\x09-\x0D]+"


def result(llm, name):
    return QUERIES[name](llm, FOLDER).toPandas()


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").df()


@pytest.mark.parametrize("name", ["op1_warc", "op3_exact_topk"])
def test_sql(llm, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()[name]).df()
    got = result(llm, name)[list(want.columns)]
    order = list(want.columns)[:2]
    a, b = (x.sort_values(order).reset_index(drop=True).astype(object).where(lambda d: d.notna(), None) for x in (got, want))
    assert len(a) == len(b) > 0 and (a.astype(str) == b.astype(str)).all().all()


def test_shards(llm, docs):
    got = result(llm, "op2_hilbert_shards").sort_values("doc_id").reset_index(drop=True)
    data = docs.text.fillna("").map(str.encode)
    assert (got["size"] == data.map(len) + 16).all() and (got.text_crc32 == data.map(zlib.crc32)).all()
    counts = got.groupby("shard").slot.agg(["count", "min", "max", "nunique"])
    assert sorted(counts.index) == list(range(40)) and counts["count"].max() - counts["count"].min() <= 1
    assert (counts["min"] == 0).all() and (counts["max"] == counts["count"] - 1).all() and (counts["nunique"] == counts["count"]).all()


def plain_fingerprint(text):
    words = re.findall(BLANK, re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(llm, docs):
    got = result(llm, "op4_simhash").set_index("doc_id")
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs.itertuples()}
    assert {k: int(v, 16) for k, v in got.fingerprint.items()} == prints
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert got.component_id.to_dict() == {i: find(i) for i in ids}
    assert got.component_id.nunique() < len(ids)


def test_packing(llm, docs):
    got = result(llm, "op5_best_fit_packing")
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc = dict(tuple(got.sort_values("piece").groupby("doc_id")))
    total = 0
    for r in docs.itertuples():
        ids = coder.encode(r.text or "", add_special_tokens=False).ids + [0]
        own = by_doc[r.doc_id]
        assert list(own.piece) == list(range(len(own))) and own.length.sum() == len(ids) and (own.length[1:] == 2048).all()
        assert list(own.start) == [0, *own.length.cumsum()[:-1]]
        for p in own.itertuples():
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
        total += len(ids)
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert list(seq.offset) == [0, *seq.length.cumsum()[:-1]] and seq.length.sum() <= 2048
    assert got.sequence_id.nunique() <= -(-total // 2048) * 1.02 + 2


def test_language(llm, docs):
    got = result(llm, "op6_language_id").set_index("doc_id")
    held = docs.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)
    assert (got.loc[docs.doc_id, "held_out"].to_numpy() == held.to_numpy()).all()
    right = (got.loc[docs.doc_id, "lang_pred"].to_numpy() == docs.lang.to_numpy())[held.to_numpy()]
    assert right.mean() > 0.95 and got.score.between(0, 1).all()


def test_sentencepiece(llm, docs):
    got = result(llm, "op7_sentencepiece").set_index("doc_id")
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in docs.itertuples():
        ids = model.encode(r.text or "")
        assert tuple(got.loc[r.doc_id, ["n_tokens", "ids_sha256", "decoded_sha256"]]) == (len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)))


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""", re.I | re.A)


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_secrets(llm):
    folder = "/root/testdata/sf0.01"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").df()
    got = QUERIES["op8_secrets"](llm, folder).toPandas().set_index("doc_id")
    kinds, some = ["assign", "access", "hex"], 0
    for r in docs.itertuples():
        spans = plain_spans(r.text or "")
        text = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)
        some += len(spans)
        own = got.loc[r.doc_id]
        assert [own.n_assign, own.n_access, own.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert own.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(own.spans.split(","))
    assert some


def plain_rules(text):
    words = re.findall(BLANK, text)
    lines = [x for x in text.split("\n") if re.search(BLANK, x)]
    at = defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i : i + 3])].append(i)
    inside = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(n - 1 for n in Counter(lines).values()), len(inside)


def test_quality(llm, docs):
    got = result(llm, "op10_quality").set_index("doc_id")
    for r in docs.itertuples():
        want = plain_rules(r.text or "")
        own = got.loc[r.doc_id]
        assert (own.n_words, own.word_chars, own.n_symbols, own.n_dup_lines, own.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert own.base_failed == failed and not (failed and own.kept)


def test_quality_verdict(llm):
    got = QUERIES["op10_quality"](llm, "/root/testdata/sf0.01").toPandas()
    labels = duckdb.sql("SELECT * FROM '/root/testdata/sf0.01/labels.parquet'").df()
    both = got.merge(labels, on="doc_id")
    fine = both[(both.quality == 1) & ~both.base_failed]
    assert fine.kept.mean() > 0.98 and both[both.quality == 0].kept.mean() < 0.2


def test_toxicity(llm):
    got = QUERIES["op9_toxicity"](llm, "/root/testdata/sf0.1").toPandas()
    labels = duckdb.sql("SELECT * FROM '/root/testdata/sf0.1/labels.parquet'").df()
    both = got.merge(labels, on="doc_id")
    assert (both.held_out == both.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = both[both.held_out]
    assert held[held.toxic == 1].predicted.mean() > 0.65 and held[held.toxic == 0].predicted.mean() < 0.05


def plain_shingles(text):
    words = re.findall(BLANK, re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def plain_groups(sets, similarity):
    """Smallest id of each id's group, by all pairs."""
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            low, high = sorted((len(sets[a]), len(sets[b])))
            if low >= similarity * high - 1e-9:
                both = len(sets[a] & sets[b])
                if both / (low + high - both) >= similarity:
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: find(i) for i in ids}


def test_near_copies(llm):
    """Copies with words changed, a chain of them, and texts of the same words in another order."""
    rng = np.random.default_rng(3)
    rows = []
    for base in range(60):
        words = [f"w{x}" for x in rng.integers(0, 3000, rng.integers(60, 400))]
        rows.append(" ".join(words))
        for _ in range(4):
            words = list(words)
            for at in rng.choice(len(words), max(1, len(words) // 120), replace=False):
                words[at] = f"x{rng.integers(0, 3000)}"
            rows.append(" ".join(words).upper())
        rows.append(" ".join(rng.permutation(words)))
    frame = llm.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = simhash.near_copies(frame).toPandas()
    first = found.groupby("root").least.transform("min")
    got = dict(zip(found.least, first, strict=True))
    want = plain_groups({i: plain_shingles(t) for i, t in enumerate(rows)}, 0.8)
    assert got == want and 60 < len(set(want.values())) < 200


@pytest.mark.parametrize("cell", [8, 4096])
def test_crowds_stay_connected(llm, monkeypatch, cell):
    """A group of near copies larger than a cell may be."""
    monkeypatch.setattr(simhash, "CELL", cell)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*words[:i], f"x{i}", *words[i + 1 :]])) for i in range(120)]
    found = simhash.near_copies(llm.createDataFrame([*rows, (500, None), (501, ""), (None, "one two")], "doc_id long, text string")).toPandas()
    sizes = found.groupby("root").size()
    assert sorted(sizes) == [1, 1, 120] and set(found.least.dropna()) == {*range(120), 500}


def near_roots(llm, rows):
    found = simhash.near_copies(llm.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).toPandas()
    return dict(zip(found.least, found.groupby("root").least.transform("min"), strict=True))


def test_near_copies_of_passages(llm):
    """One passage added, taken away or replaced, at just above and just below the limit."""
    rng = np.random.default_rng(11)
    rows = []
    for base in range(150):
        words = [f"b{base}w{x}" for x in rng.integers(0, 70, 100)]
        other = [f"c{base}w{x}" for x in range(30)]
        n = int(rng.integers(6, 26))
        at = int(rng.integers(0, 100 - n))
        rows += [" ".join(words), " ".join([words + other[:n], words[:at] + words[at + n :], words[:at] + other[: n // 2] + words[at + n // 2 :]][base % 3])]
    want = plain_groups({i: plain_shingles(t) for i, t in enumerate(rows)}, 0.8)
    assert near_roots(llm, rows) == want and 200 < len(set(want.values())) < 270


def test_near_copies_at_any_size(llm, monkeypatch):
    """The number of texts must not change what is linked: with the grid of very large tables too."""
    monkeypatch.setattr(simhash, "blocks_for", lambda nodes: 9)
    rng = np.random.default_rng(12)
    rows = []
    for base in range(100):
        words = [f"b{base}w{x}" for x in rng.integers(0, 70, 100)]
        rows += [" ".join(words), " ".join([*words, *(f"c{base}w{x}" for x in range(14))])]
    want = plain_groups({i: plain_shingles(t) for i, t in enumerate(rows)}, 0.8)
    assert near_roots(llm, rows) == want and len(set(want.values())) == 100


@pytest.mark.parametrize("cell", [16, 4096])
def test_near_copies_in_a_crowd(llm, monkeypatch, cell):
    """Many texts of the same words in another order, most pairs at 0.6 to 0.75; some have a copy with a footer."""
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = np.random.default_rng(13)
    words, rows = [f"w{x}" for x in range(100)], {}
    while len(rows) < 150:
        x, y = sorted(rng.choice(np.arange(6, 95), 2, replace=False))
        rows[" ".join([*words[x:y], *words[:x], *words[y:]])] = None
    rows = list(rows)
    rows += [f"{rows[i]} {' '.join(f'f{i}w{x}' for x in range(12))}" for i in range(40)]
    sets = {i: plain_shingles(t) for i, t in enumerate(rows)}
    want = plain_groups(sets, 0.8)
    alike = np.array([len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(150) for j in range(i)])
    assert np.median(alike) > 0.6 and (alike < 0.8).mean() > 0.8
    assert near_roots(llm, rows) == want and len(set(want.values())) > 10


def test_pipeline(llm):
    """The stages in turn against what plain code keeps."""
    import corpus_pipeline as p

    folder = "/root/testdata/sf0.01"
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    good = p.keep_good(llm, docs, folder).persist()
    kept = {r.doc_id for r in QUERIES["op10_quality"](llm, folder).where("kept").collect()}
    assert good.columns == docs.columns and {r.doc_id for r in good.select("doc_id").collect()} == kept
    single = p.drop_near_copies(llm, good, folder).toPandas()
    sets = {r.doc_id: plain_shingles(r.text) for r in good.collect()}
    want = plain_groups(sets, 0.8)
    assert single.doc_id.is_unique and set(want.values()) <= set(single.doc_id) and len(set(single.doc_id) - set(want.values())) <= 2
    hidden = p.hide_secrets(llm, good, folder).toPandas()
    assert len(hidden) == len(kept) and not any(plain_spans(t) for t in hidden.text) and (hidden.text.str.len() == hidden.n_chars).all()
    assert hidden.text.str.contains("[SECRET]", regex=False).any()


@pytest.mark.parametrize("packed, slice_", [(300, 400), (500_000, 1_000_000)])
def test_near_copies_with_a_hot_shingle(llm, monkeypatch, packed, slice_):
    """One shingle in every text; copies of texts in many packs, small slices."""
    monkeypatch.setattr(simhash, "PACKED", packed)
    monkeypatch.setattr(simhash, "SLICE", slice_)
    rng = np.random.default_rng(14)
    licence, rows = "this is the licence line", []
    for base in range(60):
        words = [f"b{base}w{x}" for x in rng.integers(0, 50, 60)]
        rows += [" ".join([licence, *words])] * (1 + base % 5) + [" ".join([licence, *words, f"x{base}", f"y{base}"])] * (base % 2)
    rng.shuffle(rows)
    want = plain_groups({i: plain_shingles(t) for i, t in enumerate(dict.fromkeys(rows))}, 0.8)
    frame = llm.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(7)
    found = simhash.near_copies(frame).toPandas()
    assert sorted(found.groupby("root").size()) == sorted(Counter(want.values()).values())


def test_slice_gets_a_hot_shingle_once_per_pack(llm, monkeypatch):
    """One shingle in all of 50,000 texts: its postings grow with the packs, not with the texts."""
    monkeypatch.setattr(simhash, "PACKED", 10_000)
    frame = llm.range(50_000).selectExpr("concat('this is the licence line ', id, ' a', id * 7, ' b', id * 11) AS text").repartition(4)
    rows = simhash.postings(frame, 16, True).where("slice >= 0").toPandas()
    packs, counted = rows["pack"].nunique(), Counter()
    for left, place in zip(rows["left"], rows["place"], strict=True):
        assert len(left) == 3 * len(place)
        counted[np.frombuffer(place, np.uint16).tolist().count(simhash.NO_TEXT)] += 1
    assert 20 <= packs <= 40 and packs - 4 <= sum(k * n for k, n in counted.items()) <= packs  # a last pack may hold one text
    often = simhash.shared_postings(frame, 16, True).toPandas()
    assert len(often) == 50_000 and (often["c"] == 1).all()


def test_run(llm):
    """The whole pipeline: every kept document is packed once, whole, into sequences that hold it."""
    import corpus_pipeline as p

    docs = llm.read.parquet(f"{FOLDER}/documents.parquet")
    got = p.run(llm, FOLDER).toPandas()
    kept = set(p.keep_good(llm, docs, FOLDER).toPandas().doc_id)
    assert 0 < got.doc_id.nunique() <= len(kept) and set(got.doc_id) <= kept
    assert (got.groupby("sequence_id").length.sum() <= 2048).all() and not got.duplicated(["doc_id", "piece"]).any()


def test_toxic_documents_go_whatever_the_columns(llm):
    """The real stage, with a column whose name has a point."""
    import corpus_pipeline as p

    docs = llm.read.parquet("/root/testdata/sf0.1/documents.parquet").selectExpr("*", "doc_id AS `a.b`")
    left = p.drop_toxic(llm, docs, "/root/testdata/sf0.1")
    assert left.columns == docs.columns
    ids = {r.doc_id for r in left.select("doc_id").collect()}
    toxic = {r.doc_id for r in llm.read.parquet("/root/testdata/sf0.1/labels.parquet").where("toxic = 1").collect()}
    fine = {r.doc_id for r in llm.read.parquet("/root/testdata/sf0.1/labels.parquet").where("toxic = 0").collect()}
    assert len(toxic & ids) < 0.35 * len(toxic) and len(fine & ids) > 0.95 * len(fine)


def test_counts_leave_a_slice_in_a_row_per_pack(llm, monkeypatch):
    """Texts that share shingles in many slices: the rows grow with packs and slices, not with texts and slices."""
    monkeypatch.setattr(simhash, "PACKED", 10_000)
    words = [f"w{i}" for i in range(70)]
    rows = [(" ".join([f"a{i}", *words[i % 30 : i % 30 + 40], f"b{i}"]),) for i in range(3000)]
    frame = llm.createDataFrame(rows, "text string").repartition(4)
    made, shuffled = [], type(frame).repartition
    monkeypatch.setattr(type(frame), "repartition", lambda self, n, *by: (made.append(self) if isinstance(by[0], str) and by[0] == "pack" else None, shuffled(self, n, *by))[1])
    often = {r.key: r.c for r in simhash.shared_postings(frame, 16, True).collect()}
    assert len(often) == 3000 and set(often.values()) == {36}
    packs = made[0].select("pack").distinct().count()
    assert made[0].count() <= 17 * packs < 3000 / 4


def test_near_copies_by_fingerprint(llm, monkeypatch):
    """Links of the fingerprints alone: those of 0.8 or more, no others; the second way gets no crowd that they settled."""
    rng = np.random.default_rng(15)
    rows = []
    for base in range(40):
        words = [f"b{base}w{x}" for x in rng.integers(0, 5000, 900)]
        rows += [" ".join(words), " ".join([*words[:-1], "end"]), " ".join([*words, *(f"c{base}w{x}" for x in range(150))])][: 2 + base % 2]
    line = "the same line again and again now "
    rows += [line * 60 + " ".join(f"z{i}w{x}" for x in range(40)) for i in range(5)]  # one fingerprint, few shingles shared
    prints = [simhash.fingerprint(t) for t in rows]
    sets = [plain_shingles(t) for t in rows]
    pairs = {(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3}
    alike = {(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert 30 <= len(alike) < len(pairs)
    seen, made = [], simhash.alike_links
    monkeypatch.setattr(simhash, "alike_links", lambda r, s: (seen.append(r), made(r, s))[1])
    proposed, of_prints = [], simhash.alike_by_fingerprint
    monkeypatch.setattr(simhash, "alike_by_fingerprint", lambda *a: (proposed.append(of_prints(*a)), proposed[-1])[1])
    assert near_roots(llm, rows) == plain_groups(dict(enumerate(sets)), 0.8)
    by = {xxhash.xxh64_intdigest(b" ".join(t.lower().encode().split()), 42): i for i, t in enumerate(rows)}
    got = {tuple(sorted((by[r.a % 2**64], by[r.b % 2**64]), reverse=True)) for r in proposed[0].collect()}
    assert got == alike
    texts = {by[r.key % 2**64] for r in seen[1].select("key").collect()}
    settled = {i for pair in alike for i in pair if rows[i].startswith("b") and int(rows[i][1 : rows[i].index("w")]) % 2 == 0}
    assert len(settled) > 10 and not settled & texts and len(texts) >= 60
