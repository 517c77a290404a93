"""Nulls, empty and very long texts, ties, repeated rows, empty tables, extra columns; hot cells, faults, pruning."""

import bisect
import re
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import language, packing, pieces, quality, secrets, sharding, simhash, topk, toxicity, warc
from tallyloom.llm.common import tokenizer_file
from tallyloom.llm.queries import token_pieces


def test_rules(odd_docs, no_docs, labels):
    counted = quality.with_statistics(odd_docs)
    rows = quality.judge(counted, quality.fit_quality(counted, labels)).collect()
    assert len(rows) == odd_docs.count() and all(r.kept is not None for r in rows)
    null = next(r for r in rows if r.doc_id == 3)
    assert null.rules.n_words == 0 and null.base_failed and not null.kept
    empty = quality.with_statistics(no_docs)
    assert quality.judge(empty, quality.fit_quality(empty, labels)).count() == 0


def test_forest_finds_the_odd():
    rng = np.random.default_rng(1)
    usual = rng.normal(0.2, 0.02, (2000, 3))
    forest = quality.IsolationForest.grow(np.vstack((usual, rng.normal(0.9, 0.02, (40, 3)))))
    assert forest.oddness(np.full((1, 3), 0.9))[0] > np.quantile(forest.oddness(usual), 0.99)
    assert quality.choose_limit([(1, 10, 500), (0, 10, 2), (0, 60, 30), (1, 60, 1)], 100, 0.01) == 0.355
    assert quality.choose_limit([(1, 10, 500)], 100, 0.01) == 2.0
    assert quality.repeated_words("a a a a".split()) == 4 and quality.repeated_words("a b c x a b c".split()) == 6


def test_language(odd_docs, no_docs):
    model = language.fit_languages(odd_docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict_language(odd_docs, model).collect()}
    assert got[3] == got[4] == got[5] == ("und", 0.0) and got[6][0] == "de" and got[1][0] == "en"
    assert language.predict_language(no_docs, model).count() == 0
    none = language.fit_languages(no_docs)
    assert {r.lang_pred for r in language.predict_language(odd_docs, none).collect()} == {"und"}


def test_unknown_words_back_off():
    grams = {"abc": 0, "z": 1}
    model = language.LanguageModel(["p", "q"], {"word": 0}, np.log([[0.9, 0.1]]), grams, np.log([[0.1, 0.9], [0.8, 0.2]]))
    assert model.predict("word", {})[0] == "p" and model.predict("xabcx", {})[0] == "q" and model.predict("yzy", {})[0] == "p"
    assert model.predict("12 - 3", {}) == ("und", 0.0)


def test_toxicity(odd_docs, no_docs, labels, llm):
    letters = "abcdefghij"
    own = lambda i: " ".join("".join(letters[int(c)] for c in str(i * 1000 + k * 37)) for k in range(40))
    plain = [(i, f"calm words about gardens and rivers of the north {own(i)}", "en") for i in range(200)]
    foul = [(1000 + i, f"calm words about you {w} worm and {w} fool gardens of the north {own(1000 + i)}", "en") for i, w in enumerate(["nasty", "vile"] * 60)]
    docs = llm.createDataFrame(plain + foul, "doc_id long, text string, lang string")
    marks = llm.createDataFrame([(i, int(i >= 1000)) for i, *_ in plain + foul], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, marks)
    got = {r.doc_id: r.score for r in toxicity.with_toxicity(docs, model).collect()}
    assert min(s for i, s in got.items() if i >= 1000) > 0.3 > max(s for i, s in got.items() if i < 1000)
    scored = toxicity.with_toxicity(odd_docs, model)
    assert scored.columns.count("score") == 1 and all(0 <= r.score < 0.3 for r in scored.collect())
    nothing = toxicity.fit_toxicity(no_docs, labels)
    assert nothing.weights is None and {r.score for r in toxicity.with_toxicity(odd_docs, nothing).collect()} == {0.0}
    assert toxicity.with_toxicity(no_docs, model).count() == 0


def test_curve_keeps_the_share_of_toxic_rows(llm, monkeypatch):
    """A bounded sample must not raise the scores, and the pipeline's stage drops by the operator's limit."""
    rng = np.random.default_rng(8)
    x, y = np.r_[rng.normal(0, 1, 20_000), rng.normal(2, 1, 200)][:, None], np.r_[np.zeros(20_000), np.ones(200)]
    some = np.r_[0:1000, 20_000:20_200]
    whole, part = toxicity.logistic(x, y), toxicity.logistic(x[some], y[some], stands_for=np.where(y[some] == 1, 1, 20))
    assert np.abs(whole - part).max() < 0.5
    seen, fit = [], toxicity.logistic
    monkeypatch.setattr(toxicity, "logistic", lambda *a, **b: seen.append(b["stands_for"]) or fit(*a, **b))
    own = lambda: " ".join("".join(rng.choice(list("ghijkl"), 7)) for _ in range(20))
    rows = [(i, own() + (" vile fool" if i >= 800 else ""), int(i >= 800)) for i in range(1000)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, toxic int")
    toxicity.fit_toxicity(docs.drop("toxic"), docs.drop("text"), fit_texts=100)
    assert set(seen[0]) == {2.0}
    scored = docs.select("doc_id", "text", (F.col("doc_id") / 1000).alias("__p"))
    monkeypatch.setattr(toxicity, "fit_toxicity", lambda *a: None)
    monkeypatch.setattr(toxicity, "with_toxicity", lambda df, model, name: df.withColumn(name, F.col("__p")))
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: None)
    assert corpus_pipeline.drop_toxic(llm, scored, "").count() == 300


def test_simhash(odd_docs, no_docs):
    got = simhash.simhash_components(odd_docs).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == odd_docs.count() and by[1][0].component_id == by[2][0].component_id == 1
    assert by[3][0].fingerprint == "0" * 16 and by[3][0].component_id == by[4][0].component_id == by[5][0].component_id == 3
    assert simhash.simhash_components(no_docs).count() == 0


@pytest.mark.parametrize("cell", [4096, 16])
def test_links_are_complete(llm, monkeypatch, cell):
    """A dense ball, chains and random prints; small cells force the cut into chunks."""
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = np.random.default_rng(5)
    base = int(rng.integers(1 << 62))
    prints = {base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False)) for _ in range(300)}
    prints |= {int(x) for x in rng.integers(1 << 62, size=300)}
    chain = [int(rng.integers(1 << 62))]
    for i in range(20):
        chain.append(chain[-1] ^ (7 << (3 * i)))
    prints = sorted(prints | set(chain))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    got = {r.fp: r.component_id for r in simhash.near_groups(llm.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")).collect()}
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = root[i], root[j]
                if a != b:
                    root = [min(a, b) if x in (a, b) else x for x in root]
    assert [got[s] for s in signed] == root


def test_unary_codes_bound_the_distance():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 1 << 63, (2, 500), dtype=np.uint64)
    pairs = lambda x: np.stack([np.bitwise_count((x >> np.uint64(2 * s)) & np.uint64(3)).astype(int) for s in range(32)])
    manhattan = np.abs(pairs(a) - pairs(b)).sum(0)
    assert (np.bitwise_count(simhash.unary_counts(a) ^ simhash.unary_counts(b)) == manhattan).all()
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


def test_packing(odd_docs, no_docs):
    packed, report = packing.pack_documents(token_pieces(odd_docs))
    rows = packed.collect()
    assert sum(r.length == 1 for r in rows) >= 3 and report["sequences"] == len({r.sequence_id for r in rows}) >= report["bound"]
    assert packing.pack_documents(token_pieces(no_docs))[0].count() == 0


def test_packing_exchange(llm):
    rng = np.random.default_rng(3)
    lengths = [int(x) for x in rng.integers(1, 2048, 6000)] + [2048] * 5
    items = llm.createDataFrame(list(enumerate(lengths)), "rid long, length long")
    places, report = packing.pack_lengths(items, group_rows=500)
    rows = places.join(items, "rid").collect()
    fill = {}
    for r in rows:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(rows) == len(lengths) and len(fill) == report["sequences"]
    for own in fill.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 2048
    single = len(packing.best_fit(np.array(lengths), 2048)[2])
    assert report["bound"] <= single and report["sequences"] <= single * 1.03


def test_bound():
    count = np.zeros(11, int)
    count[[6, 5, 4]] = [3, 2, 1]
    assert packing.bins_needed(count) == 4
    count = np.zeros(2049, int)
    count[683] = 6
    assert packing.bins_needed(count) == 3
    assert packing.bins_needed(np.zeros(11, int)) == 0


def test_end_mark_in_text():
    from tokenizers import Tokenizer

    coder = packing.encoder(tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    plain = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    for t in ("a<|endoftext|>b", "  x\n\n y\t\tz ", "don't we'LL 12³ ½ é😀‍", "\x00  \x85", "'s 'S", "a" * 300):
        assert coder.encode(t, allowed_special="all") == plain.encode(t, add_special_tokens=False).ids


def test_pieces(odd_docs, no_docs):
    path = tokenizer_file("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = pieces.with_pieces(odd_docs.drop("ids"), path).collect()
    for r in rows:
        assert r.ids == model.encode(r.text or "") and r.decoded == model.decode(r.ids)
    assert pieces.with_pieces(no_docs, path).count() == 0


def test_pieces_of_strange_texts():
    path = tokenizer_file("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    vocabulary = pieces.Vocabulary.load(path)
    rng = np.random.default_rng(4)
    letters = list("aabbcdeeehilnorstt  ▁\n\t.,=-—éß中文😀́") + ["the", "ing", "====", "    ", "\n\n", "aaaa"]
    texts = ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(3000)] + ["a" * 5000, " " * 999, "=" * 777, "-=" * 500]
    ids, ends = pieces.Encoder(vocabulary).encode(texts)
    own = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
    assert own == model.encode(texts)
    assert pieces.decode_flat(vocabulary, ids, ends).to_pylist() == model.decode(own)
    for _ in range(300):
        some = rng.integers(0, 400, rng.integers(0, 12)).tolist()
        assert pieces.decode_ids(vocabulary, some) == model.decode(some)


def test_secrets(odd_docs, no_docs, llm):
    assert secrets.with_secrets(no_docs).count() == 0
    assert all(r.secrets == [] for r in secrets.with_secrets(odd_docs).collect())
    key, token = "AKIA" + "Q7" * 8, "aB3dE6gH9jK2mN5pQ8sT"
    texts = [
        f"😀 {key}", f"{key} then {token} at https://store.example/x", token, f"{key}{' x' * 200} {token}", 'secret:token:abcdefg', 'PassWord = "abc" api_key:"abcdef"',
        "https://store.example/x", f"user=bob {token} jdbc:mysql://h/db", "f" * 23, "f" * 24 + "g" + "0" * 30, "password=abcde", "token=" + "x" * 40 + " secret : zzzzzz",
    ]
    rows = secrets.with_secrets(llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: r.s for r in rows.select("doc_id", secrets.written(F.col("secrets")).alias("s")).collect()}
    assert got[0] == "access:2:22" and got[1] == "access:0:20,secret:26:46,endpoint:50:73"
    assert got[2] == "" and got[3] == "access:0:20" and got[4] == "" and got[6] == "" and got[8] == "" and got[10] == ""
    assert got[5] == "assign:17:32"
    assert got[7] == "login:0:8,secret:9:29,endpoint:30:47" and got[9] == "hex:0:24,hex:25:55" and got[11].count("assign") == 2
    hidden = rows.select("doc_id", secrets.masked(F.col("text"), F.col("secrets")).alias("t")).collect()
    assert hidden[1].t == "[SECRET] then [SECRET] at [SECRET]" and hidden[0].t == "😀 [SECRET]"


def test_secrets_run_no_python(odd_docs):
    plan = secrets.with_secrets(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_hilbert_curve():
    bits = 4
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * 3, indexing="ij"), -1).reshape(-1, 3)
    index = sharding.hilbert_index(grid, bits)
    walk = grid[np.argsort(index)]
    assert sorted(index) == list(range(len(grid))) and (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_shards(odd_docs, no_docs, llm, tmp_path):
    got = sharding.hilbert_shards(odd_docs, ["lang", "source", "n_chars"], 3, ["doc_id"]).collect()
    assert sorted(r.shard for r in got).count(0) in (3, 4) and len(got) == odd_docs.count()
    assert sharding.hilbert_shards(no_docs, ["lang", "n_chars"], 3).count() == 0
    points = llm.range(4096).select((F.col("id") % 64).alias("x"), F.floor(F.col("id") / 64).alias("y"))
    placed = sharding.hilbert_shards(points, ["x", "y"], 64, ["x", "y"], bits=6).persist()
    ranges = sharding.shard_ranges(placed, ["x", "y"])
    assert sharding.shards_matching(ranges, {"x": (0, 7), "y": (0, 63)}).count() <= 24
    sharding.write_shards(placed, str(tmp_path / "out"), 64)
    assert llm.read.parquet(str(tmp_path / "out")).where("shard = 5").count() == 64


def test_topk(llm):
    rows = [(i, [0.1 * (i % 7), -0.3, float(i % 5)], 1) for i in range(200)] + [(20, [1.0, 2.0], 1), (40, None, 1), (60, [float("nan")] * 3, 1), (80, [None, 1.0, 2.0], 1)]
    rows += [(0, [0.0, -0.3, 0.0], 1)] * 3 + [(None, [1.0, 1.0, 1.0], 2), (7, [float("inf"), 1.0, 1.0], 2)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in topk.exact_topk(df, F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    clean = {(i, tuple(int(np.floor(64 * x)) for x in v)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    for q, v in clean:
        if q % 20 == 0 and len(v) == 3:
            other = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in clean if i != q and len(w) == 3))[:20]
            assert got[q] == [(i, -s) for s, i in other]
    assert topk.exact_topk(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_topk_blocks(llm, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_CELLS", 1 << 10)
    monkeypatch.setattr(topk, "QUERY_ROWS", 8)
    v = np.random.default_rng(6).normal(size=(500, 16))
    df = llm.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {}
    for r in topk.exact_topk(df, F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    w = np.floor(64 * v).astype(int)
    for q in range(0, 500, 20):
        score = w @ w[q]
        assert got[q] == [(i, score[i]) for i in sorted((i for i in range(500) if i != q), key=lambda i: (-score[i], i))[:20]]


def test_warc(llm, tmp_path):
    big = "x" * 3000
    rows = [(1, "http://a/\r\nX: 1", big), (2, None, big), (2, None, big), (3, "http://b", None), (4, "http://b", "é" * 600), (None, "http://c", big), (5, "http://d", "y\r\n\r\nWARC/1.1\r\n")]
    pages = llm.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, record_type string")
    path = str(tmp_path / "a")
    back = warc.archived(warc.page_records(pages), path)
    got = sorted((r.record_id, r.record_type, r.refers_to, r.payload_bytes) for r in back.collect())
    assert len(got) == len(rows) and got.count(("urn:page:2", "response", None, 3000)) == 2
    assert ("urn:page:1", "revisit", "urn:page:2", 3000) in got and ("urn:page:", "revisit", "urn:page:2", 3000) in got
    assert ("urn:page:3", "response", None, 0) in got and ("urn:page:4", "response", None, 1200) in got
    only = back.where("record_type = 'revisit' and target_uri like 'http://c%'")
    assert [r.record_id for r in only.collect()] == ["urn:page:"]
    bare = llm.read.format("warc").option("payload", "false").option("splitBytes", "1").load(path)
    assert bare.count() == len(rows) and bare.where("payload is not null").count() == 0
    assert {bytes(r.payload) for r in back.where("record_id = 'urn:page:5'").collect()} == {b"y\r\n\r\nWARC/1.1\r\n"}
    assert warc.archived(warc.page_records(pages.limit(0)), str(tmp_path / "b")).count() == 0


def test_warc_of_others(llm, tmp_path):
    """Plain records and gzip members without lengths, no manifest."""
    import gzip

    one = warc.record({"record_type": "response", "record_id": "r1", "payload": b"p" * 70_000}, "now")
    two = warc.record({"record_type": "resource", "record_id": "r2", "payload": b"q" * 10}, "now")
    (tmp_path / "a.warc").write_bytes(one + two + one)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two) + warc.member(two, 6))
    (tmp_path / "junk.txt").write_bytes(b"no archive")
    back = llm.read.format("warc").load(str(tmp_path))
    assert sorted((r.record_id, len(r.payload)) for r in back.collect()) == [("r1", 70_000)] * 3 + [("r2", 10)] * 3
    assert back.where("record_type = 'resource'").count() == 3


def test_first_stage_keeps_extra_columns(llm):
    """Extra columns may have the names that the stage's own counts have elsewhere."""
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = docs
    for name in ("rules", "oddness", "base_failed", "kept"):
        odd = odd.withColumn(name, F.lit("own"))
    out = corpus_pipeline.keep_good(llm, odd, "/root/testdata/sf0.001")
    assert out.columns == odd.columns and {tuple(r[-4:]) for r in out.collect()} == {("own",) * 4}
    assert out.count() == corpus_pipeline.keep_good(llm, docs, "/root/testdata/sf0.001").count() > 0


def test_pipeline_edges(llm, tmp_path, odd_docs, no_docs):
    empty = str(tmp_path / "sf")
    llm.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    for docs in (odd_docs.drop("score", "ids"), no_docs):
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(llm, docs, empty)
            assert out.columns == docs.columns
            out.count()
    out = corpus_pipeline.drop_near_copies(llm, odd_docs, empty).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(["1", "3", "6", "7", "8", "None"])
    assert corpus_pipeline.pack(llm, no_docs, empty).count() == 0


def test_letters_of_languages(llm):
    """Numbers and signs are no letters; marks belong to their word, in learning and prediction alike."""
    hindi, plain = "यह हिन्दी में लिखा गया वाक्य है और दूसरा वाक्य भी", "this is an english sentence and another one"
    rows = [(i, hindi, "hi") for i in range(40)] + [(100 + i, plain, "en") for i in range(40)]
    model = language.fit_languages(llm.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert "हिन्दी" in model.words and len(language.LETTERS.findall("हिन्दी")) == 1
    odd = ["½ ² ①", "Ⅷ", "12 34", "́ ́", "_", "", "हिन्दी", "sentence Ⅷ"]
    got = [model.predict(t, {}) for t in odd]
    assert [g[0] for g in got] == ["und"] * 6 + ["hi", "en"] and all(0 <= g[1] <= 1 for g in got)


def test_secrets_of_one_long_text_cost_little_and_equal_a_plain_sweep(llm):
    """Thousands of logins and passwords in one text: the join looks into few runs, and loses none."""
    parts = [f"user=name{i} {'x ' * (i % 150)}password=abc{i:06d} https://h{i}.example/{'y ' * (i % 190)}" for i in range(9000)]
    text = "\n".join(parts)
    assert len(text) > 1_000_000
    rows = secrets.with_secrets(llm.createDataFrame([(1, text)], "doc_id long, text string"))
    began = time.monotonic()
    found = [(s.start, s.rank, s.end) for s in rows.collect()[0].secrets]
    took = time.monotonic() - began
    strong = [(m.start(), 0, m.end()) for m in re.finditer(r"password=abc\d{6}", text)]
    logins = [(m.start(), 4, m.end()) for m in re.finditer(r"user=name\d+", text)]
    addresses = [(m.start(), 5, m.end()) for m in re.finditer(r"https://\S+", text)]

    def close(span, starts, others):
        i = bisect.bisect_left(starts, span[0] - secrets.SCOPE - 100)
        near = [o for o in others[i : i + 40] if o[0] <= span[2] + secrets.SCOPE and span[0] <= o[2] + secrets.SCOPE]
        return bool(near)

    with_secret = [s for s in logins if close(s, [o[0] for o in strong], strong)]
    named = [s for s in addresses if close(s, [o[0] for o in logins], logins) and close(s, [o[0] for o in strong], strong)]
    assert 0 < len(with_secret) < len(logins)
    assert found == sorted(strong + with_secret + named)
    assert took < 20
