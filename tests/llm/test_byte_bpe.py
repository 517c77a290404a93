"""Byte-level pairs against the library that the vocabulary was made for."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
from tallyloom.llm import byte_bpe

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library(path):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.loaded(path).ranks, special_tokens={})


def listed(ids):
    return np.frombuffer(ids, "<u4").tolist()


def strange_texts():
    rng, tokens = random.Random(5), list(byte_bpe.loaded(PATH).ranks)
    texts = ["", " ", "\n\n \t x", "<|endoftext|>", "it's 'll", "a" * 60_000, "ab" * 30_000, "= " * 9000, "\x00\x1c\x85\xa0　x", "é😀漢字" * 50, "�́"]
    for _ in range(300):
        texts.append(b"".join(rng.choices(tokens, k=rng.randint(1, 30))).decode("utf-8", "replace"))
        texts.append("".join(rng.choices("abeintrs", k=rng.randint(1, 600))))
        texts.append("".join(chr(rng.choice([97, 32, 0xE9, 0x4E00 + rng.randint(0, 5000), 10, 9, 45, 61])) for _ in range(200)))
    return texts


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
@pytest.mark.parametrize("stretch, known", [(200_000, 48 << 20), (37, 5000)])
def test_encoder(monkeypatch, name, stretch, known):
    """Strange texts, words long enough to matter, both vocabularies; small stretches and a small memory change nothing."""
    monkeypatch.setattr(byte_bpe, "STRETCH", stretch)
    monkeypatch.setattr(byte_bpe, "KNOWN_BYTES", known)
    path, texts = public_tokenizers.path(name), strange_texts()
    encoder, plain = byte_bpe.Encoder(byte_bpe.loaded(path), public_tokenizers.PATTERN), library(path)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert listed(ids) == plain.encode_ordinary(text) and encoder.merges.decode(listed(ids)) == text.encode()


def test_better_rank_after_a_merge():
    """A merge may give rise to a pair of a better rank; the word's other places wait for it."""
    ranks = {bytes([b]): b + 100 for b in range(256)} | {b"xab": 1, b"abx": 2, b"ab": 50, b"bx": 60, b"xa": 61, b"abab": 3}
    merges, plain = byte_bpe.Merges(ranks), tiktoken.Encoding("own", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    words = ["".join(rng.choices("abx", k=rng.randint(2, 40))) for _ in range(500)]
    for word, ids in zip(words, merges.replay([w.encode() for w in words]), strict=True):
        assert word.encode() in ranks or ids.tolist() == plain.encode_ordinary(word)


def test_query(llm):
    got = entry.queries()["op13_byte_bpe"](llm, FOLDER).toPandas().set_index("doc_id")
    plain = library(PATH)
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs) and got.index.is_unique
    for r in docs:
        ids = plain.encode_ordinary(r.text or "")
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(plain.decode_bytes(ids)).hexdigest())
        assert tuple(got.loc[r.doc_id, ["n_tokens", "ids_sha256", "decoded_sha256"]]) == want


def test_edges(odd_docs, no_docs):
    out = byte_bpe.with_byte_bpe(odd_docs, PATH, public_tokenizers.PATTERN)
    assert out.columns == [*[c for c in odd_docs.columns if c != "ids"], "ids", "decoded"]
    plain, rows = library(PATH), out.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert listed(bytes(r.ids)) == plain.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert byte_bpe.with_byte_bpe(no_docs, PATH, public_tokenizers.PATTERN).collect() == []


def test_words_in_use_are_not_merged_again(monkeypatch):
    """A memory full of words seen once keeps those of every text."""
    monkeypatch.setattr(byte_bpe, "STRETCH", 50)
    monkeypatch.setattr(byte_bpe, "KNOWN_BYTES", 60_000)
    merged, replayed = [], byte_bpe.Merges.replayed
    monkeypatch.setattr(byte_bpe.Merges, "replayed", lambda self, words: (merged.extend(words), replayed(self, words))[1])
    encoder, plain = byte_bpe.Encoder(byte_bpe.loaded(PATH), public_tokenizers.PATTERN), library(PATH)
    texts = [" ".join(["zxqvutter", "wqxylophine", *(f"q{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}xzqv{chr(97 + k)}jk" for k in range(26))]) for i in range(200)]
    assert [listed(ids) for ids in encoder.encode(texts)] == [plain.encode_ordinary(t) for t in texts]
    assert len(merged) > 5000 and merged.count(b" wqxylophine") == 1
    assert len(encoder.known) + len(encoder.older) < 1500
