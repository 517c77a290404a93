"""One query per operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import byte_bpe, language, packing, phrases, pieces, quality, secrets, sharding, simhash, topk, toxicity, variants, warc
from tallyloom.llm.common import fold, table, tokenizer_file
from tallyloom.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    back = warc.archived(warc.page_records(table(spark, folder, "pages")))
    number = lambda c: F.nullif(F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1), F.lit("")).cast("long")
    response = F.col("record_type") == "response"
    return back.select(
        number("record_id").alias("page_id"), F.when(response, F.length("payload")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"),
    )


ORACLES["op1_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
     f AS (SELECT payload_digest, payload_bytes, max(page_id) AS first FROM d WHERE payload_bytes >= 1000 GROUP BY 1, 2)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first IS NOT NULL AND d.page_id IS DISTINCT FROM f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first IS NOT NULL AND d.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest, payload_bytes)
"""


@query
def op2_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id", "lang", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    sharded = sharding.hilbert_shards(docs, ["lang", "source", "size"], 40, ["doc_id", "text_crc32", "size"])
    return sharded.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.exact_topk(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20, 64)


ORACLES["op3_exact_topk"] = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
"""


@query
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_components(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def token_pieces(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return packing.token_pieces(docs, tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed, _ = packing.pack_documents(token_pieces(table(spark, folder, "documents")))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = language.fit_languages(docs.where(~held_out))
    return language.predict_language(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = pieces.with_pieces(docs, tokenizer_file("piece_bpe_32k.model"))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.with_secrets(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    number = lambda rank: F.size(F.filter("secrets", lambda s: s["rank"] == rank)).cast("long")
    base = secrets.written(F.filter("secrets", lambda s: s["rank"] < 3))
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), secrets.written(F.col("secrets")).alias("spans"),
    )


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = toxicity.fit_toxicity(docs.where(~held_out), table(spark, folder, "labels"))
    scored = toxicity.with_toxicity(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.LIMIT).cast("int").alias("predicted"))


@query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    counted = cut_lineage(quality.with_statistics(table(spark, folder, "documents").select("doc_id", "text")).drop("text"))
    model = quality.fit_quality(counted, table(spark, folder, "labels"))
    judged = quality.judge(counted, model)
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *[F.col(f"rules.{c}").alias(c) for c in shown], "base_failed", "kept")


@query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling_variants(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents").select("doc_id", "text", "lang"))


ORACLES["op12_collocations"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, unnest([{'m': m, 'phrase': array_to_string(w[i:i + m - 1], ' ')} FOR i IN range(1, len(w) + 1)]) AS g
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m),
c AS (SELECT lang, g.m AS m, g.phrase AS phrase, count(*) AS a FROM g WHERE len(string_split(g.phrase, ' ')) = g.m GROUP BY 1, 2, 3),
t AS (SELECT lang, sum(a)::BIGINT AS n FROM c WHERE m = 1 GROUP BY 1),
f AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM c WHERE a >= 30),
x AS (SELECT lang, m, phrase, a, w, unnest(range(1, m)) AS k FROM f WHERE m > 1),
s AS (SELECT x.lang, x.phrase, x.a, x.k, l.a AS l, r.a AS r, (2000000::HUGEINT * x.a) // (l.a::HUGEINT + r.a) AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.w[1:x.k], ' ')
             JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.w[x.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, a, array_to_string(w[i:i + m2 - 1], ' ') AS phrase
      FROM (SELECT lang, m, a, w, m2, unnest(range(1, m - m2 + 2)) AS i FROM f, (SELECT unnest([2, 3]) AS m2) WHERE m > m2)),
z AS (SELECT lang, phrase, max(a) AS a FROM o GROUP BY 1, 2),
k AS (SELECT b.* FROM b LEFT JOIN z ON z.lang = b.lang AND z.phrase = b.phrase WHERE z.a IS NULL OR 100::HUGEINT * z.a < 80::HUGEINT * b.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, k.phrase) AS rank, k.phrase, k.a, k.l, k.r, t.n, k.score::BIGINT AS score
FROM k JOIN t ON t.lang = k.lang QUALIFY rank <= 2000
"""


@query
def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = byte_bpe.with_byte_bpe(docs, tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
