"""Queries for record linkage, text vectors and neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import fuzzy, linkage, names, neighbours, text_features
from tallyloom.plans.q_behaviour import END, NORM, days
from tallyloom.plans.registry import query

# Single letters only, so that byte-wise and letter-wise comparisons agree.
LATIN = "translate({c}, 'абвгдеёжзийклмнопрстуфхцчшщъыьэюя', 'abvgdee2zijklmnoprstufhc4w5678eyq')"
CLEAN = f"""clean0 AS (SELECT unique_id, {', '.join(f"replace(lower(regexp_replace(trim(coalesce({c}, '')), '\\s+', ' ', 'g')), 'ё', 'е') AS {c}" for c in linkage.NAME_FIELDS)},
 coalesce(try_strptime(birthdate, '%Y-%m-%d')::DATE, DATE '1900-01-01')::VARCHAR AS birthdate, coalesce(gender, '') AS gender, coalesce(passport, '') AS passport, coalesce(inn, '') AS inn FROM persons),
clean AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY surname, name, fathername, birthdate, passport, inn ORDER BY unique_id) AS rn FROM clean0) AS r WHERE rn = 1),
rec AS (SELECT unique_id, {', '.join(f"nullif({LATIN.format(c=c)}, '') AS {c}" for c in linkage.NAME_FIELDS)}, birthdate, nullif(passport, '') AS passport, nullif(inn, '') AS inn, nullif(gender, '') AS gender FROM clean)"""


def cleaned(t):
    return linkage.clean_persons(t.persons).withColumn("birthdate", F.col("birthdate").cast("string"))


def records(t):
    latin = cleaned(t).withColumns({c: F.expr(LATIN.format(c=c)) for c in linkage.NAME_FIELDS})
    return linkage.blanks_to_null(latin).select("unique_id", *linkage.FIELDS)


@query("clean_persons", f"WITH {CLEAN} SELECT * FROM clean", uses="persons")
def _(t):
    return cleaned(t)


AGREE = [" AND ".join(f"l.{f} = r.{f}" for f in rule) for rule in linkage.RULES]
PAIRS = "pairs AS (SELECT l.unique_id AS id_l, r.unique_id AS id_r, " + ", ".join(f"l.{f} AS {f}_l, r.{f} AS {f}_r" for f in linkage.FIELDS) + \
    ", CASE " + " ".join(f"WHEN {a} THEN {i}" for i, a in enumerate(AGREE)) + " END AS rule FROM rec l JOIN rec r ON l.unique_id < r.unique_id AND (" + " OR ".join(AGREE) + "))"


@query("blocking_pairs", f"WITH {CLEAN}, {PAIRS} SELECT id_l, id_r, rule FROM pairs", uses="persons")
def _(t):
    return linkage.blocking_pairs(records(t)).select("id_l", "id_r", "rule")


def gamma_sql(f: str) -> str:
    missing = f"WHEN {f}_l IS NULL OR {f}_r IS NULL THEN -1"
    if f in linkage.NAME_FIELDS:
        jw = f"jaro_winkler_similarity({f}_l, {f}_r)"
        return f"CASE {missing} WHEN {f}_l = {f}_r THEN 4 WHEN {jw} >= 0.92 THEN 3 WHEN {jw} >= 0.88 THEN 2 WHEN {jw} >= 0.7 THEN 1 ELSE 0 END"
    if f == "birthdate":
        gap = f"abs(date_diff('day', {f}_l::DATE, {f}_r::DATE))"
        return f"CASE {missing} WHEN {f}_l = {f}_r THEN 4 WHEN {gap} <= 1 THEN 3 WHEN {gap} <= 30.4375 THEN 2 WHEN {gap} <= 365.25 THEN 1 ELSE 0 END"
    return f"CASE {missing} WHEN {f}_l = {f}_r THEN 1 ELSE 0 END"


GAMMAS = [f"gamma_{f}" for f in linkage.FIELDS]
COMPARED = "compared AS (SELECT *, " + ", ".join(f"cast({gamma_sql(f)} AS int) AS gamma_{f}" for f in linkage.FIELDS) + " FROM pairs)"


@query("compare_pairs", f"WITH {CLEAN}, {PAIRS}, {COMPARED} SELECT id_l, id_r, {', '.join(GAMMAS)} FROM compared", uses="persons")
def _(t):
    return linkage.compare_pairs(linkage.blocking_pairs(records(t))).select("id_l", "id_r", *GAMMAS)


# Fixed example weights (log2) per level, lowest level first.
WEIGHTS = {
    "surname": [-4.0, -1.0, 1.5, 3.0, 4.0],
    "name": [-3.0, -1.0, 1.0, 2.0, 3.0],
    "fathername": [-3.0, -0.5, 0.5, 1.5, 2.5],
    "birthdate": [-5.0, -2.0, 0.5, 3.0, 6.0],
    "passport": [-6.0, 12.0],
    "inn": [-6.0, 11.0],
    "gender": [-3.0, 1.0],
}
SCORED = "scored AS (SELECT id_l, id_r, log2(0.001 / 0.999) + " + " + ".join(
    "CASE gamma_" + f + " " + " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(ws)) + " ELSE 0 END" for f, ws in WEIGHTS.items()
) + " AS match_weight FROM compared), prob AS (SELECT *, 2 ** match_weight / (1 + 2 ** match_weight) AS match_probability FROM scored)"


@query("score_pairs", f"WITH {CLEAN}, {PAIRS}, {COMPARED}, {SCORED} SELECT * FROM prob", rounds="match_weight match_probability", uses="persons")
def _(t):
    compared = linkage.compare_pairs(linkage.blocking_pairs(records(t)))
    return linkage.score_pairs(compared, WEIGHTS, 0.001).select("id_l", "id_r", "match_weight", "match_probability")


CLUSTERS = """WITH RECURSIVE {head}, e AS (SELECT id_l AS a, id_r AS b FROM prob WHERE match_probability >= 0.95 UNION SELECT id_r, id_l FROM prob WHERE match_probability >= 0.95),
 reach(id, r) AS (SELECT DISTINCT a, a FROM e UNION SELECT reach.id, e.b FROM reach JOIN e ON reach.r = e.a), clusters AS (SELECT id, min(r) AS cluster_id FROM reach GROUP BY id)"""
CLUSTER_HEAD = CLUSTERS.format(head=f"{CLEAN}, {PAIRS}, {COMPARED}, {SCORED}")


@query("cluster_pairs", f"{CLUSTER_HEAD} SELECT * FROM clusters", uses="persons")
def _(t):
    """Stricter candidate rules than the SQL side's, and the same clusters."""
    compared = linkage.deciding_pairs(records(t), WEIGHTS, 0.001)
    return linkage.cluster_pairs(linkage.score_pairs(compared, WEIGHTS, 0.001))


@query("canonical_per_cluster", f"{CLUSTER_HEAD} SELECT min(unique_id) AS unique_id, coalesce(cluster_id, unique_id)::VARCHAR AS cluster_id FROM rec LEFT JOIN clusters ON unique_id = id GROUP BY 2", uses="persons")
def _(t):
    people = records(t)
    compared = linkage.deciding_pairs(people, WEIGHTS, 0.001)
    clusters = linkage.cluster_pairs(linkage.score_pairs(compared, WEIGHTS, 0.001))
    return linkage.canonical_per_cluster(people, clusters).select("unique_id", "cluster_id")


@query("dedup_persons_fixed", f"""{CLUSTER_HEAD.replace("clean AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY surname, name, fathername, birthdate, passport, inn ORDER BY unique_id) AS rn FROM clean0) AS r WHERE rn = 1)", "clean AS (SELECT * FROM clean0)")}
 SELECT count(*) AS n, count(DISTINCT coalesce(cluster_id, unique_id)) AS clusters, cast(sum(coalesce(cluster_id, unique_id)) AS bigint) AS checksum FROM rec LEFT JOIN clusters ON unique_id = id""", uses="persons")
def _(t):
    """The whole job with given weights, without the cleaning's own removal of copies."""
    from tallyloom.functions.text import normalize_person_name
    from tallyloom.operators.rows import birthdate_parse, person_fill

    people = person_fill(t.persons, linkage.NAME_FIELDS).withColumns({c: normalize_person_name(F.col(c)) for c in linkage.NAME_FIELDS})
    people = people.withColumn("birthdate", birthdate_parse(F.col("birthdate")).cast("string"))
    people = people.withColumns({c: F.expr(LATIN.format(c=c)) for c in linkage.NAME_FIELDS})
    clusters, _ = linkage.dedup_persons(people, WEIGHTS, 0.95, 0.001, adjust=())
    full = people.select("unique_id").join(clusters, F.col("unique_id") == F.col("id"), "left")
    cluster = F.coalesce("cluster_id", "unique_id")
    return full.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(cluster).alias("clusters"), F.sum(cluster).alias("checksum"))


@query("dedup_persons")
def _(t):
    """With trained weights: rows in, rows out, clusters of more than one record."""
    people = cleaned(t)
    clusters, kept = linkage.dedup_persons(people)
    sizes = clusters.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    rows_in = people.agg(F.lit("rows_in").alias("what"), F.count(F.lit(1)).alias("n"))
    return rows_in.unionByName(kept.agg(F.lit("rows_out").alias("what"), F.count(F.lit(1)).alias("n"))).unionByName(
        sizes.agg(F.lit("clusters").alias("what"), F.count(F.lit(1)).alias("n"))
    )


ALL_PAIRS = "pairs AS (SELECT " + ", ".join(f"l.{f} AS {f}_l, r.{f} AS {f}_r" for f in linkage.FIELDS) + " FROM rec l JOIN rec r ON l.unique_id < r.unique_id)"
LEVELS_SQL = " UNION ALL ".join(f"SELECT '{f}' AS field, gamma_{f} AS level FROM compared WHERE gamma_{f} >= 0" for f in linkage.FIELDS)


@query("estimate_u", f"WITH {CLEAN}, {ALL_PAIRS}, {COMPARED}, lv AS ({LEVELS_SQL}), c AS (SELECT field, level, count(*) AS n FROM lv GROUP BY ALL) SELECT field, level, n / sum(n) OVER (PARTITION BY field) AS share FROM c", rounds="share", digits=9, uses="persons")
def _(t):
    return linkage.estimate_u(records(t))


TRAINED = "pairs AS (" + " UNION ALL ".join(
    f"SELECT {i} AS rule, " + ", ".join(f"l.{f} AS {f}_l, r.{f} AS {f}_r" for f in linkage.FIELDS) + " FROM rec l JOIN rec r ON l.unique_id < r.unique_id AND " + " AND ".join(f"l.{f} = r.{f}" for f in rule)
    for i, rule in enumerate(linkage.TRAINING_RULES)) + ")"


@query("agreement_patterns", f"WITH {CLEAN}, {TRAINED}, {COMPARED} SELECT rule, {', '.join(GAMMAS)}, count(*) AS n FROM compared GROUP BY ALL", uses="persons")
def _(t):
    """Pairs of each training rule by their levels, counted without forming them."""
    rows = [(i, *levels, n) for i, found in enumerate(linkage.training_patterns(records(t))) for levels, n in found]
    return t.spark.createDataFrame(rows, "rule int, " + ", ".join(f"{g} int" for g in GAMMAS) + ", n long")


@query("em_match_weights")
def _(t):
    weights = linkage.train_weights(records(t))
    rows = [(f, level, float(w)) for f, ws in weights.items() for level, w in enumerate(ws)]
    return t.spark.createDataFrame(rows, "field string, level int, weight double")


# --- names -------------------------------------------------------------------------------------


NAME_COUNTS = """nc AS (SELECT term, count(*) AS n FROM (SELECT replace(replace(trim(surname), 'ё', 'е'), 'Ё', 'Е') AS term FROM persons
 UNION ALL SELECT replace(name, 'ё', 'е') FROM persons) AS u GROUP BY term)"""


def counts_of(t):
    return names.value_counts_union(t.persons.select(F.col("surname").alias("x")), t.persons.select(F.col("name").alias("x")), "x")


@query("value_counts_union", f"WITH {NAME_COUNTS} SELECT * FROM nc", uses="persons")
def _(t):
    return counts_of(t)


@query("merge_frequencies", f"""WITH {NAME_COUNTS}, ext AS (SELECT DISTINCT fathername AS term FROM persons WHERE fathername IS NOT NULL UNION SELECT replace(name, 'ё', 'е') FROM persons)
 SELECT coalesce(ext.term, nc.term) AS term, CASE WHEN ext.term IS NULL THEN 0 ELSE 1 END + 10 * coalesce(n, 0) AS freq FROM nc FULL JOIN ext ON nc.term = ext.term""", uses="persons")
def _(t):
    ext = t.persons.selectExpr("fathername AS term").where("term IS NOT NULL").unionByName(t.persons.selectExpr("replace(name, 'ё', 'е') AS term"))
    return names.merge_frequencies(ext, counts_of(t), 10)


SURNAMES = "replace(lower(trim(surname)), 'ё', 'е')"
# Rows of ``persons`` whose surname has lost a letter; the row before has the same surname, whole.
SLIPPED = "unique_id % 3 = 2 AND unique_id % 4 = 1"
TITLE = "array_to_string([upper(p[1]) || lower(p[2:]) FOR p IN string_split({c}, '-')], '-')"


def surname_fixes(t):
    """Surnames against a dictionary of the whole ones, ranked with the frequencies seen."""
    lowered = t.persons.select("unique_id", F.expr(SURNAMES).alias("surname"))
    dictionary = lowered.where(f"NOT ({SLIPPED})").select(F.col("surname").alias("term")).where("term <> ''").distinct()
    terms = names.merge_frequencies(dictionary, names.value_counts_union(lowered.join(dictionary, F.col("surname") == F.col("term"), "left_semi"), lowered.limit(0), "surname"))
    return names.correct_names(lowered, "surname", terms, dictionary, min_ratio=85)


FIXES = f"""l AS (SELECT unique_id, {SURNAMES} AS s FROM persons WHERE surname IS NOT NULL),
 fixes AS (SELECT DISTINCT a.s AS value, {TITLE.format(c='coalesce(b.s, a.s)')} AS corrected FROM l a LEFT JOIN l b ON a.unique_id % 3 = 2 AND a.unique_id % 4 = 1 AND b.unique_id = a.unique_id - 1)"""


@query("correct_names", f"WITH {FIXES} SELECT * FROM fixes", uses="persons")
def _(t):
    """Every slip comes back as the surname it was made from."""
    return surname_fixes(t)


@query("correct_distinct_values", f"WITH {FIXES} SELECT unique_id, corrected AS surname FROM l JOIN fixes ON s = value", uses="persons")
def _(t):
    """The whole surname on every row, slips and all."""
    lowered = t.persons.select("unique_id", F.expr(SURNAMES).alias("surname"))
    return names.correct_distinct_values(lowered, "surname", surname_fixes(t))


@query("record_fingerprint", f"""SELECT unique_id, concat_ws(' ', {', '.join(f"regexp_replace(lower(coalesce({c}, '')), '[^а-яёa-z0-9]', '', 'g')" for c in ['surname', 'name', 'fathername', 'gender', 'birthdate', 'passport', 'inn'])}) AS cleaned,
 concat_ws(' ', {', '.join(f"coalesce({c}, '<nan>')" for c in ['name', 'surname', 'fathername', 'birthdate', 'inn', 'passport'])}) AS raw FROM persons""", uses="persons")
def _(t):
    return t.persons.select("unique_id", linkage.full_fingerprint().alias("cleaned"), linkage.raw_fingerprint().alias("raw"))


FINGER = f"""fp AS (SELECT unique_id, concat_ws(' ', {', '.join(f"coalesce({LATIN.format(c=f'lower({c})')}, '<nan>')" for c in ['name', 'surname', 'fathername', 'birthdate', 'inn', 'passport'])}) AS text FROM persons)"""


@query("fuzzy_topk_match", f"""WITH {FINGER}, q AS (SELECT * FROM fp WHERE unique_id % 3 = 2), b AS (SELECT * FROM fp WHERE unique_id % 3 <> 2),
 p AS (SELECT q.unique_id AS query_id, b.unique_id AS match_id, levenshtein(q.text, b.text) AS edits, 1 - levenshtein(q.text, b.text) / greatest(length(q.text), length(b.text)) AS similarity
 FROM q CROSS JOIN b),
 r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, match_id) AS rank FROM p) SELECT query_id, match_id, edits, similarity, rank FROM r WHERE rank <= 5""", rounds="similarity", uses="persons")
def _(t):
    parts = [F.coalesce(F.expr(LATIN.format(c=f"lower({c})")), F.lit("<nan>")) for c in ("name", "surname", "fathername", "birthdate", "inn", "passport")]
    prints = t.persons.select("unique_id", F.concat_ws(" ", *parts).alias("text"))
    return fuzzy.fuzzy_topk_match(prints.where("unique_id % 3 <> 2"), prints.where("unique_id % 3 = 2"), "unique_id", "text", 5)


# --- vectors ----------------------------------------------------------------------------------------


@query("char_tfidf", """WITH fp AS (SELECT unique_id, """ + "concat_ws(' ', " + ", ".join(f"regexp_replace(lower(coalesce({c}, '')), '[^а-яёa-z0-9]', '', 'g')" for c in ["surname", "name", "fathername", "gender", "birthdate", "passport", "inn"]) + """) AS text FROM persons),
 clean AS (SELECT unique_id, regexp_replace(text, '\\s\\s+', ' ', 'g') AS text FROM fp),
 g AS (SELECT unique_id, substr(text, i::INT, 2) AS term, count(*) AS tf FROM (SELECT unique_id, text, unnest(range(1, length(text))) AS i FROM clean) AS x GROUP BY ALL),
 d AS (SELECT term, ln((1 + (SELECT count(*) FROM persons)) / (1 + count(*))) + 1 AS idf FROM g GROUP BY term), w AS (SELECT unique_id, term, tf * idf AS w FROM g JOIN d USING (term))
 SELECT unique_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY unique_id)) AS weight FROM w""", rounds="weight", uses="persons")
def _(t):
    docs = t.persons.select("unique_id", linkage.full_fingerprint().alias("text"))
    return text_features.char_tfidf(docs, "unique_id", "text")


WORDS = f"""docs AS (SELECT user_id, string_agg({NORM}, ' ' ORDER BY ts, search_id) AS text, count(*) AS queries FROM searches WHERE {days('ts', 30)} GROUP BY user_id),
tok AS (SELECT user_id, [x FOR x IN string_split(coalesce(text, ''), ' ') IF length(x) >= 2] AS a FROM docs),
grams AS (SELECT user_id, unnest(a) AS term FROM tok UNION ALL SELECT user_id, a[i] || ' ' || a[i + 1] FROM (SELECT user_id, a, unnest(range(1, len(a))) AS i FROM tok) AS x),
tf AS (SELECT user_id, term, count(*) AS tf FROM grams GROUP BY ALL), n AS (SELECT count(*) AS n FROM docs),
vocab AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf, n GROUP BY term, n HAVING count(*) >= 5 AND count(*) <= 0.8 * n.n ORDER BY total DESC, term LIMIT 5000),
w AS (SELECT user_id, term, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN vocab USING (term), n)"""


@query("word_tfidf", f"WITH {WORDS} SELECT user_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY user_id)) AS weight FROM w", rounds="weight", uses="searches")
def _(t):
    return text_features.word_tfidf(t.searches, END)


@query("text_svd")
def _(t):
    return text_features.search_svd_block(t.searches, END, 8)


@query("knn_exact", """WITH d AS (SELECT q.vec_id AS query_id, b.vec_id AS neighbour_id, list_sum([(q.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) * (q.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) FOR i IN range(1, 65)]) AS distance
 FROM embeddings q, embeddings b), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 9), neighbour_id) AS rank FROM d) SELECT * FROM r WHERE rank <= 10""", rounds="distance")
def _(t):
    return neighbours.knn_exact(t.embeddings, t.embeddings, "vec_id", "embedding", 10)


@query("knn_approx")
def _(t):
    return neighbours.knn_approx(t.embeddings, t.embeddings, "vec_id", "embedding", 10, radius=1.5)


@query("match_by_vector")
def _(t):
    return linkage.match_by_vector(t.persons.where("unique_id % 3 <> 2"), t.persons.where("unique_id % 3 = 2"))
