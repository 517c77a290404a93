"""Projections, joins, windows, sorts, sets and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import numeric as nm
from tallyloom.functions import similarity as sim
from tallyloom.functions import text as tx
from tallyloom.functions import time as tm
from tallyloom.functions import vectors as vc
from tallyloom.operators import arrays, joins, rows
from tallyloom.operators.quantiles import value_ranks
from tallyloom.operators.slices import Ordered
from tallyloom.plans.registry import query

LETTERS = "А-Яа-яЁёІіЇїЄєҐґҚқЎўҲҳӘәӨөҮүҢңҺһІі"


def mixed_sql(key: str, seed: int = 0) -> str:
    return f"cast('0x' || substr(md5(concat({key}, ':{seed}')), 1, 8) AS BIGINT)"


# --- projections -------------------------------------------------------------------------


ACTION_ID = "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END"


@query("decode_action_type", "SELECT event_id, user_id, event_type AS action_type FROM events")
def _(t):
    names = t.events.select(F.expr(ACTION_ID).alias("action_type_id"), F.col("event_type").alias("action_type")).distinct()
    log = t.events.select("event_id", "user_id", F.expr(ACTION_ID).alias("action_type_id"))
    return joins.decode(log, names, "action_type_id")


@query("date_range_filter", "SELECT event_id FROM events WHERE cast(ts AS date) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'")
def _(t):
    return t.events.where(tm.between_days(F.col("ts"), "2024-01-05", "2024-01-09")).select("event_id")


@query("lookback_filter", " UNION ALL ".join(
    f"SELECT {d} AS days, count(*) AS n FROM events WHERE cast(ts AS date) BETWEEN DATE '2024-01-25' - {d} AND DATE '2024-01-25'" for d in (7, 30, 60, 120)))
def _(t):
    hits = [F.count_if(tm.lookback(F.col("ts"), "2024-01-25", d)).alias(str(d)) for d in (7, 30, 60, 120)]
    wide = t.events.agg(*hits)
    return wide.unpivot([], ["7", "30", "60", "120"], "days", "n").select(F.col("days").cast("int").alias("days"), "n")


@query("value_set_filter", "SELECT event_id, product_id FROM actions WHERE action_type IN ('click', 'order') AND product_id IS NOT NULL AND action_type <> ''", uses="actions")
def _(t):
    kind = F.col("action_type")
    return t.actions.where(kind.isin("click", "order") & F.col("product_id").isNotNull() & (kind != "")).select("event_id", "product_id")


@query("fill_by_type", "SELECT unique_id, coalesce(passport, '') AS passport, coalesce(gender, 'NONE') AS gender, CASE WHEN unique_id % 4 = 0 THEN NULL ELSE unique_id END AS number FROM persons", uses="persons")
def _(t):
    from tallyloom.operators.behaviour import fill_by_type

    df = t.persons.select("unique_id", "passport", "gender", F.when(F.col("unique_id") % 4 != 0, F.col("unique_id")).alias("number"))
    return fill_by_type(df, ["gender"])


@query("pack_embedding", "SELECT point_id, concat_ws(',', cast(round(f1 * 100) AS bigint), cast(round(f3 * 100) AS bigint), cast(round(f4 * 100) AS bigint)) AS packed FROM points", uses="points")
def _(t):
    packed = t.points.select("point_id", F.array("f1", "f3", "f4").alias("emb"))
    cells = F.transform("emb", lambda x: F.round(x * 100).cast("bigint").cast("string"))
    return packed.select("point_id", F.array_join(cells, ",").alias("packed"))


@query("sort_columns", "SELECT p_brand, p_name, p_partkey, p_size FROM part")
def _(t):
    from tallyloom.operators.behaviour import sort_columns

    return sort_columns(t.part.select("p_size", "p_partkey", "p_name", "p_brand"))


PERSON_TEXTS = ["surname", "name", "fathername", "birthdate", "gender", "passport", "inn"]


@query("ensure_columns", "SELECT unique_id, coalesce(surname, '') AS surname, coalesce(fathername, '') AS fathername, coalesce(passport, '') AS passport, '' AS phone FROM persons", uses="persons")
def _(t):
    df = t.persons.select("unique_id", "surname", "fathername", "passport")
    return rows.ensure_columns(df, ["surname", "fathername", "passport", "phone"])


@query("ensure_unique_id", """SELECT c_custkey, CASE WHEN c_custkey % 4 = 1 THEN cast(row_number() OVER (ORDER BY c_custkey) - 1 AS varchar) ELSE 'C' || cast(c_custkey AS varchar) END AS unique_id FROM customer""")
def _(t):
    given = F.when(F.col("c_custkey") % 8 == 1, " ").when(F.col("c_custkey") % 4 != 1, F.concat(F.lit("C"), "c_custkey"))
    return rows.ensure_unique_id(t.customer.select("c_custkey", given.alias("unique_id")), "c_custkey")


@query("person_fill", "SELECT unique_id, coalesce(fathername, '') AS fathername, coalesce(gender, '') AS gender, coalesce(inn, '') AS inn FROM persons", uses="persons")
def _(t):
    return rows.person_fill(t.persons, PERSON_TEXTS).select("unique_id", "fathername", "gender", "inn")


@query("birthdate_parse", "SELECT unique_id, cast(coalesce(try_strptime(regexp_replace(birthdate, '\\s+', '', 'g'), '%Y-%m-%d'), TIMESTAMP '1900-01-01') AS date)::varchar AS birthdate FROM persons", uses="persons")
def _(t):
    parsed = rows.birthdate_parse(F.concat(F.lit(" "), F.col("birthdate")))
    return t.persons.select("unique_id", parsed.cast("string").alias("birthdate"))


@query("snake_case_columns", "SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS the_region FROM nation")
def _(t):
    df = t.nation.toDF("Nation Key", "Nation - NAME", "THE Region")
    return df.toDF(*rows.snake_case(df.columns))


@query("map_labels", "SELECT doc_id, CASE toxic WHEN 0 THEN -1 WHEN 1 THEN 1 END AS label FROM labels")
def _(t):
    return t.labels.select("doc_id", rows.map_labels(F.col("toxic")).alias("label"))


@query("mod_split", "SELECT CASE WHEN o_orderkey % 10 >= 7 THEN 'test' ELSE 'train' END AS part, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1", rounds="total", digits=2)
def _(t):
    part = F.when(rows.mod_split(F.col("o_orderkey")), "test").otherwise("train").alias("part")
    return t.orders.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))


@query("every_nth", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) AS r WHERE (rn - 1) % 30 = 0")
def _(t):
    return rows.every_nth(t.orders.select("o_orderkey"), "o_orderkey", 30)


@query("clip_lower", "SELECT event_id, CASE WHEN pageview_duration_sec < 0 THEN 0.0 ELSE pageview_duration_sec END AS dwell FROM pageviews", rounds="dwell", uses="pageviews")
def _(t):
    return t.pageviews.select("event_id", nm.clip_lower(F.col("pageview_duration_sec"), 0.0).alias("dwell"))


PRICE_EDGES, PRICE_LABELS = [0, 500, 2000, 10000, 1e6], ["<500", "500-2k", "2k-10k", "10k+"]


@query("cut_bins", """SELECT order_id, CASE WHEN price > 0 AND price <= 500 THEN '<500' WHEN price > 500 AND price <= 2000 THEN '500-2k'
 WHEN price > 2000 AND price <= 10000 THEN '2k-10k' WHEN price > 10000 AND price <= 1000000 THEN '10k+' END AS price_bin FROM shop_orders""", uses="shop_orders")
def _(t):
    return t.shop_orders.select("order_id", nm.cut_bins(F.col("price"), PRICE_EDGES, PRICE_LABELS).alias("price_bin"))


@query("combo_flags", """SELECT order_id, CASE WHEN utm_medium = 4 AND price > 500 AND price <= 2000 THEN 1 ELSE 0 END AS combo FROM shop_orders""", uses="shop_orders")
def _(t):
    bin_is = nm.cut_bins(F.col("price"), PRICE_EDGES, PRICE_LABELS) == "500-2k"
    return t.shop_orders.select("order_id", rows.combo_flag(F.col("utm_medium") == 4, bin_is).alias("combo"))


@query("null_out_of_range_cells", "SELECT event_id, a, b FROM (SELECT event_id, value / 10.0 AS a, value - 20.0 AS b FROM events) AS x WHERE abs(a) < 10 AND abs(b) < 10", rounds="a b")
def _(t):
    df = t.events.select("event_id", (F.col("value") / 10.0).alias("a"), (F.col("value") - 20.0).alias("b"))
    return rows.null_out_of_range(df, ["a", "b"], 10)


@query("conditional_multiply", "SELECT point_id, CASE WHEN f3 - 0.05 > 0 THEN f1 * (f3 - 0.05) ELSE f1 END AS a FROM points", rounds="a", uses="points")
def _(t):
    return t.points.select("point_id", rows.conditional_multiply(F.col("f1"), F.col("f3") - 0.05).alias("a"))


@query("round_dedup", "SELECT DISTINCT round(f1 / 3, 12) + 0.0 AS a, round(f3, 12) + 0.0 AS b FROM points", rounds="a b", uses="points")
def _(t):
    df = t.points.select((F.col("f1") / 3).alias("a"), F.col("f3").alias("b"))
    return rows.round_dedup(df, ["a", "b"], 12)


@query("drop_feature_list", "SELECT * EXCLUDE (f2, f4) FROM points", rounds="f1 f3", uses="points")
def _(t):
    return rows.drop_feature_list(t.points, ["f2", "f4"])


@query("infer_feature_kinds", """SELECT f AS feature, CASE WHEN f = 'embedding' THEN 'embedding' WHEN avg(length(v)) > 20 AND count(DISTINCT v) > 20 THEN 'text' ELSE 'categorical' END AS kind,
 avg(length(v)) AS avg_length, CASE WHEN f = 'embedding' THEN NULL ELSE count(DISTINCT v) END AS n_distinct FROM (
 SELECT 'text' AS f, text AS v FROM documents UNION ALL SELECT 'lang', lang FROM documents UNION ALL SELECT 'source', source FROM documents UNION ALL SELECT 'embedding', NULL) AS x GROUP BY f""", rounds="avg_length")
def _(t):
    df = t.documents.select("text", "lang", "source", F.array(F.col("n_chars").cast("double")).alias("embedding"))
    return rows.infer_feature_kinds(df)


# --- joins -------------------------------------------------------------------------------------


@query("join_inner_dim", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def _(t):
    nations = t.nation.join(joins.broadcast_if_small(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    out = t.customer.join(joins.broadcast_if_small(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    return out.select("c_custkey", "n_name", "r_name")


@query("join_left_product", "SELECT event_id, a.product_id, brand, price FROM actions a LEFT JOIN products p ON a.product_id = p.product_id", rounds="price", uses="actions products")
def _(t):
    pruned = t.products.select("product_id", "brand", "price")
    return t.actions.join(pruned, "product_id", "left").select("event_id", "product_id", "brand", "price")


@query("join_totals_back", "SELECT *, cast(sum(n) OVER (PARTITION BY user_id) AS bigint) AS total FROM (SELECT user_id, action_type, count(*) AS n FROM actions GROUP BY ALL) AS c", uses="actions")
def _(t):
    from pyspark.sql import Window as W

    counts = t.actions.groupBy("user_id", "action_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("total", F.sum("n").over(W.partitionBy("user_id")))


@query("exact_id_match", """SELECT unique_id FROM persons p WHERE unique_id % 3 <> 2 AND coalesce(passport, '') <> '' AND coalesce(inn, '') <> ''
 AND passport IN (SELECT passport FROM persons WHERE unique_id % 3 = 2 AND passport <> '')""", uses="persons")
def _(t):
    known, wanted = t.persons.where("unique_id % 3 <> 2"), t.persons.where("unique_id % 3 = 2")
    return joins.exact_id_match(known, wanted).select("unique_id")


@query("row_membership", """SELECT event_id FROM actions a WHERE EXISTS (SELECT 1 FROM actions b WHERE b.event_id % 7 = 0 AND b.user_id = a.user_id
 AND b.product_id IS NOT DISTINCT FROM a.product_id AND b.action_type = a.action_type)""", uses="actions")
def _(t):
    return joins.row_membership(t.actions, t.actions.where("event_id % 7 = 0"), ["user_id", "product_id", "action_type"]).select("event_id")


HALF = "SELECT * FROM points WHERE point_id % 5 = 0"


@query("novelty_anti_join", f"""SELECT p.point_id FROM points p LEFT JOIN (SELECT DISTINCT round(f1, 12) AS f1, round(f3, 12) AS f3, round(f4, 12) AS f4 FROM ({HALF}) AS h) k
 ON round(p.f1, 12) = k.f1 AND round(p.f3, 12) = k.f3 AND round(p.f4, 12) = k.f4 WHERE k.f1 IS NULL""", uses="points")
def _(t):
    return joins.novelty_anti_join(t.points, t.points.where("point_id % 5 = 0"), ["f1", "f3", "f4"]).select("point_id")


@query("validity_label_join", f"""SELECT p.point_id, CASE WHEN k.f1 IS NULL THEN 0 ELSE 1 END AS is_valid FROM points p LEFT JOIN
 (SELECT DISTINCT round(f1, 12) AS f1, round(f3, 12) AS f3, round(f4, 12) AS f4 FROM ({HALF}) AS h) k
 ON round(p.f1, 12) = k.f1 AND round(p.f3, 12) = k.f3 AND round(p.f4, 12) = k.f4""", uses="points")
def _(t):
    return joins.validity_label(t.points, t.points.where("point_id % 5 = 0"), ["f1", "f3", "f4"]).select("point_id", "is_valid")


@query("pairwise_distance", """WITH m AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS v FROM embeddings, range(1, 65) AS r(i) GROUP BY label, i)
 SELECT vec_id, m.label AS anchor, sqrt(sum((e.embedding[m.i]::DOUBLE - m.v) * (e.embedding[m.i]::DOUBLE - m.v))) AS distance
 FROM embeddings e, m GROUP BY ALL""", rounds="distance")
def _(t):
    parts = t.embeddings.select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", "i").agg(F.avg("v").alias("v"))
    centres = parts.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("c"))  # one entry per dimension
    centres = centres.select(F.col("label").alias("anchor"), F.transform("c", lambda r: r["v"]).alias("centre"))
    return arrays.distance_to_anchors(t.embeddings, "vec_id", "embedding", centres, "anchor", "centre")


GRID = """g AS (SELECT cast(l_quantity AS int) AS i, cast((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS int) AS j, count(*) AS x, sum(l_tax) AS tax FROM lineitem GROUP BY ALL),
 cells AS (SELECT i, j, x, tax / (SELECT sum(tax) FROM g) AS q FROM g)"""


@query("grid_neighbourhood_sum", f"""WITH {GRID} SELECT a.i, a.j, a.x * sum(b.q) AS expectation FROM cells a JOIN cells b
 ON b.i > a.i - 3 AND b.i <= a.i AND b.j > a.j - 2 AND b.j <= a.j GROUP BY a.i, a.j, a.x""", rounds="expectation", digits=9)
def _(t):
    month = (F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")
    grid = t.lineitem.groupBy(F.col("l_quantity").cast("int").alias("i"), month.cast("int").alias("j")).agg(
        F.count(F.lit(1)).alias("x"), F.sum("l_tax").alias("tax")
    )
    total = t.lineitem.agg(F.sum("l_tax")).first()[0]
    cells = grid.select("i", "j", "x", (F.col("tax") / F.lit(total)).alias("q"))
    return arrays.grid_neighbourhood_sum(cells, 3, 2).select("i", "j", "expectation")


# --- windows ---------------------------------------------------------------------------------------


@query("run_length_encode", """WITH f AS (SELECT event_id, event_type, CASE WHEN lag(event_type) OVER (ORDER BY event_id) = event_type THEN 0 ELSE 1 END AS s FROM events),
 r AS (SELECT event_type, cast(sum(s) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS bigint) AS run FROM f) SELECT run, event_type, count(*) AS count FROM r GROUP BY ALL""")
def _(t):
    return arrays.run_length_encode(t.events, ["event_id"], "event_type")


@query("run_length_encode_per_user", """WITH f AS (SELECT user_id, event_id, ts, event_type, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) = event_type THEN 0 ELSE 1 END AS s FROM events),
 r AS (SELECT user_id, event_type, cast(sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS bigint) AS run FROM f)
 SELECT user_id, run, event_type, count(*) AS count FROM r GROUP BY ALL""")
def _(t):
    return arrays.run_length_encode(t.events, ["ts", "event_id"], "event_type", keys=["user_id"])


@query("max_after_zero", """SELECT user_id, max(CASE WHEN p = 0 THEN w END) AS max_after_zero FROM (SELECT user_id, widget_name_id AS w,
 lag(widget_name_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM actions) AS x GROUP BY user_id""", uses="actions")
def _(t):
    return arrays.max_after_zero(t.actions, ["ts", "event_id"], "widget_name_id", keys=["user_id"])


@query("sawtooth", "SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) % 10 + 1 AS tooth FROM events")
def _(t):
    return arrays.sawtooth(t.events.select("event_id"), "event_id", 10)


@query("ecdf", "SELECT DISTINCT f2 AS value, cume_dist() OVER (ORDER BY f2) AS ecdf FROM points", rounds="value ecdf", uses="points")
def _(t):
    return value_ranks(t.points, [], "f2").select(F.col("f2").alias("value"), "ecdf")


@query("average_rank", """SELECT point_id, rank() OVER (ORDER BY f1) + (count(*) OVER (PARTITION BY f1) - 1) / 2 AS avg_rank FROM points""", rounds="avg_rank", uses="points")
def _(t):
    ranks = value_ranks(t.points, [], "f1").select("f1", "avg_rank")
    return t.points.select("point_id", "f1").join(ranks, "f1").select("point_id", "avg_rank")


# --- sorts ------------------------------------------------------------------------------------------------


@query("topk_values", "SELECT l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC LIMIT 20", rounds="l_extendedprice")
def _(t):
    return arrays.topk_values(t.lineitem, "l_extendedprice", 20)


@query("sample_n", f"SELECT o_orderkey FROM orders ORDER BY {mixed_sql('o_orderkey', 42)}, o_orderkey LIMIT 500")
def _(t):
    from tallyloom.operators.sampling import sample_rows

    return sample_rows(t.orders.select("o_orderkey"), "o_orderkey", size=500, seed=42)


# --- sets ------------------------------------------------------------------------------------------------------


@query("stack_train_val", "SELECT id, score, 0 AS source FROM scores WHERE id % 10 < 7 UNION ALL SELECT id, score, 1 FROM scores WHERE id % 10 >= 7", rounds="score", uses="scores")
def _(t):
    test = rows.mod_split(F.col("id"))
    s = t.scores.select("id", "score")
    return rows.stack_sources(s.where(~test), s.where(test))


@query("dedup_on_keys", "SELECT user_id, product_id, min(event_id) AS event_id FROM actions GROUP BY user_id, product_id", uses="actions")
def _(t):
    return rows.dedup_on_keys(t.actions, ["user_id", "product_id"], ["event_id"]).select("user_id", "product_id", "event_id")


@query("dedup_full_row", "SELECT DISTINCT user_id, action_type, product_id FROM actions", uses="actions")
def _(t):
    return t.actions.select("user_id", "action_type", "product_id").distinct()


BLANKS = "('', 'nan', 'none', 'null', 'na', 'n/a', '-', '_', '?')"


@query("unique_union", f"""SELECT DISTINCT passport FROM persons WHERE passport IS NOT NULL AND lower(trim(passport)) NOT IN {BLANKS}
 UNION SELECT c_mktsegment FROM customer""", uses="persons")
def _(t):
    other = t.customer.select(F.col("c_mktsegment").alias("passport"))
    return rows.unique_union(t.persons, other, "passport", tx.is_blank(F.col("passport")))


@query("union_distinct_ids", "SELECT row_number() OVER (ORDER BY k) - 1 AS id, k AS orig_index FROM (SELECT o_custkey AS k FROM orders WHERE o_orderkey % 3 = 0 UNION SELECT c_custkey FROM customer WHERE c_custkey % 4 = 0) AS u")
def _(t):
    a = t.orders.where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("k"))
    return rows.union_distinct_ids(a, t.customer.where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("k")), "k")


@query("set_difference", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    ordered = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return rows.set_difference(t.customer.select("c_custkey"), ordered, "c_custkey")


# --- scalar functions ----------------------------------------------------------------------------------------------


@query("normalize_person_name", "SELECT unique_id, replace(lower(regexp_replace(trim(surname), '\\s+', ' ', 'g')), 'ё', 'е') AS surname FROM persons", uses="persons")
def _(t):
    return t.persons.select("unique_id", tx.normalize_person_name(F.col("surname")).alias("surname"))


RAW_NAME = "concat(surname, ' - ', coalesce(fathername, '?'), ' 7;', name)"
SURFACE = f"""replace(replace(replace(replace(replace(trim(regexp_replace(regexp_replace({RAW_NAME}, '[^A-Za-z{LETTERS}\\- ]+', ' ', 'g'), '\\s+', ' ', 'g')),
 'Ё', 'Е'), 'ё', 'е'), ' - ', '-'), '- ', '-'), ' -', '-')"""


@query("normalize_name_surface", f"SELECT unique_id, {SURFACE} AS surface FROM persons", uses="persons")
def _(t):
    return t.persons.select("unique_id", tx.normalize_name_surface(F.expr(RAW_NAME)).alias("surface"))


@query("title_case_name", f"""WITH s AS (SELECT unique_id, {SURFACE} AS v FROM persons) SELECT unique_id, array_to_string([
 array_to_string([upper(p[1]) || lower(p[2:]) FOR p IN string_split(w, '-')], '-') FOR w IN string_split(v, ' ')], ' ') AS title FROM s""", uses="persons")
def _(t):
    return t.persons.select("unique_id", tx.title_case_name(F.expr(RAW_NAME)).alias("title"))


@query("is_blank", f"SELECT unique_id, CASE WHEN passport IS NULL OR lower(trim(passport)) IN {BLANKS} THEN 1 ELSE 0 END AS blank FROM persons", uses="persons")
def _(t):
    return t.persons.select("unique_id", tx.is_blank(F.col("passport")).cast("int").alias("blank"))


@query("is_cyrillic", f"SELECT unique_id, CASE WHEN coalesce(fathername, inn) IS NOT NULL AND regexp_matches(coalesce(fathername, inn), '[{LETTERS}]') THEN 1 ELSE 0 END AS cyrillic FROM persons", uses="persons")
def _(t):
    return t.persons.select("unique_id", tx.is_cyrillic(F.expr("coalesce(fathername, inn)")).cast("int").alias("cyrillic"))


@query("clean_fingerprint_text", "SELECT doc_id, regexp_replace(lower(text), '[^а-яёa-z0-9]', '', 'g') AS cleaned FROM documents")
def _(t):
    return t.documents.select("doc_id", tx.clean_fingerprint_text(F.col("text")).alias("cleaned"))


@query("date_parts", """SELECT order_id, cast(hour(create_time) AS int) AS hour, cast(isodow(create_time) - 1 AS int) AS dow, cast(day(create_time) AS int) AS day,
 cast(month(create_time) AS int) AS month, cast(week(create_time) AS int) AS week FROM shop_orders""", uses="shop_orders")
def _(t):
    parts = tm.date_parts(F.col("create_time"))
    return t.shop_orders.select("order_id", *[c.alias(n) for n, c in parts.items()])


@query("is_holiday", "SELECT o_orderkey, CASE WHEN strftime(o_orderdate, '%m-%d') IN ('01-01', '01-07', '05-01', '05-09', '06-12', '11-04') THEN 1 ELSE 0 END AS holiday FROM orders")
def _(t):
    return t.orders.select("o_orderkey", tm.is_holiday(F.col("o_orderdate")).alias("holiday"))


@query("is_weekend", "SELECT o_orderkey, CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS weekend FROM orders")
def _(t):
    return t.orders.select("o_orderkey", tm.is_weekend(F.col("o_orderdate")).alias("weekend"))


@query("seconds_of_day_gap", """SELECT event_id, ((cast(floor((epoch_us(TIMESTAMP '2024-01-15 12:00:00') - epoch_us(ts)) / 1000000) AS bigint) % 86400) + 86400) % 86400 AS gap FROM events""")
def _(t):
    fixed = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return t.events.select("event_id", tm.seconds_of_day_gap(fixed, F.col("ts")).alias("gap"))


@query("array_tail_get", "SELECT conv_id, len(a) AS n, a[-1] AS last, CASE WHEN len(a) >= 2 THEN a[-2] END AS second, CASE WHEN len(a) >= 5 THEN a[-5] END AS fifth FROM (SELECT conv_id, list(role ORDER BY turn) AS a FROM conversations GROUP BY conv_id) AS x")
def _(t):
    """A conversation has a handful of turns, so its list is short."""
    lists = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("r"))
    lists = lists.select("conv_id", F.transform("r", lambda x: x["role"]).alias("a"))
    return lists.select(
        "conv_id", F.size("a").cast("long").alias("n"),
        *[F.try_element_at("a", F.lit(-n)).alias(name) for n, name in ((1, "last"), (2, "second"), (5, "fifth"))],
    )


@query("log_transforms", """SELECT point_id, ln(1 + f1) AS log1p, CASE WHEN f3 > 0 THEN ln(f3) END AS ln_disc, CASE WHEN f3 - 0.05 >= 0 THEN sqrt(f3 - 0.05) END AS root, cbrt(f1) AS cube_root FROM points""",
       rounds="log1p ln_disc root cube_root", uses="points")
def _(t):
    one, disc = nm.log_transforms(F.col("f1")), nm.log_transforms(F.col("f3"))
    return t.points.select(
        "point_id", one["log1p"].alias("log1p"), disc["ln"].alias("ln_disc"),
        nm.log_transforms(F.col("f3") - 0.05)["sqrt"].alias("root"), one["cbrt"].alias("cube_root"),
    )


@query("inverse_normal")
def _(t):
    return t.points.select("point_id", nm.inverse_normal(F.col("f1") / 51.0).alias("z"))


@query("sigmoid_logloss", "SELECT id, 1 / (1 + exp(-(score - 0.5) * 8)) AS p, ln(1 + exp(-(2 * y - 1) * (score - 0.5) * 8)) AS loss FROM scores", rounds="p loss", uses="scores")
def _(t):
    z = (F.col("score") - 0.5) * 8
    return t.scores.select("id", nm.sigmoid(z).alias("p"), nm.softplus(-(2 * F.col("y") - 1) * z).alias("loss"))


@query("vector_projection", """WITH d AS (SELECT point_id, f1 * 2.0 + f3 * 3.0 + f4 * 1.0 AS ab FROM points) SELECT point_id, ab / 14 * 2 AS x, ab / 14 * 3 AS y, ab / 14 AS z FROM d""", rounds="x y z", uses="points")
def _(t):
    b = F.array(F.lit(2.0), F.lit(3.0), F.lit(1.0))
    out = t.points.select("point_id", vc.project(F.array("f1", "f3", "f4"), b).alias("p"))
    return out.select("point_id", *[F.col("p")[i].alias(n) for i, n in enumerate("xyz")])


@query("max_edit_rule", "SELECT unique_id, CASE WHEN length(name) <= 4 THEN 1 ELSE 2 END AS budget FROM persons", uses="persons")
def _(t):
    from tallyloom.operators.names import max_edits

    return t.persons.select("unique_id", max_edits(F.col("name")).alias("budget"))


@query("jaro_winkler", "SELECT p_partkey, jaro_winkler_similarity(p_name, lower(p_type)) AS similarity FROM part", rounds="similarity")
def _(t):
    """Distinct value pairs are compared once each."""
    pairs = t.part.select("p_partkey", F.col("p_name").alias("a"), F.lower("p_type").alias("b"))
    scored = pairs.select("a", "b").distinct().withColumn("similarity", sim.jaro_winkler("a", "b"))
    return pairs.join(scored, ["a", "b"]).select("p_partkey", "similarity")


@query("edit_similarity")
def _(t):
    pairs = t.persons.select(F.lower(F.trim("surname")).alias("a"), F.col("name").alias("b")).distinct()
    return pairs.select("a", "b", sim.edit_similarity("a", "b").alias("ratio"))


@query("read_parquet", "SELECT n_name, n_regionkey FROM nation")
def _(t):
    return t.nation.select("n_name", "n_regionkey")


@query("sort_user_time", "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events")
def _(t):
    placed = Ordered.per_key(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"]).row_number("place")
    return placed.result().select("user_id", "event_id", "place")
