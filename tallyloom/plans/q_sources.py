"""Readers and writers, each as a round trip over a given table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.plans.registry import query
from tallyloom.session import shared_folder
from tallyloom.sources import dictionaries, tables

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@query("scan_parquet", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, sum(value) AS total FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY event_type",
       rounds="total", digits=2)
def _(t):
    log = tables.scan_parquet(t.spark, t.path("events"), EVENT_SCHEMA)
    return (
        log.where("ts >= TIMESTAMP_NTZ '2024-01-10 00:00:00'")
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.sum("value").alias("total"))
    )


@query("scan_csv", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part", rounds="p_retailprice")
def _(t):
    path = shared_folder(t.spark, "parts-csv")
    tables.write_csv(t.part, path)
    schema = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    return tables.scan_csv(t.spark, path, schema).drop("p_type")


@query("read_csv_dates", "SELECT o_orderkey, epoch_us(o_orderdate) AS order_us, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE year(o_orderdate) END AS order_year FROM orders")
def _(t):
    path = shared_folder(t.spark, "orders-csv")
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    broken = F.when(F.col("o_orderkey") % 5 == 0, "no date").otherwise(text)
    tables.write_csv(t.orders.select(text.alias("o_orderdate"), "o_orderkey", broken.alias("shipped")), path)
    schema = T.StructType().add("o_orderdate", "timestamp_ntz").add("o_orderkey", "long").add("shipped", "timestamp_ntz")
    df = tables.read_csv_dates(t.spark, path, schema, ["o_orderdate", "shipped"], key="o_orderkey")
    return df.select(
        "o_orderkey", F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("order_us"),
        F.year("shipped").cast("long").alias("order_year"),
    )


NAME_TERMS = "SELECT DISTINCT replace(replace(trim(surname), 'ё', 'е'), 'Ё', 'Е') AS term FROM persons"


@query("read_text_dictionary", NAME_TERMS, uses="persons")
def _(t):
    path = shared_folder(t.spark, "terms-text")
    t.persons.select(F.concat(F.lit("\t"), "surname", F.lit(" 12 "))).write.text(path)
    return dictionaries.read_text_dictionary(t.spark, path)


@query("read_jsonl_dictionary", "SELECT DISTINCT replace(name, 'ё', 'е') AS term FROM persons UNION SELECT DISTINCT replace(fathername, 'ё', 'е') FROM persons WHERE fathername IS NOT NULL",
       uses="persons")
def _(t):
    path = shared_folder(t.spark, "terms-json")
    people = t.persons
    named = people.select(F.to_json(F.struct(F.lit(" ").alias("surname"), F.col("name").alias("text"))).alias("value"))
    other = people.where("fathername IS NOT NULL").select(
        F.to_json(F.struct(F.lit(5).alias("id"), F.col("fathername").alias("label"))).alias("value")
    )
    broken = people.where("unique_id % 7 = 0").select(F.lit('{"name": "обрыв').alias("value"))
    named.unionByName(other).unionByName(broken).write.text(path)
    return dictionaries.read_jsonl_dictionary(t.spark, path)


@query("json_first_string", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 3 = 1 THEN 'w' || cast(user_id AS varchar)
 ELSE NULL END AS term FROM events""")
def _(t):
    key = F.col("event_id") % 3
    doc = F.when(
        key == 0, F.to_json(F.struct(F.lit("").alias("name"), F.col("event_type").alias("word"), F.lit("zz").alias("a")))
    ).when(key == 1, F.to_json(F.struct(F.col("user_id").alias("n"), F.concat(F.lit(" w"), "user_id").alias("other"))))
    doc = doc.otherwise(F.to_json(F.struct(F.col("user_id").alias("n"), F.lit("  ").alias("text"))))
    term = dictionaries.first_json_string(F.col("doc"), dictionaries.TERM_KEYS)
    return t.events.select("event_id", doc.alias("doc")).select("event_id", term.alias("term"))


@query("route_dictionary_terms", """SELECT DISTINCT 'surname' AS bucket, replace(replace(trim(surname), 'ё', 'е'), 'Ё', 'Е') AS term FROM persons
 UNION SELECT 'patronymic', fathername FROM persons WHERE fathername IS NOT NULL UNION SELECT 'name', replace(name, 'ё', 'е') FROM persons""", uses="persons")
def _(t):
    base = shared_folder(t.spark, "terms-routed")

    def store(column: str, folder: str):
        rows = t.persons.where(F.col(column).isNotNull())
        rows.select(F.to_json(F.struct(F.col(column).alias("value"))).alias("value")).write.text(f"{base}/{folder}")

    store("surname", "all_surnames")
    store("name", "first_names.x")
    store("fathername", "unsorted")
    terms = [dictionaries.json_terms(t.spark, f"{base}/{f}") for f in ("all_surnames", "first_names.x", "unsorted")]
    return dictionaries.route_terms(terms[0].unionByName(terms[1]).unionByName(terms[2]))


@query("write_parquet", "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL", rounds="qty")
def _(t):
    path = shared_folder(t.spark, "lineitem")
    tables.write_parquet(t.lineitem, path, "zstd", ["l_returnflag"])
    return t.spark.read.parquet(path).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty")
    )


@query("write_csv", "SELECT id, score FROM scores", rounds="score", uses="scores")
def _(t):
    path = shared_folder(t.spark, "scores")
    tables.write_csv(t.scores.select("id", "score"), path)
    return tables.scan_csv(t.spark, path, "id bigint, score double")


@query("append_points", "SELECT count(*) AS n, count(DISTINCT point_id) AS points, sum(f1) AS f1 FROM points", rounds="f1", uses="points")
def _(t):
    path = shared_folder(t.spark, "points")
    tables.append_points(t.points.where("y = 1"), path)
    tables.append_points(t.points.where("y = 0"), path)
    return t.spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("point_id").alias("points"), F.sum("f1").alias("f1")
    )


@query("load_or_empty", "SELECT 'found' AS state, count(*) AS n FROM points UNION ALL SELECT 'missing', 0", uses="points")
def _(t):
    path = shared_folder(t.spark, "valid")
    points = t.points.select("f1", "f2", "f3", "f4", "y")
    tables.append_points(points, path)
    found = tables.load_or_empty(t.spark, path, points.schema)
    missing = tables.load_or_empty(t.spark, path + "-none", points.schema)
    return found.agg(F.lit("found").alias("state"), F.count(F.lit(1)).alias("n")).unionByName(
        missing.agg(F.lit("missing").alias("state"), F.count(F.lit(1)).alias("n"))
    )
