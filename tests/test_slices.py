"""Cut keys give the same answers as whole ones."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.operators import behaviour as b
from tallyloom.operators.arrays import run_length_encode
from tallyloom.operators.quantiles import exact_quantiles, value_ranks
from tallyloom.operators.slices import Ordered, by_range

START = datetime(2024, 1, 1)
SCHEMA = "user_id bigint, ts timestamp_ntz, event_id bigint, action_type string, product_id bigint"


def log(spark, rows):
    return spark.createDataFrame([(u, START + timedelta(milliseconds=ms), i, a, p) for i, (u, ms, a, p) in enumerate(rows)], SCHEMA)


def skewed(spark, n=600):
    """User 1 has two thirds of the rows, some at the same instant, most of them late."""
    rows = []
    for i in range(n):
        user = 1 if i % 3 else i % 7 + 2
        rows.append((user, (i * i * 37) % 900_000 if i % 5 else 400_000, "view" if i % 2 else "order", i % 4 or None))
    return log(spark, rows)


def test_cut_keys_match_plain_windows(spark):
    df = skewed(spark)
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    want = df.select(
        "event_id", F.row_number().over(w).alias("n"), F.lag("action_type").over(w).alias("before"),
        F.last("product_id", ignorenulls=True).over(upto).alias("known"), F.sum("product_id").over(upto).alias("total"),
    )
    cut = Ordered.per_key(df, ["user_id"], ["ts", "event_id"], limit=10)
    assert cut.df.where("user_id = 1").select("__slice").distinct().count() > 5
    got = cut.row_number("n").previous(before="action_type").last_known(known="product_id").running_sum(total="product_id").result()
    got = got.select("event_id", "n", "before", "known", "total")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_global_order(spark):
    df = spark.range(1000).select(((F.col("id") * 37) % 1000).alias("k"))
    got = Ordered.overall(df, ["k"], pieces=16).row_number("n").result()
    assert got.where("n <> k + 1").count() == 0


def test_range_slices_are_even_and_hold_equal_rows(spark):
    """A first column with one value in half the rows, nulls and NaN; the driver sees one carry row per partition."""
    rows = spark.range(40_000).selectExpr("CASE WHEN id % 2 = 0 THEN 7.0D WHEN id % 100 = 1 THEN NULL WHEN id % 100 = 3 THEN double('NaN') ELSE id * 0.5D END AS x", "id % 20000 AS k", "id")
    sliced = by_range(rows, ["x", "k"], 32)
    sizes = [r["count"] for r in sliced.groupBy("__slice").count().collect()]
    assert len(sizes) <= 32 and max(sizes) < 3 * 40_000 / 32
    assert sliced.groupBy("x", "k").agg(F.count_distinct("__slice").alias("n")).where("n > 1").isEmpty()
    numbered = Ordered.overall(rows, ["x", "k", "id"], 32).row_number("n").result()
    got = [r.id for r in numbered.orderBy("n").collect()]
    assert got == [r.id for r in rows.orderBy("x", "k", "id").collect()]


def test_quantiles_of_cut_groups(spark):
    df = skewed(spark).withColumn("v", F.col("event_id") % 50 * 0.37)
    want = {r[0]: (r[1], r[2]) for r in df.groupBy("user_id").agg(F.expr("percentile(v, 0.3)"), F.median("v")).collect()}
    for r in exact_quantiles(df, ["user_id"], "v", {"a": 0.3, "m": 0.5}, limit=5).collect():
        assert abs(r["a"] - want[r["user_id"]][0]) < 1e-9 and abs(r["m"] - want[r["user_id"]][1]) < 1e-9


def test_ranks_with_ties(spark):
    df = spark.createDataFrame([(x,) for x in (3.0, 1.0, 3.0, 3.0, 9.0)], "v double")
    got = {r["v"]: (r["min_rank"], r["max_rank"], r["avg_rank"], r["ecdf"]) for r in value_ranks(df, [], "v").collect()}
    assert got == {1.0: (1, 1, 1.0, 0.2), 3.0: (2, 4, 3.0, 0.8), 9.0: (5, 5, 5.0, 1.0)}


def test_session_gap_is_truncated_to_seconds(spark):
    times = [0, 2_400_000, 4_800_500, 7_201_500]  # gaps 2400 s, 2400.5 s, 2401 s
    rows = [(1, t, "view", None) for t in times] + [(2, 0, "view", None)]
    got = [r["session_id"] for r in b.sessionize(log(spark, rows)).where("user_id = 1").orderBy("ts").collect()]
    assert got == [1, 1, 1, 2]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 2), min_size=1, max_size=40))
def test_run_lengths_round_trip(spark, values):
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], "k int, i bigint, v int")
    for keys in ([], ["k"]):
        runs = run_length_encode(df, ["i"], "v", keys, limit=4).orderBy("run").collect()
        assert [v for r in runs for v in [r["v"]] * r["count"]] == values
        assert all(a["v"] != c["v"] for a, c in zip(runs, runs[1:]))


def test_asof_ties_take_the_search_first(spark):
    actions = log(spark, [(1, 1000, "click", 5), (1, 500, "click", 5), (2, 100, "order", 5)])
    searches = spark.createDataFrame([(1, START + timedelta(seconds=1), 7, "x")], "user_id bigint, ts timestamp_ntz, search_id bigint, search_query string")
    got = b.asof_last_search(searches, actions, "2024-01-02", limit=1).collect()
    assert [(r["event_id"], r["secs_since_last_search"]) for r in got] == [(0, 0)]


def test_last_three_actions_are_padded(spark):
    row = b.last_k_actions(log(spark, [(1, 5, "order", 1), (1, 1, "view", 1)]), "2024-01-02").first()
    assert row["last_3_actions_str"] == "NONE__view__order" and row["last_actions_count"] == 2


def test_text_pieces_join_to_the_whole(spark):
    searches = spark.createDataFrame(
        [(1, START + timedelta(hours=h), h, q) for h, q in ((1, "Ёлка, дом"), (30, None), (50, "чай  МОЛОКО!"), (51, "x"))],
        "user_id bigint, ts timestamp_ntz, search_id bigint, search_query string",
    )
    for rows in (10_000, 1):
        pieces = b.concat_user_text(searches, "2024-01-05", piece_rows=rows).orderBy("piece", "part").collect()
        assert " ".join(p["queries_text"] for p in pieces) == "елка дом чай молоко x"
    assert len(pieces) == 3


def test_largest_slice_is_bounded(spark):
    """A burst, a heavy tail, one far outlier, an infinity and one hot instant of a single key are cut by rows."""
    n, limit = 40_000, 1000
    ids = spark.range(n).withColumn("k", F.lit(1))
    orders = {
        "burst": F.when(F.col("id") % 50 == 0, F.col("id") * 1e6).otherwise(F.col("id") * 1e-6),
        "tail": F.exp(F.pmod(F.xxhash64("id"), F.lit(1000)) / 30.0),
        "outlier": F.when(F.col("id") == 7, 1e12).otherwise(F.col("id").cast("double")),
        "infinite": F.when(F.col("id") == 7, float("inf")).when(F.col("id") == 8, float("nan")).otherwise(F.col("id").cast("double")),
        "instant": F.lit(5.0),
    }
    for name, order in orders.items():
        cut = Ordered.per_key(ids.withColumn("o", order), ["k"], ["o", "id"], limit)
        largest = cut.df.groupBy("__slice").count().agg(F.max("count")).first()[0]
        assert largest <= 4 * limit, name
        got = cut.row_number("n").result()
        want = ids.withColumn("o", order).withColumn("n", F.row_number().over(W.partitionBy("k").orderBy("o", "id")))
        assert got.select("id", "n").exceptAll(want.select("id", "n").withColumn("n", F.col("n").cast("long"))).count() == 0, name
