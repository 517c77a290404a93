"""Queries for profiling, preparation, metrics and split search."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import arrays, metrics, prep, profiling, sampling, trees
from tallyloom.plans.q_rows import mixed_sql
from tallyloom.plans.registry import query

# A few numeric columns with every kind of oddity, derived from line items.
NUM = """num AS (SELECT point_id AS id, f2 AS price, f1 AS qty, f3 AS disc, f1 * 2.0 + 1.0 AS qty_line, f1 AS qty_copy, 7.5 AS same,
 CASE WHEN point_id % 3 = 0 THEN f2 * 0.5 + f1 END AS gappy, CASE WHEN point_id % 4 = 0 THEN f2 * f2 ELSE 0.0 END AS heavy,
 CASE WHEN f1 > 45 THEN 45.0 ELSE f1 END AS capped, CASE WHEN point_id % 5 < 3 THEN 0.0 ELSE -f1 END AS zeros,
 CASE WHEN point_id < 6 THEN f1 END AS few FROM points)"""
COLUMNS = ["price", "qty", "disc", "qty_line", "qty_copy", "same", "gappy", "heavy", "capped", "zeros", "few"]


def num(t):
    c = F.col
    return t.points.select(
        c("point_id").alias("id"), c("f2").alias("price"), c("f1").alias("qty"), c("f3").alias("disc"), (c("f1") * 2.0 + 1.0).alias("qty_line"),
        c("f1").alias("qty_copy"), F.lit(7.5).alias("same"), F.when(c("point_id") % 3 == 0, c("f2") * 0.5 + c("f1")).alias("gappy"),
        F.when(c("point_id") % 4 == 0, c("f2") * c("f2")).otherwise(0.0).alias("heavy"), F.when(c("f1") > 45, 45.0).otherwise(c("f1")).alias("capped"),
        F.when(c("point_id") % 5 < 3, 0.0).otherwise(-c("f1")).alias("zeros"), F.when(c("point_id") < 6, c("f1")).alias("few"),
    )


LONG = "long AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, id, {c}::DOUBLE AS v FROM num" for c in COLUMNS) + ")"
PROFILE = """m AS (SELECT feature, count(*) AS rows, count(v) AS n, avg(v) AS mu, min(v) AS lo, max(v) AS hi FROM long GROUP BY feature),
prof AS (SELECT feature, CASE WHEN n < 10 THEN 0.0 ELSE 1 - n / rows END AS nan_ratio, CASE WHEN n < 10 THEN 0.0 ELSE count(*) FILTER (WHERE v = 0) / n END AS zero_ratio,
 CASE WHEN n < 10 THEN 0.0 ELSE avg((v - mu) ** 3) / nullif(avg((v - mu) ** 2), 0) ** 1.5 END AS skew, CASE WHEN n < 10 THEN 0.0 ELSE count(*) FILTER (WHERE v = hi) / n END AS max_ratio,
 CASE WHEN n < 10 THEN 0.0 ELSE count(*) FILTER (WHERE v = lo) / n END AS min_ratio, CASE WHEN n >= 10 THEN hi END AS max_val, CASE WHEN n >= 10 THEN lo END AS min_val
 FROM long JOIN m USING (feature) GROUP BY feature, n, rows, hi, lo)"""
PROF_DOUBLES = ["nan_ratio", "zero_ratio", "skew", "max_ratio", "min_ratio", "max_val", "min_val"]
REAL = [c for c in COLUMNS if c != "same"]


@query("column_profile", f"WITH {NUM}, {LONG}, {PROFILE} SELECT * FROM prof WHERE feature <> 'same'", rounds=PROF_DOUBLES, uses="points")
def _(t):
    return profiling.column_profile(num(t), REAL)


KIND = "CASE WHEN skew > 1.5 THEN 'log' WHEN max_ratio > 0.05 THEN 'cap' WHEN zero_ratio > 0.5 THEN 'zero' ELSE 'none' END"


@query("auto_standardize_fit", f"WITH {NUM}, {LONG}, {PROFILE} SELECT *, {KIND} AS transform FROM prof WHERE feature <> 'same'", rounds=PROF_DOUBLES, uses="points")
def _(t):
    return prep.auto_standardize_fit(num(t), REAL)


@query("auto_standardize", f"""WITH {NUM}, mx AS (SELECT max(capped) AS cap FROM num) SELECT id, price, ln(1 + heavy) AS heavy, CASE WHEN capped > cap - 1 THEN cap - 1 ELSE capped END AS capped,
 CASE WHEN capped = cap THEN 1.0 ELSE 0.0 END AS capped_is_capped, gappy, 0.0 AS price_is_nan, 0.0 AS heavy_is_nan, 0.0 AS capped_is_nan,
 CASE WHEN gappy IS NULL THEN 1.0 ELSE 0.0 END AS gappy_is_nan FROM num, mx""", rounds="price heavy capped gappy", uses="points")
def _(t):
    df = num(t).select("id", "price", "heavy", "capped", "gappy", "qty")
    fitted = prep.auto_standardize_fit(df, ["price", "heavy", "capped", "gappy"])
    return prep.auto_standardize(df, fitted, to_drop=["qty"])


@query("constant_columns", f"WITH {NUM}, {LONG} SELECT feature FROM long GROUP BY feature HAVING count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END) <= 1", uses="points")
def _(t):
    return profiling.constant_columns(num(t), COLUMNS)


@query("duplicate_columns", f"""WITH {NUM}, {LONG} SELECT a.feature, b.feature AS duplicate FROM long a JOIN long b ON a.id = b.id AND a.feature IN ('qty', 'price') AND b.feature IN ('qty_copy', 'qty_line', 'capped')
 GROUP BY ALL HAVING count(*) FILTER (WHERE a.v IS DISTINCT FROM b.v) = 0""", uses="points")
def _(t):
    return profiling.duplicate_columns(num(t), "id", COLUMNS)


SPEAR = ["price", "qty", "qty_line", "disc", "gappy"]
_pairs = [(a, b) for i, a in enumerate(SPEAR) for b in SPEAR[i + 1:]]
RHO = " UNION ALL ".join(
    f"""SELECT '{a}' AS a, '{b}' AS b, corr(ra, rb) AS rho FROM (SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra,
 rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb FROM num WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS r_{a}_{b}""" for a, b in _pairs)


@query("spearman_matrix", f"WITH {NUM} {RHO}", rounds="rho", uses="points")
def _(t):
    return profiling.spearman_matrix(num(t), "id", SPEAR)


@query("high_corr_columns", f"WITH {NUM}, rho AS ({RHO}) SELECT a AS leader, b AS feature FROM rho WHERE abs(rho) >= 0.995", uses="points")
def _(t):
    return profiling.high_corr_columns(profiling.spearman_matrix(num(t), "id", SPEAR), SPEAR, 0.995)


BOX = """SELECT feature, quantile_cont(v, 0.05) AS q_low, median(v) AS median, quantile_cont(v, 0.95) AS q_high, stddev_pop(v) AS std FROM long
 WHERE feature IN ('price', 'qty', 'gappy') GROUP BY feature"""


@query("robust_box", f"""WITH {NUM}, {LONG}, b AS ({BOX}), h AS (SELECT *, CASE WHEN (q_high - q_low) / 2 > 1e-12 THEN (q_high - q_low) / 2 ELSE std END AS half_width FROM b)
 SELECT *, median - 1.5 * half_width AS box_low, median + 1.5 * half_width AS box_high FROM h""", rounds="q_low median q_high std half_width box_low box_high", digits=3, uses="points")
def _(t):
    return profiling.robust_box(num(t), ["price", "qty", "gappy"])


@query("point_range_summary", f"WITH {NUM}, {LONG} SELECT feature, min(v) AS min, median(v) AS median, max(v) AS max FROM long WHERE feature IN ('price', 'disc', 'gappy') GROUP BY feature",
       rounds="min median max", uses="points")
def _(t):
    return profiling.range_summary(num(t), ["price", "disc", "gappy"])


HIST = """s AS (SELECT min(score) AS lo, max(score) AS hi, count(*) AS n, quantile_cont(score, 0.75) - quantile_cont(score, 0.25) AS iqr FROM scores),
w AS (SELECT lo, hi, greatest(CASE WHEN iqr > 0 THEN 2 * iqr / cbrt(n) ELSE (hi - lo) / sqrt(n) END, 0.08) AS width FROM s),
b AS (SELECT lo, hi, least(greatest(ceil((hi - lo) / width), 20), 80)::INT AS bins FROM w)"""


@query("adaptive_histogram", f"""WITH {HIST} SELECT least(floor((score - lo) / (hi - lo) * bins), bins - 1)::INT AS bin, y, count(*) AS n,
 lo + least(floor((score - lo) / (hi - lo) * bins), bins - 1)::INT * ((hi - lo) / bins) AS left_edge, lo + (least(floor((score - lo) / (hi - lo) * bins), bins - 1)::INT + 1) * ((hi - lo) / bins) AS right_edge
 FROM scores, b GROUP BY ALL""", rounds="left_edge right_edge", uses="scores")
def _(t):
    return profiling.adaptive_histogram(t.scores, "score", "y")


@query("density_histogram", """WITH s AS (SELECT min(f2) AS lo, max(f2) AS hi, count(*) AS n FROM points),
 c AS (SELECT least(floor((f2 - lo) / (hi - lo) * 40), 39)::INT AS bin, count(*) AS c FROM points, s GROUP BY ALL)
 SELECT i::INT AS bin, lo + i * ((hi - lo) / 40) AS left_edge, lo + (i + 1) * ((hi - lo) / 40) AS right_edge, coalesce(c, 0) / (n * ((hi - lo) / 40)) AS density
 FROM range(40) AS r(i) CROSS JOIN s LEFT JOIN c ON c.bin = r.i""", rounds="left_edge right_edge density", digits=9, uses="points")
def _(t):
    return profiling.density_histogram(t.points, "f2", 40)


CLIP = "q AS (SELECT quantile_cont(f2, 0.002) AS l2, quantile_cont(f2, 0.998) AS h2, quantile_cont(f1, 0.002) AS l1, quantile_cont(f1, 0.998) AS h1 FROM points)"


@query("quantile_clip", f"WITH {CLIP} SELECT point_id FROM points, q WHERE f2 BETWEEN l2 AND h2 AND f1 BETWEEN l1 AND h1", uses="points")
def _(t):
    return profiling.quantile_clip(t.points, ["f2", "f1"]).select("point_id")


@query("quantile_clip_fence", f"""WITH {NUM}, q AS (SELECT quantile_cont(heavy, 0.002) AS lo, quantile_cont(heavy, 0.998) AS hi, quantile_cont(heavy, 0.25) AS q1, quantile_cont(heavy, 0.75) AS q3 FROM num)
 SELECT id FROM num, q WHERE heavy BETWEEN CASE WHEN q3 > q1 THEN greatest(lo, q1 - 3 * (q3 - q1)) ELSE lo END AND CASE WHEN q3 > q1 THEN least(hi, q3 + 3 * (q3 - q1)) ELSE hi END""", uses="points")
def _(t):
    return profiling.quantile_clip(num(t), ["heavy"], iqr_k=3.0).select("id")


@query("histogram_2d", f"""WITH {CLIP}, i AS (SELECT f2, f1, y FROM points, q WHERE f2 BETWEEN l2 AND h2 AND f1 BETWEEN l1 AND h1),
 n AS (SELECT least(greatest(floor(sqrt(count(*)) / 3), 25), 80) AS base, count(DISTINCT round(f2, 8)) AS ux, count(DISTINCT round(f1, 8)) AS uy, min(f2) AS x0, max(f2) AS x1, min(f1) AS y0, max(f1) AS y1 FROM i),
 b AS (SELECT *, least(greatest(least(base, greatest(10, ux // 3)), 25), 80) AS nx, least(greatest(least(base, greatest(10, uy // 3)), 25), 80) AS ny FROM n)
 SELECT least(floor((f2 - x0) / (x1 - x0) * nx), nx - 1)::INT AS x_bin, least(floor((f1 - y0) / (y1 - y0) * ny), ny - 1)::INT AS y_bin, y, count(*) AS n FROM i, b GROUP BY ALL""", uses="points")
def _(t):
    return profiling.histogram_2d(t.points, "f2", "f1", "y")


@query("label_distribution", "SELECT source AS cluster, quality, count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY source) AS percent FROM documents JOIN labels USING (doc_id) GROUP BY source, quality", rounds="percent")
def _(t):
    from tallyloom.operators.selection import label_distribution

    labelled = t.documents.select("doc_id", F.col("source").alias("cluster")).join(t.labels, "doc_id")
    return label_distribution(labelled, "cluster", "quality")


@query("column_means_impute", f"WITH {NUM} SELECT id, coalesce(gappy, (SELECT avg(gappy) FROM num)) AS gappy, price FROM num", rounds="gappy price", uses="points")
def _(t):
    df = num(t).select("id", "gappy", "price")
    return prep.impute(df, prep.fit_means(df, ["gappy", "price"]))


@query("drop_sparse_columns", """WITH x AS (SELECT point_id AS id, f1, CASE WHEN point_id % 9 = 0 THEN NULL ELSE f2 END AS f2, CASE WHEN point_id = (SELECT min(point_id) FROM points) THEN NULL ELSE f3 END AS f3 FROM points)
 SELECT id, f1, coalesce(f3, (SELECT (sum(f1) + sum(f3)) / (count(f1) + count(f3)) FROM x)) AS f3 FROM x""", rounds="f1 f3", uses="points")
def _(t):
    first = t.points.agg(F.min("point_id")).first()[0]
    df = t.points.select(
        F.col("point_id").alias("id"), "f1", F.when(F.col("point_id") % 9 != 0, F.col("f2")).alias("f2"), F.when(F.col("point_id") != first, F.col("f3")).alias("f3")
    )
    return prep.drop_sparse_columns(df, ["f1", "f2", "f3"])


@query("nan_variance", f"WITH {NUM} SELECT var_pop(gappy) AS v FROM num", rounds="v", digits=9, uses="points")
def _(t):
    filled = F.when(F.col("gappy").isNull() & (F.col("id") % 2 == 0), F.lit(float("nan"))).otherwise(F.col("gappy"))
    return num(t).agg(arrays.nan_variance(filled).alias("v"))


@query("positive_columns", f"WITH {NUM}, {LONG} SELECT feature FROM long GROUP BY feature HAVING sum(sign(v)) > 0", uses="points")
def _(t):
    return arrays.positive_columns(num(t), COLUMNS)


@query("nonzero_diag_product", "SELECT product(l_discount * 10) AS product FROM lineitem WHERE l_orderkey = l_partkey AND l_discount <> 0", rounds="product", digits=9)
def _(t):
    cells = t.lineitem.select("l_orderkey", "l_partkey", (F.col("l_discount") * 10).alias("v"))
    return arrays.nonzero_diag_product(cells, "l_orderkey", "l_partkey", "v")


# --- preparation ------------------------------------------------------------------------------------


@query("categorical_detect", f"WITH {NUM}, {LONG} SELECT feature, count(DISTINCT v) AS n_distinct, CASE WHEN count(DISTINCT v) < 10 THEN 1 ELSE 0 END AS is_categorical FROM long GROUP BY feature", uses="points")
def _(t):
    return prep.categorical_columns(num(t), COLUMNS)


@query("class_weights", "SELECT p_type, (SELECT count(*) FROM part) / (count(*) * (SELECT count(DISTINCT p_type) FROM part)) AS weight FROM part GROUP BY p_type", rounds="weight")
def _(t):
    return prep.class_weights(t.part, "p_type")


SCALED = ["f1", "f2"]


def scaler_query(kind: str, sql: str):
    @query(f"scale_{kind}", f"SELECT point_id, {sql.format(c='f1')} AS f1, {sql.format(c='f2')} AS f2 FROM points, (SELECT "
           + ", ".join(f"avg({c}) AS {c}_mu, stddev_pop({c}) AS {c}_sd, min({c}) AS {c}_lo, max({c}) AS {c}_hi, max(abs({c})) AS {c}_ab, median({c}) AS {c}_md, "
                       f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_iq" for c in SCALED) + " FROM points) AS s", rounds=SCALED, uses="points")
    def _(t):
        df = t.points.select("point_id", *SCALED)
        return prep.scale(df, prep.fit_scaler(df, SCALED, kind))


scaler_query("standard", "({c} - {c}_mu) / {c}_sd")
scaler_query("minmax", "({c} - {c}_lo) / ({c}_hi - {c}_lo)")
scaler_query("maxabs", "{c} / {c}_ab")
scaler_query("robust", "({c} - {c}_md) / {c}_iq")


@query("impute_median", f"WITH {NUM} SELECT id, coalesce(gappy, (SELECT median(gappy) FROM num)) AS gappy, coalesce(few, (SELECT median(few) FROM num), 0.0) AS few FROM num", rounds="gappy few", uses="points")
def _(t):
    df = num(t).select("id", "gappy", "few")
    return prep.impute(df, prep.fit_medians(df, ["gappy", "few"]))


@query("one_hot", "SELECT o_orderkey, " + ", ".join(f"CASE WHEN o_orderstatus = '{s}' THEN 1 ELSE 0 END AS st_{s}" for s in "FO") + " FROM orders")
def _(t):
    """Fitted on orders without status P, so that P is unknown later."""
    values = prep.categories(t.orders.where("o_orderstatus <> 'P'"), "o_orderstatus")
    return prep.one_hot(t.orders, "o_orderstatus", values, "st").select("o_orderkey", *[f"st_{v}" for v in values])


@query("poly2", "SELECT point_id, 1.0 AS one, f1, f3, f1 * f1 AS f1_x_f1, f1 * f3 AS f1_x_f3, f3 * f3 AS f3_x_f3 FROM points", rounds="f1 f3 f1_x_f1 f1_x_f3 f3_x_f3", uses="points")
def _(t):
    return prep.poly2(t.points.select("point_id", "f1", "f3"), ["f1", "f3"])


@query("stratified_folds", f"""SELECT id, y, (row_number() OVER (PARTITION BY y ORDER BY {mixed_sql('id', 7)}, id) - 1) % 5 AS fold FROM scores""", uses="scores")
def _(t):
    return sampling.stratified_folds(t.scores, "id", "y", 5, 7).select("id", "y", "fold")


@query("train_test_split", f"""WITH r AS (SELECT id, row_number() OVER (ORDER BY {mixed_sql('id', 42)}, id) AS p, count(*) OVER () AS n FROM scores)
 SELECT id, CASE WHEN p <= least(greatest(1, floor(n * 0.35 + 0.5)), n - 1) THEN 1 ELSE 0 END AS is_test FROM r""", uses="scores")
def _(t):
    return sampling.train_test_split(t.scores, "id", 0.35, 42).select("id", "is_test")


@query("shuffle_column", f"""WITH a AS (SELECT id, y, row_number() OVER (ORDER BY id) AS p FROM scores), b AS (SELECT score, row_number() OVER (ORDER BY {mixed_sql('id', 3)}, id) AS p FROM scores)
 SELECT id, y, score FROM a JOIN b USING (p)""", rounds="score", uses="scores")
def _(t):
    return sampling.shuffle_column(t.scores, "id", "score", 3)


@query("bootstrap_sample")
def _(t):
    columns = sampling.sample_features(["y", "score"], 0.5, seed=1)
    return sampling.bootstrap_rows(t.scores, "id", 0.7, 5).select("draw", "id", *columns)


@query("to_normal_fit")
def _(t):
    return prep.to_normal_fit(num(t), ["price", "qty", "disc", "heavy"], 12)


@query("to_normal")
def _(t):
    df = num(t).select("id", "price", "qty", "heavy")
    train = df.where("id % 10 < 7")
    fitted = prep.to_normal_fit(train, ["price", "qty", "heavy"], 12)
    return prep.to_normal(train, df.where("id % 10 >= 7"), fitted, "id", quantile_fallback=True, scaler="standard")


@query("ks_normal_test")
def _(t):
    df = num(t).select("id", "price", "qty")
    scaled = prep.scale(df, prep.fit_scaler(df, ["price", "qty"]))
    rows = [(c, prep.ks_normal_test(scaled, c)) for c in ("price", "qty")]
    return t.spark.createDataFrame(rows, "feature string, p_value double")


# --- metrics --------------------------------------------------------------------------------------------

COUNTS = "SELECT {t} count(*) FILTER (WHERE y = 1 AND p = 1)::DOUBLE AS tp, count(*) FILTER (WHERE y = 0 AND p = 1)::DOUBLE AS fp, count(*) FILTER (WHERE y = 1 AND p = 0)::DOUBLE AS fn, count(*) FILTER (WHERE y = 0 AND p = 0)::DOUBLE AS tn"
METRICS = {
    "accuracy": "(tp + tn) / (tp + fp + fn + tn)",
    "balanced_accuracy": "(coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2",
    "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)",
    "precision": "coalesce(tp / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(tp / nullif(tp + fn, 0), 0)",
    "mcc": "coalesce((tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0)",
}


@query("threshold_metrics", f"WITH c AS ({COUNTS.format(t='')} FROM (SELECT y, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p FROM scores) AS x) SELECT "
       + ", ".join(f"{e} AS {n}" for n, e in METRICS.items()) + " FROM c", rounds=list(METRICS), uses="scores")
def _(t):
    return metrics.threshold_metrics(t.scores, "y", "score", 0.5)


@query("confusion_matrix", "SELECT y, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted, count(*) / (SELECT count(*) FROM scores) AS share FROM scores GROUP BY ALL", rounds="share", uses="scores")
def _(t):
    hit = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return metrics.confusion_matrix(t.scores.select("y", hit), "y", "predicted")


AUC = """r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM scores),
auc AS (SELECT (sum(rk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0) / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)) AS roc_auc FROM r)"""


@query("roc_auc", f"WITH {AUC} SELECT roc_auc FROM auc", rounds="roc_auc", uses="scores")
def _(t):
    return metrics.roc_auc(t.scores, "y", "score")


STEPS = """g AS (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM scores GROUP BY score),
c AS (SELECT score, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS ap, sum(neg) OVER () AS an FROM g WINDOW w AS (ORDER BY score DESC))"""


@query("roc_curve", f"WITH {STEPS} SELECT score AS threshold, fp / an AS fpr, tp / ap AS tpr FROM c", rounds="threshold fpr tpr", uses="scores")
def _(t):
    return metrics.roc_curve(t.scores, "y", "score")


@query("average_precision", f"WITH {STEPS} SELECT sum(pos / ap * (tp / (tp + fp))) AS average_precision FROM c", rounds="average_precision", uses="scores")
def _(t):
    return metrics.average_precision(t.scores, "y", "score")


@query("log_loss", "SELECT avg(-CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) AS log_loss FROM (SELECT y, least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS p FROM scores) AS x", rounds="log_loss", uses="scores")
def _(t):
    return metrics.log_loss(t.scores.withColumn("score", F.least("score", F.lit(1.0))), "y", "score")


@query("regression_error", "SELECT avg((f2 - f1 * 1500) ** 2) AS mse, sqrt(avg((f2 - f1 * 1500) ** 2)) AS rmse FROM points", rounds="mse rmse", digits=2, uses="points")
def _(t):
    return metrics.regression_error(t.points.withColumn("p", F.col("f1") * 1500), "f2", "p")


@query("margin_to_probability", "SELECT id, 1 / (1 + exp(-(score * 6 - 3))) AS p FROM scores", rounds="p", uses="scores")
def _(t):
    return t.scores.select("id", metrics.margin_to_probability(F.col("score") * 6 - 3).alias("p"))


@query("validate_binary_target", "SELECT y, count(*) AS n FROM scores GROUP BY y", uses="scores")
def _(t):
    return metrics.validate_binary_target(t.scores, "y").groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@query("threshold_grid", "SELECT DISTINCT a + (b - a) * (pl - floor(pl)) AS threshold FROM (SELECT i, n, i * (n - 1) / 399 AS pl, s[1 + (i * (n - 1) // 399)] AS a, s[1 + ((i * (n - 1) + 398) // 399)] AS b FROM "
       "(SELECT list(f2 ORDER BY f2) AS s, count(*) AS n FROM points) AS x, range(400) AS r(i)) AS y", rounds="threshold", digits=4, uses="points")
def _(t):
    return metrics.threshold_grid(t.points, "f2", 400)


CURVE = f"""d AS (SELECT DISTINCT score AS threshold FROM scores), cc AS ({COUNTS.format(t='threshold,')} FROM (SELECT threshold, y, CASE WHEN score >= threshold THEN 1 ELSE 0 END AS p FROM scores, d) AS x GROUP BY threshold),
curve AS (SELECT threshold, {METRICS['f1']} AS value FROM cc)"""


@query("threshold_curve", f"WITH {CURVE} SELECT * FROM curve", rounds="threshold value", uses="scores")
def _(t):
    return metrics.threshold_curve(t.scores, "y", "score", "f1")


@query("threshold_curve_below", f"""WITH d AS (SELECT DISTINCT score AS threshold FROM scores), cc AS ({COUNTS.format(t='threshold,')} FROM (SELECT threshold, y, CASE WHEN score <= threshold THEN 1 ELSE 0 END AS p FROM scores, d) AS x GROUP BY threshold)
 SELECT threshold, {METRICS['mcc']} AS value FROM cc""", rounds="threshold value", uses="scores")
def _(t):
    return metrics.threshold_curve(t.scores, "y", "score", "mcc", positive_if_ge=False)


@query("best_threshold", f"WITH {CURVE} SELECT threshold AS best_threshold, value AS best_value FROM curve ORDER BY value DESC, threshold LIMIT 1", rounds="best_threshold best_value", uses="scores")
def _(t):
    return metrics.best_threshold(metrics.threshold_curve(t.scores, "y", "score", "f1"))


@query("score_report", """WITH q AS (SELECT quantile_cont(score, 0.002) AS lo, quantile_cont(score, 0.998) AS hi FROM scores), k AS (SELECT scores.* FROM scores, q WHERE score BETWEEN lo AND hi),
 s AS (SELECT min(score) AS lo, max(score) AS hi, count(*) AS n, quantile_cont(score, 0.75) - quantile_cont(score, 0.25) AS iqr FROM k),
 b AS (SELECT lo, hi, least(greatest(ceil((hi - lo) / greatest(2 * iqr / cbrt(n), 0.08)), 20), 80)::INT AS bins FROM s)
 SELECT least(floor((score - lo) / (hi - lo) * bins), bins - 1)::INT AS bin, y, count(*) AS n FROM k, b GROUP BY ALL""", uses="scores")
def _(t):
    """The histogram part; the threshold part is ``threshold_curve`` and ``best_threshold``."""
    from tallyloom.operators.selection import score_report

    return score_report(t.scores, "y", "score")["histogram"].select("bin", "y", "n")


# --- trees ------------------------------------------------------------------------------------------------

@query("impurity", """WITH c AS (SELECT p_brand, count(*) FILTER (WHERE p_size % 3 = 0) AS c0, count(*) FILTER (WHERE p_size % 3 = 1) AS c1, count(*) FILTER (WHERE p_size % 3 = 2) AS c2, count(*) AS n FROM part GROUP BY p_brand)
 SELECT p_brand, c0, c1, c2, 1 - (c0 / n) ** 2 - (c1 / n) ** 2 - (c2 / n) ** 2 AS gini, -(c0 / n) * ln(c0 / n + 1e-6) - (c1 / n) * ln(c1 / n + 1e-6) - (c2 / n) * ln(c2 / n + 1e-6) AS entropy FROM c""", rounds="gini entropy")
def _(t):
    return trees.impurity_table(t.part.withColumn("k", F.col("p_size") % 3), "k", 3, ["p_brand"])


FEATURES = ["f1", "f2", "f3"]
PREFIX = ", ".join(f"""p_{f} AS (SELECT '{f}' AS feature, {f} AS value, count(*) FILTER (WHERE y = 0) AS n0, count(*) FILTER (WHERE y = 1) AS n1 FROM points GROUP BY {f})""" for f in FEATURES)
PREFIX += ", pre AS (" + " UNION ALL ".join(f"SELECT * FROM p_{f}" for f in FEATURES) + """), cum AS (SELECT feature, value, n0, n1, lag(value) OVER w AS prev_value, sum(n0) OVER w AS upto0, sum(n1) OVER w AS upto1,
 sum(n0) OVER (PARTITION BY feature) AS all0, sum(n1) OVER (PARTITION BY feature) AS all1 FROM pre WINDOW w AS (PARTITION BY feature ORDER BY value))"""


@query("class_prefix_counts", f"WITH {PREFIX} SELECT feature, value, prev_value, n0, n1, upto0::BIGINT AS upto0, upto1::BIGINT AS upto1 FROM cum", rounds="value prev_value", uses="points")
def _(t):
    return trees.class_prefix_counts(profiling.melt(t.points, FEATURES, ["y"]), ["feature"], "y", 2)


def gain_sql(kind: str) -> str:
    def imp(a: str, b: str) -> str:
        n = f"({a} + {b})"
        if kind == "gini":
            return f"(1 - ({a} / {n}) ** 2 - ({b} / {n}) ** 2)"
        return f"(-({a} / {n}) * ln({a} / {n} + 1e-6) - ({b} / {n}) * ln({b} / {n} + 1e-6))"

    left, right = ("(upto0 - n0)", "(upto1 - n1)"), ("(all0 - upto0 + n0)", "(all1 - upto1 + n1)")
    return f"{imp('all0', 'all1')} - ({left[0]} + {left[1]}) / (all0 + all1) * {imp(*left)} - ({right[0]} + {right[1]}) / (all0 + all1) * {imp(*right)}"


for _kind in ("gini", "entropy"):

    @query(f"best_split_{_kind}" if _kind == "entropy" else "best_split", f"""WITH {PREFIX}, gains AS (SELECT feature, (prev_value + value) / 2 AS threshold, {gain_sql(_kind)} AS gain FROM cum WHERE prev_value IS NOT NULL)
 SELECT * FROM gains ORDER BY round(gain, 12) DESC, feature, threshold LIMIT 1""", rounds="threshold gain", digits=9, uses="points")
    def _(t, kind=_kind):
        return trees.best_split(t.points, FEATURES, "y", 2, kind)


def tree_sql(source: str, features: list[str], target: str, depth: int, least: int, kind: str) -> tuple[str, str]:
    """(WITH parts, last table) that place every row (``x``) in its leaf (``node``), grown level by level."""

    def term(n: str, s: str, q: str) -> str:
        if kind == "mse":
            return f"greatest({q} / {n} - ({s} / {n}) * ({s} / {n}), 0)"
        return f"(1 - ({s} / {n}) ** 2 - (({n} - {s}) / {n}) ** 2)"

    parts = [f"d0 AS (SELECT {', '.join(f'{f}::DOUBLE AS {f}' for f in features)}, ({target})::DOUBLE AS y, 1::BIGINT AS node FROM {source})"]
    for d in range(depth):
        values = " UNION ALL ".join(f"SELECT node, {i} AS place, '{f}' AS feature, {f} AS v, y FROM o{d}" for i, f in enumerate(features))
        left, right, whole = ("ln", "ls", "lq"), ("an - ln", "asum - ls", "aq - lq"), ("an", "asum", "aq")
        gain = f"{term(*whole)} - ln / an * {term(*left)} - (an - ln) / an * {term(*(f'({x})' for x in right))}"
        parts += [
            f"n{d} AS (SELECT node FROM d{d} GROUP BY node HAVING count(*) > {least} AND min(y) < max(y) AND node >= {2 ** d})",
            f"o{d} AS (SELECT * FROM d{d} WHERE node IN (SELECT node FROM n{d}))",
            f"g{d} AS (SELECT node, place, feature, v, count(*)::DOUBLE AS n, sum(y) AS s, sum(y * y) AS q FROM ({values}) AS u GROUP BY ALL)",
            f"""c{d} AS (SELECT node, place, feature, v, lag(v) OVER w AS p, sum(n) OVER w - n AS ln, sum(s) OVER w - s AS ls, sum(q) OVER w - q AS lq, sum(n) OVER a AS an, sum(s) OVER a AS asum, sum(q) OVER a AS aq
 FROM g{d} WINDOW w AS (PARTITION BY node, feature ORDER BY v), a AS (PARTITION BY node, feature))""",
            f"b{d} AS (SELECT node AS parent, feature, (p + v) / 2 AS threshold FROM c{d} WHERE p IS NOT NULL QUALIFY row_number() OVER (PARTITION BY node ORDER BY round({gain}, 12) DESC, place, (p + v) / 2) = 1)",
            f"d{d + 1} AS (SELECT {', '.join(features)}, y, CASE WHEN parent IS NULL THEN node ELSE 2 * node + CASE WHEN CASE feature {' '.join(f'WHEN {chr(39)}{f}{chr(39)} THEN {f}' for f in features)} END < threshold THEN 0 ELSE 1 END END AS node FROM d{d} LEFT JOIN b{d} ON node = parent)",
        ]
    return ", ".join(parts), f"d{depth}"


TREE, TREE_END = tree_sql("points", FEATURES, "y", 3, 20, "gini")


@query("decision_tree", f"""WITH {TREE}, l AS (SELECT node, avg(y) AS p FROM {TREE_END} GROUP BY node)
 SELECT node AS leaf, y::INT AS y, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction, count(*) AS n FROM {TREE_END} JOIN l USING (node) GROUP BY ALL""", uses="points")
def _(t):
    """Three levels over three features."""
    tree = trees.LevelTree(max_depth=3, min_leaf_size=20).fit(t.points, FEATURES, "y", 2)
    return tree.transform(t.points).groupBy("leaf", F.col("y").cast("int").alias("y"), "prediction").agg(F.count(F.lit(1)).alias("n"))


PARTS = ["l_quantity", "l_discount", "l_tax"]
REGRESSION, REGRESSION_END = tree_sql("lineitem", PARTS, "l_extendedprice", 3, 20, "mse")


@query("regression_tree", f"WITH {REGRESSION} SELECT node AS leaf, count(*) AS n, avg(y) AS prediction FROM {REGRESSION_END} GROUP BY node", rounds="prediction", digits=4)
def _(t):
    """Three levels over three features, split by squared error; leaves predict the mean price."""
    tree = trees.LevelTree("mse", max_depth=3, min_leaf_size=20).fit(t.lineitem, PARTS, "l_extendedprice")
    return tree.transform(t.lineitem).groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max("prediction").alias("prediction"))


@query("squared_error", "SELECT l_linestatus, l_returnflag, count(*) AS n, avg(l_quantity::DOUBLE) AS mean, var_pop(l_quantity::DOUBLE) AS mse FROM lineitem GROUP BY ALL", rounds="mean mse")
def _(t):
    return trees.error_table(t.lineitem, "l_quantity", ["l_linestatus", "l_returnflag"])


IMPORTANCE = """imp AS (SELECT n_nationkey AS model, mkt AS feature, coalesce(c, 0) / sum(coalesce(c, 0)) OVER (PARTITION BY n_nationkey) AS p FROM nation CROSS JOIN (SELECT DISTINCT c_mktsegment AS mkt FROM customer) AS s
 LEFT JOIN (SELECT c_nationkey, c_mktsegment, count(*) AS c FROM customer GROUP BY ALL) AS g ON c_nationkey = n_nationkey AND c_mktsegment = mkt)"""


def _kl(p: str, q: str) -> str:
    r = f"(CASE WHEN {q} > 1e-4 THEN {p} / {q} ELSE 0 END)"
    return f"{p} * CASE WHEN {r} > 1e-4 THEN ln({r}) ELSE 0 END"


@query("kl_distance", f"WITH {IMPORTANCE} SELECT a.model AS model_a, b.model AS model_b, sum({_kl('a.p', 'b.p')} + {_kl('b.p', 'a.p')}) AS distance FROM imp a JOIN imp b ON a.feature = b.feature AND a.model < b.model GROUP BY ALL", rounds="distance")
def _(t):
    """Share of each segment per nation stands for a model's importance vector: 25 models."""
    from tallyloom.operators.selection import kl_distances

    counts = t.customer.groupBy(F.col("c_nationkey").alias("model"), F.col("c_mktsegment").alias("feature")).agg(F.count(F.lit(1)).alias("c"))
    return kl_distances(counts, "model", "feature", "c")
