"""Queries for matrices, models, importance, selection and batches of points."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import batches, matrix, metrics, models, profiling, sampling, selection
from tallyloom.operators.joins import validity_label
from tallyloom.plans import q_evaluate as ev
from tallyloom.plans.registry import query
from tallyloom.session import shared_folder
from tallyloom.sources import tables

FEATURES = ["f1", "f2", "f3", "f4"]


# --- matrices ------------------------------------------------------------------------------

CELLS = "cells AS (" + " UNION ALL ".join(f"SELECT point_id, '{f}' AS feature, {f}::DOUBLE AS value FROM points" for f in FEATURES) + ")"


def q_value(partition: str) -> str:
    over = f"PARTITION BY {partition}" if partition else ""
    ties = f"PARTITION BY {partition + ', ' if partition else ''}value"
    return f"""CASE WHEN value = min(value) OVER ({over}) THEN 0.0 WHEN value = max(value) OVER ({over}) THEN 1.0
 ELSE (rank() OVER ({over} ORDER BY value) + (count(*) OVER ({ties}) - 1) / 2.0 - 1) / (count(*) OVER ({over}) - 1) END"""


SCALES = {"row": "point_id", "column": "feature", "global": ""}


@query("quantile_scale", f"WITH {CELLS} " + " UNION ALL ".join(f"SELECT '{n}' AS scope, point_id, feature, {q_value(p)} AS q_value FROM cells" for n, p in SCALES.items()),
       rounds="q_value", uses="points")
def _(t):
    out = None
    for scope in SCALES:
        part = matrix.matrix_long(t.points, "point_id", FEATURES, scope).select(F.lit(scope).alias("scope"), "point_id", "feature", "q_value")
        out = part if out is None else out.unionByName(part)
    return out


@query("matrix_long", f"WITH {CELLS} SELECT point_id, y, feature, value, {q_value('feature')} AS q_value FROM cells JOIN points USING (point_id)".replace("SELECT point_id, y, feature, value,", "SELECT cells.point_id, y, feature, value,"),
       rounds="value q_value", uses="points")
def _(t):
    return matrix.matrix_long(t.points, "point_id", FEATURES, "column", cluster="y")


@query("cluster_row_order")
def _(t):
    return matrix.cluster_row_order(t.points, "point_id", ["f1", "f3", "f4"], 6)


@query("selected_rows", """SELECT row_number() OVER (ORDER BY o_orderkey) AS position, '"' || o_orderpriority || '-' || cast(o_orderkey AS varchar) || '"' AS quoted
 FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 48)""")
def _(t):
    cells = t.lineitem.where("l_quantity >= 48").select(F.col("l_orderkey").alias("o_orderkey")).join(t.orders, "o_orderkey")
    cells = cells.select("o_orderkey", F.concat_ws("-", "o_orderpriority", F.col("o_orderkey").cast("string")).alias("label"))
    return matrix.selected_rows(cells, "o_orderkey", "label")


@query("top_abs_weights", """WITH w AS (SELECT p_brand AS feature, avg(p_retailprice) - (SELECT avg(p_retailprice) FROM part) AS weight FROM part GROUP BY p_brand)
 SELECT feature, weight, abs(weight) AS absolute_weight FROM w ORDER BY absolute_weight DESC, feature LIMIT 5""", rounds="weight absolute_weight")
def _(t):
    mean = t.part.agg(F.avg("p_retailprice")).first()[0]
    weights = t.part.groupBy(F.col("p_brand").alias("feature")).agg((F.avg("p_retailprice") - mean).alias("weight"))
    return selection.top_abs_weights(weights, 5)


@query("feature_list_json", f"""WITH {ev.NUM}, {ev.LONG}, rho AS ({ev.RHO}) SELECT feature FROM long GROUP BY feature HAVING count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END) <= 1
 UNION SELECT b.feature FROM long a JOIN long b ON a.id = b.id AND a.feature = 'qty' AND b.feature IN ('qty_copy', 'qty_line', 'capped') GROUP BY ALL HAVING count(*) FILTER (WHERE a.v IS DISTINCT FROM b.v) = 0
 UNION SELECT b FROM rho WHERE abs(rho) >= 0.995""", uses="points")
def _(t):
    df = ev.num(t)
    none = F.lit(None).cast("string")
    constant = profiling.constant_columns(df, ev.COLUMNS).select(F.lit("constant").alias("kind"), "feature", none.alias("other"))
    twins = profiling.duplicate_columns(df, "id", ev.COLUMNS).select(F.lit("duplicate").alias("kind"), "feature", F.col("duplicate").alias("other"))
    groups = profiling.high_corr_columns(profiling.spearman_matrix(df, "id", ev.SPEAR), ev.SPEAR, 0.995)
    linked = groups.select(F.lit("correlated").alias("kind"), "feature", F.col("leader").alias("other"))
    path = shared_folder(t.spark, "drop-lists")
    tables.write_feature_lists(constant.unionByName(twins).unionByName(linked), path)
    return tables.read_drop_list(t.spark, path)


@query("assign_cluster", """SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 'toxic' ELSE source END AS cluster FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR quality <> 0""")
def _(t):
    assigned = t.documents.select(F.col("doc_id").alias("id"), F.col("source").alias("cluster"))
    picked = t.labels.select(F.col("doc_id").alias("id"), "toxic", "quality")
    assigned = selection.assign_cluster(assigned, picked.where("toxic = 1"), "toxic")
    return selection.remove_from_cluster(assigned, picked.where("quality = 0"))


# --- logistic pieces ---------------------------------------------------------------------------

W = [0.25, 1.5, -2.0, 0.5]
L2 = 0.1
SIGNED = "signed AS (SELECT point_id, 2 * y - 1 AS y, f1 / 50 AS a, f2 / 500000 AS b, f3 * 10 AS c FROM points), z AS (SELECT *, 0.25 + 1.5 * a - 2.0 * b + 0.5 * c AS s FROM signed)"
PENALTY = L2 * sum(w * w for w in W[1:])


def signed(t):
    return t.points.select("point_id", (2 * F.col("y") - 1).alias("y"), (F.col("f1") / 50).alias("a"), (F.col("f2") / 500000).alias("b"), (F.col("f3") * 10).alias("c"))


@query("logistic_loss", f"WITH {SIGNED} SELECT avg(ln(1 + exp(-y * s))) + {PENALTY} AS loss FROM z", rounds="loss", uses="points")
def _(t):
    return models.logistic_loss(signed(t), ["a", "b", "c"], "y", W, L2)


@query("logistic_gradient", f"WITH {SIGNED} " + " UNION ALL ".join(
    f"SELECT '{n}' AS term, avg(-y / (1 + exp(y * s)) * {v}) + {2 * L2 * w} AS gradient FROM z" for n, v, w in [("bias", "1", 0.0), ("a", "a", W[1]), ("b", "b", W[2]), ("c", "c", W[3])]),
       rounds="gradient", uses="points")
def _(t):
    return models.logistic_gradient(signed(t), ["a", "b", "c"], "y", W, L2)


# --- models ---------------------------------------------------------------------------------------


def split(t):
    """Points flagged for training and testing by the last digit of the key."""
    test = F.col("point_id") % 10 >= 7
    return t.points.where(~test), t.points.where(test)


def auc_frame(t, **values):
    return t.spark.createDataFrame([(n, float(v)) for n, v in values.items()], "what string, value double")


@query("fit_logistic")
def _(t):
    train, test = split(t)
    scaler, model = models.fit_logistic(train, FEATURES)
    scored = models.score_column(model, scaler.transform(models.assemble(test, FEATURES, "raw")))
    weights = {f: w for f, w in zip(FEATURES, model.coefficients)}
    return auc_frame(t, auc=metrics.roc_auc(scored, "y", "score").first()[0], reg=model.getOrDefault("regParam"), **weights)


@query("fit_boosted")
def _(t):
    train, test = split(t)
    flagged = train.withColumn("is_val", F.col("point_id") % 10 == 6)
    model = models.fit_boosted(flagged, FEATURES, validation="is_val")
    return auc_frame(t, auc=models.auc_of(model, models.assemble(test, FEATURES)), trees=len(model.trees))


@query("tune_grid")
def _(t):
    return models.tune_grid(split(t)[0], FEATURES, rates=(0.05, 0.1, 0.3), depths=(2, 3, 4))[1]


@query("stack_scores")
def _(t):
    train, test = split(t)
    boosted = models.fit_boosted(train, FEATURES)
    plain = models.quick_logistic(train, FEATURES, "y")
    stacked = models.stack_scores([boosted, plain], models.assemble(train, FEATURES), models.assemble(test, FEATURES))
    return stacked.select("point_id", "y", "score")


@query("random_forest")
def _(t):
    train, test = split(t)
    model = models.fit_forest(train, FEATURES)
    scored = models.score_column(model, models.assemble(test, FEATURES))
    return scored.select("point_id", "score", (F.col("score") > 0.5).cast("int").alias("predicted"))


@query("pca_project")
def _(t):
    from tallyloom.operators.prep import fit_scaler, scale

    df = scale(t.points.select("point_id", *FEATURES), fit_scaler(t.points, FEATURES))
    return models.pca_project(df, FEATURES, 2).select("point_id", F.col("pca")[0].alias("x"), F.col("pca")[1].alias("y"))


@query("adversarial_validation")
def _(t):
    early = F.col("point_id") % 2 == 0
    return models.adversarial_validation(t.points.where(early), t.points.where(~early), "point_id", FEATURES)


@query("model_importance")
def _(t):
    return models.model_importance(models.fit_forest(split(t)[0], FEATURES), FEATURES, t.spark)


@query("permutation_importance")
def _(t):
    train, test = split(t)
    return models.permutation_importance(models.fit_forest(train, FEATURES), test, "point_id", FEATURES, repeats=5)


@query("feature_ablation")
def _(t):
    return models.feature_ablation(*split(t), FEATURES)


@query("greedy_backward_elimination")
def _(t):
    """With a column that repeats the label on training rows only, dropping it helps and must happen."""
    train, test = split(t)
    leak = lambda d, flip: d.withColumn("leak", F.when(F.col("y") == flip, 1.0).otherwise(0.0) + F.col("f3"))
    return models.greedy_backward_elimination(leak(train, 1), leak(test, 0), [*FEATURES, "leak"])


@query("suggest_drops")
def _(t):
    train, test = split(t)
    odd = lambda d: d.withColumns({"same": F.lit(1.0), "twin": F.col("f1"), "line": F.col("f2") * 2 + 1})
    return models.suggest_drops(odd(train), odd(test), "point_id", [*FEATURES, "same", "twin", "line"])


@query("compare_clusters")
def _(t):
    df = t.points.withColumn("cluster", F.when(F.col("f2") > 300000, "high").when(F.col("f2") > 100000, "middle").otherwise("low"))
    return models.compare_clusters(df, "point_id", "cluster", "middle", "high", ["f1", "f3", "y"], label="y")["metrics"]


# --- batches of points --------------------------------------------------------------------------------


def valid_points(t):
    return t.points.where("f3 < 0.08")


@query("space_filling_points")
def _(t):
    """One low-discrepancy point per known point, in the box estimated from them."""
    low, high = batches.estimate_box(t.points, FEATURES, 0.25)
    index = t.points.select(F.col("point_id").alias("id"))
    return batches.box_points(index, FEATURES, low, high, seed=7)


@query("candidate_pool")
def _(t):
    return batches.candidate_pool(valid_points(t), "point_id", FEATURES, t.points.count())


@query("expansion_batch")
def _(t):
    return batches.expansion_batch(valid_points(t), t.points, "point_id", FEATURES, batch=1000)


@query("ensemble_uncertainty")
def _(t):
    train, test = split(t)
    return models.ensemble_uncertainty(train, test.select("point_id", *FEATURES), FEATURES, "f2").select("point_id", "mean", "uncertainty")


@query("validity_model")
def _(t):
    requested = validity_label(t.points, valid_points(t), FEATURES)
    model = models.validity_model(requested, FEATURES)
    return models.score_column(model, models.assemble(requested, FEATURES), "p_valid").select("point_id", "is_valid", "p_valid")


@query("acquisition_score", "SELECT id, (id % 100) / 10.0 * least(greatest(score, 0.05), 1.0) AS a, -abs(score - 0.60) AS b FROM scores", rounds="a b", uses="scores")
def _(t):
    p = F.col("score")
    return t.scores.select("id", batches.acquisition_score(F.col("id") % 100 / 10.0, p).alias("a"), batches.boundary_score(p).alias("b"))


@query("diverse_top")
def _(t):
    pool = t.points.select(F.col("point_id").alias("id"), *FEATURES, (F.col("f2") * F.col("f1")).alias("score"))
    return batches.diverse_top(pool, FEATURES, "score", 50)


@query("active_batch")
def _(t):
    requested = validity_label(t.points, valid_points(t), FEATURES)
    return batches.active_batch(valid_points(t), requested, "point_id", FEATURES, "f2", batch=1000, pool_size=100_000)


@query("greedy_spread")
def _(t):
    pool = batches.candidate_pool(valid_points(t), "point_id", FEATURES, t.points.count())
    low, high = batches.estimate_box(valid_points(t), FEATURES)
    unit = {f: (F.col(f) - low[f]) / (high[f] - low[f]) for f in FEATURES}
    requested = validity_label(t.points, valid_points(t), FEATURES)
    return batches.greedy_spread(pool.withColumns(unit), valid_points(t).withColumns(unit), "point_id", FEATURES, 50, requested.withColumns(unit))
