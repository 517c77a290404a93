"""Known answers for the array, impurity, loss, name and linkage operators."""

import math
import random
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import numeric, similarity, text
from tallyloom.operators import arrays, linkage, metrics, models, names, neighbours, prep, profiling, rows, trees


def frame(spark, rows_, schema):
    return spark.createDataFrame(rows_, schema)


def matrix(spark, m):
    return frame(spark, [(i, j, float(v)) for i, r in enumerate(m) for j, v in enumerate(r)], "i int, j int, v double")


def test_diagonal_product(spark):
    m = [[2, 5, 6, 2, 2], [9, 2, 6, 6, 9], [4, 4, 3, 1, 4], [8, 4, 5, 9, 6], [5, 3, 5, 5, 3]]
    assert arrays.nonzero_diag_product(matrix(spark, m), "i", "j", "v").first()[0] == 324.0
    assert arrays.nonzero_diag_product(matrix(spark, [[1, 0], [0, 0]]), "i", "j", "v").first()[0] == 1.0
    assert arrays.nonzero_diag_product(matrix(spark, [[0, 1], [1, 0]]), "i", "j", "v").first()[0] is None


def test_max_after_zero(spark):
    for values, want in (([1, 2, 9, 8, 0, 5], 5), ([2, 0, 2, 5, 0, 1, 0, 0, 4, 7], 4), ([-7, -1, 5, -4, -6, 0, -3, -5, 0, -10], -3), ([1, 2, 3, 4, 0], None)):
        df = frame(spark, list(enumerate(values)), "i bigint, v int")
        assert arrays.max_after_zero(df, ["i"], "v").first()[0] == want


def test_means_and_positive_columns(spark):
    df = frame(spark, [(0.0, 1.0, 2.0), (float("nan"), 1.0, None), (5.0, 6.0, 7.0)], "a double, b double, c double")
    filled = prep.impute(df, prep.fit_means(df, ["a", "b", "c"])).collect()
    assert tuple(filled[1]) == (2.5, 1.0, 4.5)
    b = [[3, 2, -1, -3, 4], [3, -2, -2, -2, -5], [3, 2, -1, 1, 1], [2, 0, 4, -2, 0], [0, 4, 1, 2, 4]]
    df = frame(spark, b, "c0 int, c1 int, c2 int, c3 int, c4 int")
    assert {r[0] for r in arrays.positive_columns(df, df.columns).collect()} == {"c0", "c1", "c4"}


def test_class_impurity(spark):
    df = frame(spark, [(x,) for x in (1, 1, 2, 4, 2, 2, 0, 1, 0, 4)], "y int")
    row = trees.impurity_table(df, "y", 5).first()
    assert math.isclose(row["gini"], 0.74) and math.isclose(row["entropy"], 1.3661548, abs_tol=1e-7)


def test_best_split(spark):
    rng = random.Random(1)
    step = frame(spark, [(float(i), int(i < 50), rng.random()) for i in range(100)], "x double, y int, noise double")
    for kind, gain in (("gini", 0.5), ("entropy", 0.69314618)):
        best = trees.best_split(step, ["noise", "x"], "y", 2, kind).first()
        assert (best["feature"], best["threshold"]) == ("x", 49.5) and math.isclose(best["gain"], gain, abs_tol=1e-6)
    short = frame(spark, list(zip([0.1, 0.4, 0.2, 0.3, 0.5, 0.0], [0, 1, 0, 1, 1, 0])), "x double, y int")
    assert math.isclose(trees.best_split(short, ["x"], "y", 2).first()["threshold"], 0.25)


def test_tree_separates_blobs(spark):
    rng = random.Random(1)
    rows_ = [(rng.gauss(cx, 1), rng.gauss(cy, 1), k) for k, (cx, cy) in enumerate([(-5, -5), (-5, 5), (5, -5), (5, 5)]) for _ in range(25)]
    df = frame(spark, rows_, "a double, b double, y int")
    tree = trees.LevelTree(max_depth=4, min_leaf_size=1).fit(df, ["a", "b"], "y", 4)
    assert tree.transform(df).where("prediction <> y").count() == 0
    assert all(v > 0 for v in tree.importances().values())


def test_logistic_loss_and_gradient(spark):
    df = frame(spark, [(1.0, 2.0, -1), (3.0, 4.0, 1), (-5.0, 6.0, 1)], "a double, b double, y int")
    assert math.isclose(models.logistic_loss(df, ["a", "b"], "y", [1, 2, 3], 1.0).first()[0], 16.00008, abs_tol=1e-5)
    got = {r["term"]: r["gradient"] for r in models.logistic_gradient(df, ["a", "b"], "y", [1, 2, 3], 1.0).collect()}
    for term, want in (("bias", 0.33325), ("a", 4.3335), ("b", 6.66634)):
        assert math.isclose(got[term], want, abs_tol=1e-5)
    far = frame(spark, [(1e5, 1), (-1e5, -1), (1e5, 1)], "a double, y int")
    assert abs(models.logistic_loss(far, ["a"], "y", [1, 100], 0.0).first()[0]) < 1e-5
    wrong = frame(spark, [(100.0, -1), (-100.0, 1), (100.0, -1)], "a double, y int")
    assert math.isclose(models.logistic_loss(wrong, ["a"], "y", [1, 100], 0.0).first()[0], 10000.333334, abs_tol=1e-5)


def test_inverse_normal(spark):
    ps = [1e-9, 0.001, 0.02, 0.2, 0.5, 0.77, 0.99, 1 - 1e-7]
    got = [r[0] for r in frame(spark, [(p,) for p in ps], "p double").select(numeric.inverse_normal(F.col("p"))).collect()]
    assert all(math.isclose(g, NormalDist().inv_cdf(p), rel_tol=1e-12, abs_tol=1e-12) for g, p in zip(got, ps))


def test_radical_inverse(spark):
    got = [r[0] for r in spark.range(1, 6).select(numeric.radical_inverse(F.col("id"), 2)).collect()]
    assert got == [0.5, 0.25, 0.75, 0.125, 0.625]


def test_name_texts(spark):
    df = frame(spark, [(" Иван -  пётр 7", ), ("N/A",), (None,), ("анна-мария ЛИ",)], "s string")
    got = [tuple(r) for r in df.select(text.title_case_name(F.col("s")), text.is_blank(F.col("s")), text.is_cyrillic(F.col("s"))).collect()]
    assert got == [("Иван-Петр", False, True), ("", True, False), ("", True, False), ("Анна-Мария Ли", False, True)]


def test_string_similarities(spark):
    df = frame(spark, [("martha", "marhta"), ("иванов", "ивнаов")], "a string, b string")
    got = df.select(similarity.jaro_winkler("a", "b"), similarity.osa_distance("a", "b"), similarity.edit_similarity("a", "b")).collect()
    assert math.isclose(got[0][0], 0.9611111, abs_tol=1e-6) and [r[1] for r in got] == [1, 1] and got[1][2] == 83


def test_name_correction(spark):
    terms = frame(spark, [("александр", 500), ("александра", 20), ("анна", 300), ("инна", 40)], "term string, freq bigint")
    values = frame(spark, [("алексндр",), ("анна-алексанрд",), ("Smith",), ("nan",), ("яков",)], "v string")
    got = {r["value"]: r["corrected"] for r in names.correct_names(values, "v", terms, terms, min_ratio=80).collect()}
    assert got == {"алексндр": "Александр", "анна-алексанрд": "Анна-Александр", "Smith": "Smith", "nan": "", "яков": "Яков"}


def test_birthdates(spark):
    df = frame(spark, [("1999-02-03",), (" 1999 -02-03",), ("1999-02-31",), ("x",), (None,)], "b string")
    got = [str(r[0]) for r in df.select(rows.birthdate_parse(F.col("b"))).collect()]
    assert got == ["1999-02-03", "1999-02-03", "1900-01-01", "1900-01-01", "1900-01-01"]


def test_binary_labels(spark):
    for labels in ([1, 1], [0, 1, 2], [0, 1, None]):
        with pytest.raises(ValueError):
            metrics.validate_binary_target(frame(spark, [(x,) for x in labels], "y int"), "y")


def test_auc_equals_pair_counting(spark):
    rng = random.Random(3)
    rows_ = [(rng.randint(0, 1), rng.randint(0, 9) / 10) for _ in range(80)]
    pos, neg = [s for y, s in rows_ if y], [s for y, s in rows_ if not y]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    df = frame(spark, rows_, "y int, s double")
    assert math.isclose(metrics.roc_auc(df, "y", "s").first()[0], want)
    grouped = models.grouped_auc(df.withColumn("g", F.lit(1)), ["g"], "y", "s").first()["auc"]
    assert math.isclose(grouped, want)
    auc, precision, loss = metrics.probability_report(df, "y", "s")
    assert math.isclose(auc, want) and math.isclose(precision, metrics.average_precision(df, "y", "s").first()[0])
    assert math.isclose(loss, metrics.log_loss(df, "y", "s").first()[0])
    with pytest.raises(ValueError):
        metrics.threshold_curve(df, "y", "s", "roc_auc")


def test_profile_of_short_and_missing_columns(spark):
    df = frame(spark, [(float(i), float("nan") if i % 2 else 1.0, None if i > 3 else 1.0) for i in range(12)], "a double, b double, c double")
    got = {r["feature"]: r for r in profiling.column_profile(df, ["a", "b", "c"]).collect()}
    assert got["a"]["max_val"] == 11 and got["b"]["max_val"] is None and got["c"]["nan_ratio"] == 0


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(200, k) for k in range(201, 230)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r["id"]: r["cluster_id"] for r in linkage.connected_components(frame(spark, edges, "id_l bigint, id_r bigint")).collect()}
    assert got == {x: root(x) for x in parent}


PEOPLE = "unique_id bigint, surname string, name string, fathername string, birthdate string, gender string, passport string, inn string"


def people(spark):
    return frame(
        spark,
        [
            (1, "ivanov", "petr", "olegovich", "1980-01-01", "m", "111", "900"),
            (2, "ivanov", "petr", "olegovich", "1980-01-01", "m", "111", "900"),
            (3, "ivanof", "petr", "olegovich", "1980-01-01", "m", "111", ""),
            (4, "ivanov", "petr", "olegovich", "1980-01-01", "m", "", "900"),
            (5, "sidorova", "anna", "", "1990-05-05", "f", "111", "555"),
            (6, "", "", "", "", "", "", ""),
            (7, "", "", "", "", "", "", ""),
        ],
        PEOPLE,
    )


WEIGHTS = {"surname": [-4, -1, 1.5, 3, 4], "name": [-3, -1, 1, 2, 3], "fathername": [-3, -0.5, 0.5, 1.5, 2.5], "birthdate": [-5, -2, 0.5, 3, 6],
           "passport": [-6, 12], "inn": [-6, 11], "gender": [-3, 1]}


def test_blank_values_never_pair_and_cut_blocks_agree(spark):
    records = linkage.blanks_to_null(people(spark))
    want = {(r["id_l"], r["id_r"], r["rule"]) for r in linkage.blocking_pairs(records).collect()}
    cut = {(r["id_l"], r["id_r"], r["rule"]) for r in linkage.blocking_pairs(records, block_rows=1).collect()}
    assert want == cut and not any(6 in p[:2] or 7 in p[:2] for p in want) and (1, 5, 0) in want


def test_dedup_follows_chains_and_copies(spark):
    clusters, kept = linkage.dedup_persons(people(spark), WEIGHTS, prior=0.001, adjust=())
    got = {r["id"]: r["cluster_id"] for r in clusters.collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1}
    assert sorted(r["unique_id"] for r in kept.collect()) == [1, 5, 6, 7]


def test_stricter_rules_lose_no_match(spark):
    strict = linkage.passing_rules(linkage.RULES, WEIGHTS, linkage.weight_needed(0.95, 0.001))
    records = linkage.blanks_to_null(people(spark))

    def matches(rules):
        pairs = linkage.compare_pairs(linkage.blocking_pairs(records, rules=rules))
        scored = linkage.score_pairs(pairs, WEIGHTS, 0.001).where("match_probability >= 0.95")
        return {(r["id_l"], r["id_r"]) for r in scored.collect()}

    assert matches(strict) == matches(linkage.RULES) and matches(strict)


def test_em_likelihood_never_falls():
    rng = random.Random(2)
    u = {f: [1 / n] * n for f, n in linkage.LEVELS.items()}
    patterns = [(tuple(rng.randint(-1, linkage.LEVELS[f] - 1) for f in linkage.FIELDS), rng.randint(1, 50)) for _ in range(40)]
    _, share, path = linkage.em_match_rates(patterns, u, rounds=15, tolerance=0.0)
    assert 0 < share < 1 and all(b >= a - 1e-6 for a, b in zip(path, path[1:]))


def test_nearest_neighbours_match_brute_force(spark):
    rng = random.Random(4)
    points = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(120)] + [[0.5, 0.5, 0.5]] * 60  # a third are copies
    df = frame(spark, list(enumerate(points)), "id bigint, v array<double>")
    got = {}
    for r in neighbours.knn_exact(df, df, "id", "v", 4, pivots=7, block=16).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["neighbour_id"]
    for i, p in enumerate(points):
        order = sorted(range(len(points)), key=lambda j: (round(sum((a - b) ** 2 for a, b in zip(p, points[j])), 9), j))[:4]
        assert [got[i][k] for k in (1, 2, 3, 4)] == order


def test_suggest_drops_finds_planted_columns(spark):
    rng = np.random.default_rng(5)
    n = 400
    data = pd.DataFrame({"id": range(n), "a": rng.normal(size=n), "b": rng.normal(size=n)})
    data["flat"], data["twin"], data["line"] = 2.0, data["a"], 3 * data["b"] - 1
    data["y"] = (data["a"] + data["b"] + rng.normal(scale=0.3, size=n) > 0).astype(int)
    df = spark.createDataFrame(data)
    out = models.suggest_drops(df.where("id % 2 = 0"), df.where("id % 2 = 1"), "id", ["a", "b", "flat", "twin", "line"])
    found = {tuple(r) for r in out.collect()}
    assert {("constant", "flat", None), ("duplicate", "a", "twin"), ("correlated", "twin", "a"), ("correlated", "line", "b")} <= found
    assert ("unimportant", "flat", None) in found and ("unimportant", "a", None) not in found
    assert not {f for kind, f, _ in found if kind in ("constant", "correlated")} & {"a", "b"}
