"""Farthest-first choice, string similarity and agreement rates against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions.similarity import jaro_winkler_of
from tallyloom.operators import batches, linkage, trees


def plain_spread(ids, points, gap, batch):
    taken, gap = [], gap.copy()
    for _ in range(batch):
        i = max(range(len(ids)), key=lambda k: (gap[k], -ids[k])) if len(ids) < 2000 else int(gap.argmax())
        taken.append(ids[i])
        gap = np.minimum(gap, np.sqrt(((points - points[i]) ** 2).sum(1)))
        gap[i] = -1
    return taken


@pytest.mark.parametrize("n, batch, candidates, start", [(1000, 60, 2000, np.inf), (1000, 60, 7, np.inf), (1000, 40, 50, 0.5), (50_000, 100, 2000, 0.9)])
def test_farthest_first(spark, n, batch, candidates, start):
    """Same points in the same order at any size, with many or few candidates a round, ties included."""
    rng = np.random.default_rng(n + candidates)
    points = np.round(rng.random((n, 3)), 1 if n <= 1000 and candidates == 7 else 6)
    gap = np.full(n, np.inf) if np.isinf(start) else rng.random(n) * start
    rows = [(i, p.tolist(), float(g)) for i, (p, g) in enumerate(zip(points, gap))]
    frame = spark.createDataFrame(rows, "id long, v array<double>, gap double").repartition(6)
    assert batches.farthest_first(frame, batch, candidates) == plain_spread(list(range(n)), points, gap, batch)


def test_greedy_spread_filters_and_returns_small_pools(spark):
    pool = spark.range(30).select("id", (F.col("id") / 30).alias("a"), F.lit(0.0).alias("b"))
    known = spark.createDataFrame([(100, 0.0, 0.0)], "key long, a double, b double")
    assert batches.greedy_spread(pool, known, "key", ["a", "b"], 40).count() == 30
    assert {r.id for r in batches.greedy_spread(pool, known, "key", ["a", "b"], 2).collect()} == {29, 14}
    requested = spark.range(400).select((F.col("id") / 400).alias("a"), F.lit(0.0).alias("b"), (F.col("id") < 200).cast("int").alias("is_valid"))
    chosen = batches.greedy_spread(pool, known.limit(0), "key", ["a", "b"], 5, requested)
    assert chosen.count() == 5 and chosen.agg(F.max("a")).first()[0] < 0.55


def plain_jaro_winkler(a, b):
    if a == b:
        return 1.0
    reach, used, left = max(max(len(a), len(b)) // 2 - 1, 0), set(), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if j not in used and b[j] == c:
                used.add(j)
                left.append(c)
                break
    if not left:
        return 0.0
    right = [b[j] for j in sorted(used)]
    m = len(left)
    jaro = (m / len(a) + m / len(b) + (m - sum(x != y for x, y in zip(left, right)) // 2) / m) / 3
    prefix = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def test_jaro_winkler_of_many_pairs():
    rng = random.Random(3)
    left = ["".join(rng.choices("abcdé", k=rng.randint(0, 12))) for _ in range(9000)] + ["", "a" * 300, "😀a"]
    right = ["".join(rng.choices("abcdé", k=rng.randint(0, 12))) for _ in range(9000)] + ["", "a" * 299 + "b", "a😀"]
    assert jaro_winkler_of(left, right).tolist() == [plain_jaro_winkler(a, b) for a, b in zip(left, right)]


def test_rates_of_all_pairs(spark):
    """Counts of all pairs, hot values and blocks of names that meet included."""
    rng = random.Random(8)
    letters = lambda: "".join(rng.choices("abco", k=rng.randint(3, 7)))
    rows = []
    for i in range(400):
        day = None if i % 11 == 0 else "bad" if i % 13 == 0 else f"19{80 + i % 3}-0{1 + i % 5}-{10 + i % 19}"
        rows.append((i, letters(), "anna" if i % 3 else letters(), None if i % 4 else letters(), day, str(i % 90) if i % 2 else None, None, "m" if i % 5 else "f"))
    records = spark.createDataFrame(rows, "unique_id long, surname string, name string, fathername string, birthdate string, passport string, inn string, gender string")
    got = {(r.field, r.level): r.share for r in linkage.estimate_u(records).collect()}
    left = records.select(F.col("unique_id").alias("id_l"), *[F.col(f).alias(f"{f}_l") for f in linkage.FIELDS])
    right = records.select(F.col("unique_id").alias("id_r"), *[F.col(f).alias(f"{f}_r") for f in linkage.FIELDS])
    pairs = linkage.compare_pairs(left.join(right, F.col("id_l") < F.col("id_r")))
    levels = [(f, r[f"gamma_{f}"]) for r in pairs.collect() for f in linkage.FIELDS if r[f"gamma_{f}"] >= 0]
    whole = Counter(f for f, _ in levels)
    want = {k: n / whole[k[0]] for k, n in Counter(levels).items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    names = records.unpivot(["unique_id"], linkage.NAME_FIELDS, "field", "value").where("value is not null").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    small, large = ({(r.field, r.level): r.n for r in linkage.alike_names(names, most).collect()} for most in (17, 1000))
    assert small == large and Counter(k[0] for k in want)["surname"] == 5


def test_regression_tree(spark):
    """A step function is found exactly; null targets and values do no harm."""
    rows = [(float(i), float(i % 7), 5.0 if i < 40 else (9.0 if i % 7 < 3 else 1.0)) for i in range(100)] + [(None, 1.0, 9.0), (3.0, 3.0, None)]
    frame = spark.createDataFrame(rows, "a double, b double, y double")
    tree = trees.LevelTree("mse", max_depth=3, min_leaf_size=2).fit(frame.where("a is not null"), ["a", "b"], "y")
    out = tree.transform(frame.where("a is not null and y is not null"))
    assert out.where("abs(prediction - y) > 1e-9").isEmpty() and tree.nodes[1]["rows"] == 100
    assert tree.transform(frame).count() == 102 and set(tree.importances()) == {"a", "b"}
