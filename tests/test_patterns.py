"""Agreement patterns counted without pairs, against the pairs themselves."""

from __future__ import annotations

import random

import pytest

from tallyloom.operators import linkage

SCHEMA = "unique_id bigint, " + ", ".join(f"{f} string" for f in linkage.FIELDS)


def people(n, seed=3):
    rng = random.Random(seed)
    pick = lambda *values: rng.choice([*values, None])
    return [
        (i, pick("ivanov", "ivanow", "petrov"), pick("anna", "ana", "boris"), pick("olegovna", "olegowna"), pick("1990-01-01", "1990-01-02", "1990-03-01"),
         pick("p1", "p2", "p3"), pick("i1", "i2"), pick("f", "m")) for i in range(n)
    ]


def on_pairs(frame, rule):
    rows = linkage.gamma_patterns(linkage.compare_pairs(linkage.blocking_pairs(frame, rules=[rule]))).collect()
    return sorted((tuple(r[f"gamma_{f}"] for f in linkage.FIELDS), r["n"]) for r in rows)


def test_patterns_equal_those_of_pairs(spark):
    frame = spark.createDataFrame(people(90), SCHEMA).cache()
    got = linkage.training_patterns(frame)
    for rule, patterns in zip(linkage.TRAINING_RULES, got, strict=True):
        assert patterns == on_pairs(frame, rule)


@pytest.mark.parametrize("rule", [("surname", "birthdate"), ("passport",)])
def test_cut_blocks_count_the_same(spark, rule):
    frame = spark.createDataFrame(people(80, 5), SCHEMA).cache()
    got = linkage.exact_patterns(linkage.folded_patterns(frame, rule, block_rows=4).collect(), rule)
    assert got == on_pairs(frame, rule)


def test_a_hot_block_costs_its_kinds_only(spark):
    """A third of all rows under one name and date: 20 thousand rows, two hundred million pairs, a handful of kinds."""
    n = 20_000
    hot = spark.range(n).selectExpr(
        "id AS unique_id", "'ivanov' AS surname", "concat('name', id % 3) AS name", "'olegovich' AS fathername", "'1990-01-01' AS birthdate",
        "concat('p', id) AS passport", "CASE WHEN id % 2 = 0 THEN concat('i', id) END AS inn", "'m' AS gender",
    )
    found = linkage.exact_patterns(linkage.folded_patterns(hot, ("surname", "birthdate")).collect(), ("surname", "birthdate"))
    assert sum(c for _, c in found) == n * (n - 1) // 2
    assert all(levels[linkage.FIELDS.index("passport")] == 0 for levels, _ in found)


def test_no_rows(spark):
    assert linkage.training_patterns(spark.createDataFrame([], SCHEMA)) == [[] for _ in linkage.TRAINING_RULES]


def scored(pairs, weights, shares, u):
    rows = linkage.score_pairs(linkage.compare_pairs(pairs), weights, 0.001, shares, u).where("match_weight >= 3").collect()
    found = [(r["id_l"], r["id_r"], round(r["match_weight"], 9)) for r in rows]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("name_weight", [4.0, 1.0])
def test_promising_pairs_lose_no_match(spark, name_weight):
    """Against all pairs of the blocking rules, with rare and common names; fewer pairs are formed."""
    weights = {
        "surname": [-4.0, -1.0, 1.5, 3.0, name_weight], "name": [-3.0, -1.0, 1.0, 2.0, 3.0], "fathername": [-3.0, -0.5, 0.5, 1.5, 2.5],
        "birthdate": [-5.0, -2.0, 0.5, 3.0, 6.0], "passport": [-6.0, 12.0], "inn": [-6.0, 11.0], "gender": [-3.0, 1.0],
    }
    rare = [(1000 + i, "rarov", "zoya", None, "1970-01-01", None, None, "f") for i in range(3)]
    frame = spark.createDataFrame(people(120, 9) + rare, SCHEMA).cache()
    shares = {f: linkage.value_shares(frame, f) for f in ("surname", "name")}
    u = {f: sum(r["share"] ** 2 for r in shares[f].collect()) for f in shares}
    needed = 3 - linkage.math.log2(0.001 / 0.999)
    few, whole = linkage.promising_pairs(frame, weights, needed, shares, u, block_rows=16).cache(), linkage.blocking_pairs(frame)
    assert scored(few, weights, shares, u) == scored(whole, weights, shares, u) != set()
    assert few.count() < whole.count()
    nothing = linkage.promising_pairs(frame, weights, 1000.0, shares, u)
    assert nothing.count() == 0 and set(nothing.columns) == set(whole.columns)
