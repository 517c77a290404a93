"""Clusters from pairs of kinds, against the clusters of all candidate pairs."""

from __future__ import annotations

import random

import pytest

from tallyloom.operators import linkage

SCHEMA = "unique_id bigint, " + ", ".join(f"{f} string" for f in linkage.FIELDS)
WEIGHTS = {
    "surname": [-4.0, -1.0, 1.5, 3.0, 4.0], "name": [-3.0, -1.0, 1.0, 2.0, 3.0], "fathername": [-3.0, -0.5, 0.5, 1.5, 2.5],
    "birthdate": [-5.0, -2.0, 0.5, 3.0, 6.0], "passport": [-6.0, 12.0], "inn": [-6.0, 11.0], "gender": [-3.0, 1.0],
}


def people(n, seed, repeat=0):
    """Records with many gaps; the first ``repeat`` ids come a second time with other values."""
    rng = random.Random(seed)
    pick = lambda *values: rng.choice([*values, None])
    return [
        (i % (n - repeat), rng.choice(["ivanov", "ivanow", "petrov", "sidorov"]), pick("anna", "ana", "boris", "zoya"), pick("olegovna", "olegowna", "petrovna"),
         pick("1990-01-01", "1990-01-02", "1971-03-01"), pick(None, None, f"p{i % 40}"), pick(None, f"i{i % 50}"), pick("f", "m")) for i in range(n)
    ]


def clusters_of(frame, compared, prior, shares=None, u=None):
    return {(r["id"], r["cluster_id"]) for r in linkage.cluster_pairs(linkage.score_pairs(compared, WEIGHTS, prior, shares, u)).collect()}


def hot(spark, n=6000):
    """A third and more of all rows under one name and date, most of them without documents."""
    return spark.range(n).selectExpr(
        "id AS unique_id", "'ivanov' AS surname", "concat('name', id % 2) AS name", "'olegovich' AS fathername", "'1990-01-01' AS birthdate",
        "CASE WHEN id % 5 = 0 THEN concat('p', id) END AS passport", "CASE WHEN id % 7 = 0 THEN concat('i', id) END AS inn", "'m' AS gender",
    )


@pytest.mark.parametrize("seed, repeat, prior", [(1, 0, 0.001), (2, 15, 0.001), (4, 15, 0.01)])
def test_clusters_are_those_of_all_pairs(spark, seed, repeat, prior):
    frame = spark.createDataFrame(people(150, seed, repeat), SCHEMA).cache()
    whole = linkage.compare_pairs(linkage.blocking_pairs(frame))
    got = clusters_of(frame, linkage.deciding_pairs(frame, WEIGHTS, prior), prior)
    assert got == clusters_of(frame, whole, prior) != set()


def test_clusters_with_shares_of_values(spark):
    frame = spark.createDataFrame(people(150, 7), SCHEMA).cache()
    shares = {f: linkage.value_shares(frame, f) for f in ("surname", "name")}
    u = {f: sum(r["share"] ** 2 for r in shares[f].collect()) for f in shares}
    few = linkage.compare_pairs(linkage.spanning_pairs(frame, WEIGHTS, 0.001, 0.95, shares, u))
    assert clusters_of(frame, few, 0.001, shares, u) == clusters_of(frame, linkage.compare_pairs(linkage.blocking_pairs(frame)), 0.001, shares, u) != set()


def test_a_hot_name_takes_pairs_by_its_records_only(spark):
    """Six thousand records alike would be eighteen million pairs."""
    found = linkage.spanning_pairs(hot(spark), WEIGHTS, 0.001, 0.95, {}, {})
    assert 3000 < found.count() < 3 * 6000


def test_one_record_stands_for_a_hot_name(spark):
    frame = hot(spark, 3000).cache()
    compared = linkage.deciding_pairs(frame, WEIGHTS, 0.001)
    assert compared.count() < 3 * 3000
    clusters = linkage.cluster_pairs(linkage.score_pairs(compared, WEIGHTS, 0.001))
    kept = linkage.canonical_per_cluster(frame, clusters).select("unique_id", "cluster_id").collect()
    assert kept == [(0, "0")]  # the two names are alike enough


def test_clusters_of_hot_names_take_few_links(spark):
    """Two names that are not alike, three thousand records each."""
    frame = hot(spark).replace({"name0": "anna", "name1": "boris"}, subset=["name"])
    compared = linkage.deciding_pairs(frame, WEIGHTS, 0.001)
    assert compared.count() < 3 * 6000
    clusters = linkage.cluster_pairs(linkage.score_pairs(compared, WEIGHTS, 0.001))
    assert {r["cluster_id"] for r in clusters.select("cluster_id").distinct().collect()} == {0, 1}
    assert clusters.count() == 6000
