"""Choosing the next batch of points: space-filling, expansion, uncertainty and spread."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tallyloom.functions.numeric import inverse_normal, radical_inverse, uniform
from tallyloom.operators.joins import novelty_anti_join
from tallyloom.operators.models import assemble, ensemble_uncertainty, score_column, validity_model
from tallyloom.operators.prep import column_quantiles
from tallyloom.operators.rows import round_dedup
from tallyloom.operators.slices import Ordered
from tallyloom.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy

# Bases of the low-discrepancy sequence, one per dimension.
PRIMES = [2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53]
#: Points that a round of ``farthest_first`` brings to the driver.
CANDIDATES = 2000


def _shift(seed: int, dimension: int) -> float:
    return float(np.random.default_rng([seed, dimension]).random())


def halton(index: DataFrame, features: Sequence[str], seed: int = 0) -> DataFrame:
    """(id, one coordinate in (0, 1) per feature): a Halton point per row of ``index(id)``, rotated by the seed."""
    raw = index.select(
        "id", *[(radical_inverse(F.col("id") + 1, PRIMES[d]) + _shift(seed, d)).alias(f) for d, f in enumerate(features)]
    )
    edge = 1e-9
    return raw.select("id", *[F.least(F.greatest(F.col(f) - F.floor(f), F.lit(edge)), F.lit(1 - edge)).alias(f) for f in features])


def box_points(index: DataFrame, features: Sequence[str], low: dict[str, float], high: dict[str, float], seed: int = 0) -> DataFrame:
    """Even cover of a box, one point per row of ``index(id)``."""
    return halton(index, features, seed).select("id", *[(F.lit(low[f]) + F.col(f) * (high[f] - low[f])).alias(f) for f in features])


def normal_points(index: DataFrame, features: Sequence[str], centre: dict[str, float], width: dict[str, float], seed: int = 0) -> DataFrame:
    """Even cover mapped to a normal cloud, one point per row of ``index(id)``."""
    return halton(index, features, seed).select("id", *[(F.lit(centre[f]) + inverse_normal(F.col(f)) * width[f]).alias(f) for f in features])


def box_stats(valid: DataFrame, features: Sequence[str], low: float, high: float) -> dict[str, dict[str, float]]:
    """Centre, tail quantiles and spread per feature: one fitted row per feature."""
    q = column_quantiles(valid, features, {"low": low, "mid": 0.5, "high": high})
    std = valid.agg(*[F.stddev_pop(f).alias(f) for f in features]).first()
    known = sorted(float(std[f]) for f in features if std[f] and std[f] > 1e-12)
    typical = float(np.median(known)) if known else 1.0
    return {f: {**q[f], "std": float(std[f]) if std[f] and std[f] > 1e-12 else typical} for f in features}


def estimate_box(valid: DataFrame, features: Sequence[str], expand: float = 0.2, least: int = 20) -> tuple[dict[str, float], dict[str, float]]:
    """1 % to 99 % quantiles widened by ``expand``; a default box for too few points."""
    if valid.limit(least).count() < least:
        return {f: -2.0 for f in features}, {f: 2.0 for f in features}
    s = box_stats(valid, features, 0.01, 0.99)
    low, high = {}, {}
    for f in features:
        width = s[f]["high"] - s[f]["low"]
        width = width if width > 1e-9 else 1.0
        low[f], high[f] = s[f]["low"] - expand * width, s[f]["high"] + expand * width
    return low, high


def _noise(index: DataFrame, features: Sequence[str], seed: int, prefix: str = "__z_") -> DataFrame:
    """``index`` with one standard normal number per feature, seeded by the row's id."""
    flat = index.select("*", *[uniform(F.col("id"), seed + d).alias(f"{prefix}{f}") for d, f in enumerate(features)])
    return flat.withColumns({f"{prefix}{f}": inverse_normal(F.col(f"{prefix}{f}")) for f in features})


def around_known(spark: SparkSession, valid: DataFrame, key: str, features: Sequence[str], n: int, width: dict[str, float], seed: int) -> DataFrame:
    """``n`` draws of known points with normal noise."""
    total = valid.count()
    numbered = Ordered.overall(valid.select(key, *features), [key]).row_number("__pos").result()
    picks = spark.range(n).select("id", (F.floor(uniform(F.col("id"), seed) * total) + 1).alias("__pos"))
    noisy = _noise(picks, features, seed + 100)
    return noisy.join(numbered, "__pos").select("id", *[(F.col(f) + F.col(f"__z_{f}") * width[f]).alias(f) for f in features])


def radial_points(index: DataFrame, features: Sequence[str], stats: dict, radii: Sequence[float], seed: int) -> DataFrame:
    """Random directions from the centre, scaled per feature, at one of the radii."""
    noisy = _noise(index.select("id"), features, seed)
    steps = [F.col(f"__z_{f}") for f in features]
    norm = F.sqrt(sum((s * s for s in steps[1:]), steps[0] * steps[0]))
    radius = F.element_at(F.array(*[F.lit(float(r)) for r in radii]), (F.floor(uniform(F.col("id"), seed + 50) * len(radii)) + 1).cast("int"))
    reach = noisy.withColumn("__reach", radius / norm)
    return reach.select(
        "id", *[(F.lit(stats[f]["mid"]) + s * F.col("__reach") * stats[f]["std"]).alias(f) for f, s in zip(features, steps)]
    )


def _stack(parts: Sequence[DataFrame], features: Sequence[str]) -> DataFrame:
    """All points with their part and place, so that cutting to size keeps the order of the parts."""
    out = None
    for i, p in enumerate(parts):
        named = p.select(F.lit(i).alias("part"), "id", *features)
        out = named if out is None else out.unionByName(named)
    return out


def _novel(points: DataFrame, requested: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per rounded point, the earliest by (part, id), without points already requested."""
    rounded = points.withColumns({f: F.round(f, 12) + F.lit(0.0) for f in features})
    first = rounded.groupBy(*features).agg(F.min(F.struct("part", "id")).alias("__p"))
    return novelty_anti_join(first.select(*features, "__p.part", "__p.id"), requested, features)


def expansion_batch(
    valid: DataFrame, requested: DataFrame, key: str, features: Sequence[str], batch: int = 1000, seed: int = 2026, expand: float = 1.5,
    radii: Sequence[float] = (2.5, 3.5, 5.0), wide: float = 3.0, core: float = 0.35, attempts: int = 10,
) -> DataFrame:
    """40 % widened box, 35 % radial rays, 15 % wide normal cloud, the rest near known points."""
    spark = valid.sparkSession
    s = box_stats(valid, features, 0.05, 0.95)
    half = {f: (s[f]["high"] - s[f]["low"]) / 2 for f in features}
    half = {f: h if h > 1e-12 else s[f]["std"] for f, h in half.items()}
    centre = {f: s[f]["mid"] for f in features}
    n_box, n_radial, n_wide = int(batch * 0.40), int(batch * 0.35), int(batch * 0.15)
    low = {f: centre[f] - expand * half[f] for f in features}
    high = {f: centre[f] + expand * half[f] for f in features}
    parts = [
        box_points(spark.range(n_box), features, low, high, seed + 1),
        radial_points(spark.range(n_radial), features, s, radii, seed),
        normal_points(spark.range(n_wide), features, centre, {f: wide * s[f]["std"] for f in features}, seed + 2),
        around_known(spark, valid, key, features, batch - n_box - n_radial - n_wide, {f: core * s[f]["std"] for f in features}, seed + 3),
    ]
    points = cut_lineage(_novel(_stack(parts, features), requested, features))
    for attempt in range(attempts):
        missing = batch - points.count()
        if missing <= 0:
            break
        wider = [r * (1 + 0.25 * attempt) for r in radii]
        more = radial_points(spark.range(missing * 2), features, s, wider, seed + 1000 * (attempt + 1))
        more = more.select(F.lit(len(parts) + attempt).alias("part"), "id", *features)
        points = cut_lineage(_novel(points.unionByName(more), requested, features))
    return points.orderBy("part", "id").limit(batch)


def candidate_pool(valid: DataFrame, key: str, features: Sequence[str], n: int, seed: int = 42, normal_fraction: float = 0.35) -> DataFrame:
    """Box points and noisy copies of known points: (id, features)."""
    spark = valid.sparkSession
    low, high = estimate_box(valid, features, 0.25)
    n_normal = int(n * normal_fraction)
    box = box_points(spark.range(n - n_normal), features, low, high, seed)
    std = valid.agg(*[F.stddev_pop(f).alias(f) for f in features]).first()
    width = {f: 0.25 * (std[f] if std[f] and std[f] > 1e-9 else 1.0) for f in features}
    cloud = around_known(spark, valid, key, features, n_normal, width, seed + 1)
    return box.unionByName(cloud.withColumn("id", F.col("id") + (n - n_normal)))


def acquisition_score(uncertainty: Column, p_valid: Column) -> Column:
    return uncertainty * F.least(F.greatest(p_valid, F.lit(0.05)), F.lit(1.0))


def boundary_score(p_valid: Column) -> Column:
    return -F.abs(p_valid - 0.60)


def diverse_top(pool: DataFrame, features: Sequence[str], score: str, batch: int, multiplier: int = 20, least: int = 5000, seed: int = 42) -> DataFrame:
    """The best point of each of ``batch`` clusters among the top scores, filled up by score."""
    top = pool.orderBy(F.col(score).desc(), "id").limit(max(batch * multiplier, least))
    top = cut_lineage(top)
    if top.count() <= batch:
        return top
    rows = StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(assemble(top, features, "raw")).transform(assemble(top, features, "raw"))
    placed = KMeans(k=batch, seed=seed, maxIter=10).fit(rows).transform(rows).select("id", score, F.col("prediction").alias("__c"))
    best = W.partitionBy("__c").orderBy(F.col(score).desc(), "id")
    ranked = placed.withColumn("__first", (F.row_number().over(best) == 1).cast("int"))
    chosen = ranked.orderBy(F.col("__first").desc(), F.col(score).desc(), "id").limit(batch)
    return top.join(chosen.select("id"), "id", "left_semi")


def _p_valid(model: Model | None, pool: DataFrame, features: Sequence[str]) -> DataFrame:
    if model is None:
        return pool.withColumn("p_valid", F.lit(1.0))
    return score_column(model, assemble(pool, features), "p_valid").drop("features")


def active_batch(
    valid: DataFrame, requested: DataFrame, key: str, features: Sequence[str], label: str, batch: int = 100, pool_size: int = 5000,
    min_valid: float = 0.70, boundary_share: float = 0.15, random_share: float = 0.10, seed: int = 42, trees: int = 10,
) -> DataFrame:
    """Uncertain points likely to be valid, points near the validity boundary, and random ones."""
    if boundary_share + random_share >= 1:
        raise ValueError("the shares must leave room for uncertain points")
    pool = candidate_pool(valid, key, features, pool_size, seed)
    pool = _p_valid(validity_model(requested, features, trees=trees), pool, features)
    pool = cut_lineage(ensemble_uncertainty(valid, pool, features, label, trees=trees))
    n_random, n_boundary = int(batch * random_share), int(batch * boundary_share)
    n_active = batch - n_random - n_boundary
    scored = pool.withColumns({"a_score": acquisition_score(F.col("uncertainty"), F.col("p_valid")), "b_score": boundary_score(F.col("p_valid"))})

    likely = scored.where(F.col("p_valid") >= min_valid)
    if likely.limit(n_active).count() < n_active:
        median = scored.agg(F.median("p_valid")).first()[0]
        likely = scored.where(F.col("p_valid") >= median)
    active = diverse_top(likely, features, "a_score", n_active, 25, seed=seed)
    near = scored.where(F.col("p_valid") >= 0.25)
    near = near if near.limit(n_boundary).count() >= n_boundary else scored
    boundary = diverse_top(near, features, "b_score", n_boundary, 20, seed=seed)
    open_pool = scored.where(F.col("p_valid") >= max(0.30, min_valid - 0.30))
    open_pool = open_pool if open_pool.limit(n_random).count() >= n_random else scored
    picked = open_pool.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(n_random)
    stacked = _stack([active, boundary, picked], features)
    return stacked.select(*features).transform(lambda d: round_dedup(d, features, 12)).limit(batch)


def _nearer(gap: np.ndarray, points: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Distances to the nearest chosen point, from those to what was chosen before."""
    for one in chosen:
        gap = np.minimum(gap, np.sqrt(((points - one) ** 2).sum(axis=1)))
    return gap


def farthest_first(points: DataFrame, batch: int, candidates: int = CANDIDATES) -> list[tuple]:
    """Ids of ``batch`` points of (id, v, gap), each the farthest from all before it; ties go to the smallest id.

    Every point keeps its distance to the nearest chosen one.  A round brings the ``candidates`` farthest
    points to the driver.  Distances only shrink, so the farthest of them is the farthest of all as long as it stands before the
    last one as that stood when the round began; such points are taken one after another, then the next
    round moves all points' distances on.  At least one point is taken per round, the same ones at any size.
    """
    taken: list[tuple] = []
    current = cut_lineage(points.select("id", "v", "gap"))
    while len(taken) < batch:
        top = current.orderBy(F.desc("gap"), "id").limit(candidates).toPandas().sort_values(["gap", "id"], ascending=[False, True])
        if not len(top):
            break
        ids, v, gap = top["id"].to_numpy(), np.array(top["v"].tolist(), float), top["gap"].to_numpy(float)
        by_id = np.argsort(ids, kind="stable")
        ids, v, gap = ids[by_id], v[by_id], gap[by_id]
        all_here = len(top) < candidates
        least, last = float(top["gap"].iloc[-1]), top["id"].iloc[-1]
        new = []
        while len(taken) + len(new) < batch and len(ids):
            i = int(gap.argmax())
            if not (all_here or gap[i] > least or (gap[i] == least and ids[i] <= last)):
                break
            new.append((ids[i], v[i]))
            rest = np.arange(len(ids)) != i
            gap = _nearer(gap[rest], v[rest], v[i : i + 1])
            ids, v = ids[rest], v[rest]
        taken += [i for i, _ in new]
        if all_here or len(taken) >= batch:
            break
        chosen = np.array([p for _, p in new])
        gone = {i for i, _ in new}

        def move(rows: Iterator[pd.DataFrame], chosen: np.ndarray = chosen, gone: set = gone) -> Iterator[pd.DataFrame]:
            for part in rows:
                part = part[~part["id"].isin(gone)]
                if len(part):
                    yield part.assign(gap=_nearer(part["gap"].to_numpy(float), np.array(part["v"].tolist(), float), chosen))

        current = cut_lineage(current.mapInPandas(move, current.schema))
    return taken


def greedy_spread(
    pool: DataFrame, labelled: DataFrame, key: str, features: Sequence[str], batch: int, requested: DataFrame | None = None,
    min_valid: float = 0.70, candidates: int = CANDIDATES,
) -> DataFrame:
    """``batch`` pool points spread out from the labelled ones and from each other.

    With ``requested`` (points and whether they were valid) only pool points that are valid with a probability of
    ``min_valid`` or more take part.  A pool of no more than ``batch`` points comes back whole.
    Every pool point starts from its distance to the nearest labelled point.
    """
    from tallyloom.operators.neighbours import knn_exact

    if requested is not None:
        pool = _p_valid(validity_model(requested, features), pool, features).where(F.col("p_valid") >= min_valid)
    pool = cut_lineage(pool.select("id", *features))
    if pool.limit(batch + 1).count() <= batch:
        return pool
    vector = F.array(*[F.col(f).cast("double") for f in features]).alias("v")
    asked = pool.select("id", vector)
    known = labelled.select(F.col(key).alias("id"), vector)
    gap = F.lit(float("inf"))
    if not known.isEmpty():
        near = knn_exact(known, asked, "id", "v", 1).select(F.col("query_id").alias("id"), F.sqrt("distance").alias("gap"))
        asked, gap = asked.join(near, "id", "left"), F.coalesce("gap", gap)
    taken = farthest_first(asked.withColumn("gap", gap), batch, candidates)
    kind = pool.schema["id"].dataType
    chosen = pool.sparkSession.createDataFrame([(kind.fromInternal(i.item() if hasattr(i, "item") else i),) for i in taken], T.StructType([T.StructField("id", kind)]))
    return pool.join(F.broadcast(chosen), "id", "left_semi")
