"""Nearest neighbours: exact through cells with boxes, approximate through trees of planes."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy

SLACK = 1e-9  # covers rounding in the distances of boxes


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, dtype="float64") for v in column])


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, one query at a time to bound memory and keep full precision."""
    out = np.empty((len(a), len(b)))
    for i, row in enumerate(a):
        gap = b - row
        out[i] = np.einsum("ij,ij->i", gap, gap)
    return out


class Boxes:
    """A binary tree of cuts along one axis each, halving a sample at each node; ``leaf`` numbers the leaf of each vector."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.cut = np.zeros(2**depth, "int64"), np.full(2**depth, np.inf)
        at = {1: np.arange(len(sample))}  # the root is node 1, children of n are 2n and 2n + 1
        for node in range(1, 2**depth):
            rows = at.pop(node, np.zeros(0, "int64"))
            axis, cut = _halving(sample[rows])
            self.axis[node], self.cut[node] = axis, cut
            if len(rows):
                right = sample[rows, axis] > cut
                at[2 * node], at[2 * node + 1] = rows[~right], rows[right]

    def leaf(self, v: np.ndarray) -> np.ndarray:
        node, rows = np.ones(len(v), "int64"), np.arange(len(v))
        for _ in range(self.depth):
            node = 2 * node + (v[rows, self.axis[node]] > self.cut[node])
        return node - 2**self.depth


def _halving(v: np.ndarray) -> tuple[int, float]:
    """The axis of the widest spread that cuts the vectors into fair halves, and where; a cut at infinity if they are all equal."""
    if len(v) < 2:
        return 0, np.inf
    best, found = 0, (0, np.inf)
    for axis in np.argsort(-(v.max(0) - v.min(0)), kind="stable"):
        values = np.sort(v[:, axis])
        middle = values[len(values) // 2]
        upto, below = np.searchsorted(values, middle, "right"), np.searchsorted(values, middle, "left")
        for n in (upto, below):
            if min(n, len(values) - n) > best:
                best, found = min(n, len(values) - n), (int(axis), float(values[n - 1]))
        if best * 4 >= len(values):
            break
    return found


def _tiles(v: np.ndarray, rows: int) -> list[np.ndarray]:
    """Places of the vectors in compact groups of at most ``rows``."""
    done, todo = [], [np.arange(len(v))]
    while todo:
        own = todo.pop()
        if len(own) <= rows:
            done.append(own)
            continue
        part = v[own]
        axis = int((part.max(0) - part.min(0)).argmax())
        half = np.argpartition(part[:, axis], len(own) // 2)
        todo += [own[half[len(own) // 2 :]], own[half[: len(own) // 2]]]
    return done


def _gap(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Squared distance of a box (or a point) to each of several boxes, a little too small rather than too large."""
    apart = np.maximum(np.maximum(lows - high, low - highs), 0.0)
    return np.einsum("...i,...i->...", apart, apart) * (1 - SLACK)


TIE = 2e-9  # distances are compared to nine digits


class Search:
    """The ``k`` nearest of some base vectors, in the order of their ids, for queries that come with a limit.

    Both sides are laid into compact tiles; a tile of queries meets the tiles of the base by the distance of
    their boxes and ends where that exceeds what its queries still allow.  Within a tile one matrix product picks the pairs that may
    count, with room for its rounding; their distances are then taken anew.
    """

    def __init__(self, base: np.ndarray, k: int, tile: int):
        self.base, self.k, self.tile = base, k, tile
        self.centre = base.mean(0)
        self.tiles = []
        for own in _tiles(base, tile):
            b = base[own]
            moved = b - self.centre
            self.tiles.append((own, b, moved, np.einsum("ij,ij->i", moved, moved)))
        self.low, self.high = (np.array([f(b, axis=0) for _, b, _, _ in self.tiles]) for f in (np.min, np.max))
        self.largest = float(np.einsum("ij,ij->i", base, base).max())

    def nearest(self, queries: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, base, squared distance) of the pairs found, by places; per query the ``k`` best within its limit."""
        out = [self._of_tile(own, queries[own], limit[own]) for own in _tiles(queries, max(1, self.tile // 2))]
        return tuple(np.concatenate(x) for x in zip(*out))

    def _of_tile(self, own: np.ndarray, q: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        k, n = self.k, len(q)
        room = TIE + 16 * (q.shape[1] + 8) * np.finfo(float).eps * (self.largest + float(np.einsum("ij,ij->i", q, q).max()))
        low, high = q.min(0), q.max(0)
        gaps = _gap(low, high, self.low, self.high)
        moved = q - self.centre
        square = np.einsum("ij,ij->i", moved, moved)[:, None]
        best, place = np.full((n, k), np.inf), np.full((n, k), -1)
        cut = limit.astype(float).copy()
        for t in np.argsort(gaps, kind="stable"):
            if gaps[t] > cut.max() + room:
                break
            b_own, b, b_moved, b_square = self.tiles[t]
            some = np.flatnonzero(_gap(q, q, self.low[t], self.high[t]) <= cut + room)
            if not len(some):
                continue
            d = square[some] + b_square - 2 * (moved[some] @ b_moved.T)
            upto = cut[some]
            if len(b) > 4 * k and (not np.isfinite(upto).all() or np.count_nonzero(d <= (upto + room)[:, None]) > 4 * k * len(some)):
                upto = np.minimum(upto, np.partition(d, k - 1, axis=1)[:, k - 1] + room if k > 1 else d.min(1) + room)
            i, j = np.nonzero(d <= (upto + room)[:, None])
            if not len(i):
                continue
            apart = q[some[i]] - b[j]
            exact = np.einsum("ij,ij->i", apart, apart)
            changed = np.unique(i)
            old = some[changed]
            who = np.concatenate([some[i], np.repeat(old, k)])
            dist, where = np.concatenate([exact, best[old].ravel()]), np.concatenate([b_own[j], place[old].ravel()])
            order = np.lexsort((where, np.round(dist, 9), who))
            who, dist, where = who[order], dist[order], where[order]
            first = np.searchsorted(who, old, "left")[:, None] + np.arange(k)
            best[old], place[old] = dist[first], where[first]
            cut[old] = np.minimum(cut[old], best[old].max(1))
        i, j = np.nonzero(place >= 0)
        return own[i], place[i, j], best[i, j]


def _packed(v: pd.Series, kind: str) -> list[bytes]:
    return [np.asarray(x, dtype=kind).tobytes() for x in v]


def _unpacked(v: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(v), kind).reshape(len(v), -1).astype(float)


CELLS = 8192  # tasks of a search


def knn_exact(
    base: DataFrame, queries: DataFrame, id_col: str, vector: str, k: int, pivots: int | None = None, block: int = 4096
) -> DataFrame:
    """(query_id, neighbour_id, distance, rank): the ``k`` nearest by squared L2, ties by id.

    Cuts along the axes, fitted on a bounded sample, deal the base into compact cells (``pivots`` of them, or as many as
    hold about four ``block``s each); a larger cell is cut by hash.  A query first meets the cell it lies in: its
    k-th distance there is a limit, and only cells whose box comes nearer than that are met too, so few in
    low dimensions and at worst all of them, in bounded pieces of both sides.  Equal vectors are handled once:
    base copies beyond the ``k`` smallest ids cannot matter, query copies share one search.
    """
    v, rows, tile = F.col(vector), 4 * block, max(2 * k, block // 8)
    floats = all(df.schema[vector].dataType.simpleString() == "array<float>" for df in (base, queries))
    kind, array = ("<f4", "array<float>") if floats else ("<f8", "array<double>")
    base = base.select(F.col(id_col).alias("bid"), v.cast(array).alias("v"))
    asked = queries.select(F.col(id_col).alias("query_id"), v.cast(array).alias("v"))
    groups = asked.groupBy("v").agg(F.min("query_id").alias("qid"))
    id_type, q_type = base.schema["bid"].dataType.simpleString(), groups.schema["qid"].dataType.simpleString()
    spark = base.sparkSession

    cells = max(1, pivots or -(-base.count() // rows))
    seen = [r["v"] for r in base.orderBy(F.xxhash64("bid"), "bid").limit(max(2048, 128 * cells)).select("v").collect()]
    if not seen:
        return spark.createDataFrame([], f"query_id {q_type}, neighbour_id {id_type}, distance double, rank int")
    sample = np.unique(np.array(seen, dtype=float), axis=0)
    tree = Boxes(sample, max(0, int(np.ceil(np.log2(cells)))))

    def dealt(df: DataFrame, key: str, of: str) -> DataFrame:
        def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    v = _packed(batch["v"], kind)
                    yield pd.DataFrame({key: batch[key], "v": v, "leaf": tree.leaf(_unpacked(pd.Series(v), kind)).astype("int32")})

        return df.select(key, "v").mapInPandas(leaves, f"{key} {of}, v binary, leaf int")

    base = base.withColumn("rn", F.row_number().over(W.partitionBy("v").orderBy("bid"))).where(f"rn <= {k}")
    base = cut_lineage(dealt(base, "bid", id_type))
    sizes = {r["leaf"]: r["n"] for r in base.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per leaf
    parts = np.array([max(1, -(-sizes.get(leaf, 0) // rows)) for leaf in range(2**tree.depth)])
    first = np.cumsum(parts) - parts

    def unit(of: str) -> Column:
        """The number of a row's part of its leaf."""
        at = F.col("leaf") + 1
        start, cut = (F.element_at(F.array(*[F.lit(int(x)) for x in xs]), at) for xs in (first, parts))
        return (start + F.pmod(F.xxhash64(of), cut.cast("long"))).cast("int")

    base = base.select("bid", "v", unit("bid").alias("unit"))
    asked_at = dealt(groups.where("qid IS NOT NULL"), "qid", q_type).select("qid", "v", unit("qid").alias("unit"))

    def bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, tuple] = {}
        for batch in batches:
            for u, own in batch.groupby("unit"):
                m = _unpacked(own["v"], kind)
                low, high, n = known.get(u, (np.inf, -np.inf, 0))
                known[u] = np.minimum(low, m.min(0)), np.maximum(high, m.max(0)), n + len(own)
        for u, (low, high, n) in known.items():
            yield pd.DataFrame({"unit": [u], "low": [low.tobytes()], "high": [high.tobytes()], "n": [n]})

    def widest(own: pd.DataFrame) -> pd.DataFrame:
        low, high = _unpacked(own["low"], "<f8").min(0), _unpacked(own["high"], "<f8").max(0)
        return pd.DataFrame({"unit": own["unit"].iloc[:1], "low": [low.tobytes()], "high": [high.tobytes()], "n": [own["n"].sum()]})

    shape = "unit int, low binary, high binary, n long"
    found = base.select("unit", "v").mapInPandas(bounds, shape).groupBy("unit").applyInPandas(widest, shape).orderBy("unit").collect()  # one row per unit
    units, held = np.array([r["unit"] for r in found]), {r["unit"]: r["n"] for r in found}
    low, high = (np.array([np.frombuffer(r[c], "<f8") for r in found]) for c in ("low", "high"))

    def met(right: DataFrame, search, shape: str) -> DataFrame:
        """``search`` over each unit of the base and each bounded piece of the queries that are sent to it."""
        demand = {r["unit"]: r["n"] for r in right.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per unit
        pieces = [max(1, -(-demand.get(u, 0) // rows)) for u in range(int(parts.sum()))]
        among = F.element_at(F.array(*[F.lit(p) for p in pieces]), F.col("unit") + 1)
        left = base.withColumn("piece", F.explode(F.sequence(F.lit(0), among - 1)))
        right = right.withColumn("piece", F.pmod(F.xxhash64("qid"), among.cast("long")).cast("int"))
        tasks = min(CELLS, max(1, sum(pieces)))  # small in bytes, large in work: not to be coalesced
        left, right = (df.repartition(tasks, "unit", "piece").groupBy("unit", "piece") for df in (left, right))
        return left.cogroup(right).applyInPandas(search, shape)

    def ready(b: pd.DataFrame) -> tuple[np.ndarray, Search]:
        b = b.sort_values("bid", kind="stable", na_position="first")
        return b["bid"].astype(object).where(b["bid"].notna(), None).to_numpy(), Search(_unpacked(b["v"], kind), k, tile)

    def at_home(b: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(q):
            return pd.DataFrame({c: [] for c in ("qid", "v", "limit", "bids", "distances", "units")}, dtype=object)
        m, limit = _unpacked(q["v"], kind), np.full(len(q), np.inf)
        bids, distances = [[] for _ in limit], [[] for _ in limit]
        if len(b):
            ids, search = ready(b)
            for i, j, d in zip(*search.nearest(m, limit)):
                bids[i].append(ids[j])
                distances[i].append(d)
            limit = np.array([ds[-1] if len(ds) == k else np.inf for ds in map(sorted, distances)])
        own, more = int(q["unit"].iloc[0]), [[] for _ in limit]
        others = units != own
        for some in _tiles(m, max(1, tile // 2)):
            near = np.flatnonzero(others & (_gap(m[some].min(0), m[some].max(0), low, high) <= limit[some].max() + TIE))
            for u in near:
                for i in some[_gap(m[some], m[some], low[u], high[u]) <= limit[some] + TIE]:
                    more[i].append(int(units[u]))
        return pd.DataFrame({"qid": q["qid"], "v": q["v"], "limit": limit, "bids": bids, "distances": distances, "units": more})

    def elsewhere(b: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(b) or not len(q):
            return pd.DataFrame({"qid": [], "bid": [], "distance": []})
        ids, search = ready(b)
        i, j, d = search.nearest(_unpacked(q["v"], kind), q["limit"].to_numpy(float))
        return pd.DataFrame({"qid": q["qid"].to_numpy()[i], "bid": ids[j], "distance": d})

    home = cut_lineage(met(asked_at, at_home, f"qid {q_type}, v binary, limit double, bids array<{id_type}>, distances array<double>, units array<int>"))
    pairs = f"qid {q_type}, bid {id_type}, distance double"
    near = home.select("qid", F.inline(F.arrays_zip("bids", "distances"))).toDF("qid", "bid", "distance")
    if len(held) > 1:
        near = near.unionByName(met(home.select("qid", "v", "limit", F.explode("units").alias("unit")), elsewhere, pairs))
    order = W.partitionBy("qid").orderBy(F.round("distance", 9), "bid")
    best = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    members = asked.join(groups.select("qid", F.col("v").alias("gv")), F.col("v") == F.col("gv")).select("query_id", "qid")
    return members.join(best, "qid").select("query_id", F.col("bid").alias("neighbour_id"), "distance", "rank")


class SplitTrees:
    """Binary trees of planes between sample points, halving the sample at each node; leaves are buckets of the index."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int, seed: int):
        rng = np.random.default_rng(seed)
        self.depth = depth
        self.planes, self.cuts = [], []
        for _ in range(trees):
            planes, cuts = np.zeros((2**depth, sample.shape[1])), np.zeros(2**depth)
            at = np.ones(len(sample), dtype="int64")  # the root is node 1, children of n are 2n and 2n + 1
            for node in range(1, 2**depth):
                own = sample[at == node]
                if len(own) > 1:
                    a, b = own[rng.choice(len(own), 2, replace=False)]
                    planes[node] = (a - b) / (np.linalg.norm(a - b) or 1.0)
                    cuts[node] = np.median(own @ planes[node])
                    at[at == node] = 2 * node + (own @ planes[node] > cuts[node])
            self.planes.append(planes)
            self.cuts.append(cuts)

    def _descend(self, v: np.ndarray, tree: int, node: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The leaf of each vector from its node at a level on, and its distance to each plane of the way."""
        margins = np.full((len(v), self.depth), np.inf)
        for step in range(level, self.depth):
            gap = np.einsum("ij,ij->i", v, self.planes[tree][node]) - self.cuts[tree][node]
            margins[:, step] = np.abs(gap)
            node = 2 * node + (gap > 0)
        return node, margins

    def leaves(self, v: np.ndarray, tree: int, probes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, leaves): the own leaf of each vector, then those beyond its nearest planes, one plane at a time."""
        rows = np.arange(len(v))
        own, margins = self._descend(v, tree, np.ones(len(v), dtype="int64"), 0)
        yield rows, own
        nearest = np.argsort(margins, axis=1)
        for p in range(min(probes - 1, self.depth)):
            for level in range(self.depth):
                some = rows[nearest[:, p] == level]
                if len(some):
                    other = (own[some] >> (self.depth - level - 1)) ^ 1
                    yield some, self._descend(v[some], tree, other, level + 1)[0]


def knn_approx(
    base: DataFrame, queries: DataFrame, id_col: str, vector: str, k: int, radius: float = float("inf"), trees: int = 6, probes: int = 4,
    leaf: int = 512, sample: int = 65_536, block: int = 4096, seed: int = 7,
) -> DataFrame:
    """(query_id, neighbour_id, distance, rank): nearest neighbours within ``radius`` found in the leaves of split trees.

    The planes are fitted on a bounded sample (``sample`` rows by hash of the id); every base vector is filed under one
    leaf a tree, about ``leaf`` rows each while the sample gives enough leaves.  A query looks into its own leaf and the
    ``probes - 1`` beyond its nearest planes.  Only its ``k`` best of a block of a leaf leave the task, so no pairs are
    put out; leaves above ``block`` rows are cut on both sides.  Copies are handled once, as in ``knn_exact``.
    """
    v = F.col(vector).cast("array<double>")
    base = base.where(F.col(vector).isNotNull()).select(F.col(id_col).alias("bid"), v.alias("v"))
    base = base.withColumn("rn", F.row_number().over(W.partitionBy("v").orderBy("bid"))).where(f"rn <= {k}").drop("rn")
    asked = queries.where(F.col(vector).isNotNull()).select(F.col(id_col).alias("query_id"), v.alias("v"))
    groups = asked.groupBy("v").agg(F.min("query_id").alias("qid"))
    id_type, q_type = base.schema["bid"].dataType.simpleString(), groups.schema["qid"].dataType.simpleString()
    out = f"query_id {q_type}, neighbour_id {id_type}, distance double, rank int"

    rows = base.count()
    points = _matrix(pd.Series([r["v"] for r in base.orderBy(F.xxhash64("bid"), "bid").limit(sample).collect()]))
    if not len(points):
        return base.sparkSession.createDataFrame([], out)
    depth = max(0, int(np.ceil(np.log2(max(1.0, min(rows / leaf, len(points) / 16))))))
    forest = base.sparkSession.sparkContext.broadcast(SplitTrees(points, depth, trees, seed))

    def filed(df: DataFrame, key: str, kind: str, tries: int) -> DataFrame:
        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                m = _matrix(batch["v"])
                for tree in range(trees):
                    for at, node in forest.value.leaves(m, tree, tries):
                        yield pd.DataFrame({key: batch[key].to_numpy()[at], "v": batch["v"].to_numpy()[at], "bucket": tree * (2 << depth) + node})

        return df.select(key, "v").mapInPandas(place, f"{key} {kind}, v array<double>, bucket long")

    left, right = filed(base, "bid", id_type, 1), filed(groups, "qid", q_type, probes)
    # At most trees x leaves rows, so bounded by the sample.
    sizes = left.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / block).alias("b_parts"))
    wanted = right.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / block).alias("q_parts"))
    parts = F.broadcast(sizes.join(wanted, "bucket"))
    left = left.join(parts, "bucket").select(
        "bucket", F.pmod(F.xxhash64("bid"), "b_parts").alias("bp"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("q_parts") - 1)).alias("qp"), "bid", "v"
    )
    right = right.join(parts, "bucket").select(
        "bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b_parts") - 1)).alias("bp"), F.pmod(F.xxhash64("qid"), "q_parts").alias("qp"), "qid", "v"
    )
    keys = ["bucket", "bp", "qp"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        lambda b, q: _nearest(b, q, k, radius), f"qid {q_type}, bid {id_type}, distance double"
    )
    once = found.groupBy("qid", "bid").agg(F.min("distance").alias("distance"))  # several trees may find a pair
    order = W.partitionBy("qid").orderBy(F.round("distance", 9), "bid")
    best = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    members = asked.join(groups.select("qid", F.col("v").alias("gv")), F.col("v") == F.col("gv")).select("query_id", "qid")
    return members.join(best, "qid").select("query_id", F.col("bid").alias("neighbour_id"), "distance", "rank")


def _nearest(b: pd.DataFrame, q: pd.DataFrame, k: int, radius: float) -> pd.DataFrame:
    """The ``k`` nearest of one block for each of its queries."""
    if not len(b) or not len(q):
        return pd.DataFrame({"qid": [], "bid": [], "distance": []})
    b = b.sort_values("bid")
    base, out = _matrix(b["v"]), []
    for start in range(0, len(q), 512):
        some = q.iloc[start : start + 512]
        d = _squared(_matrix(some["v"]), base)
        take = np.argsort(np.round(d, 9), axis=1, kind="stable")[:, :k]
        out.append(
            pd.DataFrame(
                {
                    "qid": np.repeat(some["qid"].to_numpy(), take.shape[1]),
                    "bid": b["bid"].to_numpy()[take].ravel(),
                    "distance": np.take_along_axis(d, take, axis=1).ravel(),
                }
            )
        )
    found = pd.concat(out, ignore_index=True)
    return found[found["distance"] <= radius * radius]
