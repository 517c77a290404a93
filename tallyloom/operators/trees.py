"""Impurity, exact split search and a level-wise decision tree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.profiling import melt
from tallyloom.operators.slices import Ordered

EPS = 1e-6


def class_shares(counts: Sequence[Column], total: Column) -> list[Column]:
    return [c / total for c in counts]


def impurity(counts: Sequence[Column], criterion: str = "gini") -> Column:
    """Impurity of a node from its class counts."""
    total = sum(counts[1:], counts[0]).cast("double")
    shares = class_shares(counts, total)
    if criterion == "gini":
        return 1.0 - sum((p * p for p in shares[1:]), shares[0] * shares[0])
    if criterion == "entropy":
        return sum((-p * F.log(p + EPS) for p in shares[1:]), -shares[0] * F.log(shares[0] + EPS))
    raise ValueError(f"unknown criterion {criterion}")


def impurity_table(df: DataFrame, label: str, n_classes: int, by: Sequence[str] = ()) -> DataFrame:
    counts = df.groupBy(*by).agg(*[F.count_if(F.col(label) == k).alias(f"c{k}") for k in range(n_classes)])
    cols = [F.col(f"c{k}") for k in range(n_classes)]
    return counts.select(*by, *cols, impurity(cols, "gini").alias("gini"), impurity(cols, "entropy").alias("entropy"))


def squared_error(n: Column, total: Column, squares: Column) -> Column:
    """Mean squared distance of a node's targets from their mean, from their number, sum and sum of squares."""
    return F.greatest(squares / n - (total / n) * (total / n), F.lit(0.0))


def error_table(df: DataFrame, target: str, by: Sequence[str] = ()) -> DataFrame:
    """Number, mean and squared error of the targets of each group."""
    y = F.col(target).cast("double")
    sums = df.where(y.isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q"))
    return sums.select(*by, "n", (F.col("s") / F.col("n")).alias("mean"), squared_error(F.col("n"), F.col("s"), F.col("q")).alias("mse"))


def variance_prefix_sums(long: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """Running (number, sum, sum of squares) of the target along each feature's sorted values, equal values together."""
    y = F.col(target).cast("double")
    sums = long.where(F.col("value").isNotNull()).groupBy(*keys, "value").agg(
        F.count(F.lit(1)).cast("double").alias("n0"), F.sum(y).alias("n1"), F.sum(y * y).alias("n2")
    )
    ordered = Ordered.per_key(sums, list(keys), ["value"]).previous(prev_value="value")
    return ordered.running_sum(**{f"upto{k}": f"n{k}" for k in range(3)}).result()


def class_prefix_counts(long: DataFrame, keys: Sequence[str], label: str, n_classes: int) -> DataFrame:
    """Running class counts along each feature's sorted values, equal values together."""
    counts = long.where(F.col("value").isNotNull()).groupBy(*keys, "value").agg(
        *[F.count_if(F.col(label) == k).alias(f"n{k}") for k in range(n_classes)]
    )
    ordered = Ordered.per_key(counts, list(keys), ["value"]).previous(prev_value="value")
    return ordered.running_sum(**{f"upto{k}": f"n{k}" for k in range(n_classes)}).result()


def split_gains(long: DataFrame, keys: Sequence[str], label: str, n_classes: int, criterion: str) -> DataFrame:
    """(keys, feature, threshold, gain) for every place between two distinct values."""
    place = [*keys, "feature"]
    if criterion == "mse":
        return _error_gains(long, keys, label)
    prefix = class_prefix_counts(long, place, label, n_classes)
    totals = prefix.groupBy(*place).agg(*[F.sum(f"n{k}").alias(f"all{k}") for k in range(n_classes)])
    rows = prefix.join(totals, place).where(F.col("prev_value").isNotNull())
    left = [F.col(f"upto{k}") - F.col(f"n{k}") for k in range(n_classes)]
    whole = [F.col(f"all{k}") for k in range(n_classes)]
    right = [w - l for w, l in zip(whole, left)]

    def size(cols: list[Column]) -> Column:
        return sum(cols[1:], cols[0]).cast("double")

    gain = (
        impurity(whole, criterion)
        - size(left) / size(whole) * impurity(left, criterion)
        - size(right) / size(whole) * impurity(right, criterion)
    )
    return rows.select(*place, ((F.col("prev_value") + F.col("value")) / 2).alias("threshold"), gain.alias("gain"))


def _error_gains(long: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """``split_gains`` for a number as the target: how much a split lowers the mean squared error."""
    place = [*keys, "feature"]
    prefix = variance_prefix_sums(long, place, target)
    totals = prefix.groupBy(*place).agg(*[F.sum(f"n{k}").alias(f"all{k}") for k in range(3)])
    rows = prefix.join(totals, place).where(F.col("prev_value").isNotNull())
    left = [F.col(f"upto{k}") - F.col(f"n{k}") for k in range(3)]
    whole = [F.col(f"all{k}") for k in range(3)]
    right = [w - l for w, l in zip(whole, left)]
    gain = squared_error(*whole) - left[0] / whole[0] * squared_error(*left) - right[0] / whole[0] * squared_error(*right)
    return rows.select(*place, ((F.col("prev_value") + F.col("value")) / 2).alias("threshold"), gain.alias("gain"))


def best_split(
    df: DataFrame, features: Sequence[str], label: str, n_classes: int, criterion: str = "gini", keys: Sequence[str] = ()
) -> DataFrame:
    """Largest gain over all features and thresholds; ties go to the first feature, then the lowest threshold."""
    long = melt(df, features, [*keys, label])
    gains = split_gains(long, keys, label, n_classes, criterion)
    place = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    # Gains that differ only by rounding noise count as ties.
    rank = F.struct(F.round("gain", 12), -place, -F.col("threshold"))
    best = F.max_by(F.struct("feature", "threshold", "gain"), rank).alias("b")
    return gains.groupBy(*keys).agg(best).select(*keys, "b.feature", "b.threshold", "b.gain")


class LevelTree:
    """A decision tree grown one level at a time; every level is one Spark job over all nodes.

    ``nodes`` maps a node id (root 1, children 2n for value < threshold and
    2n + 1) to a split or to what its leaf predicts; its size is bounded by the depth.
    With the criterion ``gini`` or ``entropy`` a leaf has class shares, with ``mse`` the mean of a number.
    Rows whose target (or, at a split, value) is null: the former teach nothing, the latter go right.
    """

    def __init__(self, criterion: str = "gini", max_depth: int = 4, min_leaf_size: int = 5, min_improvement: float | None = None):
        self.criterion, self.max_depth = criterion, max_depth
        self.min_leaf_size, self.min_improvement = min_leaf_size, min_improvement
        self.nodes: dict[int, dict] = {}

    def _summaries(self, placed: DataFrame, label: str) -> dict[int, dict]:
        """What is known of each open node; one row per node comes to the driver."""
        if self.criterion == "mse":
            rows = error_table(placed, label, ["__node"]).collect()
            return {r["__node"]: {"mean": r["mean"], "rows": r["n"], "pure": r["mse"] <= 1e-12 * max(1.0, r["mean"] ** 2)} for r in rows}
        counts = placed.groupBy("__node").agg(*[F.count_if(F.col(label) == k).alias(f"c{k}") for k in range(self.n_classes)])
        out = {}
        for r in counts.collect():
            sizes = [r[f"c{k}"] for k in range(self.n_classes)]
            total = sum(sizes)
            out[r["__node"]] = {"shares": [s / max(total, 1) for s in sizes], "rows": total, "pure": max(sizes) == total}
        return out

    def fit(self, df: DataFrame, features: Sequence[str], label: str, n_classes: int = 0) -> "LevelTree":
        self.features, self.n_classes = list(features), n_classes
        self.nodes, open_nodes = {}, [1]
        known = df.where(F.col(label).isNotNull())
        for depth in range(self.max_depth + 1):
            placed = known.withColumn("__node", self._node_of()).where(F.col("__node").isin(open_nodes))
            own = self._summaries(placed, label)
            self.nodes |= own
            splittable = [n for n, s in own.items() if depth < self.max_depth and not s["pure"] and s["rows"] > self.min_leaf_size]
            if not splittable:
                break
            found = best_split(placed.where(F.col("__node").isin(splittable)), features, label, n_classes, self.criterion, ["__node"])
            open_nodes = []
            for row in found.collect():  # one row per open node
                if self.min_improvement is not None and row["gain"] <= self.min_improvement:
                    continue
                self.nodes[row["__node"]].update(feature=row["feature"], threshold=row["threshold"], gain=row["gain"])
                open_nodes += [2 * row["__node"], 2 * row["__node"] + 1]
            if not open_nodes:
                break
        return self

    def _node_of(self, node: int = 1) -> Column:
        split = self.nodes.get(node, {})
        if "feature" not in split:
            return F.lit(node).cast("long")
        goes_left = F.col(split["feature"]).cast("double") < split["threshold"]
        return F.when(goes_left, self._node_of(2 * node)).otherwise(self._node_of(2 * node + 1))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``leaf`` and the prediction of the row's leaf.

        A class tree gives shares (``probability``) and the first most likely class (``prediction``),
        a tree of numbers the mean of the leaf (``prediction``).
        """
        out = df.withColumn("leaf", self._node_of())
        leaves = {n: s for n, s in self.nodes.items() if "feature" not in s}
        if self.criterion == "mse":
            table = df.sparkSession.createDataFrame([(n, float(s["mean"])) for n, s in leaves.items()], "leaf bigint, prediction double")
            return out.join(F.broadcast(table), "leaf", "left")
        table = df.sparkSession.createDataFrame([(n, s["shares"]) for n, s in leaves.items()], "leaf bigint, probability array<double>")
        out = out.join(F.broadcast(table), "leaf", "left")
        best = F.array_position("probability", F.array_max("probability")) - 1
        return out.withColumn("prediction", best.cast("int"))

    def importances(self) -> dict[str, float]:
        """Summed gain per feature."""
        out = {f: 0.0 for f in self.features}
        for s in self.nodes.values():
            if "feature" in s:
                out[s["feature"]] += s["gain"]
        return out
