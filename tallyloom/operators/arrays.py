"""Array-style computations on long tables: runs, lags, grids, vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.vectors import squared_distance
from tallyloom.operators.slices import Ordered


def ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int | None = None) -> Ordered:
    if keys:
        return Ordered.per_key(df, list(keys), list(order), **({"limit": limit} if limit else {}))
    return Ordered.overall(df, list(order))


def run_length_encode(
    df: DataFrame, order: Sequence[str], value: str, keys: Sequence[str] = (), limit: int | None = None
) -> DataFrame:
    """Consecutive equal values as (keys, run, value, count), runs numbered from 1."""
    marked = ordered(df.select(*keys, *order, value, F.lit(1).alias("__row")), keys, order, limit).previous(
        __before=value, __seen="__row"
    )
    starts = F.col("__seen").isNull() | ~F.col(value).eqNullSafe(F.col("__before"))
    runs = marked.running_sum(run=starts.cast("long")).result()
    return runs.groupBy(*keys, "run", value).agg(F.count(F.lit(1)).alias("count"))


def max_after_zero(df: DataFrame, order: Sequence[str], value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Largest value whose predecessor is 0; null if there is none."""
    before = ordered(df.select(*keys, *order, value), keys, order).previous(__before=value).result()
    return before.groupBy(*keys).agg(F.max(F.when(F.col("__before") == 0, F.col(value))).alias("max_after_zero"))


def sawtooth(df: DataFrame, order: str, period: int) -> DataFrame:
    """Row position along ``order`` modulo the period, counted 1..period."""
    return (
        Ordered.overall(df, [order])
        .row_number("__pos")
        .result()
        .withColumn("tooth", (F.col("__pos") - 1) % period + 1)
        .drop("__pos")
    )


def topk_values(df: DataFrame, value: str, k: int) -> DataFrame:
    return df.select(value).orderBy(F.col(value).desc()).limit(k)


def positive_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with more positive than negative entries."""
    signs = df.select(*[F.signum(F.col(c).cast("double")).alias(c) for c in columns])
    long = signs.unpivot([], list(columns), "feature", "s")
    return long.groupBy("feature").agg(F.sum("s").alias("balance")).where("balance > 0").select("feature")


def nonzero_diag_product(cells: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """Product of the non-zero diagonal entries of a long matrix; null if there is none."""
    on = cells.where((F.col(row) == F.col(col)) & (F.col(value) != 0))
    return on.agg(F.product(value).alias("product"))


def nan_variance(value: Column) -> Column:
    """Population variance; null and NaN are ignored."""
    return F.var_pop(F.nanvl(value.cast("double"), F.lit(None).cast("double")))


def distance_to_anchors(points: DataFrame, id_col: str, vector: str, anchors: DataFrame, anchor_id: str,
                        anchor_vector: str, most: int = 1000) -> DataFrame:
    """Euclidean distance of every point to every anchor.

    The anchors travel with each task, so their number is checked; the points
    are read once and never shuffled.
    """
    rows = anchors.select(anchor_id, anchor_vector).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} anchors")
    table = F.array(
        *[
            F.struct(F.lit(r[0]).alias("anchor"), F.array(*[F.lit(float(x)) for x in r[1]]).alias("v"))
            for r in sorted(rows, key=lambda r: r[0])
        ]
    )
    near = points.select(id_col, vector, F.explode(table).alias("__a"))
    return near.select(
        id_col, F.col("__a.anchor").alias(anchor_id), F.sqrt(squared_distance(F.col(vector), F.col("__a.v"))).alias("distance")
    )


def grid_neighbourhood_sum(
    cells: DataFrame, h: int, w: int, row: str = "i", col: str = "j", value: str = "x", prob: str = "q"
) -> DataFrame:
    """For each cell its value times the probability mass of the h x w cells up-left of it.

    The box sum is separable: every cell is added to the ``h`` rows below it, then
    to the ``w`` columns right of it, each step one aggregation.
    """
    def spread(df: DataFrame, axis: str, size: int) -> DataFrame:
        shifted = df.withColumn("__d", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
        shifted = shifted.withColumn(axis, F.col(axis) + F.col("__d"))
        return shifted.groupBy(row, col).agg(F.sum("__mass").alias("__mass"))

    mass = cells.select(row, col, F.col(prob).alias("__mass"))
    wide = spread(spread(mass, row, h), col, w)
    out = cells.join(wide, [row, col], "left")
    return out.withColumn("expectation", F.col(value) * F.coalesce("__mass", F.lit(0.0))).drop("__mass")
