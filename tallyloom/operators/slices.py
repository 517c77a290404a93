"""Ordered per-key computations that survive one key holding a third of all rows.

A plain window over ``partitionBy(user)`` puts every row of a user into one
task.  Here each key's rows are cut into consecutive *slices* along the order
column, the window runs inside (key, slice), and a small table with one row per
(key, slice) carries the state from one slice to the next.

Slices are chosen by rows, in two ways:

* ``by_key``: about one row in ``limit / 8``, chosen by hash of its key and place,
  marks a cut; the marks of a key, sorted, are its cut points.  Keys with few
  marks stay whole.  A cut is a place in the whole order, tie-breaks included, so
  bursts, outliers, infinities and a hot instant are cut as evenly as any rows.
  The marks depend on the rows alone, so a repeated task finds the same ones.
  They are 8 rows in ``limit``, which bounds what is broadcast.
* ``by_range``: no key at all (a global order).  The slices are the partitions of a
  range shuffle over all order columns, checkpointed; the carry table has one row per partition.

Rows with equal order values (all order columns) always land in the same slice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.session import cut_lineage

SLICE = "__slice"
HOT_ROWS = 1_000_000


def cuts_below(place: Column, cuts: Column) -> Column:
    """How many of the sorted ``cuts`` are at or below ``place``, by binary search."""
    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        above = F.get(cuts, middle) <= place
        open_ = state["low"] < state["high"]
        return F.struct(
            F.when(open_ & above, middle + 1).otherwise(state["low"]).alias("low"), F.when(open_ & ~above, middle).otherwise(state["high"]).alias("high")
        )

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cuts) + F.lit(1))).cast("int"))
    return F.aggregate(steps, start, halve, lambda state: state["low"])


def by_key(df: DataFrame, keys: list[str], order: str | list[str], limit: int = HOT_ROWS) -> DataFrame:
    """Add ``__slice``; only keys of about ``limit`` rows or more get more than one."""
    order = [order] if isinstance(order, str) else list(order)
    place = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)])
    every = max(1, limit // 8)
    marked = df.where(F.pmod(F.xxhash64(*keys, *order), F.lit(every)) == 0)
    cuts = marked.groupBy(*keys).agg(F.array_sort(F.collect_set(place)).alias("__cuts")).where(F.size("__cuts") >= min(8, limit))
    cuts = cuts.select(*[F.col(k).alias(f"__h_{k}") for k in keys], "__cuts")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__h_{k}"))
    cut = F.when(F.col("__cuts").isNotNull(), cuts_below(place, F.col("__cuts"))).otherwise(F.lit(0))
    return df.join(F.broadcast(cuts), same, "left").withColumn(SLICE, cut.cast("long")).drop("__cuts", *[f"__h_{k}" for k in keys])


def by_range(df: DataFrame, order: str | list[str], pieces: int | None = None) -> DataFrame:
    """Add ``__slice`` for a global order: the range partition of all order columns that a row lies in.

    The bounds are the shuffle's own sample, so the driver holds a few values per partition, however many
    rows there are.  They are sampled anew each time a plan runs, so the dealt rows are checkpointed with their slice.
    """
    order = [order] if isinstance(order, str) else list(order)
    if pieces is None:
        pieces = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(max(2, pieces), *[F.col(o) for o in order])
    return cut_lineage(dealt.withColumn(SLICE, F.spark_partition_id().cast("long")))


@dataclass
class Ordered:
    """Rows of ``df`` (which has ``__slice``) ordered by ``order`` inside ``keys``."""

    df: DataFrame
    keys: list[str]
    order: list[Column]

    @classmethod
    def per_key(cls, df: DataFrame, keys: list[str], order: list[str], limit: int = HOT_ROWS) -> "Ordered":
        return cls(by_key(df, keys, order, limit), keys, [F.col(o) for o in order])

    @classmethod
    def overall(cls, df: DataFrame, order: list[str], pieces: int | None = None) -> "Ordered":
        return cls(by_range(df, order, pieces), [], [F.col(o) for o in order])

    @property
    def _place(self) -> list[str]:
        return [*self.keys, SLICE]

    def _local(self):
        return W.partitionBy(*self._place).orderBy(*self.order)

    def _across(self):
        """Order of the slices of one key; a few rows per key."""
        return W.partitionBy(*self.keys).orderBy(SLICE) if self.keys else W.orderBy(SLICE)

    def _attach(self, df: DataFrame, carry: DataFrame) -> DataFrame:
        renamed = carry.select(
            *[F.col(c).alias(f"__c_{c}") if c in self._place else F.col(c) for c in carry.columns]
        )
        same = F.lit(True)
        for c in self._place:
            same = same & F.col(c).eqNullSafe(F.col(f"__c_{c}"))
        return df.join(renamed, same, "left").drop(*[f"__c_{c}" for c in self._place])

    def _step(self, df: DataFrame) -> "Ordered":
        return Ordered(df, self.keys, self.order)

    def running_sum(self, **sums: Column | str) -> "Ordered":
        """Inclusive running sums; ``name=column``."""
        values = {n: F.col(v) if isinstance(v, str) else v for n, v in sums.items()}
        carry = self.df.groupBy(*self._place).agg(*[F.sum(v).alias(f"__t_{n}") for n, v in values.items()])
        before = self._across().rowsBetween(W.unboundedPreceding, -1)
        carry = carry.select(*self._place, *[F.sum(f"__t_{n}").over(before).alias(f"__b_{n}") for n in values])
        inside = self._local().rowsBetween(W.unboundedPreceding, 0)
        out = self.df.select("*", *[F.sum(v).over(inside).alias(f"__i_{n}") for n, v in values.items()])
        out = self._attach(out, carry)
        kept = [c for c in self.df.columns if c not in sums]
        out = out.select(
            *kept,
            *[
                F.when(
                    F.col(f"__i_{n}").isNotNull() | F.col(f"__b_{n}").isNotNull(),
                    F.coalesce(F.col(f"__i_{n}"), F.lit(0)) + F.coalesce(F.col(f"__b_{n}"), F.lit(0)),
                ).alias(n)
                for n in sums
            ],
        )
        return self._step(out)

    def row_number(self, name: str) -> "Ordered":
        return self.running_sum(**{name: F.lit(1).cast("long")})

    def previous(self, **columns: str) -> "Ordered":
        """Value of the row just before; null on a key's first row."""
        packed = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
        carry = self.df.groupBy(*self._place).agg(F.max_by(packed, F.struct(*self.order)).alias("__last"))
        carry = carry.select(*self._place, F.lag("__last").over(self._across()).alias("__before"))
        out = self.df.withColumn("__prev", F.lag(packed).over(self._local()))
        out = self._attach(out, carry).withColumn("__prev", F.coalesce("__prev", "__before"))
        kept = [c for c in self.df.columns if c not in columns]
        return self._step(out.select(*kept, *[F.col(f"__prev.{n}").alias(n) for n in columns]))

    def last_known(self, **columns: str) -> "Ordered":
        """Last non-null value at or before each row."""
        place = F.struct(*self.order)
        carry = self.df.groupBy(*self._place).agg(
            *[
                F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(f"__t_{n}")
                for n, c in columns.items()
            ]
        )
        before = self._across().rowsBetween(W.unboundedPreceding, -1)
        carry = carry.select(
            *self._place, *[F.last(f"__t_{n}", ignorenulls=True).over(before).alias(f"__b_{n}") for n in columns]
        )
        inside = self._local().rowsBetween(W.unboundedPreceding, 0)
        out = self.df.select(
            "*", *[F.last(c, ignorenulls=True).over(inside).alias(f"__i_{n}") for n, c in columns.items()]
        )
        out = self._attach(out, carry)
        kept = [c for c in self.df.columns if c not in columns]
        return self._step(
            out.select(*kept, *[F.coalesce(f"__i_{n}", f"__b_{n}").alias(n) for n in columns])
        )

    def result(self) -> DataFrame:
        return self.df.drop(SLICE)
