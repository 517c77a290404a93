"""Lookups, membership and distance joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``rows`` rows; never reads more than needed to tell."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only for a side whose size was checked; else the planner shuffles."""
    return F.broadcast(df) if small(df, rows) else df


def decode(log: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Replace an id by the attributes of its dimension row; unknown ids drop out."""
    return log.join(broadcast_if_small(names), key).drop(key)


def null_safe(left: str, right: str, columns: Sequence[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return same


def row_membership(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose values also occur as a row of ``b`` (nulls equal nulls)."""
    return a.alias("a").join(b.select(*columns).distinct().alias("b"), null_safe("a", "b", columns), "left_semi")


def rounded_key(columns: Sequence[str], decimals: int = 12) -> list[Column]:
    return [(F.round(F.col(c), decimals) + F.lit(0.0)).alias(f"__k_{c}") for c in columns]


def _with_keys(df: DataFrame, columns: Sequence[str], decimals: int) -> DataFrame:
    return df.select("*", *rounded_key(columns, decimals))


def novelty_anti_join(points: DataFrame, known: DataFrame, columns: Sequence[str], decimals: int = 12) -> DataFrame:
    """Points that do not occur in ``known`` after rounding."""
    keys = [f"__k_{c}" for c in columns]
    seen = known.select(*rounded_key(columns, decimals)).distinct()
    return _with_keys(points, columns, decimals).join(seen, keys, "left_anti").drop(*keys)


def validity_label(requested: DataFrame, valid: DataFrame, columns: Sequence[str], decimals: int = 12) -> DataFrame:
    """``is_valid`` = 1 for requested points that occur in ``valid`` after rounding."""
    keys = [f"__k_{c}" for c in columns]
    found = valid.select(*rounded_key(columns, decimals)).distinct().withColumn("__hit", F.lit(1))
    out = _with_keys(requested, columns, decimals).join(found, keys, "left")
    return out.withColumn("is_valid", F.coalesce("__hit", F.lit(0))).drop("__hit", *keys)


def exact_id_match(people: DataFrame, wanted: DataFrame, match_inn: bool = False) -> DataFrame:
    """People whose passport is among the wanted ones; both documents must be present.

    With ``match_inn`` a hit on the tax number counts as well.
    """

    def present(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")) != ""

    candidates = people.where(present("passport") & present("inn"))
    by_passport = candidates.join(wanted.where(present("passport")).select("passport").distinct(), "passport", "left_semi")
    if not match_inn:
        return by_passport
    by_inn = candidates.join(wanted.where(present("inn")).select("inn").distinct(), "inn", "left_semi")
    return by_passport.unionByName(by_inn).dropDuplicates(["unique_id"])
