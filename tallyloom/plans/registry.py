"""Registry of named queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.plans import inputs
from tallyloom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the given tables and to the inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name in inputs.DERIVED:
            return inputs.derive(self, name)
        return self.spark.read.parquet(self.path(name))


def rounded(df: DataFrame, names: list[str], digits: int, shift: float = 0.0) -> DataFrame:
    """Round doubles and turn -0.0 into 0.0, so that results compare by value.

    Means of a few prices often lie on the middle between two rounded values, where the last bit of a sum decides;
    ``shift`` (below half a digit, the same in the SQL) moves those middles to places no short decimal reaches.
    """
    chosen = set(names)
    return df.select(
        *[(F.round(F.col(c) + F.lit(shift) if shift else F.col(c), digits) + F.lit(0.0)).alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns]
    )


def query(key: str, sql: str | None = None, rounds: str | list[str] = "", digits: int = 6, uses: str = "", shift: float = 0.0):
    """Register ``fn(tables)``; ``rounds`` lists double columns, ``uses`` the derived inputs of ``sql``."""
    names = rounds.split() if isinstance(rounds, str) else list(rounds)

    def register(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")

        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return rounded(fn(Tables(spark, folder)), names, digits, shift)

        QUERIES[key] = run
        if sql is not None:
            text = inputs.with_clause(uses.split(), sql)
            if names:
                fixes = ", ".join(f'round("{n}"{f" + {shift}" if shift else ""}, {digits}) + 0.0 AS "{n}"' for n in names)
                text = f"SELECT * REPLACE ({fixes}) FROM ({text}) AS answer"
            ORACLES[key] = text
        return fn

    return register
