"""Array-valued vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def squared_distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x)


def project(a: Column, b: Column) -> Column:
    """Projection of ``a`` onto ``b``; null where ``b`` is the zero vector."""
    scale = F.try_divide(dot(a, b), dot(b, b))
    return F.when(scale.isNotNull(), F.transform(b, lambda x: x.cast("double") * scale))
