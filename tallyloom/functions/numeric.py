"""Numeric Column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Wichura's AS 241 (PPND16) for the normal quantile.
_CENTRE_TOP = [3.3871328727963666080, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
               4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3]
_CENTRE_BOTTOM = [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
                  2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3]
_MIDDLE_TOP = [1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
               1.27045825245236838258, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4]
_MIDDLE_BOTTOM = [1.0, 2.05319162663775882187, 1.67638483018380384940, 6.89767334985100004550e-1,
                  1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9]
_TAIL_TOP = [6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 2.96560571828504891230e-1,
             2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7]
_TAIL_BOTTOM = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
                7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15]


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def inverse_normal(p: Column) -> Column:
    """Standard normal quantile; null outside (0, 1)."""
    q = p - 0.5
    centre_r = F.lit(0.180625) - q * q
    centre = q * _polynomial(centre_r, _CENTRE_TOP) / _polynomial(centre_r, _CENTRE_BOTTOM)
    r = F.sqrt(-F.log(F.least(p, 1.0 - p)))
    middle = _polynomial(r - 1.6, _MIDDLE_TOP) / _polynomial(r - 1.6, _MIDDLE_BOTTOM)
    tail = _polynomial(r - 5.0, _TAIL_TOP) / _polynomial(r - 5.0, _TAIL_BOTTOM)
    outer = F.when(r <= 5.0, middle).otherwise(tail) * F.signum(q)
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, centre).otherwise(outer))


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def softplus(z: Column) -> Column:
    """ln(1 + e^z) without overflow."""
    return F.greatest(F.lit(0.0), z) + F.log1p(F.exp(-F.abs(z)))


def log_transforms(x: Column) -> dict[str, Column]:
    return {"log1p": F.log1p(x), "ln": F.ln(x), "sqrt": F.when(x >= 0, F.sqrt(x)), "cbrt": F.cbrt(x)}


def clip_lower(x: Column, floor: float = 0) -> Column:
    """Values below ``floor`` become ``floor``; null stays null."""
    return F.when(x < floor, F.lit(floor)).otherwise(x)


def cut_bins(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (a, b] a value lies in; null outside."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    out = F.lit(None).cast("string")
    for low, high, label in zip(edges, edges[1:], labels):
        out = F.when((x > low) & (x <= high), F.lit(label)).otherwise(out)
    return out


def mixed(key: Column, seed: int = 0) -> Column:
    """Seeded pseudo-random whole number in [0, 2^32): the first digits of the MD5 of key and seed, the same in any engine."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def uniform(key: Column, seed: int = 0) -> Column:
    """Seeded uniform number in (0, 1) from a key of any type."""
    return (mixed(key, seed) + 0.5) / float(1 << 32)


def radical_inverse(index: Column, base: int) -> Column:
    """Van der Corput sequence: the digits of ``index`` in ``base`` mirrored at the point."""
    digits = math.ceil(53 / math.log2(base))
    start = F.struct(F.lit(0.0).alias("u"), index.cast("double").alias("rest"), F.lit(1.0 / base).alias("scale"))

    def step(acc: Column, _: Column) -> Column:
        rest = F.floor(acc["rest"] / base).cast("double")
        return F.struct(
            (acc["u"] + (acc["rest"] - rest * base) * acc["scale"]).alias("u"), rest.alias("rest"), (acc["scale"] / base).alias("scale")
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(digits)), start, step, lambda acc: acc["u"])


def kl_term(p: Column, q: Column) -> Column:
    """p ln(p / q) with the logarithm and the ratio taken as 0 where their argument is tiny."""
    ratio = F.when(q > 1e-4, p / q).otherwise(0.0)
    return p * F.when(ratio > 1e-4, F.log(ratio)).otherwise(0.0)
