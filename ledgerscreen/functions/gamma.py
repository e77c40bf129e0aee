"""The regularised incomplete gamma function as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the series and of the continued fraction; beyond them nothing changes for the
#: degrees of freedom and arguments up to some hundreds that a chi-square test meets.
TERMS = 400
TINY = 1e-300


def gamma_q(a: float, x: Column) -> Column:
    """Upper regularised incomplete gamma Q(a, x) for a fixed ``a`` > 0; 1 for x <= 0, null for null.

    Below a + 1 by the power series of P = 1 - Q, above it by the continued fraction
    (modified Lentz), both as folds over a constant array."""
    steps = F.sequence(F.lit(1), F.lit(TERMS))
    front = F.exp(-x + F.lit(a) * F.ln(F.greatest(x, F.lit(TINY))) - F.lit(math.lgamma(a)))
    series = F.aggregate(
        steps, F.struct(F.lit(1.0 / a).alias("term"), F.lit(1.0 / a).alias("sum")),
        lambda s, k: F.struct((s["term"] * x / (k + F.lit(a))).alias("term"), (s["sum"] + s["term"] * x / (k + F.lit(a))).alias("sum")),
        lambda s: s["sum"])
    b0 = x + F.lit(1.0 - a)

    def lentz(s, k):
        factor = -k * (k - F.lit(a))
        base = b0 + 2.0 * k
        d = factor * s["d"] + base
        d = 1.0 / F.when(F.abs(d) < TINY, F.lit(TINY)).otherwise(d)
        c = base + factor / s["c"]
        c = F.when(F.abs(c) < TINY, F.lit(TINY)).otherwise(c)
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    fraction = F.aggregate(steps, F.struct(F.lit(1.0 / TINY).alias("c"), (1.0 / b0).alias("d"), (1.0 / b0).alias("h")), lentz, lambda s: s["h"])
    q = F.when(x < a + 1.0, 1.0 - front * series).otherwise(front * fraction)
    return F.when(x.isNull(), F.lit(None).cast("double")).when(x <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0)))


def chi2_sf(x: Column, df: int) -> Column:
    """P(chi-square with ``df`` degrees of freedom >= x)."""
    return gamma_q(df / 2.0, x / 2.0)
