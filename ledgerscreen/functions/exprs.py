"""Native Column expressions shared by the operators (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerscreen.params import DEFAULT_PARAMS, SEVERITY, UNKNOWN_SEVERITY, Params

TWO_POW_32 = 4294967296.0


def _as_str(c) -> Column:
    if isinstance(c, Column):
        return c.cast("string")
    return F.lit(str(c))


def hash_key(*parts) -> Column:
    """``'p1:p2:...'`` -- the text every hashed decision is keyed on."""
    return F.concat_ws(":", *[_as_str(p) for p in parts])


def hash_u32(*parts) -> Column:
    """First 32 bits of md5 of the key as a non-negative BIGINT.

    Deterministic, independent of partitioning, and computable in any SQL
    engine with md5 and hex parsing, so a plan and its oracle agree.
    """
    return F.conv(F.substring(F.md5(hash_key(*parts)), 1, 8), 16, 10).cast("bigint")


def hash_unit(*parts) -> Column:
    """Uniform double in (0, 1) derived from :func:`hash_u32`."""
    return (hash_u32(*parts).cast("double") + F.lit(0.5)) / F.lit(TWO_POW_32)


def false_if_null(pred: Column) -> Column:
    """pandas-style predicate: a comparison against null is False, not NULL."""
    return F.coalesce(pred, F.lit(False))


def leading_digit(x: Column) -> Column:
    """First character of ``str(abs(x))`` after stripping leading zeros and the dot.

    Values in [1e-4, 0.1) and 0 give 0 (their text starts ``0.0``); smaller
    non-zero values are printed in exponent form and give their first
    significant digit, as do values >= 0.1.
    """
    a = F.abs(x)
    text = F.substring(F.replace(F.ltrim(a.cast("string"), F.lit("0")), F.lit("."), F.lit("")), 1, 1)
    digit = F.when(text == "", F.lit(None)).otherwise(text.cast("int"))
    return (F.when(x.isNull(), F.lit(None).cast("int"))
            .when((a >= 1e-4) & (a < 0.1), F.lit(0))
            .otherwise(digit))


def severity_map() -> Column:
    pairs = []
    for name, w in SEVERITY.items():
        pairs += [F.lit(name), F.lit(w)]
    return F.create_map(*pairs)


def severity_from_string(tests_triggered: Column) -> Column:
    """Max severity over the comma-separated rule names; '' or null -> 0."""
    names = F.filter(F.split(F.coalesce(tests_triggered, F.lit("")), ","), lambda s: F.trim(s) != "")
    weights = F.transform(names, lambda s: F.coalesce(F.element_at(severity_map(), F.trim(s)),
                                                      F.lit(UNKNOWN_SEVERITY)))
    return F.aggregate(weights, F.lit(0.0), lambda acc, w: F.greatest(acc, w))


def risk_bucket(score: Column, p: Params = DEFAULT_PARAMS) -> Column:
    return (F.when(score > p.high_cut, F.lit("High"))
            .when(score > p.medium_cut, F.lit("Medium"))
            .otherwise(F.lit("Low")))


def risk_rank(level: Column) -> Column:
    return (F.when(level == "Low", F.lit(0)).when(level == "Medium", F.lit(1))
            .when(level == "High", F.lit(2)))


def round_half_even(x: Column, digits: int) -> Column:
    """Rounding of a double as numpy and pandas do it: scale, nearest even, unscale."""
    scale = F.lit(float(10 ** digits))
    return F.rint(x * scale) / scale


def blend_score(severity: Column, ml_score: Column, p: Params = DEFAULT_PARAMS) -> Column:
    """``w_r * severity + w_m * ml`` in doubles, rounded half-even to 4 decimals."""
    return round_half_even(F.lit(p.rule_weight) * severity + F.lit(p.ml_weight) * F.coalesce(ml_score, F.lit(0.0)), 4)


def hhmmss(seconds: Column) -> Column:
    """Seconds of day -> ``HH:MM:SS``."""
    s = seconds.cast("bigint")
    return F.concat_ws(":",
                       F.lpad((s / 3600).cast("bigint").cast("string"), 2, "0"),
                       F.lpad(((s / 60).cast("bigint") % 60).cast("string"), 2, "0"),
                       F.lpad((s % 60).cast("string"), 2, "0"))
