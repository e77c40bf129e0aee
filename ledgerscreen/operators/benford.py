"""Benford leading-digit screen (per account and overall)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscreen.functions.exprs import leading_digit
from ledgerscreen.functions.gamma import chi2_sf
from ledgerscreen.params import DEFAULT_PARAMS, Params

DIGITS = range(1, 10)


def expected_share(d: int):
    """Benford's expected share of leading digit d: log10(1 + 1/d)."""
    return F.log10(F.lit(1.0) + F.lit(1.0) / F.lit(float(d)))


def tie_text(digits: int) -> str:
    """For each odd multiple of half a unit in [0, 1], whether Python's ``round`` goes up (1)
    or down (0): there the last bit of the double decides."""
    scale = 10 ** digits
    return "".join(str(round(round(k / (2 * scale), digits) * scale) - k // 2) for k in range(1, 2 * scale, 2))


def python_round(x: Column, digits: int) -> Column:
    """``round(x, digits)`` of Python for doubles from 0 to 1."""
    scale = float(10 ** digits)
    halves = F.rint(x * (2.0 * scale))
    down = (halves - 1.0) / 2.0
    tie = (halves % 2.0 == 1.0) & (x == halves / (2.0 * scale))
    up = F.substring(F.lit(tie_text(digits)), (down + 1).cast("int"), F.lit(1)).cast("double")
    return F.when(tie, (down + up) / scale).otherwise(F.round(x, digits))


def with_leading_digit(df: DataFrame) -> DataFrame:
    return df.withColumn("leading_digit", leading_digit(F.col("amount")))


def leading_digits(df: DataFrame) -> DataFrame:
    """E1 per row: transaction_id, amount, leading_digit."""
    return with_leading_digit(df).select("transaction_id", "amount", "leading_digit")


def by_account(df: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """One row per (non-null) account with actual/expected shares (3 dp),
    the max absolute deviation (3 dp) and REVIEW/OK on the unrounded deviation.

    One hash aggregate with nine conditional counts: partial aggregation makes
    it skew-proof and its output is one row per account."""
    d = with_leading_digit(df).where(F.col("account").isNotNull())
    counts = d.groupBy("account").agg(
        F.count(F.lit(1)).alias("n_transactions"),
        *[F.count_if(F.col("leading_digit") == k).alias(f"_c{k}") for k in DIGITS])
    devs = [F.abs(F.col(f"_c{k}") / F.col("n_transactions") - expected_share(k)) for k in DIGITS]
    maxdev = F.greatest(*devs)
    cols = [F.col("account"), F.col("n_transactions")]
    for k in DIGITS:
        cols.append(python_round(F.col(f"_c{k}") / F.col("n_transactions"), 3).alias(f"digit_{k}_actual"))
        cols.append(F.round(expected_share(k), 3).alias(f"digit_{k}_expected"))
    cols.append(python_round(maxdev, 3).alias("max_deviation"))
    cols.append(F.when(maxdev > F.lit(p.benford_threshold), "REVIEW").otherwise("OK").alias("flag"))
    return counts.select(*cols).orderBy(F.desc("max_deviation"), "account")


def chi_square(df: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Pearson's test of each (non-null) account's leading digits 1 to 9 against Benford's law:
    account, n_digits, chi_square (6 dp), p_value (9 dp, 8 degrees of freedom), flag ``REVIEW`` below
    ``benford_alpha``.  An account without such a digit has statistic 0, p-value 1."""
    d = with_leading_digit(df).where(F.col("account").isNotNull())
    counts = d.groupBy("account").agg(*[F.count_if(F.col("leading_digit") == k).alias(f"_c{k}") for k in DIGITS])
    n = sum((F.col(f"_c{k}") for k in DIGITS), F.lit(0).cast("long"))
    parts = [(F.col(f"_c{k}") - F.col("n_digits") * F.lit(math.log10(1 + 1 / k)))
             * (F.col(f"_c{k}") - F.col("n_digits") * F.lit(math.log10(1 + 1 / k))) / F.lit(math.log10(1 + 1 / k)) for k in DIGITS]
    x = F.coalesce(F.try_divide(sum(parts[1:], parts[0]), F.col("n_digits")), F.lit(0.0))
    tested = counts.withColumn("n_digits", n).withColumn("_x", x).withColumn("_p", chi2_sf(F.col("_x"), len(DIGITS) - 1))
    return tested.select("account", "n_digits", F.round("_x", 6).alias("chi_square"), F.round("_p", 9).alias("p_value"),
                         F.when(F.col("_p") < p.benford_alpha, "REVIEW").otherwise("OK").alias("flag"))


def overall(df: DataFrame) -> DataFrame:
    """E2 + E4: share of each leading digit over all rows, full-outer-aligned
    with the expected 1..9 table (a digit-0 row has a null expected share)."""
    d = with_leading_digit(df)
    n = d.agg(F.count(F.lit(1)).alias("_n"))
    actual = (d.groupBy("leading_digit").agg(F.count(F.lit(1)).alias("_c"))
              .crossJoin(F.broadcast(n))   # 1 row
              .select("leading_digit", (F.col("_c") / F.col("_n")).alias("actual_share")))
    expected = (d.sparkSession.range(1, 10).select(F.col("id").cast("int").alias("leading_digit"))
                .select("leading_digit", F.round(F.log10(F.lit(1.0) + F.lit(1.0) / F.col("leading_digit")), 6)
                        .alias("expected_share")))
    return actual.join(expected, "leading_digit", "full_outer")


def summary(bench: DataFrame) -> DataFrame:
    """E5: account, n_transactions, max_deviation, flag, largest deviation first."""
    return (bench.select("account", "n_transactions", "max_deviation", "flag")
            .orderBy(F.desc("max_deviation"), "account"))


def all_flagged(bench: DataFrame) -> DataFrame:
    """Whether every account is flagged REVIEW."""
    return bench.agg(F.count(F.lit(1)).alias("n_accounts"),
                     F.count_if(F.col("flag") == "REVIEW").alias("n_review"),
                     F.coalesce(F.bool_and(F.col("flag") == "REVIEW"), F.lit(True)).alias("all_review"))
