"""Row-level audit rules (DataFrame form) fused into one pass.

Shape of the plan::

    ledger --+-- groupBy(vendor)              count, sum      (partial agg, tiny)
             +-- groupBy(account)             q1, median, q3  (exact, scale-aware)
             +-- groupBy(vendor,amount,date)  count > 1       (partial agg)
             \\-- each stored and counted, then left joins back (broadcast while it has few
                 rows, sort-merge + skew split otherwise) -> six nullable reason columns

Every aggregate is a map-side-combined hash aggregate, so a vendor, account or
group of duplicate rows holding a third of the ledger is reduced before any
shuffle.  No window over a business key is used: a window would put the
whole hot group into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscreen.functions.exprs import false_if_null
from ledgerscreen.functions.quantiles import group_quantiles
from ledgerscreen.params import (DEFAULT_PARAMS, REASON_DUPLICATE, REASON_MONTH_END,
                                 REASON_OFF_HOURS, REASON_OUTLIER, REASON_ROUND, RULE_NAMES, Params)
from ledgerscreen.session import join_side, stored

DUP_KEYS = ("vendor", "amount", "date")


def vendor_stats(df: DataFrame) -> DataFrame:
    """Rows and spend per vendor; the null vendor is kept as a group (it counts
    toward total spend but is never flagged or mapped)."""
    return df.groupBy("vendor").agg(F.count(F.lit(1)).alias("vendor_n"),
                                    F.sum("amount").alias("vendor_sum"))


def account_stats(df: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Exact q1 / median / q3 of amount per (non-null) account."""
    return group_quantiles(df, ["account"], "amount",
                           {"acct_q1": p.q_low, "acct_median": 0.5, "acct_q3": p.q_high}, p).drop("n")


def duplicate_keys(df: DataFrame) -> DataFrame:
    """(vendor, amount, date) keys shared by more than one row (null == null)."""
    return (df.groupBy(*DUP_KEYS).agg(F.count(F.lit(1)).alias("dup_n"))
            .where(F.col("dup_n") > 1))


def enrich(df: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Ledger + the per-vendor, per-account and duplicate-group statistics each
    rule and feature needs, computed once and shared (C1, C4, C5, G3-G5).

    Each statistic is stored and counted before its join, so the ledger is shuffled
    only for one that has many rows."""
    vs = stored(vendor_stats(df), "vendor-stats")
    total = vs.agg(F.sum("vendor_sum").alias("total_amount"))   # 1 row
    acct = join_side(account_stats(df, p), "account-stats")
    dups = duplicate_keys(df).withColumnRenamed("vendor", "_dv").withColumnRenamed(
        "amount", "_da").withColumnRenamed("date", "_dd")
    dups = join_side(dups, "duplicate-keys")
    e = df.join(join_side(vs.where(F.col("vendor").isNotNull()), "vendors"), "vendor", "left")
    e = e.join(acct, "account", "left")
    e = e.join(dups, (e.vendor.eqNullSafe(dups._dv)) & (e.amount == dups._da) & (e.date == dups._dd), "left")
    e = e.drop("_dv", "_da", "_dd")
    return e.crossJoin(F.broadcast(total))   # one row: bounded broadcast


def row_local_reasons(p: Params = DEFAULT_PARAMS) -> dict:
    """Reason columns of the rules that need only the row itself (no aggregate):
    round number, off-hours/weekend and month-end late posting."""
    amt = F.col("amount")
    hour = F.col("hour")
    is_round = false_if_null((amt % F.lit(p.round_base) == 0) & (amt >= F.lit(p.round_min)))
    is_off = (false_if_null(F.col("is_weekend")) | false_if_null(hour < p.business_start_hour)
              | false_if_null(hour > p.business_end_hour))
    is_me = false_if_null((F.col("day") >= p.month_end_day) & (hour >= p.late_hour))
    return {
        "round_number": F.when(is_round, F.lit(REASON_ROUND)),
        "off_hours_weekend": F.when(is_off, F.lit(REASON_OFF_HOURS)),
        "month_end_late_hour_posting": F.when(is_me, F.lit(REASON_MONTH_END)),
    }


def rule_columns(e: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Adds one nullable reason column per rule (null = not flagged)."""
    amt = F.col("amount")
    local = row_local_reasons(p)
    is_dup = F.col("dup_n").isNotNull()
    share_pct = F.try_divide(F.col("vendor_sum"), F.col("total_amount")) * F.lit(100.0)
    is_conc = false_if_null(F.col("vendor").isNotNull() & (share_pct > F.lit(p.concentration_pct)))
    upper = F.col("acct_q3") + F.lit(p.iqr_mult) * (F.col("acct_q3") - F.col("acct_q1"))
    is_out = false_if_null(F.col("account").isNotNull() & (amt > upper))
    return e.select(
        "*",
        F.when(is_dup, F.lit(REASON_DUPLICATE)).alias("r_duplicate"),
        local["round_number"].alias("r_round_number"),
        local["off_hours_weekend"].alias("r_off_hours_weekend"),
        F.when(is_conc, F.lit(p.concentration_reason)).alias("r_vendor_concentration"),
        F.when(is_out, F.format_string(REASON_OUTLIER.replace("{account}", "%s"), F.col("account")))
         .alias("r_statistical_outlier"),
        local["month_end_late_hour_posting"].alias("r_month_end_late_hour_posting"),
    )


def with_flag_summary(r: DataFrame) -> DataFrame:
    """Count, names joined by ', ' and reasons joined by ' | ' in rule order.
    Rows with no flag keep count 0 and empty strings (the left-joined form, J1/J2)."""
    reason_cols = [F.col(f"r_{n}") for n in RULE_NAMES]
    names = [F.when(F.col(f"r_{n}").isNotNull(), F.lit(n)) for n in RULE_NAMES]
    n = sum((c.isNotNull().cast("int") for c in reason_cols), F.lit(0))
    return r.select(
        "*",
        n.cast("int").alias("n_tests_triggered"),
        F.concat_ws(", ", *names).alias("tests_triggered"),
        F.concat_ws(" | ", *reason_cols).alias("reasons"),
    )


def rule_flags(r: DataFrame) -> DataFrame:
    """One row per flagged transaction (the rule flag table)."""
    s = r if "n_tests_triggered" in r.columns else with_flag_summary(r)
    return (s.where(F.col("n_tests_triggered") > 0)
            .select("transaction_id", "n_tests_triggered", "tests_triggered", "reasons"))


def single_rule(r: DataFrame, name: str) -> DataFrame:
    """(transaction_id, reason) for the rows one rule flags."""
    col = f"r_{name}"
    return r.where(F.col(col).isNotNull()).select("transaction_id", F.col(col).alias("reason"))


def flags_per_txn_hist(flags: DataFrame) -> DataFrame:
    """Flagged rows per number of rules triggered."""
    return (flags.groupBy("n_tests_triggered").agg(F.count(F.lit(1)).alias("n_transactions"))
            .orderBy("n_tests_triggered"))


def rule_counts(flags: DataFrame) -> DataFrame:
    """Rows flagged per rule name (split + explode of the names string)."""
    names = F.explode(F.split(F.col("tests_triggered"), ", "))
    return (flags.where(F.coalesce(F.col("tests_triggered"), F.lit("")) != "")
            .select(names.alias("test_name"))
            .groupBy("test_name").agg(F.count(F.lit(1)).alias("n_flagged")))


def rule_flag_rate(ledger: DataFrame, flags: DataFrame) -> DataFrame:
    """C11: flagged rows / all rows."""
    total = ledger.agg(F.count(F.lit(1)).alias("n_rows"))
    flagged = flags.agg(F.count(F.lit(1)).alias("n_flagged"))
    return (total.crossJoin(flagged)
            .select("n_rows", "n_flagged",
                    F.round(F.try_divide(F.col("n_flagged"), F.col("n_rows")) * 100, 4).alias("flag_rate_pct")))
