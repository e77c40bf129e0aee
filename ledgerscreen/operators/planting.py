"""Planted-label injection over any ledger.

One hash per row, ``md5('seed:plant:id')`` (first 32 bits), is split into
disjoint ranges, one per kind, whose widths are the kinds' rates
(``count per 8,000 rows / 8,000``).  A row whose hash falls in a kind's range
seeds one altered copy with id ``PL-<kind>-<source id>``.  The test is
row-local (no global ranking), so planting is a map-only job at any scale and
the expected count scales with the table.  Labels mark the copies positive and
every other row ``none``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscreen.functions.exprs import hash_u32, hash_unit
from ledgerscreen.params import (DEFAULT_PARAMS, MONTH_END_MONTHS, OFF_HOURS_NIGHT, PLANT_BASE_ROWS,
                                 PLANT_KINDS, ROUND_AMOUNTS, Params)
from ledgerscreen.schema import RAW_COLUMNS


def rate_threshold(count_per_base: int) -> int:
    """Width of a kind's range on the 32-bit hash for its planting rate."""
    return int((count_per_base / PLANT_BASE_ROWS) * 4294967296.0)


def kind_ranges() -> dict[str, tuple[int, int]]:
    """Disjoint [lo, hi) ranges of the 32-bit planting hash, one per kind."""
    out, lo = {}, 0
    for kind, n in PLANT_KINDS:
        hi = lo + rate_threshold(n)
        out[kind] = (lo, hi)
        lo = hi
    return out


def plant_hash(p: Params):
    return hash_u32(p.plant_seed, "plant", F.col("transaction_id"))


def _pick(df: DataFrame, kind: str, n: int, p: Params) -> DataFrame:
    lo, hi = kind_ranges()[kind]
    # the hash is projected once; the filter then reads the column
    hashed = df.select("*", plant_hash(p).alias("_ph"))
    return hashed.where((F.col("_ph") >= F.lit(lo)) & (F.col("_ph") < F.lit(hi))).drop("_ph")


def _u(kind: str, tag: str, p: Params):
    return hash_unit(p.plant_seed, kind, tag, F.col("transaction_id"))


def _h(kind: str, tag: str, p: Params):
    return hash_u32(p.plant_seed, kind, tag, F.col("transaction_id"))


def _two(c) -> F.Column:
    return F.lpad(c.cast("string"), 2, "0")


def _new_id(kind: str):
    return F.concat(F.lit(f"PL-{kind}-"), F.col("transaction_id"))


def _altered_columns(kind: str, p: Params) -> dict:
    """Column expressions a kind changes (evaluated on the source row)."""
    cols: dict = {}
    if kind == "duplicate":
        pass
    elif kind == "round_number":
        amounts = F.array(*[F.lit(a) for a in ROUND_AMOUNTS])
        cols["amount"] = F.element_at(amounts, (_h(kind, "amount", p) % len(ROUND_AMOUNTS) + 1).cast("int"))
    elif kind == "off_hours_weekend":
        weekend = (_h(kind, "mode", p) % 2) == 0
        to_sat = (F.lit(12) - F.weekday("date")) % 7           # days to the Saturday on/after
        shift = to_sat + (_h(kind, "sunday", p) % 2).cast("int")
        cols["date"] = F.when(weekend, F.date_add("date", shift.cast("int"))).otherwise(F.col("date"))
        night = F.array(*[F.lit(h) for h in OFF_HOURS_NIGHT])
        hour = F.when(weekend, F.lit(9) + _h(kind, "hour", p) % 9).otherwise(
            F.element_at(night, (_h(kind, "hour", p) % len(OFF_HOURS_NIGHT) + 1).cast("int")))
        cols["time"] = F.concat_ws(":", _two(hour), _two(_h(kind, "minute", p) % 60), F.lit("00"))
        # a fresh amount, so the copy is not also an exact duplicate of its source
        cols["amount"] = F.col("amount") * (F.lit(0.5) + _u(kind, "factor", p))
    elif kind == "vendor_concentration":
        cols["vendor"] = F.lit(p.shell_vendor)
        cols["department"] = F.lit(p.shell_department)
        cols["account"] = F.lit(p.shell_account)
        cols["entry_type"] = F.lit("Debit")
        cols["amount"] = F.col("amount") * (F.lit(1.2) + F.lit(1.3) * _u(kind, "factor", p))
    elif kind == "statistical_outlier":
        cols["amount"] = F.col("amount") * (F.lit(8.0) + F.lit(7.0) * _u(kind, "factor", p))
    elif kind == "month_end_spike":
        months = F.array(*[F.lit(m) for m in MONTH_END_MONTHS])
        m = F.element_at(months, (_h(kind, "month", p) % len(MONTH_END_MONTHS) + 1).cast("int"))
        d0 = (F.lit(28) + _h(kind, "day", p) % 4).cast("int")
        y = F.year("date")
        last = F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1))))
        cols["date"] = F.make_date(y, m, F.when(d0 <= last, d0).otherwise(F.lit(28)))
        hour = F.lit(18) + _h(kind, "hour", p) % 6
        cols["time"] = F.concat_ws(":", _two(hour), _two(_h(kind, "minute", p) % 60), F.lit("00"))
        cols["department"] = F.lit(p.month_end_department)
        cols["entry_type"] = F.lit("Debit")
        cols["amount"] = F.col("amount") * (F.lit(1.5) + F.lit(1.5) * _u(kind, "factor", p))
    else:
        raise ValueError(f"unknown kind {kind!r}")
    cols["transaction_id"] = _new_id(kind)
    return cols


def plant_kind(df: DataFrame, kind: str, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Altered copies for one kind (raw ledger columns, date typed)."""
    n = dict(PLANT_KINDS)[kind]
    src = _pick(df, kind, n, p)
    if kind == "statistical_outlier":
        # only rows above their account's mean, so x8..x15 clears the upper fence
        means = df.groupBy("account").agg(F.round(F.avg("amount"), 2).alias("_acct_mean"))
        src = src.join(means, "account").where(F.col("amount") > F.col("_acct_mean"))
    cols = {c: F.col(c) for c in RAW_COLUMNS}
    cols.update(_altered_columns(kind, p))
    return src.select(*[cols[c].alias(c) for c in RAW_COLUMNS])


def planted_rows(df: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """All planted copies with an ``anomaly_type`` column (one kind at a time)."""
    out = None
    for kind, _ in PLANT_KINDS:
        part = plant_kind(df, kind, p).withColumn("anomaly_type", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


def plant_copies(df: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Every planted copy (raw columns + ``anomaly_type``) in ONE pass over the
    base ledger: the planting hash picks at most one kind per row, and each
    column takes the picked kind's altered expression.  Only the outlier kind
    needs an extra aggregate (account means: one row per account)."""
    kinds = [k for k, _ in PLANT_KINDS]
    h = F.col("_ph")
    pick = None
    for k, (lo, hi) in kind_ranges().items():
        pick = (F.when(h < F.lit(hi), F.lit(k)) if pick is None else pick.when(h < F.lit(hi), F.lit(k)))
    means = df.groupBy("account").agg(F.round(F.avg("amount"), 2).alias("_acct_mean"))
    # The kind ranges are contiguous from 0, so "picked by some kind" is one
    # comparison; filtering on it (rather than on the CASE) keeps the md5 from
    # being inlined once per CASE branch when Catalyst pushes the filter down.
    total = max(hi for _, hi in kind_ranges().values())
    hashed = df.select("*", plant_hash(p).alias("_ph")).where(F.col("_ph") < F.lit(total))
    tagged = (hashed.select("*", pick.alias("anomaly_type"))
              .join(means, "account", "left")
              .where((F.col("anomaly_type") != "statistical_outlier") | (F.col("amount") > F.col("_acct_mean"))))
    per_kind = {k: _altered_columns(k, p) for k in kinds}
    kind = F.col("anomaly_type")
    cols = []
    for c in RAW_COLUMNS:
        expr = F.col(c)
        for k in kinds:
            if c in per_kind[k]:
                expr = F.when(kind == k, per_kind[k][c]).otherwise(expr)
        cols.append(expr.alias(c))
    return tagged.select(*cols, "anomaly_type")


def plant_all(df: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Base rows (``anomaly_type`` = 'none') plus all planted copies."""
    return (df.select(*RAW_COLUMNS, F.lit("none").alias("anomaly_type"))
            .unionByName(plant_copies(df, p)))


def plant(df: DataFrame, p: Params = DEFAULT_PARAMS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ledger with planted rows, all labels, positive labels only)."""
    rows = planted_rows(df, p)
    ledger = df.select(*RAW_COLUMNS).unionByName(rows.select(*RAW_COLUMNS))
    positives = rows.select("transaction_id", F.lit(1).alias("is_anomaly"), "anomaly_type")
    labels = df.select("transaction_id", F.lit(0).alias("is_anomaly"),
                       F.lit("none").alias("anomaly_type")).unionByName(positives)
    return ledger, labels, positives


def labels_of(planted: DataFrame) -> DataFrame:
    """Label table from a ``plant_all`` frame: 1 + kind for copies, 0 + none else."""
    return planted.select("transaction_id",
                          (F.col("anomaly_type") != "none").cast("int").alias("is_anomaly"), "anomaly_type")
