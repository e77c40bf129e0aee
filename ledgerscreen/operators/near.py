"""Near-duplicate entries: a band join on amount and date inside each vendor.

Entries of equal vendor, amount and date are one point with a count (they are the exact duplicates
of the audit rules).  A point lies in a cell of amount and date; partners within the tolerances lie in the
same cell or a neighbouring one, so each point meets only five cells (its own
and the four that follow it).  A vendor of any size is thus spread over its cells, and the
points of a cell are bounded by the distinct amounts and days that fit in it, not by the ledger.

A null vendor equals a null vendor, as in the duplicate rule; a null amount or date has no
neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscreen.params import DEFAULT_PARAMS, Params

#: A cell, and those that follow it in order.
FORWARD = ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))


def points(je: DataFrame) -> DataFrame:
    """(vendor, amount, date, n)."""
    return (je.where(F.col("amount").isNotNull() & F.col("date").isNotNull())
            .groupBy("vendor", "amount", "date").agg(F.count(F.lit(1)).alias("n")))


def cells(p: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Points with their cell.  Cells are twice as wide as the amount's tolerance, so that
    rounding in the division can't put partners two cells apart."""
    return p.select("*", F.floor(F.col("amount") / (2.0 * params.near_amount)).alias("ca"),
                    F.floor(F.unix_date("date") / F.lit(params.near_days + 1)).alias("cd"))


def near_pairs(je: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Unordered pairs of different points of a vendor whose amounts differ by at most
    ``near_amount`` and whose dates by at most ``near_days``: vendor, amount_a, date_a, n_a, amount_b,
    date_b, n_b with (amount_a, date_a) < (amount_b, date_b)."""
    placed = cells(points(je), params)
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(d).alias("d")) for a, d in FORWARD])
    x = placed.withColumn("_s", F.explode(steps)).select(
        F.col("vendor").alias("_v"), (F.col("ca") + F.col("_s.a")).alias("_a"), (F.col("cd") + F.col("_s.d")).alias("_d"),
        ((F.col("_s.a") == 0) & (F.col("_s.d") == 0)).alias("own"), F.col("amount").alias("xa"), F.col("date").alias("xd"), F.col("n").alias("xn"))
    met = x.join(placed, x["_v"].eqNullSafe(placed["vendor"]) & (F.col("_a") == F.col("ca")) & (F.col("_d") == F.col("cd")))
    first = (F.col("xa") < F.col("amount")) | ((F.col("xa") == F.col("amount")) & (F.col("xd") < F.col("date")))
    met = met.where((F.abs(F.col("xa") - F.col("amount")) <= params.near_amount)
                    & (F.abs(F.datediff("xd", "date")) <= params.near_days) & (~F.col("own") | first))
    a, b = F.struct(F.col("xa").alias("amount"), F.col("xd").alias("date"), F.col("xn").alias("n")), F.struct("amount", "date", "n")
    return met.select("vendor", F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).select(
        "vendor", *[F.col(f"{s}.{c}").alias(f"{c}_{s}") for s in "ab" for c in ("amount", "date", "n")])


def near_entries(je: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Every entry with a near partner: transaction_id, near_entries (how many entries
    are near, equal ones not counted).  Partners are counted per point, so copies are never
    expanded into pairs."""
    pairs = near_pairs(je, params)
    both = pairs.select("vendor", F.col("amount_a").alias("amount"), F.col("date_a").alias("date"), F.col("n_b").alias("n")).unionByName(
        pairs.select("vendor", F.col("amount_b").alias("amount"), F.col("date_b").alias("date"), F.col("n_a").alias("n")))
    per_point = both.groupBy("vendor", "amount", "date").agg(F.sum("n").alias("near_entries")).withColumnsRenamed(
        {"vendor": "_v", "amount": "_a", "date": "_d"})
    return (je.join(per_point, je["vendor"].eqNullSafe(F.col("_v")) & (je["amount"] == F.col("_a")) & (je["date"] == F.col("_d")))
            .select("transaction_id", "near_entries"))
