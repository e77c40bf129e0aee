"""Cube of spend with distinct vendors.

The ledger is reduced once to the finest grouping; every coarser grouping set is made from that
table.  Distinct vendors are counted exactly from (grouping, vendor) rows, or estimated from
sketches that are made once per finest group and merged from there on: then no
vendor list is shuffled, whatever its length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS = ("department", "entry_type", "month")
#: log2 of a sketch's registers: the relative standard error is about 0.8 / sqrt(2 ** LG_K).
LG_K = 12


def _level(dims: tuple):
    """Bit k set: dimension k is summed over (tells a total from a null value)."""
    return F.grouping_id(*dims).cast("long").alias("level")


def spend_cube(je: DataFrame, dims: tuple = DIMENSIONS) -> DataFrame:
    """dims, level, n_entries, spend (rounded to cents), n_vendors (exact, null not counted)."""
    per_vendor = je.groupBy(*dims, "vendor").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s"))
    # (grouping, vendor) rows first, then a plain count: no distinct aggregate over expanded rows
    fine = per_vendor.groupingSets([[*[d for k, d in enumerate(dims) if m >> k & 1], "vendor"] for m in range(2 ** len(dims))], *dims, "vendor")
    sums = fine.agg(F.grouping_id(*dims, "vendor").alias("_g"), F.sum("n").alias("n"), F.sum("s").alias("s"))
    return (sums.withColumn("level", F.shiftright("_g", 1).cast("long")).groupBy(*dims, "level")
            .agg(F.sum("n").alias("n_entries"), F.round(F.sum("s"), 2).alias("spend"), F.count("vendor").alias("n_vendors")))


def spend_cube_sketched(je: DataFrame, dims: tuple = DIMENSIONS, lg_k: int = LG_K) -> DataFrame:
    """As ``spend_cube`` with ``n_vendors`` estimated from merged sketches."""
    finest = je.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s"), F.hll_sketch_agg("vendor", lg_k).alias("h"))
    return finest.cube(*dims).agg(_level(dims), F.sum("n").alias("n_entries"), F.round(F.sum("s"), 2).alias("spend"),
                                  F.hll_sketch_estimate(F.hll_union_agg("h")).alias("n_vendors"))
