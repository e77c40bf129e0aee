"""Reconciliation of two loads of a table as a counted multiset difference.

Each load is reduced to one counted row per distinct row before anything is joined, so a row
that makes up a third of a load travels once per task.  Nulls equal nulls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows (columns of ``a``, which ``b`` must have) whose number of copies differs, with
    n_a and n_b: ``a EXCEPT ALL b`` has n_a - n_b copies of a row where that is positive, ``b EXCEPT ALL a``
    n_b - n_a, and ``a INTERSECT ALL b`` the lesser of both."""
    columns = a.columns
    missing = [c for c in columns if c not in b.columns]
    if missing:
        raise ValueError(f"the second load lacks the columns {missing}")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = a.select(*columns, one.alias("_a"), none.alias("_b")).union(b.select(*columns, none.alias("_a"), one.alias("_b")))
    return (both.groupBy(*columns).agg(F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b")).where(F.col("n_a") != F.col("n_b")))


def summary(diff: DataFrame) -> DataFrame:
    """One row: distinct rows and copies that only one load has more of."""
    more = lambda x, y: F.greatest(F.col(x) - F.col(y), F.lit(0))
    zero = F.lit(0).cast("long")
    return diff.agg(F.count_if(F.col("n_a") > F.col("n_b")).alias("rows_more_in_a"), F.count_if(F.col("n_b") > F.col("n_a")).alias("rows_more_in_b"),
                    F.coalesce(F.sum(more("n_a", "n_b")), zero).alias("copies_only_in_a"),
                    F.coalesce(F.sum(more("n_b", "n_a")), zero).alias("copies_only_in_b"))
