"""Posting volume against own history.

Postings are counted per key and day, the days without any filled in as 0, and each day is
compared with the median of the key's days before it, in units of their median absolute
deviation (at least one posting, so a key of the same count every day doesn't alarm at
the first difference).  Days, not rows, reach the window: a key has at most as many as
the calendar, however many rows it holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerscreen.params import DEFAULT_PARAMS, Params

#: Median absolute deviation to standard deviation of a normal distribution.
TO_SIGMA = 1.4826


def daily_counts(je: DataFrame, key: str) -> DataFrame:
    """(key, date, n_entries) for every day from the key's first to its last posting."""
    rows = je.where(F.col(key).isNotNull() & F.col("date").isNotNull())
    counts = rows.groupBy(key, "date").agg(F.count(F.lit(1)).alias("n"))
    days = counts.groupBy(F.col(key).alias("_key")).agg(F.min("date").alias("lo"), F.max("date").alias("hi")).select(
        "_key", F.explode(F.sequence("lo", "hi")).alias("_day"))
    return days.join(counts, (F.col("_key") == F.col(key)) & (F.col("_day") == F.col("date")), "left").select(
        F.col("_key").alias(key), F.col("_day").alias("date"), F.coalesce("n", F.lit(0)).cast("long").alias("n_entries"))


def middle(values: Column) -> Column:
    """Median of an array of numbers; null if it is empty."""
    by, n = F.array_sort(values), F.size(values)
    at = lambda k: F.get(by, k.cast("int")).cast("double")
    return F.when(n > 0, (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2.0)


def volume_screen(je: DataFrame, key: str = "vendor", p: Params = DEFAULT_PARAMS) -> DataFrame:
    """key, date, n_entries, days_before, usual (median of up to ``volume_days`` days before),
    spread (their median absolute deviation), score, flag.

    The flag is ``NEW`` while there are fewer than ``volume_least_days`` days before (score null),
    ``UNUSUAL`` above ``volume_limit`` deviations, else ``OK``."""
    before = Window.partitionBy(key).orderBy("date").rowsBetween(-p.volume_days, -1)
    d = daily_counts(je, key).withColumn("_h", F.collect_list("n_entries").over(before))
    d = d.withColumn("days_before", F.size("_h").cast("long")).withColumn("usual", middle(F.col("_h")))
    d = d.withColumn("spread", middle(F.transform("_h", lambda x: F.abs(x - F.col("usual")))))
    score = (F.col("n_entries") - F.col("usual")) / F.greatest(F.lit(TO_SIGMA) * F.col("spread"), F.lit(1.0))
    d = d.withColumn("score", F.when(F.col("days_before") >= p.volume_least_days, score))
    flag = F.when(F.col("score").isNull(), "NEW").when(F.col("score") > p.volume_limit, "UNUSUAL").otherwise("OK")
    return d.select(key, "date", "n_entries", "days_before", "usual", "spread", "score", flag.alias("flag"))
