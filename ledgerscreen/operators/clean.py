"""Cleaning and profiling (typed casts, derived calendar columns, drops, profile)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscreen.functions.quantiles import group_quantiles
from ledgerscreen.params import DEFAULT_PARAMS, Params
from ledgerscreen.schema import CLEAN_COLUMNS, RAW_COLUMNS
from ledgerscreen.session import BROADCAST_ROWS, stored

REQUIRED = ("transaction_id", "date", "amount")

# FIXED VALUES -- English day names, Monday first (weekday() numbering).
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# FIXED VALUES -- texts that count as typed values, as the usual dataframe parsers
# take them: year-month-day with one- or two-digit month and day; H:M:S with one-
# or two-digit parts and seconds to 61 (they roll over); plain decimal numbers.
DATE_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
TIME_PATTERN = r"^([01]?[0-9]|2[0-3]):([0-5]?[0-9]):([0-5]?[0-9]|6[01])$"
NUMBER_PATTERN = r"^[ \t\r\n]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \t\r\n]*$"
INFINITE_PATTERN = r"^[ \t\r\n]*[+-]?(?i:inf|infinity)[ \t\r\n]*$"
# Dates outside the range of nanosecond timestamps are no dates.
DATE_RANGE = ("1677-09-22", "2262-04-11")


def _typed_date(df: DataFrame, name: str):
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, T.DateType):
        return c
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    text = c.cast("string")
    parsed = F.when(text.rlike(DATE_PATTERN), text.try_cast("date"))
    return F.when(parsed.between(*(F.lit(d).cast("date") for d in DATE_RANGE)), parsed)


def _typed_amount(df: DataFrame, name: str):
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, T.DoubleType):
        return c
    if isinstance(dt, T.NumericType):
        return c.cast("double")
    text = c.cast("string")
    number = F.when(text.rlike(NUMBER_PATTERN), F.btrim(text, F.lit(" \t\r\n")).try_cast("double"))
    infinite = F.when(text.contains("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (F.when(text.rlike(INFINITE_PATTERN), infinite)
            .when(F.abs(number) < F.lit(float("inf")), number))        # too large for a double is no number


def typed(raw: DataFrame) -> DataFrame:
    """Coerce date/amount (bad -> null) and add the derived columns."""
    return _with_calendar(_typed_raw(raw))


def _typed_raw(raw: DataFrame) -> DataFrame:
    cols = []
    for c in RAW_COLUMNS:
        if c == "date":
            cols.append(_typed_date(raw, c).alias("date"))
        elif c == "amount":
            cols.append(_typed_amount(raw, c).alias("amount"))
        else:
            cols.append(F.col(c).cast("string").alias(c))
    return raw.select(*cols)


def _with_calendar(df: DataFrame) -> DataFrame:
    # the time of day (bad -> null) and the day name, both without a per-row date
    # formatter: a pattern test + parts, an array lookup
    part = lambda k: F.split_part("time", F.lit(":"), F.lit(k)).try_cast("int")
    hour = F.when(F.col("time").rlike(TIME_PATTERN),
                  F.floor((part(1) * 3600 + part(2) * 60 + part(3)) / 3600) % 24)
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    return df.select(
        *RAW_COLUMNS,
        F.element_at(names, F.weekday("date") + 1).alias("day_of_week"),
        (F.weekday("date") >= 5).alias("is_weekend"),
        hour.cast("int").alias("hour"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
    )


def clean(raw: DataFrame) -> DataFrame:
    """B7 + B8: drop rows missing id, date or amount, then exact-row duplicates.

    ``distinct`` is a hash aggregate over all columns: exact copies are
    collapsed map-side (partial aggregation) before the shuffle, so even a
    group of copies holding a third of the table never lands whole on one task.
    """
    return _cleaned(_required(raw).distinct())


def clean_stored(raw: DataFrame) -> DataFrame:
    """``clean`` of a stored table, which may be read several times.

    A row's 64-bit hash, not the row, goes through the shuffle that finds the hashes
    that occur more than once; only the rows of such a hash are compared whole.  Where
    many hashes repeat, all rows are."""
    rows = _required(raw)
    # 0.0 and -0.0 are equal: both hash as 0.0
    hashed = rows.withColumn("_h", F.xxhash64(*[F.col(c) + F.lit(0.0) if c == "amount" else F.col(c) for c in RAW_COLUMNS]))
    twice = stored(hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h"), "row-hashes")
    n = twice.count()
    if not n:
        return _cleaned(rows)
    if n > BROADCAST_ROWS:
        return _cleaned(rows.distinct())
    alone = hashed.join(F.broadcast(twice), "_h", "left_anti").select(*RAW_COLUMNS)
    again = hashed.join(F.broadcast(twice), "_h", "left_semi").select(*RAW_COLUMNS)
    return _cleaned(alone.unionByName(again.distinct()))


def _required(raw: DataFrame) -> DataFrame:
    return _typed_raw(raw).na.drop(subset=list(REQUIRED))


def _cleaned(rows: DataFrame) -> DataFrame:
    # the derived columns are functions of the raw ones: deduplicating on the
    # ten raw columns is the same as on all fifteen, with a narrower key
    return _with_calendar(rows).select(*CLEAN_COLUMNS)


def clean_counts(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows before and after cleaning and how many were dropped."""
    before = raw.agg(F.count(F.lit(1)).alias("rows_before"))
    after = cleaned.agg(F.count(F.lit(1)).alias("rows_after"))
    return (before.crossJoin(after)   # two 1-row aggregates
            .select("rows_before", "rows_after",
                    (F.col("rows_before") - F.col("rows_after")).alias("rows_dropped")))


def profile_summary(df: DataFrame) -> DataFrame:
    """B10 + B11: shape, date range, distinct vendors and departments."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count_distinct("vendor").alias("n_vendors"),
        F.count_distinct("department").alias("n_departments"),
    )


def profile_amount(df: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """``amount.describe()`` -- count, mean, sample std, min, quartiles, max."""
    one = df.select(F.lit(1).alias("_g"), "amount")
    q = group_quantiles(one, ["_g"], "amount", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, p)
    m = one.groupBy("_g").agg(
        F.count("amount").alias("count"), F.avg("amount").alias("mean"),
        F.stddev_samp("amount").alias("std"), F.min("amount").alias("min"), F.max("amount").alias("max"))
    return m.join(q.drop("n"), "_g").select(
        "count", F.round("mean", 2).alias("mean"), F.round("std", 2).alias("std"), "min",
        F.round("p25", 4).alias("p25"), F.round("p50", 4).alias("p50"), F.round("p75", 4).alias("p75"), "max")


def profile_nulls(df: DataFrame) -> DataFrame:
    """Null count per column as a long table (column_name, null_count)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column_name", "null_count")


def id_repeats(df: DataFrame) -> DataFrame:
    """Transaction ids that occur more than once after cleaning (rows that differ
    in some other column).  The id is a declared key; this reports violations."""
    return (df.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))
