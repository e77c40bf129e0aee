"""Quantile state of a growing table: stored per load, merged by adding, exact in the end.

A load is reduced to counted value buckets per group: the bucket of a value is its sign and
its binary logarithm in steps of 1/64, so buckets follow the order of values, and
each keeps its rows, its smallest and its largest value.  States of several loads are merged by
summing the counts: nothing is estimated, in whatever order loads arrive.

The merged counts say which bucket holds a rank and how many rows lie below it.  Only rows
between such a bucket's ends are read again, in one pass over the data; a bucket whose ends are
equal is not read at all.  The values are those of ``quantiles.group_quantiles``.

Size: at most one state row per group, load and bucket (values of one to a million
take 1,280 buckets), whatever the number of rows; a group holding a third of a load
is summed up before it is shuffled.

Defined cases: null values and rows with a null key are left out; NaN is above infinity; -0.0 is
0.0; a load stored again under its name replaces the first; an empty load adds nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ledgerscreen.functions.quantiles import interpolated, narrowed, rank_targets

STEPS = 64                   # buckets for each doubling of the value
_EXPONENT = 1100             # above any binary exponent of a double
_COUNTS = [StructField("bucket", LongType()), StructField("n", LongType()), StructField("least", DoubleType()),
           StructField("most", DoubleType())]


def bucket(x: Column) -> Column:
    """A whole number that never falls as ``x`` rises; 0 for zero."""
    top = 2 * _EXPONENT * STEPS
    power = F.least(F.log2(F.abs(x)), F.lit(float(_EXPONENT)))          # infinity is the last
    size = F.floor(power * F.lit(float(STEPS))).cast("long") + F.lit(_EXPONENT * STEPS)
    return (F.when(F.isnan(x), F.lit(top + 1).cast("long")).when(x == 0.0, F.lit(0).cast("long"))
            .when(x > 0.0, size).otherwise(-size))


def _values(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    data = df.select(*keys, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    for k in keys:
        data = data.where(F.col(k).isNotNull())
    return data


def state_of(load: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, bucket, n, least, most of one load."""
    return (_values(load, keys, value).groupBy(*keys, bucket(F.col("_x")).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("least"), F.max("_x").alias("most")))


def merged(states: DataFrame, keys: list[str]) -> DataFrame:
    """One state from the rows of any number of states."""
    return states.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))


def store(state: DataFrame, path: str, load: str) -> None:
    """Keep a load's state below ``path``; storing the same load again replaces it."""
    state.write.mode("overwrite").parquet(f"{path.rstrip('/')}/load={load}")


def stored(spark: SparkSession, path: str, keys: StructType) -> DataFrame:
    """The merged state of all loads stored below ``path``; ``keys``: the key columns' types."""
    rows = spark.read.schema(StructType([*keys.fields, *_COUNTS])).option("recursiveFileLookup", True).parquet(path)
    return merged(rows, keys.names)


def quantiles(state: DataFrame, data: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """keys, ``n`` and one exact, interpolated quantile per entry of ``probs``, from the merged
    state of the loads that ``data`` is made of."""
    if {f.name for f in state.schema} != {*keys, "bucket", "n", "least", "most"}:
        raise ValueError(f"not a state by {keys}: {state.columns}")
    by = Window.partitionBy(*keys)
    ranked = state.select(*keys, F.col("n").alias("_c"), F.col("least").alias("_lo"), F.col("most").alias("_hi"),
                          (F.sum("n").over(by.orderBy("bucket")) - F.col("n")).alias("_below"))
    sizes = state.groupBy(*keys).agg(F.sum("n").alias("n"))
    targets = rank_targets(sizes, keys, probs)
    held = (F.col("_below") <= F.col("_k")) & (F.col("_k") < F.col("_below") + F.col("_c"))
    same = F.col("_lo") == F.col("_hi")
    brackets = (targets.select(*keys, "_name", "_k").join(ranked, keys).where(held)
                .select(*keys, "_name", "_k", "_lo", "_hi", "_below", "_c", F.when(same, F.col("_lo")).alias("_v"), same.alias("_closed")))
    return interpolated(narrowed(_values(data, keys, value), brackets, keys), targets, keys, probs)
