"""Running sums over a whole table, or over each key of it, along a range sort."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscreen.llm.common import partitions, written


def running(df: DataFrame, key: str, order: list[Column], value: str, out: str) -> DataFrame:
    """``df`` and two columns: ``out`` (long), the sum of ``value`` over the earlier
    rows of the same ``key`` (a null key is one like any other), and ``row_id``
    (long), unique and ascending in (key, order).

    ``order`` has columns of ``df``, as ``F.col(...).asc_nulls_last()`` or the like;
    rows that agree in all of it may come in either order.  The rows are range-sorted by
    (key, order), so a key of any size lies over many tasks; each task sums its own
    range, and the sums of a key's ranges (one row per range) are added up after.
    ``df`` should start from a scan: finding the ranges reads it twice."""
    n = max(partitions(df.sparkSession), df.rdd.getNumPartitions())
    names = df.columns
    ranged = (df.repartitionByRange(n, F.col(key).asc_nulls_last(), *order)
              .sortWithinPartitions(F.col(key).asc_nulls_last(), *order)
              .select("*", F.spark_partition_id().cast("long").alias("_range")))

    def run(batches):
        rows, last, carried = 0, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            keys = pa.concat_arrays([b.column(key)]).dictionary_encode(null_encoding="encode")
            codes, found = keys.indices.to_numpy(zero_copy_only=False), keys.dictionary.to_pylist()
            values = b.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.concatenate([[0], np.cumsum(values)[:-1]])
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            base = np.repeat(before[starts], np.diff(np.append(starts, len(codes))))
            same = rows > 0 and found[codes[0]] == last
            end = starts[1] if len(starts) > 1 else len(codes)
            before = before - base
            if same:
                before[:end] += carried
            last, carried = found[codes[-1]], int(before[-1] + values[-1])
            ids = (b.column("_range").to_numpy().astype(np.int64) << 40) + np.arange(rows, rows + b.num_rows)
            rows += b.num_rows
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in b.schema.names), pa.array(before), pa.array(ids)],
                                             names=[*b.schema.names, "_before", "row_id"])

    schema = T.StructType([*ranged.schema.fields, T.StructField("_before", T.LongType()), T.StructField("row_id", T.LongType())])
    rows = written(ranged.mapInArrow(run, schema), "running")
    sums = rows.groupBy(F.col(key).alias("_key"), F.col("_range").alias("_r")).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy("_key").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("_key", "_r", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    return (rows.join(base, rows[key].eqNullSafe(base["_key"]) & (rows["_range"] == base["_r"]))
            .select(*names, (F.col("_before") + F.col("_base")).alias(out), "row_id"))
