"""As-of join: each row with the last row of its key before it.

Both sides are range-sorted by (key, time) together, so a key of any size lies over many
tasks.  A task carries the last right row along; what the first rows of a range
still lack is the last right row of an earlier range, found in a second pass over one row per
range.

Ties: of several right rows of a key at the same time the one with the greatest ``take`` columns
(in their order) counts.  A null key or time matches nothing."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscreen.session import scratch_path


def asof_join(left: DataFrame, right: DataFrame, by: str, on: str, take: list[str], strict: bool = True,
              prefix: str = "prev_", ranges: int | None = None) -> DataFrame:
    """``left`` with the ``take`` columns (named with ``prefix``) of the last ``right`` row of the same ``by``
    whose ``on`` is smaller (or equal, if not ``strict``); null where there is none."""
    spark = left.sparkSession
    n = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), left.rdd.getNumPartitions())
    late, early = (1, 0) if strict else (0, 1)
    # right rows of the same key and time are sorted by their ``take`` columns, so the last one counts
    rights = right.where(F.col(by).isNotNull() & F.col(on).isNotNull()).select(
        F.col(by).alias("_by"), F.col(on).alias("_on"), F.struct(*take).alias("_r"))
    l_type = T.StructType(left.schema.fields)
    r_type = rights.schema["_r"].dataType
    rows = left.select(F.col(by).alias("_by"), F.col(on).alias("_on"), F.lit(early).alias("_side"), F.xxhash64(*left.columns).alias("_spread"),
                       F.struct(*left.columns).alias("_l"), F.lit(None).cast(r_type).alias("_r"))
    rows = rows.unionByName(rights.select("_by", "_on", F.lit(late).alias("_side"), F.lit(0).cast("long").alias("_spread"),
                                          F.lit(None).cast(l_type).alias("_l"), "_r"))
    order = ["_by", "_on", "_side", "_r", "_spread"]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "_by", "_l", "_r", F.spark_partition_id().alias("_range"))

    def run(batches):
        first = last = carried = None               # the first and the last key; the last key's last right row
        started, kinds = False, None
        for b in batches:
            if not b.num_rows:
                continue
            keys = pa.concat_arrays([b.column("_by")]).dictionary_encode(null_encoding="encode")
            codes, found = keys.indices.to_numpy(zero_copy_only=False), keys.dictionary.to_pylist()
            lefts, right_rows = pa.concat_arrays([b.column("_l")]), pa.concat_arrays([b.column("_r")])
            if not started:
                first, started, kinds = found[codes[0]], True, b.schema
                carried = pa.nulls(1, right_rows.type)
            elif found[codes[0]] != last:
                carried = pa.nulls(1, right_rows.type)
            # place 0 is the carried row; a row's place is that of the last right row of its run, or the run's start
            is_right = right_rows.is_valid().to_numpy(zero_copy_only=False)
            at = np.arange(1, len(codes) + 1)
            starts = np.concatenate([[True], codes[1:] != codes[:-1]])
            run_start = np.maximum.accumulate(np.where(starts, at, 0))
            seen = np.maximum.accumulate(np.where(is_right, at, 0))
            none = seen < run_start
            here = run_start == 1                     # the run that the carried row belongs to
            place = np.where(none, np.where(here, 0, -1), seen)
            pool = pa.concat_arrays([carried, right_rows])
            picked = pool.take(pa.array(np.maximum(place, 0), mask=place < 0))
            wanted = lefts.is_valid()
            lacks = picked.is_null().to_numpy(zero_copy_only=False) & np.array([found[c] == first and first is not None for c in range(len(found))])[codes]
            out = pa.RecordBatch.from_arrays([b.column("_by"), lefts, picked, b.column("_range"), pa.array(lacks), pa.array(np.zeros(len(codes), bool))],
                                             names=["_by", "_l", "_r", "_range", "_open", "_end"])
            last, carried = found[codes[-1]], picked.slice(len(codes) - 1, 1)
            end = b.column("_range")[0]
            yield out.filter(wanted)
        if started:
            yield pa.RecordBatch.from_arrays(
                [pa.array([last], kinds.field("_by").type), pa.nulls(1, kinds.field("_l").type), carried, pa.array([end.as_py()], pa.int32()),
                 pa.array([False]), pa.array([True])], names=["_by", "_l", "_r", "_range", "_open", "_end"])

    schema = T.StructType([dealt.schema["_by"], T.StructField("_l", l_type), T.StructField("_r", r_type), T.StructField("_range", T.IntegerType()),
                           T.StructField("_open", T.BooleanType()), T.StructField("_end", T.BooleanType())])
    path = scratch_path(spark, f"asof-{uuid.uuid4().hex}")
    dealt.mapInArrow(run, schema).write.parquet(path)
    joined = spark.read.schema(schema).parquet(path)
    # one row per range: its last key's last right row, and which key's rows still lack one
    ends = joined.where("_end").select("_by", "_range", F.lit(1).alias("_o"), "_r")
    heads = joined.where("_open").select("_by", "_range").distinct().select("_by", "_range", F.lit(0).alias("_o"), F.lit(None).cast(r_type).alias("_r"))
    earlier = Window.partitionBy("_by").orderBy("_range", "_o")
    fill = (ends.unionByName(heads).withColumn("_fill", F.last("_r", ignorenulls=True).over(earlier)).where("_o = 0")
            .select(F.col("_range").alias("_h"), "_fill"))
    done = joined.where(~F.col("_end")).join(F.broadcast(fill), F.col("_open") & (F.col("_range") == F.col("_h")), "left")
    return done.select("_l.*", *[F.coalesce(F.col(f"_r.{c}"), F.when(F.col("_open"), F.col(f"_fill.{c}"))).alias(f"{prefix}{c}") for c in take])


def previous_entries(je: DataFrame) -> DataFrame:
    """Each entry with the last earlier one of its vendor: transaction_id, vendor, previous_id,
    days_since, amount_change.  Time is date and time of day (a missing time: midnight)."""
    clock = F.coalesce(F.unix_seconds(F.try_to_timestamp(F.concat_ws(" ", F.lit("1970-01-01"), "time"), F.lit("yyyy-MM-dd HH:mm:ss"))), F.lit(0))
    timed = je.select("transaction_id", "vendor", "amount", "date", (F.unix_date("date").cast("long") * 86400 + clock).alias("at"))
    out = asof_join(timed, timed, "vendor", "at", ["transaction_id", "amount", "date"])
    return out.select("transaction_id", "vendor", F.col("prev_transaction_id").alias("previous_id"),
                      F.datediff("date", "prev_date").alias("days_since"), (F.col("amount") - F.col("prev_amount")).alias("amount_change"))
