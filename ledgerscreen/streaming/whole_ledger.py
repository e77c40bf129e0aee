"""Whole-ledger rules over a stream: duplicates and vendor concentration.

Rows come with a date; ``delay`` says how late a row may be behind the newest date
seen.  A row that is later still is dropped, and nothing is remembered of dates
that the watermark has passed, so state is bounded by the rows of ``delay``.

* ``duplicate_members`` keeps, per (vendor, amount, date), whether a row was seen
  and the id of a first one that is still alone.  A second row releases both at
  once, further ones follow as they come.  The state of a key is one id and one
  number, also where a third of all rows are copies of one entry.
* ``concentration`` sums spend per vendor and period and gives, once the watermark
  has passed a period, the vendors above the share limit.  Vendors of a period
  meet its total under ``SALTS`` keys, so no task has a whole period.

For rows within the delay both give what the batch rules give on the same rows, in
whatever order these come.  Rows without id, date or amount are dropped, exact
copies of a row (all columns) count once, a null vendor is a vendor of its own for
duplicates and is never concentrated.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerscreen.operators import clean as cl
from ledgerscreen.operators.rules import DUP_KEYS
from ledgerscreen.params import DEFAULT_PARAMS, Params
from ledgerscreen.schema import RAW_COLUMNS

DELAY = "30 days"
PERIOD = "30 days"
SALTS = 16
MEMBERS = "vendor string, amount double, date date, transaction_id string"


def on_time(raw: DataFrame, delay: str = DELAY) -> DataFrame:
    """Typed rows with their event time ``posted``, exact copies dropped."""
    rows = cl.typed(raw).na.drop(subset=list(cl.REQUIRED)).select(*RAW_COLUMNS)
    rows = rows.withColumn("posted", F.col("date").cast("timestamp")).withWatermark("posted", delay)
    return rows.dropDuplicates([*RAW_COLUMNS, "posted"])         # the event time lets the state expire


def _members(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    vendor, amount, date = key
    seen, alone = state.get if state.exists else (0, None)
    until = 0
    for rows in frames:
        ids = rows["transaction_id"].tolist()
        if not ids:
            continue
        until = int(rows["posted"].iloc[0].timestamp() * 1000)
        if seen + len(ids) == 1:
            alone = ids[0]
        else:
            out = ids if seen != 1 else [alone, *ids]
            alone = None
            yield pd.DataFrame({"vendor": [vendor] * len(out), "amount": amount, "date": [date] * len(out),
                                "transaction_id": out})
        seen = min(seen + len(ids), 2)
    state.update((seen, alone))
    state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs(), 0) + 1)


def duplicate_members(raw: DataFrame, delay: str = DELAY) -> DataFrame:
    """(vendor, amount, date, transaction_id) of the rows that share the first three with another."""
    rows = on_time(raw, delay).select(*DUP_KEYS, "transaction_id", "posted")
    return rows.groupBy(*DUP_KEYS).applyInPandasWithState(
        _members, MEMBERS, "seen long, alone string", "append", GroupStateTimeout.EventTimeTimeout)


def concentration(raw: DataFrame, delay: str = DELAY, period: str = PERIOD, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """(period_start, vendor, vendor_spend, total_spend) of the vendors above the share limit."""
    spend = on_time(raw, delay).groupBy(F.window("posted", period).alias("w"), "vendor").agg(F.sum("amount").alias("spend"))
    salt = F.pmod(F.xxhash64("vendor"), F.lit(SALTS))
    vendors = spend.where(F.col("vendor").isNotNull()).withColumn("salt", salt)
    total = (spend.groupBy(F.col("w").alias("tw")).agg(F.sum("spend").alias("total"))
             .withColumn("tsalt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))))
    share = F.try_divide(F.col("spend"), F.col("total")) * 100.0
    return (vendors.join(total, (F.col("w") == F.col("tw")) & (F.col("salt") == F.col("tsalt")))
            .where(share > p.concentration_pct)
            .select(F.col("w.start").cast("date").alias("period_start"), "vendor", F.col("spend").alias("vendor_spend"),
                    F.col("total").alias("total_spend")))


def run_available(out: DataFrame, folder: str) -> DataFrame:
    """Run the stream over all that has arrived, appending to the table in ``folder``; a
    further call with the same folder goes on behind what was read.  Gives the table."""
    spark: SparkSession = out.sparkSession
    q = (out.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/rows")
         .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/rows")
