"""Structured Streaming form of the row-level screen.

New raw ledger files arriving in a folder are typed and screened as they land:

* the three rules that need only the row itself (round number, off-hours /
  weekend, month-end late posting) run unchanged on every micro-batch;
* the anomaly model is applied with a **stored** reference: the batch
  pipeline's vendor and account statistics (stream-static joins), its
  forest, and its score range and contamination
  threshold.  A streamed row therefore gets exactly the score it would get
  in the batch run that built the reference.

Duplicates and concentration have stateful forms in ``whole_ledger``; IQR outliers
need the full table and stay in the batch pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscreen.functions.exprs import blend_score, risk_bucket
from ledgerscreen.operators import clean as cl
from ledgerscreen.operators import iforest
from ledgerscreen.operators.rules import row_local_reasons
from ledgerscreen.params import DEFAULT_PARAMS, SEVERITY, Params
from ledgerscreen.schema import CLEAN_COLUMNS, CSV_TEXT, RAW_LEDGER

STREAM_RULES = ("round_number", "off_hours_weekend", "month_end_late_hour_posting")


def read_raw_stream(spark: SparkSession, folder: str, fmt: str = "csv", schema=RAW_LEDGER,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """File-stream source for raw ledger files (CSV with header, or Parquet)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        return r.options(header=True, enforceSchema=False, **CSV_TEXT).csv(folder)
    return r.format(fmt).load(folder)


def screen_rules(stream: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Typed rows + the row-local rules, their summary strings and severity."""
    je = cl.typed(stream).na.drop(subset=list(cl.REQUIRED)).select(*CLEAN_COLUMNS)
    local = row_local_reasons(p)
    reasons = [local[n].alias(f"r_{n}") for n in STREAM_RULES]
    out = je.select("*", *reasons)
    cols = [F.col(f"r_{n}") for n in STREAM_RULES]
    return out.select(
        "*",
        sum((c.isNotNull().cast("int") for c in cols), F.lit(0)).cast("int").alias("n_tests_triggered"),
        F.concat_ws(", ", *[F.when(F.col(f"r_{n}").isNotNull(), F.lit(n)) for n in STREAM_RULES])
         .alias("tests_triggered"),
        F.concat_ws(" | ", *cols).alias("reasons"),
        F.greatest(*[F.when(F.col(f"r_{n}").isNotNull(), F.lit(SEVERITY[n])) for n in STREAM_RULES],
                   F.lit(0.0)).alias("rule_severity"),
    )


def reference_tables(reference):
    """The small stored lookups a stream is scored against, written once as
    tables (one row per vendor / per account / one row), so micro-batches
    join tables instead of re-deriving them from the full ledger."""
    ruled = reference.ruled
    vendor = reference._table(ruled.where(F.col("vendor").isNotNull())
                              .groupBy("vendor").agg(F.first("vendor_n").alias("vendor_n"),
                                                     F.first("vendor_sum").alias("vendor_sum")), "ref_vendor")
    account = reference._table(ruled.where(F.col("account").isNotNull())
                               .groupBy("account").agg(F.first("acct_median").alias("acct_median")), "ref_account")
    total = reference._table(ruled.select("total_amount").limit(1), "ref_total")
    return vendor, account, total


def score_stream(screened: DataFrame, reference, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Score streamed rows with a batch pipeline's stored model and statistics.

    ``reference`` is a built ``Pipeline``; only its small stored tables are
    used (vendor and account statistics, model, score stats)."""
    vendor, account, total = reference_tables(reference)
    e = (screened.join(vendor, "vendor", "left").join(account, "account", "left")
         .crossJoin(F.broadcast(total)))        # one row
    keep = [*CLEAN_COLUMNS, "n_tests_triggered", "tests_triggered", "reasons", "rule_severity"]
    scored = iforest.score(e, reference.model, reference.n_rows, p, keep=keep)
    ml = iforest.ml_columns(scored, reference.n_rows, p, reference.ml_stats)
    risk = blend_score(F.col("rule_severity"), F.col("ml_anomaly_score"), p)
    return ml.withColumn("risk_score", risk).withColumn("risk_level", risk_bucket(F.col("risk_score"), p))
