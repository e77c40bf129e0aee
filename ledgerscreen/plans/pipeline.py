"""The end-to-end screen as one object of lazily built, shared stages.

    raw -> clean (persisted) -> enrich: vendor / account / duplicate-group
    aggregates joined back -> six reason columns + flag summary + severity
    -> isolation forest (fit on a bounded sample, model checkpointed) ->
    scoring pass over every row (feature columns in Arrow batches; persisted)
    -> ML columns, risk score and level as projections -> reports.

Stages are built on first use and shared by every query on the same
pipeline, so a run of all report queries computes each stage once.  Each
heavy stage is written as a Parquet table under the shared checkpoint folder
(``spark.checkpoint.dir``) and read back: that cuts the lineage (later plans
start at a scan, with column pruning), and a lost executor costs a re-read,
not a recomputation of the joins and the forest.
"""

from __future__ import annotations

import hashlib
import os
import time
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscreen.operators import benford, clean as cl, features as ft, iforest, reports, risk as rk
from ledgerscreen.operators import rules, validate
from ledgerscreen.params import DEFAULT_PARAMS, Params
from ledgerscreen.schema import CLEAN_COLUMNS
from ledgerscreen.session import join_side, prepare, scratch_path

PASS_THROUGH = (*CLEAN_COLUMNS, "vendor_n", "n_tests_triggered", "tests_triggered", "reasons",
                "rule_severity")


class Pipeline:
    def __init__(self, spark: SparkSession, raw: DataFrame, labels: DataFrame | None = None,
                 p: Params = DEFAULT_PARAMS, view_name: str | None = None, name: str = "ledger",
                 materialize: bool = True, plant: bool = False):
        """``raw``: raw ledger columns; ``plant``: add planted anomaly copies
        (labels then come from them); ``labels``: an explicit label table."""
        self.plant = plant
        self.spark = spark
        self.p = p
        self.view_name = view_name
        self.materialize = materialize
        self._persisted: list[DataFrame] = []
        prepare(spark)
        run = hashlib.md5(f"{spark.sparkContext.applicationId}:{name}:{id(self)}".encode()).hexdigest()[:12]
        self.base_dir = scratch_path(spark, f"pipeline-{name}-{run}")
        self._raw_in = raw
        self._labels_in = labels
        self.timings: dict[str, float] = {}

    def _table(self, df: DataFrame, stage: str) -> DataFrame:
        """Write a stage as Parquet in the shared folder and read it back."""
        if not self.materialize:
            return self._keep(df)
        path = os.path.join(self.base_dir, stage)
        t0 = time.time()
        df.write.mode("overwrite").parquet(path)
        self.timings[stage] = round(time.time() - t0, 3)
        return self.spark.read.parquet(path)

    @cached_property
    def raw_tagged(self) -> DataFrame:
        """Raw ledger + ``anomaly_type``.  With planting, the base rows are
        written first and the copies are derived from that table and appended,
        so the source joins run once."""
        from ledgerscreen.operators import planting
        from ledgerscreen.schema import RAW_COLUMNS
        src = self._raw_in.select(*RAW_COLUMNS, F.lit("none").alias("anomaly_type"))
        if not self.plant:
            return src          # read once by clean(); nothing else needs a copy
        if not self.materialize:
            return self._keep(planting.plant_all(self._raw_in, self.p))
        base = self._table(src, "raw")
        copies = planting.plant_copies(base.select(*RAW_COLUMNS), self.p)
        path = os.path.join(self.base_dir, "raw")
        t0 = time.time()
        copies.write.mode("append").parquet(path)
        self.timings["raw_planted"] = round(time.time() - t0, 3)
        return self.spark.read.parquet(path)

    @cached_property
    def raw(self) -> DataFrame:
        from ledgerscreen.schema import RAW_COLUMNS
        return self.raw_tagged.select(*RAW_COLUMNS)

    @cached_property
    def labels(self) -> DataFrame | None:
        if self._labels_in is not None:
            return self._labels_in
        if "anomaly_type" in self.raw_tagged.columns:
            return join_side(self.raw_tagged.where(F.col("anomaly_type") != "none")
                             .select("transaction_id", F.lit(1).alias("is_anomaly"), "anomaly_type"), "labels")
        return None

    def _keep(self, df: DataFrame) -> DataFrame:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._persisted.append(df)
        return df

    def release(self) -> None:
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()

    def drop_tables(self) -> None:
        """Delete this pipeline's stage tables from the shared folder (through
        the Hadoop FileSystem of that folder, so it works on any cluster store)."""
        self.release()
        sc = self.spark.sparkContext
        jvm = sc._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.base_dir)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        if fs.exists(path):
            fs.delete(path, True)

    # ------------------------------------------------------------ clean
    @cached_property
    def clean(self) -> DataFrame:
        # with planting the raw ledger is a stored table
        stored = self.plant and self.materialize
        je = self._table(cl.clean_stored(self.raw) if stored else cl.clean(self.raw), "journal_entries")
        if self.view_name:
            je.createOrReplaceTempView(self.view_name)
        return je

    @cached_property
    def n_rows(self) -> int:
        return self.clean.count()

    # ------------------------------------------------------------ rules
    @cached_property
    def enriched(self) -> DataFrame:
        return rules.enrich(self.clean, self.p)

    @cached_property
    def ruled(self) -> DataFrame:
        r = rules.with_flag_summary(rules.rule_columns(self.enriched, self.p))
        return self._table(r.withColumn("rule_severity", rk.rule_severity()), "rules")

    @cached_property
    def flags(self) -> DataFrame:
        return rules.rule_flags(self.ruled)

    # ------------------------------------------------------------ features / model
    @cached_property
    def model(self) -> DataFrame:
        return self._table(iforest.fit(ft.model_frame(self.ruled, self.p), self.n_rows, self.p), "forest_model")

    @cached_property
    def scored(self) -> DataFrame:
        return iforest.score(self.ruled, self.model, self.n_rows, self.p, keep=list(PASS_THROUGH))

    @cached_property
    def scored_table(self) -> DataFrame:
        return self._table(self.scored, "scored")

    @cached_property
    def ml_stats(self) -> dict:
        """Stored reference statistics (score range, contamination threshold)."""
        return iforest.ml_stats(self.scored_table, self.n_rows, self.p)

    @cached_property
    def ml(self) -> DataFrame:
        return iforest.ml_columns(self.scored_table, self.n_rows, self.p, self.ml_stats)

    # ------------------------------------------------------------ risk
    @cached_property
    def risk(self) -> DataFrame:
        """Row-aligned: ledger columns + rule summary + ML + risk (the export): a
        projection of the scored table, not a second copy of it."""
        return rk.with_risk(self.ml, self.p).withColumnRenamed("vendor_n", "vendor_frequency")

    @cached_property
    def export(self) -> DataFrame:
        """Risk columns then the ledger columns (22 columns)."""
        return self.risk.select(*rk.RISK_COLUMNS, *[c for c in CLEAN_COLUMNS if c != "transaction_id"])

    # ------------------------------------------------------------ validation
    @cached_property
    def validated(self) -> DataFrame | None:
        return validate.labelled(self.risk, self.labels)

    @cached_property
    def recall_by_type(self) -> DataFrame | None:
        v = self.validated
        return None if v is None else validate.recall_by_type(v)

    # ------------------------------------------------------------ Benford
    @cached_property
    def benford(self) -> DataFrame:
        return benford.by_account(self.clean, self.p)

    # ------------------------------------------------------------ reports
    def report_metrics(self) -> DataFrame:
        v = self.validated
        return reports.report_metrics(
            reports.scope_metrics(self.risk),
            None if v is None else validate.metrics(v),
            None if v is None else validate.recall_one_type(v),
            benford.all_flagged(self.benford))

    def run(self, out_dir: str) -> dict:
        """Write every stage output (Parquet) and the flat export (CSV)."""
        from ledgerscreen.sources import sinks
        # FIXED VALUES -- names of the stage outputs
        sinks.write_stage(self.flags, os.path.join(out_dir, "rule_based_flags"))
        sinks.write_stage(self.benford, os.path.join(out_dir, "benford_analysis"))
        sinks.write_stage(self.risk.select("transaction_id", "ml_anomaly_score", "ml_flag"),
                          os.path.join(out_dir, "ml_anomaly_scores"))
        sinks.write_stage(rk.ranked(self.risk), os.path.join(out_dir, "final_risk_scores"))
        sinks.write_export_csv(self.export, os.path.join(out_dir, "dashboard_export"))
        sinks.write_stage(self.report_metrics(), os.path.join(out_dir, "report_metrics"))
        return {r["risk_level"]: r["n_transactions"] for r in rk.level_counts(self.risk).collect()}
