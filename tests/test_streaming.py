"""The streaming screen agrees with the batch screen on the same rows."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerscreen.params import Params
from ledgerscreen.plans.pipeline import Pipeline
from ledgerscreen.schema import CSV_TEXT
from ledgerscreen.sources.ledger import ledger_from_events
from ledgerscreen.streaming.screen import read_raw_stream, score_stream, screen_rules


def test_stream_matches_batch(spark):
    p = Params(n_trees=20)
    ledger = ledger_from_events(spark, SF_SMALL)
    ref = Pipeline(spark, ledger, p=p, name="stream-ref")
    batch = {r.transaction_id: r for r in ref.risk.collect()}

    folder = tempfile.mkdtemp(prefix="ledgerscreen-stream-")
    as_text = ledger.select(*[F.col(c).cast("string").alias(c) for c in ledger.columns])
    halves = as_text.randomSplit([0.5, 0.5], seed=3)
    for i, part in enumerate(halves):
        part.coalesce(1).write.options(header=True, **CSV_TEXT).csv(os.path.join(folder, f"drop{i}"))
    src = os.path.join(folder, "incoming")
    os.makedirs(src)
    for i in range(2):
        d = os.path.join(folder, f"drop{i}")
        for f in os.listdir(d):
            if f.endswith(".csv"):
                os.link(os.path.join(d, f), os.path.join(src, f"part{i}.csv"))

    stream = read_raw_stream(spark, src, "csv", max_files_per_trigger=1)
    out = score_stream(screen_rules(stream, p), ref, p)
    q = (out.writeStream.format("memory").queryName("screened").outputMode("append")
         .option("checkpointLocation", os.path.join(folder, "ckpt")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.transaction_id: r for r in spark.sql("SELECT * FROM screened").collect()}
    assert set(got) == set(batch)
    for tid, r in got.items():
        b = batch[tid]
        local = ("round_number", "off_hours_weekend", "month_end_late_hour_posting")
        want = [n for n in b.tests_triggered.split(", ") if n in local] if b.tests_triggered else []
        assert (r.tests_triggered.split(", ") if r.tests_triggered else []) == want, tid
        assert r.ml_anomaly_score == b.ml_anomaly_score, tid
        assert r.ml_flag == b.ml_flag, tid
