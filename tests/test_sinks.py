"""Sources and sinks: raw CSV scan with all-string schema, table write + view, CSV export."""

import os
import tempfile

from conftest import make_raw
from ledgerscreen.operators import clean as cl
from ledgerscreen.sources import ledger, sinks

ROWS = [
    ("A1", "2025-01-02", "09:00:00", "HR", "Rent", "V1", "100.5", "Debit", "U1", "x"),
    ("A2", "2025-01-03", "23:00:00", "IT", "Fees", "V2", "oops", "Credit", "U2", "y"),
]


def test_csv_roundtrip_and_table(spark):
    d = tempfile.mkdtemp(prefix="ledgerscreen-sinks-")
    raw = make_raw(spark, ROWS)
    raw.write.option("header", True).csv(os.path.join(d, "raw"))
    back = ledger.load_raw_csv(spark, os.path.join(d, "raw"))
    assert all(f.dataType.simpleString() == "string" for f in back.schema.fields)
    je = cl.clean(back)
    assert [r.transaction_id for r in je.collect()] == ["A1"]        # bad amount dropped
    t = sinks.write_table(je, os.path.join(d, "je"), view_name="je_view")
    assert spark.sql("SELECT count(*) FROM je_view").first()[0] == 1
    sinks.write_export_csv(t, os.path.join(d, "export"))
    exp = spark.read.option("header", True).csv(os.path.join(d, "export"))
    assert exp.first().date == "2025-01-02" and exp.count() == 1


def test_csv_keeps_quotes_commas_blanks_and_order(spark):
    import pytest
    rows = [("A1", "2025-01-02", "09:00:00", "HR", "Rent", 'Smith, "Bob", Ltd', "1", "Debit", " U1 ", "two\nlines"),
            ("A2", "2025-01-02", "09:00:00", None, "", '"', "2", "Debit", "\\", "x,y")]
    d = tempfile.mkdtemp(prefix="ledgerscreen-csv-")
    raw = make_raw(spark, rows)
    sinks.write_export_csv(raw.select(*reversed(raw.columns)), os.path.join(d, "raw"))
    back = ledger.load_raw_csv(spark, os.path.join(d, "raw"))
    assert back.columns == raw.columns
    assert sorted(map(tuple, back.collect()), key=str) == sorted(
        [tuple(v or None for v in r) for r in rows], key=str)          # an empty text comes back as null
    raw.drop("vendor").write.option("header", True).csv(os.path.join(d, "short"))
    with pytest.raises(ValueError, match="vendor: missing"):
        ledger.load_raw_csv(spark, os.path.join(d, "short"))


def test_clean_table_is_checked_on_read(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="ledgerscreen-check-")
    je = cl.clean(make_raw(spark, ROWS))
    je.write.parquet(os.path.join(d, "good"))
    assert ledger.load_clean(spark, os.path.join(d, "good")).columns == je.columns
    je.withColumn("hour", je.hour.cast("string")).write.parquet(os.path.join(d, "bad"))
    with pytest.raises(ValueError, match="hour: string, expected int"):
        ledger.load_clean(spark, os.path.join(d, "bad"))


def test_pipeline_run_and_export_roundtrip(spark):
    from pyspark.sql import functions as F
    from conftest import SF_SMALL
    from ledgerscreen.operators import reports
    from ledgerscreen.params import Params
    from ledgerscreen.plans.pipeline import Pipeline
    from ledgerscreen.sources.ledger import ledger_from_events
    pl = Pipeline(spark, ledger_from_events(spark, SF_SMALL), p=Params(n_trees=10), name="run-test")
    out = tempfile.mkdtemp(prefix="ledgerscreen-run-")
    levels = pl.run(out)
    assert sum(levels.values()) == pl.clean.count()
    for stage in ("rule_based_flags", "benford_analysis", "ml_anomaly_scores", "final_risk_scores",
                  "report_metrics"):
        assert spark.read.parquet(os.path.join(out, stage)).count() > 0
    exp = ledger.load_export(spark, os.path.join(out, "dashboard_export"))
    assert len(exp.columns) == 23 and exp.count() == pl.clean.count()
    assert exp.where(F.col("date").isNull()).count() == 0
    # dashboard queries run on the re-loaded export
    kpi = reports.dash_kpis(exp).first()
    assert kpi.n_transactions == pl.clean.count()
    ranks = {r.risk_level: r.risk_rank for r in exp.select("risk_level", "risk_rank").distinct().collect()}
    assert all(ranks[k] == v for k, v in {"Low": 0, "Medium": 1, "High": 2}.items() if k in ranks)


def test_drop_tables(spark):
    from conftest import SF_SMALL
    from ledgerscreen.params import Params
    from ledgerscreen.plans.pipeline import Pipeline
    from ledgerscreen.sources.ledger import ledger_from_events
    pl = Pipeline(spark, ledger_from_events(spark, SF_SMALL), p=Params(n_trees=5), name="drop-test")
    pl.ruled.count()
    base = pl.base_dir.replace("file:", "")
    assert os.path.exists(base)
    pl.drop_tables()
    assert not os.path.exists(base)
