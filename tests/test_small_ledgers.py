"""Every key of the screen on a ledger without rows, with one row and with equal rows."""

import pytest

from conftest import make_raw
from ledgerscreen.plans import keys as K
from ledgerscreen.plans.pipeline import Pipeline

ROW = ("J1", "2024-03-30", "19:30:00", "Ops", "Rent", "Acme", "20000", "Debit", "USER_1", "d")
LEDGERS = {"none": [], "one": [ROW], "equal": [(f"J{k}", *ROW[1:]) for k in range(3)]}
#: Keys that read the given tables themselves.
OWN = {"raw_scan", "events_ledger", "event_properties", "dirty_clean", "dirty_counts", "csv_ledger", "reconcile_loads", "reconcile_summary"}


@pytest.fixture(scope="module", params=sorted(LEDGERS))
def small(spark, request):
    rows = LEDGERS[request.param]
    labels = spark.createDataFrame([("J1", 1, "vendor_concentration")], "transaction_id string, is_anomaly int, anomaly_type string")
    pl = Pipeline(spark, make_raw(spark, rows), labels, name=f"small-{request.param}", view_name=f"small_{request.param}")
    for fixture in ("main", "events"):
        K._PIPELINES[spark.sparkContext.applicationId, request.param, fixture] = pl
    yield request.param, len(rows), pl
    for fixture in ("main", "events"):
        K._PIPELINES.pop((spark.sparkContext.applicationId, request.param, fixture))


def test_every_key(spark, small):
    name, n, _ = small
    failed = {}
    for key, fn in K.REGISTRY.items():
        if key in OWN:
            continue
        try:
            rows = fn(spark, name).collect()
        except Exception as e:      # noqa: BLE001 - all failing keys are named at once
            failed[key] = str(e)[:200]
            continue
        if key in ("risk_scores", "risk_ranked", "ml_flag", "ml_minmax", "iforest_score", "dashboard_export"):
            assert len(rows) == n, key
    assert not failed


def test_scores_of_equal_rows(spark, small):
    _, n, pl = small
    rows = pl.ml.select("iso_score", "ml_anomaly_score", "ml_flag").collect()
    assert [(r.ml_anomaly_score, r.ml_flag) for r in rows] == [(0.0, "normal")] * n
    assert all(0 < r.iso_score <= 1 for r in rows)
