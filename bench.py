"""Benchmark: the full screen at $BENCH_SF_DIR on local[$BENCH_CPUS].

Times the pipeline stages (ledger build + planting + cleaning, audit rules,
forest fit, scoring + risk) and then every registered query, each executed to
completion with the no-op sink (no collect to the driver).  Prints ONE JSON
line: {"metric", "value" (total seconds), "unit", "queries": {...}, "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from ledgerscreen.session import get_session
    spark = get_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="ledgerscreen-bench")
    from ledgerscreen.plans import keys as K

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    # JVM / reader warm-up (not timed)
    spark.read.parquet(os.path.join(sf_dir, "nation.parquet")).count()

    times: dict[str, float] = {}
    t_all = time.time()
    pl = K.pipeline(spark, sf_dir, "main")

    def stage(name, fn):
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)

    stage("stage_ledger_clean", lambda: pl.clean)
    stage("stage_audit_rules", lambda: pl.ruled)
    stage("stage_iforest_fit", lambda: pl.model)
    stage("stage_score_risk", lambda: pl.ml_stats)      # the scored table and its statistics; risk is a projection
    ev = K.pipeline(spark, sf_dir, "events")
    stage("stage_events_rules", lambda: ev.ruled)

    for name, fn in K.REGISTRY.items():
        t0 = time.time()
        noop(fn(spark, sf_dir))
        times[name] = round(time.time() - t0, 3)
    total = round(time.time() - t_all, 3)

    n_rows = pl.n_rows
    timings = dict(pl.timings)
    for p in (pl, ev):
        p.drop_tables()          # leave no stage tables behind in the shared folder
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "ledger_screen_total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "ledger_rows": n_rows,
        "rows_per_sec_end_to_end": round(n_rows / total, 1) if total else None,
        "stage_write_sec": timings,
    }))


if __name__ == "__main__":
    main()
