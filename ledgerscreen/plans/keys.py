"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator key.

Main ledger: line items of the test tables with planted anomalies and labels
(fixture A + planting).  Event ledger: the events table (fixture B), long
tailed amounts, used for the Benford and outlier variants.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerscreen.functions import quantile_state
from ledgerscreen.operators import benford, clean as cl, features as ft, reports, risk as rk
from ledgerscreen.operators import asof, cube, near, reconcile, rules, validate, volume
from ledgerscreen.params import DEFAULT_PARAMS
from ledgerscreen.plans import sqlpack
from ledgerscreen.plans.pipeline import Pipeline
from ledgerscreen.session import scratch_path
from ledgerscreen.sources import json_events
from ledgerscreen.sources.ledger import (dirty_ledger_from_orders, ledger_from_events, ledger_from_lineitem,
                                         load_raw_csv, table)
from ledgerscreen.sources.sinks import write_export_csv

_PIPELINES: dict = {}


def _spark_key(spark: SparkSession):
    return spark.sparkContext.applicationId


def pipeline(spark: SparkSession, sf_dir: str, fixture: str = "main") -> Pipeline:
    key = (_spark_key(spark), sf_dir, fixture)
    if key not in _PIPELINES:
        if fixture == "main":
            _PIPELINES[key] = Pipeline(spark, ledger_from_lineitem(spark, sf_dir), None, DEFAULT_PARAMS,
                                       view_name="journal_entries", name="main", plant=True)
        elif fixture == "events":
            _PIPELINES[key] = Pipeline(spark, ledger_from_events(spark, sf_dir), None, DEFAULT_PARAMS,
                                       view_name="journal_entries_events", name="events")
        else:
            raise ValueError(fixture)
    return _PIPELINES[key]


def reset_pipelines() -> None:
    for pl in _PIPELINES.values():
        pl.drop_tables()
    _PIPELINES.clear()


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def key(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _main(spark, sf):
    return pipeline(spark, sf, "main")


def _ev(spark, sf):
    return pipeline(spark, sf, "events")


# ------------------------------------------------------------------ sources
@key("raw_scan")
def _raw_scan(spark, sf):
    return ledger_from_lineitem(spark, sf)


@key("events_ledger")
def _events_ledger(spark, sf):
    return ledger_from_events(spark, sf)


@key("event_properties")
def _event_props(spark, sf):
    return json_events.shredded(table(spark, sf, "events").select("event_id", "event_type", "props"), {"k": "bigint"})


@key("dashboard_export")
def _export(spark, sf):
    return _main(spark, sf).export


# ------------------------------------------------------------------ clean / profile
@key("clean_ledger")
def _clean(spark, sf):
    return _main(spark, sf).clean


@key("clean_counts")
def _clean_counts(spark, sf):
    pl = _main(spark, sf)
    return cl.clean_counts(pl.raw, pl.clean)


@key("dirty_clean")
def _dirty_clean(spark, sf):
    return cl.clean(dirty_ledger_from_orders(spark, sf))


@key("dirty_counts")
def _dirty_counts(spark, sf):
    raw = dirty_ledger_from_orders(spark, sf)
    return cl.clean_counts(raw, cl.clean(raw))


@key("csv_ledger")
def _csv_ledger(spark, sf):
    """The event ledger written as CSV (columns in another order, texts with quotes,
    commas and blanks at their ends), scanned and cleaned."""
    raw = ledger_from_events(spark, sf)
    text = F.concat(F.lit(' "'), F.col("vendor"), F.lit('", Ltd '))
    path = os.path.join(scratch_path(spark, f"csv-{uuid.uuid4().hex}"), "events")
    write_export_csv(raw.withColumn("vendor", text).select(*reversed(raw.columns)), path)
    return cl.clean(load_raw_csv(spark, path))


@key("id_repeats")
def _id_repeats(spark, sf):
    return cl.id_repeats(_main(spark, sf).clean)


@key("profile_summary")
def _profile_summary(spark, sf):
    return cl.profile_summary(_main(spark, sf).clean)


@key("profile_amount")
def _profile_amount(spark, sf):
    return cl.profile_amount(_main(spark, sf).clean)


@key("profile_nulls")
def _profile_nulls(spark, sf):
    return cl.profile_nulls(_main(spark, sf).clean)


# ------------------------------------------------------------------ rules
for _rule in ("duplicate", "round_number", "off_hours_weekend", "vendor_concentration",
              "statistical_outlier", "month_end_late_hour_posting"):
    _short = {"off_hours_weekend": "off_hours", "month_end_late_hour_posting": "month_end_late"}.get(_rule, _rule)

    def _mk(rule):
        return lambda spark, sf: rules.single_rule(_main(spark, sf).ruled, rule)
    REGISTRY[f"rule_{_short}"] = _mk(_rule)


@key("rule_statistical_outlier_events")
def _rule_outlier_ev(spark, sf):
    return rules.single_rule(_ev(spark, sf).ruled, "statistical_outlier")


@key("rule_flags")
def _rule_flags(spark, sf):
    return _main(spark, sf).flags


@key("rule_flags_events")
def _rule_flags_ev(spark, sf):
    return _ev(spark, sf).flags


@key("flags_per_txn_hist")
def _hist(spark, sf):
    return rules.flags_per_txn_hist(_main(spark, sf).flags)


@key("rule_counts")
def _rule_counts(spark, sf):
    return rules.rule_counts(_main(spark, sf).flags)


@key("rule_flag_rate")
def _rule_flag_rate(spark, sf):
    pl = _main(spark, sf)
    return rules.rule_flag_rate(pl.clean, pl.flags)


# ------------------------------------------------------------------ SQL pack
for _q in ("round_numbers", "off_hours", "month_end_late", "monthly_summary", "top_vendors"):
    def _mk_sql(q):
        def run(spark, sf):
            pl = _main(spark, sf)
            pl.clean   # registers the journal_entries view
            return sqlpack.run(spark, q, pl.view_name)
        return run
    REGISTRY[f"sql_{_q}"] = _mk_sql(_q)


@key("sql_duplicates")
def _sql_dup(spark, sf):
    return sqlpack.duplicates(_main(spark, sf).clean)


@key("sql_vendor_concentration")
def _sql_conc(spark, sf):
    return sqlpack.vendor_concentration(_main(spark, sf).clean)


@key("sql_ntile_outliers")
def _ntile(spark, sf):
    return sqlpack.ntile_outliers(_main(spark, sf).clean)


@key("sql_ntile_outliers_events")
def _ntile_ev(spark, sf):
    return sqlpack.ntile_outliers(_ev(spark, sf).clean)


# ------------------------------------------------------------------ Benford
@key("benford_leading_digit")
def _bld(spark, sf):
    return benford.leading_digits(_ev(spark, sf).clean)


@key("benford_overall")
def _bov(spark, sf):
    return benford.overall(_ev(spark, sf).clean)


@key("benford_by_account")
def _bba(spark, sf):
    return _main(spark, sf).benford


@key("benford_by_account_events")
def _bba_ev(spark, sf):
    return _ev(spark, sf).benford


@key("benford_summary")
def _bsum(spark, sf):
    return benford.summary(_main(spark, sf).benford)


@key("benford_all_flagged")
def _ball(spark, sf):
    return benford.all_flagged(_main(spark, sf).benford)


@key("benford_chi_square")
def _bchi(spark, sf):
    return benford.chi_square(_main(spark, sf).clean)


@key("benford_chi_square_events")
def _bchi_ev(spark, sf):
    return benford.chi_square(_ev(spark, sf).clean)


# ------------------------------------------------------------------ entries against others
@key("near_duplicate_pairs")
def _npairs(spark, sf):
    return near.near_pairs(_main(spark, sf).clean)


@key("near_duplicate_entries")
def _nentries(spark, sf):
    return near.near_entries(_main(spark, sf).clean)


@key("previous_entries")
def _prev(spark, sf):
    return asof.previous_entries(_main(spark, sf).clean)


@key("posting_volume")
def _volume(spark, sf):
    return volume.volume_screen(_main(spark, sf).clean)


@key("posting_volume_events")
def _volume_ev(spark, sf):
    return volume.volume_screen(_ev(spark, sf).clean, "account")


@key("spend_cube")
def _cube(spark, sf):
    return cube.spend_cube(_main(spark, sf).clean)


def _two_loads(spark, sf):
    """The ledger as it came, and the raw table with its planted copies."""
    raw = _main(spark, sf).raw
    return raw, ledger_from_lineitem(spark, sf).select(*raw.columns)


@key("reconcile_loads")
def _reconcile(spark, sf):
    return reconcile.differences(*_two_loads(spark, sf))


@key("reconcile_summary")
def _reconcile_sum(spark, sf):
    return reconcile.summary(reconcile.differences(*_two_loads(spark, sf)))


@key("account_quantiles_by_load")
def _quantiles_by_load(spark, sf):
    """The ledger as two loads, split in time; each leaves its state, the quantiles come from the merged one."""
    je, by = _main(spark, sf).clean, ["account"]
    late = F.coalesce(F.col("date") >= F.lit("1996-01-01").cast("date"), F.lit(False))
    path = scratch_path(spark, f"quantile-state-{uuid.uuid4().hex}")
    for load, rows in (("early", je.where(~late)), ("late", je.where(late))):
        quantile_state.store(quantile_state.state_of(rows, by, "amount"), path, load)
    state = quantile_state.stored(spark, path, StructType([je.schema["account"]]))
    return quantile_state.quantiles(state, je, by, "amount", {"q1": DEFAULT_PARAMS.q_low, "median": 0.5, "q3": DEFAULT_PARAMS.q_high})


# ------------------------------------------------------------------ features / model
@key("features")
def _features(spark, sf):
    return ft.entries(_main(spark, sf).ruled)


@key("vendor_frequency")
def _vfreq(spark, sf):
    return ft.vendor_frequency(_main(spark, sf).ruled)


@key("iforest_model")
def _model(spark, sf):
    return _main(spark, sf).model


@key("iforest_score")
def _iscore(spark, sf):
    return _main(spark, sf).ml.select("transaction_id", "path_sum", "iso_score")


@key("ml_minmax")
def _minmax(spark, sf):
    return _main(spark, sf).ml.select("transaction_id", "ml_anomaly_score")


@key("ml_flag")
def _mlflag(spark, sf):
    return _main(spark, sf).ml.select("transaction_id", "ml_anomaly_score", "ml_flag")


@key("ml_rate")
def _mlrate(spark, sf):
    ml = _main(spark, sf).ml
    return ml.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.col("ml_flag") == "anomaly").alias("n_anomaly")).select(
        "n_rows", "n_anomaly",
        F.coalesce(F.try_divide(F.col("n_anomaly") * 100.0, F.col("n_rows")), F.lit(0.0)).alias("anomaly_pct"))


@key("ml_top10")
def _mltop(spark, sf):
    ml = _main(spark, sf).ml
    return (ml.orderBy(F.desc("ml_anomaly_score"), F.asc("transaction_id")).limit(10)
            .select("transaction_id", "ml_anomaly_score", "ml_flag"))


# ------------------------------------------------------------------ risk
@key("risk_scores")
def _risk(spark, sf):
    return rk.risk_scores(_main(spark, sf).risk)


@key("severity_from_string")
def _sev(spark, sf):
    return rk.severity_table(_main(spark, sf).flags)


@key("risk_top10")
def _rtop(spark, sf):
    return rk.top_risk(_main(spark, sf).risk)


@key("risk_ranked")
def _ranked(spark, sf):
    return rk.ranked(_main(spark, sf).risk)


@key("risk_level_counts")
def _rlc(spark, sf):
    return rk.level_counts(_main(spark, sf).risk)


# ------------------------------------------------------------------ validation
@key("validation_metrics")
def _vm(spark, sf):
    return validate.metrics(_main(spark, sf).validated)


@key("threshold_sweep")
def _sweep(spark, sf):
    return validate.threshold_sweep(_main(spark, sf).validated)


@key("recall_by_type")
def _rbt(spark, sf):
    return _main(spark, sf).recall_by_type


@key("recall_one_type")
def _rot(spark, sf):
    return validate.recall_one_type(_main(spark, sf).validated)


@key("weakest_type")
def _wt(spark, sf):
    return validate.weakest_type(_main(spark, sf).recall_by_type)


@key("recall_macro")
def _rm(spark, sf):
    return validate.recall_macro(_main(spark, sf).recall_by_type)


# ------------------------------------------------------------------ reports
@key("scope_metrics")
def _scope(spark, sf):
    return reports.scope_metrics(_main(spark, sf).risk)


@key("top_vendors_flagged")
def _tvf(spark, sf):
    return reports.top_vendors_flagged(_main(spark, sf).risk)


@key("top_transactions")
def _tt(spark, sf):
    return reports.top_transactions(_main(spark, sf).risk)


@key("monthly_value")
def _mv(spark, sf):
    return reports.monthly_value(_main(spark, sf).clean)


@key("amount_histogram")
def _ah(spark, sf):
    return reports.histogram(_main(spark, sf).clean, "amount", 60)


@key("score_histogram")
def _sh(spark, sf):
    return reports.histogram(_main(spark, sf).risk, "ml_anomaly_score", 50)


@key("risk_level_ordered")
def _rlo(spark, sf):
    return reports.risk_level_ordered(_main(spark, sf).risk)


@key("report_metrics")
def _rmx(spark, sf):
    return _main(spark, sf).report_metrics()


# ------------------------------------------------------------------ dashboard
@key("dash_filtered")
def _dfilt(spark, sf):
    return _main(spark, sf).export.where(reports.dashboard_filter())


@key("dash_kpis")
def _dk(spark, sf):
    return reports.dash_kpis(_main(spark, sf).export)


@key("dash_rule_counts")
def _drc(spark, sf):
    return reports.dash_rule_counts(_main(spark, sf).export)


@key("dash_vendor_risk")
def _dvr(spark, sf):
    return reports.dash_vendor_risk(_main(spark, sf).export)


@key("dash_vendor_scatter")
def _dvs(spark, sf):
    return reports.dash_vendor_scatter(_main(spark, sf).risk)


@key("dash_dept_spend")
def _dds(spark, sf):
    return reports.dash_dept_spend(_main(spark, sf).export)


@key("dash_detail")
def _ddt(spark, sf):
    return reports.dash_detail(_main(spark, sf).export, reports.dashboard_filter())


@key("dash_departments")
def _ddep(spark, sf):
    return reports.dash_departments(_main(spark, sf).export)
