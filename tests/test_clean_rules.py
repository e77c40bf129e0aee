"""Cleaning and the six rules on a small dirty raw table (every null/edge trap)."""

from pyspark.sql import functions as F

from conftest import make_raw
from ledgerscreen.operators import clean as cl
from ledgerscreen.operators import rules
from ledgerscreen.params import RULE_NAMES

# transaction_id, date, time, department, account, vendor, amount, entry_type, posted_by, description
ROWS = [
    ("T01", "2025-02-30", "10:00:00", "HR", "Rent", "V1", "100.0", "Debit", "U1", "bad date"),
    ("T02", "2025-03-03", "10:00:00", "HR", "Rent", "V1", "abc", "Debit", "U1", "bad amount"),
    ("T03", "2025-03-03", "25:61:00", "HR", "Rent", "V1", "120.0", "Debit", "U1", "bad time"),
    ("T04", "2025-03-03", None, "HR", "Rent", "V2", "130.0", "Debit", "U1", "null time"),
    (None, "2025-03-03", "10:00:00", "HR", "Rent", "V1", "140.0", "Debit", "U1", "null id"),
    ("T06", "2025-03-04", "10:00:00", "IT", None, "V3", "150.0", "Credit", "U2", "null account"),
    ("T07", "2025-03-04", "10:00:00", None, "Rent", "V3", "160.0", "Credit", "U2", "null department"),
    ("T08", "2025-03-04", "10:00:00", "IT", "Rent", "V3", "0", "Credit", "U2", "zero"),
    ("T09", "2025-03-04", "10:00:00", "IT", "Rent", "V3", "0.05", "Credit", "U2", "tiny"),
    ("T10", "2025-03-04", "10:00:00", "IT", "Rent", "V3", "0.5", "Credit", "U2", "half"),
    ("T11", "2025-03-05", "10:00:00", "IT", "Rent", "V4", "9999.99", "Debit", "U2", "just below"),
    ("T12", "2025-03-05", "10:00:00", "IT", "Rent", "V4", "10000", "Debit", "U2", "round"),
    ("T13", "2025-03-05", "10:00:00", "IT", "Rent", "V4", "10000.5", "Debit", "U2", "not round"),
    ("T14", "2025-03-05", "10:00:00", "IT", "Rent", "V4", "20000", "Debit", "U2", "round"),
    ("T15", "2025-03-05", "10:00:00", "IT", "Rent", "V4", "-20000", "Debit", "U2", "negative"),
    ("T16", "2025-03-05", "06:59:00", "IT", "Fees", "V5", "10.0", "Debit", "U3", "hour 6"),
    ("T17", "2025-03-05", "07:00:00", "IT", "Fees", "V5", "11.0", "Debit", "U3", "hour 7"),
    ("T18", "2025-03-05", "20:59:00", "IT", "Fees", "V5", "12.0", "Debit", "U3", "hour 20"),
    ("T19", "2025-03-05", "21:00:00", "IT", "Fees", "V5", "13.0", "Debit", "U3", "hour 21"),
    ("T20", "2025-03-27", "18:00:00", "IT", "Fees", "V5", "14.0", "Debit", "U3", "day 27 h18"),
    ("T21", "2025-03-28", "17:59:00", "IT", "Fees", "V5", "15.0", "Debit", "U3", "day 28 h17"),
    ("T22", "2025-03-28", "18:00:00", "IT", "Fees", "V5", "16.0", "Debit", "U3", "day 28 h18"),
    ("T23", "2025-03-08", "12:00:00", "IT", "Fees", "V5", "17.0", "Debit", "U3", "saturday"),
    ("T24", "2025-03-06", "12:00:00", "IT", "Fees", "V6", "18.0", "Debit", "U3", "exact copy"),
    ("T24", "2025-03-06", "12:00:00", "IT", "Fees", "V6", "18.0", "Debit", "U3", "exact copy"),
    ("T25", "2025-03-06", "12:00:00", "IT", "Fees", "V6", "19.0", "Debit", "U3", "same but id"),
    ("T26", "2025-03-06", "12:00:00", "IT", "Fees", "V6", "19.0", "Debit", "U3", "same but id"),
    ("T27", "2025-03-06", "12:00:00", "IT", "Fees", None, "20.0", "Debit", "U3", "null vendor"),
    ("T28", "2025-03-06", "12:00:00", "IT", "Fees", None, "20.0", "Debit", "U3", "null vendor 2"),
]


def _cleaned(spark):
    return cl.clean(make_raw(spark, ROWS))


def test_clean_drops_and_types(spark):
    je = _cleaned(spark)
    ids = {r.transaction_id for r in je.collect()}
    assert "T01" not in ids and "T02" not in ids      # bad date / bad amount -> null -> dropped
    assert len([r for r in je.collect() if r.transaction_id == "T24"]) == 1   # exact copy removed
    assert {"T25", "T26", "T27", "T28"} <= ids
    rows = {r.transaction_id: r for r in je.collect()}
    assert rows["T03"].hour is None and rows["T04"].hour is None
    assert rows["T16"].hour == 6 and rows["T22"].day == 28
    assert rows["T23"].day_of_week == "Saturday" and rows["T23"].is_weekend is True
    assert rows["T16"].is_weekend is False
    counts = cl.clean_counts(make_raw(spark, ROWS), je).first()
    assert counts.rows_before == len(ROWS) and counts.rows_dropped == len(ROWS) - je.count()


def _flags(spark):
    je = _cleaned(spark)
    r = rules.with_flag_summary(rules.rule_columns(rules.enrich(je)))
    return {row.transaction_id: row for row in r.collect()}


def test_rules_edge_cases(spark):
    f = _flags(spark)
    # round numbers: float modulo, >= 10000 only
    assert f["T12"].r_round_number and f["T14"].r_round_number
    assert not f["T11"].r_round_number and not f["T13"].r_round_number and not f["T15"].r_round_number
    # off-hours: hour < 7 or hour > 20, weekend; null hour is not off-hours
    assert f["T16"].r_off_hours_weekend and f["T19"].r_off_hours_weekend and f["T23"].r_off_hours_weekend
    assert not f["T17"].r_off_hours_weekend and not f["T18"].r_off_hours_weekend
    assert not f["T03"].r_off_hours_weekend and not f["T04"].r_off_hours_weekend
    # month end: day >= 28 and hour >= 18
    assert f["T22"].r_month_end_late_hour_posting
    assert not f["T20"].r_month_end_late_hour_posting and not f["T21"].r_month_end_late_hour_posting
    # duplicates: every member of a (vendor, amount, date) group, null vendor == null vendor
    assert f["T25"].r_duplicate and f["T26"].r_duplicate
    assert f["T27"].r_duplicate and f["T28"].r_duplicate
    assert not f["T24"].r_duplicate          # its exact copy was removed by cleaning
    # outliers skip null accounts; concentration never flags a null vendor
    assert not f["T06"].r_statistical_outlier
    assert not f["T27"].r_vendor_concentration


def test_flag_summary_order_and_strings(spark):
    f = _flags(spark)
    row = f["T14"]       # round number (+ possibly others): names follow the fixed rule order
    names = row.tests_triggered.split(", ")
    assert names == [n for n in RULE_NAMES if n in names]
    assert row.n_tests_triggered == len(names)
    assert len(row.reasons.split(" | ")) == len(names)
    clean_row = f["T17"]
    if clean_row.n_tests_triggered == 0:
        assert clean_row.tests_triggered == "" and clean_row.reasons == ""


def test_vendor_concentration_threshold(spark):
    je = _cleaned(spark)
    r = rules.rule_columns(rules.enrich(je)).where(F.col("r_vendor_concentration").isNotNull())
    vs = je.groupBy("vendor").agg(F.sum("amount").alias("s")).collect()
    total = sum(x.s for x in vs)
    risky = {x.vendor for x in vs if x.vendor is not None and x.s / total * 100 > 8.0}
    assert {row.vendor for row in r.collect()} == risky
    assert "Vendor concentration risk (>8.0% of total spend)" in {row.r_vendor_concentration for row in r.collect()}


def test_typed_values_are_what_pandas_takes(spark):
    """Each text alone and the columns against pandas itself."""
    import pandas as pd
    dates = ["2025-01-05", "2025-1-2", "2025-01-02 10:00:00", "2025", "10:30:00", "2025-02-30", "2025/01/02", " 2025-01-02 ",
             "20250102", "2025-01", "2025-01-02Z", "0001-01-01", "9999-12-31", "1677-09-22", "2262-04-11", "", None]
    amounts = ["12", " 12 ", "1e5", ".5", "5.", "12d", "12f", "0x10", "1,000", "inf", "-Infinity", "1_000", "+3", "--3", "",
               "1e400", "1e"]
    times = ["09:05:00", "9:05:00", "9:5:0", "24:00:00", "23:59:60", "10:59:61", " 10:00:00", "10:00:00 ", "10:00",
             "1:2:3.5", "010:00:00", "10:60:00", "-1:00:00", "", None, "00:00:00", "x"]
    rows = [(str(i), d, t, "a", "b", "c", a, "e", "f", "g") for i, (d, t, a) in enumerate(zip(dates, times, amounts))]
    got = {r.transaction_id: r for r in cl.typed(make_raw(spark, rows)).collect()}
    want_d = pd.to_datetime(pd.Series(dates), errors="coerce", format="%Y-%m-%d")
    want_a = pd.to_numeric(pd.Series(amounts, dtype=object), errors="coerce")
    want_h = pd.to_datetime(pd.Series(times), format="%H:%M:%S", errors="coerce").dt.hour
    for i in range(len(rows)):
        r = got[str(i)]
        assert (None if pd.isna(want_d[i]) else want_d[i].date()) == r.date, dates[i]
        assert (None if pd.isna(want_a[i]) else want_a[i]) == r.amount, amounts[i]
        assert (None if pd.isna(want_h[i]) else int(want_h[i])) == r.hour, times[i]
