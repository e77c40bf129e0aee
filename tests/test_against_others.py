"""Entries against others: band join, as-of join, volume, chi-square, sweep, cube, reconciliation."""

import bisect
import datetime as dt
import math
import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerscreen.functions.gamma import chi2_sf, gamma_q
from ledgerscreen.operators import asof, benford, cube, near, reconcile, validate, volume
from ledgerscreen.params import Params

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    """A vendor with half of the entries, copies, null vendors, negative amounts, null amount."""
    r = random.Random(3)
    rows = [(f"T{k}", "HOT" if k % 2 else r.choice(["A", "B", None]), round(r.uniform(-40, 900), 2), DAY + dt.timedelta(r.randrange(60)),
             f"{r.randrange(24):02d}:00:00") for k in range(1500)]
    rows += [(f"C{k}", "HOT", 100.0, DAY, None) for k in range(300)] + [("N", "A", None, DAY, "10:00:00")]
    return spark.createDataFrame(rows, "transaction_id string, vendor string, amount double, date date, time string")


def test_near_entries_against_every_pair(spark, hot):
    p = Params(near_amount=2.5, near_days=2)
    rows = [r for r in hot.collect() if r.amount is not None]
    want = {}
    for x in rows:
        n = sum(x.vendor == y.vendor and (x.amount, x.date) != (y.amount, y.date) and abs(x.amount - y.amount) <= 2.5
                and abs((x.date - y.date).days) <= 2 for y in rows)
        if n:
            want[x.transaction_id] = n
    assert {r.transaction_id: r.near_entries for r in near.near_entries(hot, p).collect()} == want
    pairs = near.near_pairs(hot, p).collect()
    assert len({(r.vendor, r.amount_a, r.date_a, r.amount_b, r.date_b) for r in pairs}) == len(pairs)
    assert all((r.amount_a, r.date_a) < (r.amount_b, r.date_b) for r in pairs)


def test_near_work_is_linear_in_the_points(spark, hot):
    """The hot vendor's rows are dealt over its cells; a point is sent to five."""
    c = near.cells(near.points(hot), Params(near_amount=2.5, near_days=2))
    most = c.groupBy("vendor", "ca", "cd").count().agg(F.max("count")).first()[0]
    assert most < 12 and c.where("vendor = 'HOT'").count() > 700


def plain_asof(left, right, strict):
    by = defaultdict(dict)
    for key, t, v in right:
        if key is not None and t is not None:
            by[key][t] = max(by[key].get(t, v), v)
    out = []
    for key, t, v in left:
        times = sorted(by.get(key, {}))
        k = 0 if t is None else (bisect.bisect_left if strict else bisect.bisect_right)(times, t)
        out.append((key, t, v, by[key][times[k - 1]] if k else None))
    return Counter(out)


@pytest.mark.parametrize("strict", [True, False])
def test_asof_over_many_ranges(spark, strict):
    r = random.Random(4)
    side = lambda n: [(r.choice(["hot", "hot", "b", None]), r.choice([None, *range(200)]), r.randrange(50)) for _ in range(n)]
    left, right = side(700) + [("only left", 5, 1)], side(60) + [("only right", 5, 1)]
    schema = "k string, t long, v long"
    for n in (1, 3, 40):
        got = asof.asof_join(spark.createDataFrame(left, schema).repartition(3), spark.createDataFrame(right, schema), "k", "t", ["v"],
                             strict=strict, ranges=n)
        assert Counter(tuple(x) for x in got.collect()) == plain_asof(left, right, strict)


def test_asof_of_empty_sides(spark):
    some, none = spark.createDataFrame([("a", 1, 2)], "k string, t long, v long"), spark.createDataFrame([], "k string, t long, v long")
    assert asof.asof_join(none, some, "k", "t", ["v"]).count() == 0
    assert [tuple(x) for x in asof.asof_join(some, none, "k", "t", ["v"]).collect()] == [("a", 1, 2, None)]


def test_previous_entries(spark):
    rows = [("a", "V", 5.0, DAY, "10:00:00"), ("b", "V", 7.0, DAY, "10:00:00"), ("c", "V", 9.0, DAY, None), ("d", "V", 1.0, DAY + dt.timedelta(2), "x"),
            ("e", None, 1.0, DAY, "11:00:00"), ("f", None, 1.0, DAY, "12:00:00")]
    df = spark.createDataFrame(rows, "transaction_id string, vendor string, amount double, date date, time string")
    got = {r.transaction_id: (r.previous_id, r.days_since, r.amount_change) for r in asof.previous_entries(df).collect()}
    assert got == {"a": ("c", 0, -4.0), "b": ("c", 0, -2.0), "c": (None, None, None), "d": ("b", 2, -6.0), "e": (None,) * 3, "f": (None,) * 3}


def test_volume_against_plain_python(spark, hot):
    p = Params(volume_days=10, volume_least_days=4, volume_limit=2.0)
    counts = defaultdict(Counter)
    for r in hot.collect():
        if r.vendor is not None:
            counts[r.vendor][r.date] += 1
    rows = volume.volume_screen(hot, "vendor", p).collect()
    assert len(rows) == sum((max(c) - min(c)).days + 1 for c in counts.values())
    for r in rows:
        own = counts[r.vendor]
        before = [own[r.date - dt.timedelta(k)] for k in range(1, 11) if r.date - dt.timedelta(k) >= min(own)]
        assert (r.n_entries, r.days_before) == (own[r.date], len(before))
        if not before:
            assert (r.usual, r.spread, r.score, r.flag) == (None, None, None, "NEW")
            continue
        usual = statistics.median(before)
        spread = statistics.median(abs(x - usual) for x in before)
        assert (r.usual, r.spread) == (usual, spread)
        score = (own[r.date] - usual) / max(1.4826 * spread, 1.0) if len(before) >= 4 else None
        assert r.score == pytest.approx(score)
        assert r.flag == ("NEW" if score is None else "UNUSUAL" if score > 2 else "OK")
    assert any(r.n_entries == 0 for r in volume.daily_counts(hot.where("transaction_id in ('T0', 'T900', 'T904')"), "vendor").collect())


def reference_sf(x: float, df: int) -> float:
    """Closed forms: finite sums for even degrees, erfc and a finite sum for odd ones."""
    h = x / 2
    if df % 2 == 0:
        return math.exp(-h) * math.fsum(h ** k / math.factorial(k) for k in range(df // 2))
    return math.erfc(math.sqrt(h)) + math.exp(-h) * math.fsum(h ** (k - 0.5) / math.gamma(k + 0.5) for k in range(1, (df + 1) // 2))


def test_chi_square_tail(spark):
    xs = [0.0, 1e-12, 0.001, 0.5, 1.0, 2.0, 7.3, 8.0, 9.0, 15.507, 26.12, 50.0, 99.0, 180.0, 700.0, 5000.0]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,), (-1.0,)], "x double")
    for k in (1, 2, 3, 8, 9, 40, 99):
        got = [r[0] for r in df.select(chi2_sf(F.col("x"), k)).collect()]
        assert got[:-2] == pytest.approx([reference_sf(x, k) for x in xs], abs=1e-9)
        assert got[-2:] == [None, 1.0]
    assert df.where("x = 9.0").select(gamma_q(3.5, F.col("x"))).first()[0] == pytest.approx(reference_sf(18.0, 7), abs=1e-12)


def test_benford_chi_square_of_small_accounts(spark):
    rows = [("none", 0.0), ("null", None), ("one", 123.0), (None, 5.0)] + [("flat", float(k % 9 + 1)) for k in range(900)]
    rows += [("law", float(d)) for d in range(1, 10) for _ in range(round(10_000 * math.log10(1 + 1 / d)))]
    df = spark.createDataFrame(rows, "account string, amount double")
    got = {r.account: r for r in benford.chi_square(df).collect()}
    assert set(got) == {"none", "null", "one", "flat", "law"}
    for a in ("none", "null"):
        assert (got[a].n_digits, got[a].chi_square, got[a].p_value, got[a].flag) == (0, 0.0, 1.0, "OK")
    one = 1 / math.log10(2) - 1
    assert got["one"].chi_square == pytest.approx(one, abs=1e-6) and got["one"].p_value == pytest.approx(reference_sf(one, 8), abs=1e-9)
    assert got["flat"].flag == "REVIEW" and got["law"].flag == "OK"


def test_sweep_equals_the_metrics_at_each_cut(spark):
    r = random.Random(9)
    rows = [(round(r.random(), 1), int(r.random() < 0.2)) for _ in range(200)]
    df = spark.createDataFrame(rows, "risk_score double, is_anomaly int")
    sweep = validate.threshold_sweep(df).collect()
    assert {x.threshold for x in sweep} == {s for s, _ in rows} | {-1.0}
    for x in sweep:
        k2 = validate.metrics(df.withColumn("is_flagged", F.col("risk_score") > x.threshold)).first()
        assert (x.flagged, x.true_positives, x.recall, x.precision) == (k2.flagged, k2.true_positives, k2.recall, k2.precision)
    empty = validate.threshold_sweep(df.limit(0)).collect()
    assert [tuple(x) for x in empty] == [(-1.0, 0, 0, 0.0, 0.0, 0.0)]


def test_cube_and_its_sketch(spark):
    rows = [(f"d{k % 3}" if k % 7 else None, "Debit" if k % 2 else "Credit", k % 4, f"v{k * k % 3001}" if k % 11 else None, float(k)) for k in range(6000)]
    df = spark.createDataFrame(rows, "department string, entry_type string, month int, vendor string, amount double")
    exact = {(r.department, r.entry_type, r.month, r.level): r for r in cube.spend_cube(df).collect()}
    vendors, spend = defaultdict(set), Counter()
    for d, e, m, v, a in rows:
        for level in range(8):
            g = (None if level & 4 else d, None if level & 2 else e, None if level & 1 else m, level)
            spend[g] += a
            vendors[g] |= {v} - {None}
    assert set(exact) == set(spend)
    for g, r in exact.items():
        assert r.n_vendors == len(vendors[g]) and r.spend == pytest.approx(spend[g])
    for r in cube.spend_cube_sketched(df).collect():
        one = exact[r.department, r.entry_type, r.month, r.level]
        assert (r.n_entries, r.spend) == (one.n_entries, one.spend)
        assert abs(r.n_vendors - one.n_vendors) <= max(1, 5 * 0.8 / math.sqrt(2 ** cube.LG_K) * one.n_vendors)


def test_reconciliation_is_except_all(spark):
    rows = [("a", 1), ("a", 1), (None, None), ("b", None)] * 20 + [("hot", 7)] * 100
    other = [("a", 1)] * 25 + [(None, None)] * 50 + [("new", 1)] + [("hot", 7)] * 100
    a, b = (spark.createDataFrame(x, "k string, v long") for x in (rows, other))
    diff = reconcile.differences(a, b)
    ca, cb = Counter(rows), Counter(other)
    assert {tuple(r)[:2]: (r.n_a, r.n_b) for r in diff.collect()} == {x: (ca[x], cb[x]) for x in ca | cb if ca[x] != cb[x]}
    s = reconcile.summary(diff).first()
    assert (s.copies_only_in_a, s.copies_only_in_b) == (a.exceptAll(b).count(), b.exceptAll(a).count())
    assert tuple(reconcile.summary(reconcile.differences(a, a)).first()) == (0, 0, 0, 0)
    with pytest.raises(ValueError, match="'v'"):
        reconcile.differences(a, b.drop("v"))
