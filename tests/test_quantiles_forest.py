"""Exact quantiles by rank selection, NTILE boundaries and the forest."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from ledgerscreen.functions.quantiles import group_quantiles, order_statistics
from ledgerscreen.params import Params


def _spark_formula(vals, q):
    v = sorted(vals)
    pos = (len(v) - 1) * q
    lo, hi = math.floor(pos), math.ceil(pos)
    if lo == hi or v[lo] == v[hi]:
        return v[lo]
    return (hi - pos) * v[lo] + (pos - lo) * v[hi]


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_MID}/events.parquet").select(
        F.col("event_type").alias("k"), F.col("value").alias("x"))


def test_group_quantiles(spark, events):
    probs = {"q1": 0.25, "med": 0.5, "q3": 0.75, "p05": 0.05}
    a = {r.k: r for r in group_quantiles(events, ["k"], "x", probs).collect()}
    for k, g in events.toPandas().groupby("k"):
        for name, q in probs.items():
            assert a[k][name] == _spark_formula(g["x"].tolist(), q), (k, name)
        assert a[k].n == len(g)


def test_quantiles_of_awkward_groups(spark):
    inf = float("inf")
    groups = {"one": [-5.0], "two": [3.0, -1.0], "three": [-2.0, -2.0, 7.0], "equal": [4.0] * 50,
              "wide": [-1e308, 1e308, 0.0, 1e-300, -1e-300], "ends": [-inf, 1.0, 2.0, 3.0, inf],
              "skew": [2.0 ** k for k in range(-200, 200)]}
    df = spark.createDataFrame([(k, x) for k, v in groups.items() for x in v] + [("none", None), (None, 1.0)],
                               "k string, x double")
    got = {r.k: r for r in group_quantiles(df, ["k"], "x", {"q1": 0.25, "med": 0.5}).collect()}
    assert set(got) == set(groups)
    for k, v in groups.items():
        assert got[k].med == _spark_formula(v, 0.5) and got[k].q1 == _spark_formula(v, 0.25), k


def test_order_statistics_and_ranks_out_of_range(spark, events):
    vals = sorted(r.x for r in events.collect())
    ranks = [0, 17, len(vals) // 2, len(vals) - 1, len(vals), -1]
    got = order_statistics(events, "x", ranks)
    assert [got[k] for k in ranks[:4]] == [vals[k] for k in ranks[:4]]
    assert got[len(vals)] is None and got[-1] is None


@pytest.mark.parametrize("finish", [20000, 40])
def test_sketch_brackets_only_narrow(spark, events, monkeypatch, finish):
    """Right, wrong and no shares give the same ranks, with and without the narrowing passes."""
    from ledgerscreen.functions import quantiles
    monkeypatch.setattr(quantiles, "_FINISH_ROWS", finish)
    vals = sorted(r.x for r in events.collect())
    ranks = [0, 3, 5000, 7500, len(vals) - 1, len(vals)]
    for n in (len(vals), 3 * len(vals), None):
        got = order_statistics(events, "x", ranks, n)
        assert [got[k] for k in ranks] == [vals[k] if k < len(vals) else None for k in ranks]


def test_path_sums_match_scalar_walk():
    from ledgerscreen.operators.iforest import ForestArrays, path_sums
    rng = np.random.default_rng(7)
    t_count, depth, k = 12, 5, 4
    rows = []

    def build(t, node, d):
        if d == depth or rng.random() < 0.2:
            rows.append(dict(tree=t, node=node, feature=None, category=None, split=None, leaf_value=int(rng.integers(0, 10**9))))
            return
        name = f"f{rng.integers(0, k)}"
        value = str(rng.integers(0, 3)) if name == "f3" else None      # f3 is a category
        rows.append(dict(tree=t, node=node, feature=name, category=value, split=float(rng.random()), leaf_value=None))
        build(t, 2 * node, d + 1)
        build(t, 2 * node + 1, d + 1)
    for t in range(t_count):
        build(t, 1, 0)
    names = [f"f{i}" for i in range(k)]
    arrs = ForestArrays(rows, names[:3], names[3:], t_count, depth)
    cats = pd.Series([None if c == 3 else str(c) for c in rng.integers(0, 5, 500)])
    numbers = rng.random((500, 3))
    got = path_sums(arrs, arrs.matrix([pd.Series(numbers[:, j]) for j in range(3)] + [cats]))
    m = {(r["tree"], r["node"]): r for r in rows}
    for i in range(500):
        tot = 0
        for t in range(t_count):
            nd = 1
            while m[(t, nd)]["feature"] is not None:
                r = m[(t, nd)]
                left = (numbers[i, names.index(r["feature"])] < r["split"] if r["category"] is None
                        else cats[i] != r["category"])
                nd = 2 * nd if left else 2 * nd + 1
            tot += m[(t, nd)]["leaf_value"]
        assert got[i] == tot


def test_c_factor():
    from ledgerscreen.operators.iforest import c_factor
    assert c_factor(1) == 0.0 and c_factor(2) == 1.0
    assert abs(c_factor(256) - 10.244770920116851) < 1e-9


def test_forest_independent_of_partitioning_and_finds_outliers(spark):
    from ledgerscreen.plans.pipeline import Pipeline
    from ledgerscreen.sources.ledger import ledger_from_events
    raw = ledger_from_events(spark, SF_SMALL)
    p = Params(n_trees=20)
    a = Pipeline(spark, raw, p=p, name="t-a")
    b = Pipeline(spark, raw.repartition(7), p=p, name="t-b")
    ma = sorted(tuple(r) for r in a.model.collect())
    mb = sorted(tuple(r) for r in b.model.collect())
    assert ma == mb
    sa = {r.transaction_id: r.ml_anomaly_score for r in a.risk.collect()}
    sb = {r.transaction_id: r.ml_anomaly_score for r in b.risk.collect()}
    assert sa == sb
    assert all(0.0 <= v <= 1.0 for v in sa.values())
    flagged = a.risk.where(F.col("ml_flag") == "anomaly").count()
    n = a.risk.count()
    assert abs(flagged - 0.05 * n) <= 0.01 * n + 2


def _je(spark, rows):
    return spark.createDataFrame([(f"T{i}", a, x) for i, (a, x) in enumerate(rows)],
                                 "transaction_id string, account string, amount double")


def test_ntile_outliers_is_the_fourth_quarter(spark):
    from ledgerscreen.plans import sqlpack
    rows = [("one", -5.0), ("two", 1.0), ("two", 9.0), ("three", -1.0), ("three", -1.0), ("three", 50.0),
            ("four", -8.0), ("four", -7.0), ("four", -6.0), ("four", -5.0), ("same", 2.0), ("same", 2.0), ("same", 2.0),
            ("same", 2.0), (None, 100.0)] + [("many", float(k * k)) for k in range(1, 30)]
    got = sorted(r.transaction_id for r in sqlpack.ntile_outliers(_je(spark, rows)).collect())
    want = []
    for acct in {a for a, _ in rows if a}:
        v = sorted(x for a, x in rows if a == acct)
        n = len(v)
        tiles = [1 + min(i // (n // 4 + 1), n % 4) + max(0, i - (n % 4) * (n // 4 + 1)) // max(n // 4, 1)
                 * (i >= (n % 4) * (n // 4 + 1)) for i in range(n)]
        fourth = [x for x, t in zip(v, tiles) if t == 4]
        if fourth:
            want += [f"T{i}" for i, (a, x) in enumerate(rows) if a == acct and x > fourth[0] * 1.5]
    assert got == sorted(want) and want


def _frame(spark, n, accounts):
    from ledgerscreen.operators.features import NUMERIC
    return spark.range(n).selectExpr("concat('R', id) AS transaction_id", *[
        f"double(pmod(hash(id, {k}), 50)) AS x_{c}" for k, c in enumerate(NUMERIC)],
        "'HR' AS c_department", f"concat('Misc. Fees `', id % {accounts}, '`') AS c_account",
        "CASE WHEN id % 3 = 0 THEN 'Debit' END AS c_entry_type")


def test_any_number_and_spelling_of_categories(spark):
    """A thousand accounts, with dots and back quotes in their names."""
    from ledgerscreen.operators import iforest
    rows = iforest.fit(_frame(spark, 3000, 1000), 3000, Params(n_trees=30)).collect()
    tested = {r.category for r in rows if r.feature == "account"}
    assert len(tested) > 100 and all(v.startswith("Misc. Fees `") for v in tested)


@pytest.mark.parametrize("n", [1, 5, 60, 79, 80, 81, 500])
def test_one_sampling_law(spark, n):
    """Every tree gets min(psi, N) rows of the pool, dealt circularly, on both sides of N = T * psi = 80."""
    from ledgerscreen.operators import iforest
    p = Params(n_trees=10, max_samples=8)
    got = iforest.sample(_frame(spark, n, 3), n, p).select("tree", "transaction_id").collect()
    psi, pool = min(8, n), min(n, 80)
    import hashlib
    order = sorted((hashlib.md5(f"42:pool:R{i}".encode()).hexdigest(), f"R{i}") for i in range(n))[:pool]
    want = sorted((s // psi, order[s % pool][1]) for s in range(10 * psi))
    assert sorted((r.tree, r.transaction_id) for r in got) == want
