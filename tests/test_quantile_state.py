"""Stored quantile states: merged in any order, replaced, exact against the whole table."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerscreen.functions import quantile_state as qs
from ledgerscreen.functions.quantiles import group_quantiles

PROBS = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "q99": 0.99, "q4": 1.0}
KEY = StructType([StructField("account", StringType())])


@pytest.fixture(scope="module")
def loads(spark):
    """Three loads: a hot account, ties, signs, zeros, tiny and infinite values, nulls, an empty load."""
    r = random.Random(5)
    first = [("HOT", round(r.lognormvariate(4, 2), 2)) for _ in range(4000)] + [("tie", 7.5)] * 900 + [("one", -3.0), ("null", None), (None, 5.0)]
    second = ([("HOT", round(r.uniform(-50, 50), 2)) for _ in range(3000)] + [("tie", 7.5)] * 5 + [("tie", 8.0)]
              + [("odd", x) for x in (0.0, -0.0, 5e-324, -5e-324, math.inf, -math.inf, 1e308, -1e308, 1.0)])
    df = lambda rows: spark.createDataFrame(rows, "account string, amount double")
    return [df(first), df([]), df(second)]


def plain(values, q):
    values = sorted(values)
    pos = q * (len(values) - 1)
    lo, hi = values[math.floor(pos)], values[math.ceil(pos)]
    return lo if lo == hi or pos == math.floor(pos) else (math.ceil(pos) - pos) * lo + (pos - math.floor(pos)) * hi


def rows(df):
    return {r["account"]: tuple(r[c] for c in ("n", *PROBS)) for r in df.collect()}


def test_same_as_the_whole_table_in_any_order_of_loads(spark, loads, tmp_path):
    whole = loads[0].unionByName(loads[1]).unionByName(loads[2])
    for k, order in enumerate(([0, 1, 2], [2, 0, 1])):
        path = str(tmp_path / f"s{k}")
        for at in order:
            qs.store(qs.state_of(loads[at], ["account"], "amount"), path, f"l{at}")
        got = rows(qs.quantiles(qs.stored(spark, path, KEY), whole, ["account"], "amount", PROBS))
        by = {}
        for r in whole.collect():
            if r["account"] is not None and r["amount"] is not None:
                by.setdefault(r["account"], []).append(r["amount"])
        assert set(got) == set(by) == {"HOT", "tie", "one", "odd"}
        for account, values in by.items():
            assert got[account] == (len(values), *[plain(values, q) for q in PROBS.values()])
    assert got == rows(group_quantiles(whole, ["account"], "amount", PROBS))


def test_a_load_stored_again_replaces_itself(spark, loads, tmp_path):
    path = str(tmp_path)
    for _ in range(2):
        qs.store(qs.state_of(loads[0], ["account"], "amount"), path, "l0")
    assert qs.stored(spark, path, KEY).agg(F.sum("n")).first()[0] == 4901
    qs.store(qs.state_of(loads[1], ["account"], "amount"), path, "l0")
    empty = qs.quantiles(qs.stored(spark, path, KEY), loads[1], ["account"], "amount", PROBS)
    assert empty.count() == 0 and empty.columns == ["account", "n", *PROBS]


def test_buckets_follow_the_values(spark):
    r = random.Random(8)
    xs = sorted([r.choice((-1, 1)) * 10 ** r.uniform(-300, 300) for _ in range(3000)] + [2.0 ** k for k in range(-1000, 1000)]
                + [math.nextafter(2.0 ** k, 0) for k in range(-1000, 1000)] + [0.0, math.inf, -math.inf])
    df = spark.createDataFrame([(k, x) for k, x in enumerate([*xs, math.nan])], "k long, x double").withColumn("b", qs.bucket(F.col("x")))
    got = [r["b"] for r in df.orderBy("k").collect()]
    assert got == sorted(got) and got[xs.index(0.0)] == 0 and got.count(0) == 1


def test_state_is_small_and_merges_by_adding(spark, loads):
    one = qs.state_of(loads[0], ["account"], "amount")
    whole = qs.state_of(loads[0].unionByName(loads[2]), ["account"], "amount")
    both = qs.merged(one.unionByName(qs.state_of(loads[2], ["account"], "amount")), ["account"])
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, whole.select(both.columns).collect()))
    ten = loads[0]
    for _ in range(3):
        ten = ten.unionByName(ten)
    assert qs.state_of(ten, ["account"], "amount").count() == one.count()


def test_a_state_by_other_keys_is_refused(loads):
    with pytest.raises(ValueError, match="not a state"):
        qs.quantiles(loads[0], loads[0], ["account"], "amount", PROBS)
