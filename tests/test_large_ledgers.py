"""What keeps the ledger's shuffles and times in proportion to its rows."""
import datetime
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import make_raw
from ledgerscreen.operators import asof, clean as cl, iforest, rules
from ledgerscreen.schema import RAW_COLUMNS
from ledgerscreen.sources.ledger import ledger_from_lineitem


def rows(n):
    return [(f"T{i}", f"2024-03-{1 + i % 28:02d}", "10:00:00", "D", f"A{i % 3}", f"V{i % 4}", str(100.0 + i % 17), "Debit", "U", "x")
            for i in range(n)]


@pytest.fixture
def no_estimate(spark):
    """As on large tables: nothing is broadcast by the planner's estimate, nor replanned."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_statistics_join_without_a_shuffle_of_the_ledger(spark, no_estimate, tmp_path):
    cl.clean(make_raw(spark, rows(200))).write.parquet(str(tmp_path / "je"))
    text = plan(rules.enrich(spark.read.parquet(str(tmp_path / "je"))))
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text


@pytest.mark.parametrize("most", [1_000_000, 1])
def test_stored_cleaning_drops_the_same_copies(spark, monkeypatch, tmp_path, most):
    from conftest import make_raw
    monkeypatch.setattr(cl, "BROADCAST_ROWS", most)
    data = rows(30) + rows(5) + rows(3)
    data += [("Z", "2024-01-01", None, None, None, None, v, None, None, None) for v in ("0.0", "-0.0", "0", "1", None)]
    data += [("Z", "2024-01-01", None, None, "a", None, "1", None, None, None), ("Z", "2024-01-01", None, None, None, "a", "1", None, None, None)]
    raw = make_raw(spark, data)
    key = lambda df: sorted(map(str, df.withColumn("amount", F.col("amount") + 0.0).collect()))
    got = cl.clean_stored(raw)
    assert key(got) == key(cl.clean(raw)) and got.count() == 34
    assert key(cl.clean_stored(make_raw(spark, rows(9)))) == key(cl.clean(make_raw(spark, rows(9))))


def test_cleaning_does_not_sort_the_rows(spark, no_estimate):
    assert "SortAggregate" not in plan(cl.clean(make_raw(spark, rows(9))))


def test_copies_are_found_by_hash_not_by_moving_rows(spark, no_estimate, tmp_path):
    make_raw(spark, rows(50)).write.parquet(str(tmp_path / "raw"))
    assert "Exchange" not in plan(cl.clean_stored(spark.read.parquet(str(tmp_path / "raw"))))


def test_long_texts_of_the_part_are_not_shuffled_with_the_line_items(spark, no_estimate):
    df = ledger_from_lineitem(spark, "/root/testdata/sf0.001")
    assert df.columns == list(RAW_COLUMNS)
    scans = plan(df)
    # the last join of the tree, at the top of its text, is that with the part
    assert scans.index("p_partkey") < scans.index("o_orderkey")


def test_last_of_equal_times_is_the_greatest(spark):
    day = datetime.date(2024, 1, 1)
    je = spark.createDataFrame([("b", "v", 1.0, day, 5), ("c", "v", 2.0, day, 5), ("a", "v", 3.0, day, 5), ("d", "v", 4.0, day, 9),
                                ("e", None, 4.0, day, 9), ("f", "w", 4.0, day, 1)], "id string, v string, x double, d date, at long")
    for ranges in (1, 3, 50):
        got = {r["id"]: (r["prev_id"], r["prev_x"]) for r in asof.asof_join(je, je, "v", "at", ["id", "x"], ranges=ranges).collect()}
        assert got == {"a": (None, None), "b": (None, None), "c": (None, None), "d": ("c", 2.0), "e": (None, None), "f": (None, None)}
        assert "SortAggregate" not in plan(asof.asof_join(je, je, "v", "at", ["id", "x"], ranges=ranges))


def test_many_trees_are_walked_quickly():
    """A tree's step costs a few nanoseconds a row; the ledger's rows pass 200 trees of 8 steps each."""
    r = np.random.default_rng(0)
    nodes = [dict(tree=t, node=n, feature=f"f{r.integers(0, 6)}" if n < 256 else None, category=None, split=float(r.random()),
                  leaf_value=int(r.integers(0, 99))) for t in range(200) for n in range(1, 512)]
    arrays = iforest.ForestArrays(nodes, [f"f{i}" for i in range(6)], ["c"], 200, 8)
    x = np.column_stack([r.random((20_000, 6)), np.full(20_000, -1.0)])
    best = []
    for _ in range(3):
        t0 = time.process_time()
        iforest.path_sums(arrays, x)
        best.append(time.process_time() - t0)
    plain = []
    for _ in range(3):                  # the unit: one step's lookups in one pass
        t0 = time.process_time()
        np.take(np.arange(200), r.integers(0, 200, (20_000, 200)))
        plain.append(time.process_time() - t0)
    assert min(best) < 8 * min(plain)
