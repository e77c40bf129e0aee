"""Suffix-array repetition, cuckoo filters and reversible line dedup."""

import random

import numpy as np
import pyarrow as pa

from ledgerscreen.llm import lines, repetition
from ledgerscreen.llm.cuckoo import CuckooFilter
from tests.llm.conftest import LINE


def test_longest_repeats_against_brute_force():
    r = random.Random(4)
    for _ in range(100):
        docs = [[r.randrange(3) for _ in range(r.randrange(25))] for _ in range(4)]
        want = []
        for d in docs:
            for i in range(len(d)):
                best = 0
                for j in range(len(d)):
                    k = 0
                    while i != j and max(i, j) + k < len(d) and d[i + k] == d[j + k]:
                        k += 1
                    best = max(best, k)
                want.append(best)
        got = repetition.longest_repeats(np.array(sum(docs, []), np.int64), np.array([len(d) for d in docs]))
        assert got.tolist() == want


def test_limits():
    lim = repetition.Limits()
    once = " ".join(f"w{i}" for i in range(400))
    twice = " ".join(f"r{i}" for i in range(51))
    m = repetition.measure(pa.array([once, f"{twice} {once} {twice}", "a b c", None]), lim)
    assert m["kept"].tolist() == [True, False, False, False]
    assert m["longest_repeat"].tolist() == [0, 51, 0, 0] and m["n_span_words"][1] == 102


def test_judge_and_keep_edge_cases(spark, edge_docs, no_docs):
    rows = repetition.judge(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[0]["n_words"] == 0 and by[0]["base_failed"] and by[4]["n_words"] == 20_000
    kept = repetition.keep(edge_docs)
    assert kept.schema == edge_docs.schema
    assert kept.count() == sum(r["kept"] for r in rows)
    assert repetition.judge(no_docs).count() == 0 and repetition.keep(no_docs).columns == edge_docs.columns


def test_cuckoo_filter_deletes_what_it_holds():
    r = np.random.default_rng(5)
    keys = np.unique(r.integers(0, 2**63, 6000, dtype=np.uint64))
    f = CuckooFilter(1000)                     # far too small: the rest overflows exactly
    f.add(keys[:4000])
    f = CuckooFilter.from_bytes(f.to_bytes())
    assert f.has(keys[:4000]).all()
    f.remove(keys[:2000])
    assert f.has(keys[2000:4000]).all()
    f.remove(keys[2000:4000])
    assert not f.table.any() and not len(f.overflow)
    f = CuckooFilter(4000)
    f.add(keys[:4000])
    assert f.has(keys[:4000]).all() and f.has(keys[4000:]).mean() < 0.01 and len(f.overflow) == 0


def test_delete_reverses_insert(spark, edge_docs):
    first = edge_docs.where("doc_id < 13")
    base = lines.insert(lines.empty_index(first), first)
    more = lines.insert(base, edge_docs)
    back = lines.delete(more, spark.createDataFrame([(13,), (14,)], "doc long"))
    view = lambda x: sorted(map(tuple, x.counts.select("k1", "k2", "n_docs", "max_doc").collect()))
    assert view(base) == view(back) != view(more)
    out = lambda i: sorted(map(str, lines.dedup(first, i).select("doc_id", "text", "n_dropped").collect()))
    assert out(base) == out(back)
    assert [r["n_docs"] for r in more.counts.where("n_docs >= 5").collect()] == [5]
    got = {r["doc_id"]: r for r in lines.dedup(edge_docs, more).collect()}
    assert got[13]["text"] == f"{LINE}\n{LINE}" and got[11]["text"] == "" and got[9]["n_dropped"] == 1
    assert got[10]["text"] == "x" and got[0]["text"] is None and got[0]["n_lines"] == 1


def test_lines_empty_table(spark, no_docs):
    index = lines.insert(lines.empty_index(no_docs), no_docs)
    assert lines.dedup(no_docs, index).count() == 0
    assert lines.delete(index, no_docs.select("doc_id")).counts.count() == 0
