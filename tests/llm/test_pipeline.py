"""The five stages against a plain Python version on the small tables."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd

import corpus_pipeline
from ledgerscreen.llm import queries
from tests.llm.test_near_leaks import brute
from tests.llm.test_tokens import WORD, truth

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def good(text):
    w = WORDS.findall(text or "")

    def cover(k):
        grams = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
        n = Counter(grams)
        return len({i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(k)})
    return len(w) >= 10 and 100 * cover(5) <= 20 * len(w) and 100 * cover(10) <= 15 * len(w) and not cover(51)


def without_common_lines(docs):
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate(LOW)
    holders = defaultdict(set)
    for i, t in docs.items():
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                holders[key(x)].add(i)
    return {i: "\n".join(x for x in (t or "").split("\n") if len(holders.get(key(x), ())) < 5 or i == max(holders[key(x)]))
            for i, t in docs.items()}


def test_pipeline_against_plain_python(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    docs = without_common_lines({i: t for i, t in docs.items() if good(t)})
    words = {i: WORDS.findall(t.translate(LOW)) for i, t in docs.items()}
    group = brute([(i, " ".join(w)) for i, w in words.items() if len(w) >= 5])
    docs = {i: t for i, t in docs.items() if group.get(i, i) == i}
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": list(docs), "text": list(docs.values())}))
    con.sql(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    leaked = {r[0] for r in con.sql(queries.ORACLE["op8_template_leaks"]).fetchall()}
    want = dict(truth(WORD, 1, [(i, t) for i, t in docs.items() if i not in leaked]))
    assert leaked and len(want) < 200

    rows = corpus_pipeline.run(spark, SF).collect()
    seen, sequences = Counter(), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        ids = want[r["doc_id"]]
        assert r["start"] == seen[r["doc_id"]] and r["doc_tokens"] == len(ids)
        assert zlib.crc32(ids[r["start"]:r["start"] + r["length"]]) == r["ids_crc32"]
        seen[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert seen == {i: len(x) for i, x in want.items()}
    for s, parts in sequences.items():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        assert sum(n for _, n in parts) == 2048 or s == max(sequences)


def test_stages_on_edge_cases(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            docs = spark.createDataFrame(out.collect(), docs.schema)
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0) == (docs.count() > 0)


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "pack"]


def test_scratch_tables_go_with_their_block(spark):
    import os

    from ledgerscreen.llm import common
    with common.scratch(spark) as tables:
        gone, kept = common.written(spark.range(3), "a"), common.written(spark.range(4), "b")
        assert gone.count() == 3
        paths = list(tables)
        tables.pop()
    there = [os.path.exists(x.removeprefix("file:")) for x in paths]
    assert there == [False, True] and kept.count() == 4 and not common._watched
