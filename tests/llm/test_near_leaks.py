"""MinHash near-dedup and template decontamination."""

import os

import numpy as np
import pyarrow as pa
import pytest

from ledgerscreen.llm import minhash, templates
from ledgerscreen.llm.common import scratch
from ledgerscreen.llm.components import components
from ledgerscreen.llm.shingles import shingle_sets
from tests.llm.conftest import prose


def test_edge_cases(spark, edge_docs, no_docs):
    rows = minhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[6]["component_id"] == by[7]["component_id"] == 5 and not by[7]["kept"]
    assert by[0]["component_id"] == 0 and by[1]["component_id"] == 1 and by[2]["kept"] and by[3]["n_shingles"] == 1
    assert by[None]["kept"]
    kept = minhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert [r["doc_id"] for r in kept.where("doc_id IN (5, 6, 7, 8)").orderBy("doc_id").collect()] == [5, 8]
    assert minhash.near_duplicates(no_docs).count() == 0 and minhash.keep_one(no_docs).count() == 0


def brute(docs):
    sets = {}
    for i, t in docs:
        w = t.lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}


def test_chains_and_large_groups_are_whole(spark):
    """A chain whose ends share little, and near copies whose pairs are often below the limit."""
    words = prose(9, 400).split()
    chain = [(i, " ".join(words[12 * i:12 * i + 120])) for i in range(7)]
    r = np.random.default_rng(3)
    base = prose(10, 200).split()
    group = []
    for k in range(30):
        w = list(base)
        for at in r.choice(200, 4, replace=False):
            w[at] = f"new{k}x{at}"
        group.append((100 + k, " ".join(w)))
    docs = spark.createDataFrame(chain + group, "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(docs).collect()}
    assert got == brute(chain + group)


def test_rows_that_share_an_id(spark):
    a, b = prose(21, 60), prose(22, 60)
    near = b + " more"
    rows = [(1, a), (1, b), (2, near), (3, a), (4, near)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 1)]


def test_groups_with_groups_inside(spark):
    """Copies of edited copies: members far from the first hub still find each other."""
    r = np.random.default_rng(11)
    base = prose(30, 150).split()
    docs, n = [], 0
    for branch in range(3):
        w = list(base)
        for at in r.choice(150, 8, replace=False):
            w[at] = f"b{branch}x{at}"
        for leaf in range(8):
            v = list(w)
            for at in r.choice(150, 3, replace=False):
                v[at] = f"l{branch}x{leaf}x{at}"
            if leaf % 4 == 0:
                del v[10:14]
            docs.append((n, " ".join(v)))
            n += 1
    got = {x["doc_id"]: x["component_id"] for x in
           minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs) and len(set(got.values())) > 1


def test_no_large_bucket_is_given_up(spark):
    """Linked documents that share a band end in one component, also when their hub heads their bucket twice."""
    r = np.random.default_rng(193)
    bases = [prose(193, 100).split()]
    edited = []
    for name, n, most in (("g", 5, 5), ("l", 29, 4)):
        for k in range(n):
            w = list(bases[r.integers(len(bases))])
            for at in r.choice(100, r.integers(1, most), replace=False):
                w[at] = f"{name}{k}x{at}"
            (bases if name == "g" else edited).append(w)
    docs = [(k, " ".join(w)) for k, w in enumerate(edited)]
    scheme = minhash.Scheme(bands=8, few=2, most=2)
    counts, values = shingle_sets(pa.array([t for _, t in docs]), scheme.width)
    bands = minhash.signatures(values, counts, scheme).reshape(len(docs), scheme.bands, scheme.rows)
    cut = np.split(values, np.cumsum(counts)[:-1])
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(
        spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), scheme=scheme).collect()}
    linked = 0
    for a in range(len(docs)):
        for b in range(a):
            both = len(np.intersect1d(cut[a], cut[b]))
            if (bands[a] == bands[b]).all(axis=1).any() and 100 * both >= 75 * (counts[a] + counts[b] - both):
                linked += 1
                assert got[a] == got[b], (a, b)
    assert linked == 14


def test_least_matches_never_prune_at_the_threshold():
    s = minhash.Scheme()
    r = np.random.default_rng(1)
    equal = r.random((20_000, s.hashes)) < 0.75
    for n, m in minhash.least_matches(s):
        assert 0 < m < n and (equal[:, :n].sum(axis=1) < m).mean() < 1e-3


def test_components(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(100, 101), (101, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


QUESTION = "A train leaves with Alice and travels 120 km in 3 hours, then Alice waits until noon before she goes back home."


def test_re_parameterised_questions(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, QUESTION), (2, None), (3, "three words only")], "item_id long, text string")
    same = QUESTION.replace("Alice", "Boris").replace("120", "75").replace("3 hours", "2 minutes")
    mixed = QUESTION.replace("Alice", "Boris", 1)
    docs = spark.createDataFrame([(1, "x " + QUESTION.upper()), (2, f"Well. {same}"), (3, mixed), (4, "nothing"), (5, None),
                                  (None, QUESTION), (6, f"before {QUESTION} behind")], "doc_id long, text string")
    got = {r["doc_id"]: r["verbatim"] for r in templates.leaks(docs, items).collect()}
    assert got == {2: False, 6: True}       # 3 gives one slot two values; 1 has no names, so no slots agree
    assert sorted(str(r["doc_id"]) for r in templates.clean(docs, items).collect()) == ["1", "3", "4", "5", "None"]
    assert templates.leaks(edge_docs, items).count() == 0
    assert templates.leaks(no_docs, items).count() == 0 and templates.leaks(edge_docs, items.limit(0)).count() == 0
    assert templates.clean(edge_docs, items).columns == edge_docs.columns


def test_items_dense_in_slots_and_slots_outside_windows(spark):
    """Exact copies of items with few literal words; a copied beginning whose document goes on with
    other values; names behind a line break."""
    dense = ["Compute 12 * 34 - 5 and then 17 + 8 - 3 before 9 / 3 + 4", "3 km 5 km 7 km 9 km 11 km", "Add 10 and 20 to 30 in 5 days"]
    start = " ".join(f"w{chr(97 + k)}" for k in range(14))
    long = f"{start} asks Alice for 5 km of wire and then later rests alone there near old Alice and her 7 dogs in town"
    items = spark.createDataFrame([*enumerate(dense), (9, long)], "item_id long, text string")
    other = f"{start} asks Alice for 5 km of wire and then never sleeps again here under tall Boris and his 8 cats in Rome"
    docs = spark.createDataFrame([*((k, f"so {t}, they say") for k, t in enumerate(dense)), (3, other), (4, long.replace(" ", "\n")),
                                  (5, "Compute 12 * 34 - 6 and then 17 + 8"), (6, "3 km 5 km 7 km"),
                                  (7, dense[0].replace(" ", " \t "))], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["verbatim"] for r in templates.leaks(docs, items).collect()}
    assert got == {(0, 0): True, (1, 1): True, (2, 2): True, (3, 9): True, (4, 9): True, (7, 0): True}


def test_blocks_against_every_pair():
    """Exact links of a block, over pieces of more shingles than one product takes."""
    import numpy as np
    r = np.random.default_rng(11)
    base = np.unique(r.integers(0, 2 ** 60, 6_000).astype(np.uint64))
    sets = [base[r.random(len(base)) < p] for p in (0.95, 0.9, 0.5, 0.45, 0.93, 0.2)]
    sets += [np.concatenate([base[:40], r.integers(0, 2 ** 60, k).astype(np.uint64)]) for k in (2, 8, 13, 14, 40)]
    sets = [np.unique(x) for x in sets]
    want = np.arange(len(sets))
    for _ in sets:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                both = len(np.intersect1d(x, y))
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    want[i] = want[j] = min(want[i], want[j])
    assert (minhash.linked_together(sets, 75) == want).all() and len(set(want)) > 3


def linked_family(r, n, edits, base):
    out = []
    for _ in range(n):
        words = list(base)
        for at in r.sample(range(len(words)), edits):
            words[at] = f"e{r.randrange(10 ** 9)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("scheme", [minhash.Scheme(), minhash.Scheme(few=3, most=30)])
def test_families_without_a_centre(spark, scheme):
    """Families whose members are linked with some others only, two of them joined by one
    document, and a near copy without an id."""
    import random
    r = random.Random(12)
    one, two = ([f"{x}{k}" for k in range(120)] for x in "pq")
    texts = linked_family(r, 25, 2, one) + linked_family(r, 30, 3, two) + linked_family(r, 15, 1, two[:60] + one[:60])
    rows = list(enumerate(texts)) + [(None, " ".join(one[:60] + ["changed"] + one[61:])), (900, " ".join(one))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [{tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if 100 * both >= 75 * (len(x) + len(sets[j]) - both):
                label[root(i)] = root(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[root(k)] = min(least.get(root(k), d), d)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, scheme=scheme).collect()}
    assert got == {d: least.get(root(k)) for k, (d, _) in enumerate(rows)}
    assert got[None] is not None


def test_near_dedup_leaves_one_table_and_no_shuffled_texts(spark):
    """Ids of dropped rows are broadcast; before, the texts were shuffled and all tables stayed."""
    docs = spark.createDataFrame([(k, prose(k // 2, 60), "x") for k in range(30)], "doc_id long, text string, lang string")
    items = spark.createDataFrame([(1, prose(0, 40))], "item_id long, text string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with scratch(spark) as tables:
            kept = minhash.keep_one(docs)
            there = [p for p in tables if os.path.exists(p.removeprefix("file:"))]
            assert len(there) == 1 and "-verdict-" in there[0]
            assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
            assert sorted(r["doc_id"] for r in kept.collect()) == list(range(0, 30, 2))
        clean = templates.clean(docs, items)
        assert "SortMergeJoin" not in clean._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["doc_id"] for r in clean.collect()) == list(range(2, 30))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
