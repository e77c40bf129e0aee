"""Curriculum mix and divergence audit against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerscreen.llm import curriculum, divergence, running
from tests.llm.conftest import prose

MIX = curriculum.Mix()


@pytest.fixture(scope="module")
def mixed_docs(spark):
    """Five sources of unequal size, one null, one without a word, a repeated row, nulls."""
    rows = [(k, prose(k, 5 + k % 60), None if k % 9 == 0 else f"s{min(k % 11, 4)}") for k in range(300)]
    rows += [(7, None, "s1"), (None, "a b c", "s2"), (None, None, None), (900, "", "empty"), (900, "", "empty"), (901, prose(1, 5_000), "z")]
    return spark.createDataFrame([(*x, 5, 1, "own") for x in rows], "doc_id long, text string, source string, row_id int, size int, place string")


def area(knots, until=1.0):
    total = 0.0
    for (t, w), (u, v) in zip(knots, knots[1:]):
        end = min(u, until)
        if end > t:
            at = w + (v - w) * (end - t) / (u - t)
            total += (w + at) / 2 * (end - t)
    return total


def test_targets_and_positions(spark, mixed_docs):
    sizes = defaultdict(int)
    rows = [(r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in mixed_docs.collect()]
    for _, source, n in rows:
        sizes[source] += n
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: MIX.weights[k % 3] for k, s in enumerate(order)}
    free, goal, left = set(order), {}, MIX.share * sum(sizes.values())
    while free:
        over = {s for s in free if left * weight[s] / sum(weight[x] for x in free) >= 2 * sizes[s]}
        if not over:
            break
        goal |= {s: 2 * sizes[s] for s in over}
        free, left = free - over, left - sum(2 * sizes[s] for s in over)
    goal |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    documents, mixed = curriculum.occurrences(mixed_docs)
    for r in documents.select("source", "target", "source_size").distinct().collect():
        assert r.target == pytest.approx(goal[r.source]) and r.source_size == sizes[r.source]
    assert documents.count() == len(rows)
    taken = {r.source: r.words for r in mixed.groupBy("source").agg(F.sum("words").alias("words")).collect()}
    assert taken == {s: int(goal[s]) for s in order if int(goal[s])}

    want = []
    for s in order:
        at = 0
        mine = sorted((hashlib.md5(f"13:{d}".encode() if d is not None else b"13").hexdigest(), d is None, d or 0, n)
                      for d, x, n in rows if x == s)
        for epoch in range(2):
            for place, none, d, n in mine:
                words = min(n, int(goal[s]) - at)
                if words > 0:
                    want.append(((at + words / 2) / int(goal[s]), s, None if none else d, epoch, words))
                at += n
    got = mixed.orderBy("first_word").collect()
    assert [r.position for r in got] == sorted(r.position for r in got) and len(got) == len(want)
    assert Counter((r.source, r.id, r.epoch, r.words) for r in got) == Counter(w[1:] for w in want)
    where = {(w[1:]): w[0] for w in want}
    before = 0
    for r in got:                                   # the schedule's integral up to a position is the demand there
        knots = MIX.schedules[order.index(r.source) % 3]
        assert area(knots, r.position) / area(knots) == pytest.approx(where[r.source, r.id, r.epoch, r.words], abs=1e-9)
        assert r.first_word == before
        before += r.words


def test_mix_is_the_same_in_other_partitions(spark, mixed_docs):
    take = lambda df: sorted(map(str, curriculum.mixture(df).collect()))
    assert take(mixed_docs) == take(mixed_docs.repartition(13))


def test_empty_mix(spark, mixed_docs):
    assert curriculum.mixture(mixed_docs.limit(0)).count() == 0
    none = curriculum.mixture(mixed_docs.where("source = 'empty'")).collect()
    assert [(r.size, r.target, r.taken) for r in none] == [(0, 0.0, 0)] * 2


def test_running_sums_over_ranges(spark):
    df = spark.range(5_000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 7 > 0, F.col("id").cast("string"))
                                   .alias("k"), "id", (F.col("id") % 5).alias("v"))
    got = running.running(df, "k", [F.col("id").desc()], "v", "before").collect()
    sums = defaultdict(int)
    for r in sorted(got, key=lambda r: -r.id):
        assert r.before == sums[r.k]
        sums[r.k] += r.v
    assert len({r.row_id for r in got}) == 5_000


@pytest.fixture(scope="module")
def audited_docs(spark):
    """70 sources in one language (three column blocks), one in another, nulls, no letters."""
    rows = [(k, prose(k, 30) + " Größe" * (k % 4), "xx", f"s{k % 70}") for k in range(350)]
    rows += [(k, prose(k, 9).upper(), "yy", "only") for k in range(20)] + [(1, None, None, None), (2, "12 34", "", "s"), (2, "12 34", "", "s")]
    return spark.createDataFrame([(*x, 1, "own") for x in rows], "doc_id long, text string, lang string, source string, n int, term string")


def plain(docs, a: divergence.Audit):
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for r in docs:
        g = (r.lang or "", r.source or "")
        groups.add(g)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        counts[g].update(words)
        seen[g[0]].update(set(words))
    kept = {lang: [t for t, n in c.items() if n >= a.least_documents] for lang, c in seen.items()}
    return counts, groups, kept


def test_audit_against_plain_python(spark, audited_docs):
    a = divergence.Audit(least_documents=3, top=4)
    counts, groups, kept = plain(audited_docs.collect(), a)
    rate = lambda c, n, v: 1 + a.scale * (c + a.prior) // (n + a.prior * v)
    p = {}
    for g in groups:
        terms = kept.get(g[0], [])
        n = sum(counts[g][t] for t in terms)
        p[g] = {t: rate(counts[g][t], n, len(terms)) for t in terms}
    want = []
    for g in groups:
        near = sorted((-sum(abs(p[g][t] - p[h][t]) for t in p[g]), h[1].encode(), h[1]) for h in groups if h[0] == g[0] and h != g)
        want += [(*g, "pair", item, -value, k) for k, (value, _, item) in enumerate(near, 1)]
        terms = kept.get(g[0], [])
        all_ = Counter({t: sum(counts[h][t] for h in groups if h[0] == g[0]) for t in terms})
        over = sorted((-(p[g][t] - rate(all_[t], sum(all_.values()), len(terms))), t.encode(), t) for t in terms if counts[g][t])
        want += [(*g, "term", t, -value, k) for k, (value, _, t) in enumerate([x for x in over if x[0] < 0][:a.top], 1)]
    assert sorted(map(tuple, divergence.audit(audited_docs, a).collect())) == sorted(want)


def test_joint_tables(spark, audited_docs):
    a = divergence.Audit(least_documents=3)
    counts, groups, kept = plain(audited_docs.collect(), a)
    t = divergence.tables(audited_docs, a)
    name = {(r.lang, r.number): r.source for r in t.groups.collect()}
    got = Counter()
    for r in divergence.joint_tables(t).collect():
        got[r.lang, name[r.lang, r.a], name[r.lang, r.b], r.n_a, r.n_b] += r.terms
    want = Counter()
    for lang in {g[0] for g in groups}:
        sources = sorted(s for x, s in groups if x == lang)
        for i, x in enumerate(sources):
            for y in sources[i + 1:]:
                for term in kept.get(lang, []):
                    want[lang, x, y, counts[lang, x][term], counts[lang, y][term]] += 1
    assert got == want                              # a Counter's zeros don't count


def test_empty_audit(spark, audited_docs):
    assert divergence.audit(audited_docs.limit(0)).count() == 0
