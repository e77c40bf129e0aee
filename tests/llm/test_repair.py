"""Conversation repair: against every possible edit, against SQL, and cut into small stretches."""

import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerscreen.llm import queries, repair, transfer
from tests.llm.conftest import same

SCHEMA = "conv_id long, turn long, role string, text string, conv string, number int, costs double, start string"


def every_repair(letters: str) -> tuple[int, str]:
    """Least (cost, audit) over all edits with up to two insertions at each place."""
    inserted = [("", "", 0), ("I", "u", 2), ("I", "a", 2), ("II", "ua", 4), ("II", "au", 4)]
    options = []
    for x in letters:
        kind, fault = divmod(transfer.LETTERS.index(x), 3)
        kept = [] if fault == 2 else [("K", "sua?"[kind], fault), ("R", "u", 2 + fault), ("R", "a", 2 + fault)]
        options.append([(i[0] + e[0], i[1] + e[1], i[2] + e[2]) for i in inserted for e in [("D", "", 3), *kept]])
    found = []
    for edits in itertools.product(*options, inserted):
        roles = "".join(e[1] for e in edits)
        body = roles[1:] if roles[:1] == "s" else roles
        if not roles or (body and len(body) % 2 == 0 and body == "ua" * (len(body) // 2)):
            found.append((sum(e[2] for e in edits), "".join(e[0] for e in edits)))
    return min(found)


def whole(grammar: transfer.Grammar, letters: str) -> tuple[int, str]:
    m = grammar.matrix(letters)
    costs, ranks = transfer.ranked(m)
    end = transfer.last_state(costs, ranks)
    return costs[end] + 2 * len(transfer.TAIL[end]), str(m[0, end][1]) + transfer.TAIL[end]


def test_matrices_against_every_edit():
    r = random.Random(5)
    grammar = transfer.Grammar()
    assert grammar.add([(3, 6), (6, 3), (0, 3), (9, 9)]) == 2          # the others could overlap the first
    assert grammar.add([(12, 12), (12, 3)]) == 1
    for n in (1, 1, 2, 2, 3, 3, 3):
        for _ in range(25):
            letters = "".join(r.choice(transfer.LETTERS) for _ in range(n))
            assert whole(grammar, letters) == whole(transfer.Grammar(), letters) == every_repair(letters)


def test_ranks_stand_for_strings():
    r = random.Random(6)
    grammar = transfer.Grammar()
    for _ in range(200):
        letters = "".join(r.choice("dgdgdgabehicjk") for _ in range(r.randrange(4, 60)))
        cuts = [0, *sorted(r.sample(range(1, len(letters)), 3)), len(letters)]
        parts = [grammar.matrix(letters[a:b]) for a, b in zip(cuts, cuts[1:])]
        small = [transfer.from_ranks(*transfer.ranked(m)) for m in parts]
        product = small[0]
        for m in small[1:]:
            product = transfer.times(product, m)
        costs, ranks = transfer.ranked(product)
        end = transfer.last_state(costs, ranks)
        states = transfer.path(small, 0, end)
        audit = "".join(str(m[x][1]) for m, x in zip(parts, zip(states, states[1:]))) + transfer.TAIL[end]
        assert (costs[end] + 2 * len(transfer.TAIL[end]), audit) == whole(grammar, letters)


def test_ropes_compare_as_strings():
    r = random.Random(7)

    def rope(text):
        if len(text) < 3 or r.random() < 0.1:
            return transfer.Rope(text)
        k = r.randrange(1, len(text))
        return rope(text[:k]) + rope(text[k:])

    for _ in range(500):
        a = "".join(r.choice("KD") for _ in range(r.randrange(40)))
        b = a[:r.randrange(len(a) + 1)] + "".join(r.choice("KD") for _ in range(r.randrange(6)))
        assert str(rope(a)) == a and (rope(a) < rope(b)) == (a < b)


@pytest.fixture(scope="module")
def talks(spark):
    """Nulls in every column, unknown and odd roles, equal turns, repeated rows, a long
    conversation, a very long text, and clashing further columns."""
    r = random.Random(8)
    texts = ["Why?", "So it is.", "no end", "", " \t", "yes.  \n", "Ja, ärgerlich!", "x" * 50_000 + "."]
    roles = ["user", "assistant", "system", "tool", "", "User", "umpire", None]
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Why?"), (1, 2, "assistant", "So."), (2, None, "user", None),
            (2, None, "user", "Why?"), (2, 3, "user", "Why?"), (2, 9, None, "So."), (3, 5, "assistant", "So."), (None, 1, "user", "Hm?"),
            (None, None, None, None), (4, 1, "user", "Why?"), (4, 1, "user", "Why?"), (4, 1, "user", "Why?"), (5, 0, "user", "")]
    rows += [(6, k // 3, r.choice(roles[:3]), r.choice(texts) + str(k % 90) * (k % 3)) for k in range(400)]
    rows += [(c, r.randrange(8), r.choice(roles), r.choice(texts)) for c in range(10, 90) for _ in range(r.randrange(9))]
    return spark.createDataFrame([(*x, "own", 3, 0.5, "z") for x in rows], SCHEMA)


def test_query_on_edge_cases(spark, talks, tmp_path):
    talks.write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    got = queries.op11_grammar_repair(spark, str(tmp_path)).toPandas()
    whole = lambda df: df.astype({"conv_id": "Int64"})
    same(whole(got), whole(con.sql(queries.ORACLE["op11_grammar_repair"]).df()))
    assert got.conv_id.isna().sum() == 1 and len(got) == talks.select("conv_id").distinct().count()


def collected(found: repair.Repaired):
    audits = {}
    for x in found.audits.orderBy("number").collect():
        audits[x.conv] = audits.get(x.conv, "") + x.audit
    turns = {}
    for x in found.turns.orderBy("conv", "range", "stretch", "slot").collect():
        turns.setdefault(x.conv, []).append((x.edit, x.role, x.text))
    return {tuple(x) for x in found.summary.collect()}, audits, turns


def test_stretches_do_not_change_the_result(spark, talks):
    one, many = repair.repair(talks), repair.repair(talks, stretch=4, fan=3)
    assert many.audits.groupBy("conv").count().agg(F.max("count")).first()[0] > 9          # three levels of the tree
    assert collected(one) == collected(many)
    for conv, turns in collected(one)[2].items():
        roles = "".join(t[1][0] for t in turns)
        body = roles[roles[:1] == "s":]
        assert body and body == "ua" * (len(body) // 2), conv


def test_empty_table(spark, talks, tmp_path):
    talks.limit(0).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op11_grammar_repair(spark, str(tmp_path)).count() == 0
