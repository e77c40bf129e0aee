"""Language identification, language model, page text and transcripts."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerscreen.llm import hpylm, langid, queries, seating, styletree, transcripts
from ledgerscreen.llm.dom import blocks
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"


def test_langid_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op3_ftrl_langid"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    held = [d for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2 and d["lang"]]
    assert {d["doc_id"] for d in docs if got[d["doc_id"]]["held_out"]} >= {d["doc_id"] for d in held}
    assert np.mean([got[d["doc_id"]]["lang_pred"] == d["lang"] for d in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_langid_edge_cases(spark, edge_docs, no_docs):
    model = langid.train(edge_docs, s=langid.Settings(sample=4, features=256))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(edge_docs, model, s=langid.Settings(features=256)).collect()}
    assert got[0] == got[1] == got[2] == ("und", 0.0) and got[4][0] == "xx" and len(got) == 16
    none = langid.train(no_docs)
    assert {r["lang_pred"] for r in langid.predict(edge_docs, none).collect()} == {"und"}
    assert langid.predict(no_docs, model).count() == 0


def test_langid_draws_different_texts(spark):
    rows = spark.createDataFrame([("en", "the same text")] * 3000 + [("en", f"text {k}") for k in range(1000)]
                                 + [("fr", "un texte")] * 50, "label string, text string")
    per = langid.texts_per_label(rows)
    got = langid.drawn(rows, per, 40).collect()
    assert len({(r["label"], r["text"]) for r in got}) == len(got) == 41
    assert sorted(map(tuple, got)) == sorted(map(tuple, langid.drawn(rows.repartition(7), per, 40).collect()))
    assert {r["text"] for r in got if r["label"] == "fr"} == {"un texte"}


def test_ftrl_against_plain_python():
    """The weights of two labels, coordinate by coordinate."""
    s = langid.Settings(features=6, epochs=3, alpha=0.7, beta=0.9, l1=0.05, l2=0.1, calibrate_every=10 ** 9)
    r = random.Random(4)
    rows = [(sorted(r.sample(range(6), 3)), [r.uniform(-1, 1) for _ in range(3)], r.randrange(2)) for _ in range(40)]
    w, t = langid.learn([(np.array(f), np.array(v), y) for f, v, y in rows], 2, s)
    z, n = [[0.0, 0.0] for _ in range(7)], [[0.0, 0.0] for _ in range(7)]

    def weight(i, y):
        l1 = 0 if i == 6 else s.l1
        if abs(z[i][y]) <= l1:
            return 0.0
        return -(z[i][y] - math.copysign(l1, z[i][y])) / ((s.beta + math.sqrt(n[i][y])) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for f, v, y in rows:
            f, v = [*f, 6], [*v, 1.0]
            before = [[weight(i, c) for c in (0, 1)] for i in f]
            e = [math.exp(sum(x * b[c] for x, b in zip(v, before))) for c in (0, 1)]
            for c in (0, 1):
                for i, x, b in zip(f, v, before):
                    g = x * (e[c] / sum(e) - (c == y))
                    z[i][c] += g - (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / s.alpha * b[c]
                    n[i][c] += g * g
    assert t == 1.0 and np.allclose(w, [[weight(i, c) for c in (0, 1)] for i in range(7)], atol=1e-12)


def test_table_counts_are_bounded_and_repeatable():
    n = np.array([0, 1, 2, 3, 50, 4000, 3_000_000])
    keys = np.arange(7, dtype=np.uint64)
    for weight in (1e-12, 0.5, 1e9):
        runs = [seating.tables(n, np.full(7, weight), keys, 0.7, 5).tolist() for _ in range(2)]
        assert runs[0] == runs[1] and runs[0][:2] == [0, 1]
        assert all(1 <= k <= m for k, m in zip(runs[0][1:], n[1:]))
    # a dish's draw doesn't hang on the dishes around it
    assert seating.tables(n[::-1], np.full(7, 0.5), keys[::-1], 0.7, 5)[::-1].tolist() == \
        seating.tables(n, np.full(7, 0.5), keys, 0.7, 5).tolist()
    # two customers of a dish: a second table has weight 0.6 against 1 - 0.7
    pairs = seating.tables(np.full(20_000, 2), np.full(20_000, 0.6), np.arange(20_000, dtype=np.uint64), 0.7, 1)
    assert abs((pairs == 2).mean() - 0.6 / 0.9) < 0.02
    assert seating.tables(np.empty(0, np.int64), np.empty(0), np.empty(0, np.uint64), 0.5, 0).tolist() == []


def table_moments(n, weight, d, most):
    """Mean and spread of k under weight^k S(n, k), by the plain recursion over customers."""
    row, k = np.full(most + 1, -np.inf), np.arange(1, most + 1)
    row[0] = 0.0
    for m in range(n):
        stay = np.where(m - d * k > 0, np.log(np.maximum(m - d * k, 1e-300)), -np.inf) + row[1:]
        row = np.concatenate([[-np.inf], np.logaddexp(row[:-1], stay)])
    x = row[1:] + k * math.log(weight)
    x = np.exp(x - x.max())
    x /= x.sum()
    assert x[-1] < 1e-6 or most >= n
    mean = (x * k).sum()
    return mean, math.sqrt((x * k * k).sum() - mean ** 2)


@pytest.mark.parametrize("n, weight, most", [(10, 1.0, 10), (100, 2.0, 100), (256, 300.0, 256), (257, 40.0, 257), (300, 60.0, 300),
                                             (1_000, 5.0, 200), (1_000, 200.0, 1_000), (10_000, 5.0, 200),
                                             (10_000, 300.0, 1_500), (10_000, 1_000.0, 2_500), (100_000, 20.0, 200)])
@pytest.mark.parametrize("discount", [0.5, 0.8])
def test_table_counts_follow_their_law(n, weight, most, discount):
    mean, spread = table_moments(n, weight, discount, most)
    got = seating.tables(np.full(10_000, n), np.full(10_000, weight), np.arange(10_000, dtype=np.uint64), discount, 2)
    assert abs(got.mean() / mean - 1) < 0.04
    assert abs(got.std() / spread - 1) < 0.06


def test_language_model_contract_and_sum(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in queries.QUERIES["op6_pitman_yor"](spark, sf).collect()}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tok = {r["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(low)) + [""]
           for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tok}
    c = Counter(w for i in tok if not held[i] for w in tok[i])
    n, v = sum(c.values()), len(c)
    for i, t in tok.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(t), n)
        assert r["n_known"] == sum(w in c for w in t)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
    out = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_predictive_probabilities_sum_to_one(spark):
    """All next words of one context, scored as tokens of one bucket after another."""
    r = random.Random(2)
    train = [(k, " ".join(r.choice("abcdefgh") for _ in range(30)), False) for k in range(20)]
    docs = spark.createDataFrame(train, "id long, text string, held boolean")
    s = hpylm.Settings(least_buckets=4, frequent=5)
    freq, _ = hpylm.frequent_words(docs, s)
    g = hpylm.totals(hpylm.dealt(docs, freq, 4, s, True), freq, 4, s)
    hot_keys = hpylm.hashes(sorted(freq, key=freq.get))
    hot_root = np.array([hpylm.root_tables(g.hot_customers[k], hot_keys, s.discount[0], k, s) for k in range(s.samples)])
    every = spark.createDataFrame(train + [(100 + k, f"c {w}", True) for k, w in enumerate([*"abcdefgh", "zz", ""])],
                                  "id long, text string, held boolean")
    total, seen = 0.0, set()
    for group in hpylm.dealt(every, freq, 4, s, False).toPandas().groupby("bucket"):
        b = hpylm.Bucket(group[1]["held"].to_numpy(), group[1]["blob"], freq, s, 4)
        _, _, own = hpylm.token_scores(b, g, hot_root)
        cls = {}
        for w, c, p, part in zip(b.word, b.cls, own, b.part):
            if bool(group[1]["held"].iloc[part]) and c == context(freq, s, "c"):
                cls[b.names[w]] = 10 ** p
        total += sum(cls.values())
        seen |= set(cls)
    assert seen == {*"abcdefgh", "zz", ""}
    assert abs(total - 1) < 1e-9


def test_frequent_words_read_the_texts_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def passed(x):
        seen.add(1)
        return x

    docs = spark.createDataFrame([(k, f"the w{k}") for k in range(40)], "id long, text string")
    freq, n = hpylm.frequent_words(docs.select("id", passed("text").alias("text")), hpylm.Settings(frequent=4))
    assert (freq, n, seen.value) == ({"": 0, "the": 1}, 120, 40)


def test_tokens_in_order():
    r = np.random.default_rng(1)
    for bounds in ((6, 50, 1000), (1 << 20, 1 << 30, 1 << 40)):          # one number, and too large for one
        columns = [(r.integers(0, min(b, 40), 500), b) for b in bounds]
        order = np.lexsort([c for c, _ in reversed(columns)])
        for got, (c, _) in zip(hpylm.in_order(*columns), columns):
            assert (got == c[order]).all()


def test_every_context_has_its_own_restaurant(spark):
    """Also words whose hashes agree modulo some tens of thousands, and with buckets that hold no training tokens."""
    words = [f"w{k}" for k in range(2_000)]
    docs = spark.createDataFrame([(k, f"{w} x {w} y{k % 7}", k % 5 == 4) for k, w in enumerate(words)], "id long, text string, held boolean")
    s = hpylm.Settings()
    freq, _ = hpylm.frequent_words(docs, s)
    g = hpylm.totals(hpylm.dealt(docs, freq, 64, s, True), freq, 64, s)
    customers, tables = g.seats(np.array([context(freq, s, w) for w in words]))
    assert customers.tolist() == [0 if k % 5 == 4 else 2 for k in range(2_000)]
    assert (tables <= customers).all() and (tables >= np.minimum(customers, 1)).all()
    assert g.seats(np.array([context(freq, s, "x")]))[0].tolist() == [1_600]


def context(freq, s, word):
    h = hpylm.hashes([word])
    return freq[word] if word in freq else len(freq) + int(h[0] % np.uint64(s.classes - len(freq)))


def test_language_model_edge_cases(spark, edge_docs, no_docs):
    held = F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False))
    rows = hpylm.score(edge_docs, held).collect()
    assert len(rows) == edge_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[0]["n_tokens"] == by[1]["n_tokens"] == 1 and by[4]["n_tokens"] == 20_001
    assert all(math.isfinite(r["score"]) for r in rows)
    assert hpylm.score(no_docs, F.lit(False)).count() == 0
    alone = hpylm.score(edge_docs, F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and math.isclose(r["score"], 0, abs_tol=1e-9) for r in alone)


PAGE = ("<html><head><title>T</title><style>p{}</style></head><body><header>Top</header><nav><ul><li>A<li>B</ul></nav>"
        "<div class='cookie-notice'>We use cookies</div>%s<aside>Side</aside><form><input>Send</form>"
        "<div id=comments><p>First!</p></div><footer>&copy; x</footer></body></html>")


def test_main_text(spark):
    article = ("<article><h1>Title &amp; more</h1><p>One <b>two\n three<br><p>Four&nbsp;five<script>no()</script>"
               "<div class='share'>Share</div><table><tr><td>a<td>b</table>&lt;x&gt; 3 < 4</article>")
    same = "<div><p>Subscribe to our letter.</p></div>"
    rows = [(1, "http://a.org/1", PAGE % article), (2, None, None), (3, "::bad::[", ""), (4, "http://a.org/2", "plain <3 text")]
    rows += [(10 + k, "http://b.org/x", f"<body>{same}<div class=body><p>{prose(k, 30)}</p></div></body>") for k in range(30)]
    rows += [(50, "http://b.org/copy", rows[-1][2])] * 2
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, row int")
    got = [(r["page_id"], r["text"]) for r in styletree.main_text(pages).collect()]
    by = dict(got)
    assert len(got) == len(rows)
    assert by[1] == "Title & more One two three Four five a b <x> 3 < 4"
    assert by[2] == by[3] == "" and by[4] == "plain <3 text"
    assert all(by[10 + k] == prose(k, 30) for k in range(30)) and by[50] == prose(29, 30)
    assert styletree.main_text(pages.limit(0)).count() == 0


def test_what_classes_say_about_a_page(spark):
    text, other = prose(70, 40), prose(71, 12)
    rows = [f"<body class='right-sidebar'><article><p>{text}</p></article></body>",
            f"<article class='post comments-open'><p>{text}</p></article>",
            f"<div class='entry-content'><p>{text}</p></div><article class='comment'><p>{other}</p></article>",
            f"<div class='post has-sidebar'><p>{text}</p><div class='sidebar-right'>{other}</div></div>",
            f"<main class=search-page><p>{text}</p></main><div id=comments><article>{other}</article></div>",
            f"<div><p>{text}</p></div><aside><article>{other}</article></aside>"]
    pages = spark.createDataFrame([(k, f"http://h{k}.org", h) for k, h in enumerate(rows)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in styletree.main_text(pages).collect()} == {k: text for k in range(len(rows))}
    beside = spark.createDataFrame([(0, "http://x.org", f"<div><p>{text}</p></div><article><h2>{other}</h2></article>")],
                                   "page_id long, url string, html string")
    assert styletree.main_text(beside).first()["text"] == f"{text} {other}"


def plain_tree(pages, w=styletree.Weights()):
    """Texts of (host, html) pages by the tree's definition, page by page."""
    parsed = [(h, blocks(t)) for h, t in pages]
    whole = ["\n".join(b.text for b in bs if not b.boiler) for _, bs in parsed]
    at, on, looks = {}, {}, {}
    for (h, bs), page in zip(parsed, whole):
        for b in bs:
            at.setdefault((h, b.path), set()).add(page)
            on.setdefault((h, b.path, b.text, b.parent), set()).add(page)
            looks.setdefault((h, b.parent), {}).setdefault(tuple(b.holder.children), set()).add(page)
    out = []
    for h, bs in parsed:
        stay, rest = [], []
        has_main = any(b.main and not b.boiler for b in bs)
        for b in bs:
            p = 0.0 if b.boiler else 0.8 if b.main else 0.2 if has_main else 0.5
            k, m = len(on[h, b.path, b.text, b.parent]), len(at[h, b.path])
            counts = [len(x) for x in looks[h, b.parent].values()]
            t = sum(counts)
            look = -sum(c / t * math.log(c / t) for c in counts) / math.log(t) if t > 1 else 1.0
            worth = 1.0 if k == 1 else (1 - w.decay) * look + w.decay * (1 - math.log(k) / math.log(m + w.doubt))
            if w.weight + (1 - w.weight) * p >= w.limit:
                rest.append(b.text)
                if w.weight * worth + (1 - w.weight) * p >= w.limit:
                    stay.append(b.text)
        out.append(" ".join(stay or rest))
    return out


def test_style_tree_against_plain_python(spark):
    """Hosts of one to 120 pages: texts beside, without and inside articles that some pages share."""
    r = random.Random(15)
    pages = []
    for host, n in enumerate((1, 2, 3, 9, 30, 120)):
        for k in range(n):
            note = f"<div class=box><p>{prose(500 + host + 100 * r.randrange(1 + k % 4), 8)}</p></div>"
            own = "".join(f"<p>{prose(1000 * host + k + 9 * j, 20)}</p>" for j in range(r.randrange(1, 4)))
            tail = f"<p>{prose(900 + host, 6)}</p>" if r.random() < 0.97 else ""
            body = f"<article>{own}{tail}</article>" if r.random() < 0.5 else f"<div class=text>{own}{tail}</div>"
            nav = f"<nav>{prose(k, 3)}</nav>"
            pages.append((f"h{host}", nav + note * (r.random() < 0.8) + body + f"<p>{prose(77 + host, 5)}</p>"))
    pages += pages[-1:] * 5
    df = spark.createDataFrame([(k, f"http://{h}/{k}", t) for k, (h, t) in enumerate(pages)], "page_id long, url string, html string")
    got = {x["page_id"]: x["text"] for x in styletree.main_text(df).collect()}
    want = plain_tree(pages)
    assert [got[k] for k in range(len(pages))] == want
    notes = [sum(len(b.text) for b in blocks(t) if not b.boiler) + len([b for b in blocks(t) if not b.boiler]) - 1 for _, t in pages]
    assert 20 < sum(len(x) < n for x, n in zip(want, notes)) < len(pages)        # the tree decides on some


def test_long_and_deep_pages(spark):
    deep = "<div>" * 3_000 + "far down" + "</div>" * 3_000
    long = "<article>" + "".join(f"<p>{prose(k, 50)}</p>" for k in range(2_000)) + "</article>"
    df = spark.createDataFrame([(1, "http://a", deep), (2, "http://a", long)], "page_id long, url string, html string")
    got = {x["page_id"]: x["text"] for x in styletree.main_text(df).collect()}
    assert got == {1: "far down", 2: " ".join(prose(k, 50) for k in range(2_000))}


def test_blocks_survive_broken_html():
    r = random.Random(6)
    bits = ["<p>", "</p>", "<b>", "</div>", "<div class=x>", "<!--", "-->", "<", ">", "text", "&amp;", "<script>", "</script>",
            "<a href='", "\"", "<ul><li>", "<br/>", "</", "<x y=z/>"]
    for _ in range(300):
        for b in blocks("".join(r.choice(bits) for _ in range(r.randrange(40)))):
            assert b.text == " ".join(b.text.split()) != ""


def test_transcripts_recover_roles(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op10_hmm_transcripts"](spark, sf).collect()
    truth = {(r["conv_id"], r["turn"]): r for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    held = [r for r in rows if zlib.crc32(str(r["conv_id"]).encode()) % 4 == 2]
    right = [r["role"] == truth[r["conv_id"], r["turn"]]["role"] for r in held if (r["conv_id"], r["turn"]) in truth]
    assert np.mean(right) > 0.95 and abs(len(rows) / len(truth) - 1) < 0.03
    assert rows[0]["rendered"] == f"<|{rows[0]['role']}|>\n{rows[0]['text']}\n<|end|>\n"


def test_viterbi_over_parts_is_exact(spark):
    model = transcripts.learn(queries.raw_turns(spark.read.parquet(f"{SF}/conversations.parquet")))
    r = random.Random(8)
    lines = [r.choice(["User: ", "AI: ", "", "", "Speaker 2: ", "\n"]) + prose(k, r.randrange(1, 40)) + r.choice(["?", ""])
             for k in range(60)]
    whole = [(1, 0, "\n".join(lines))]
    cut = [(2, k, "\n".join(lines[10 * k:10 * k + 10])) for k in range(6)] + [(2, 6, None), (3, 0, ""), (None, 0, "x")]
    # the last line of a part ends there, so parts are cut behind lines, as the whole is
    got = transcripts.turns(spark.createDataFrame(whole + cut, "id long, part long, text string"), model).collect()
    view = {i: sorted((x["turn"], x["role"], x["text"]) for x in got if x["id"] == i) for i in (1, 2, 3)}
    assert view[1] == view[2] and not view[3] and len(view[1]) > 5


@pytest.fixture(scope="module")
def hmm(spark):
    return transcripts.learn(queries.raw_turns(spark.read.parquet(f"{SF}/conversations.parquet")))


def test_viterbi_against_every_path(hmm):
    r = random.Random(5)
    for _ in range(12):
        text = "\n".join(r.choice(["User: ", "AI: ", "System: ", "", "", "Speaker 1: ", "\n", "Q:\n"]) + prose(r.randrange(99), r.randrange(1, 60))
                         + r.choice(["?", ""]) for _ in range(r.randrange(1, 5)))
        seen, _, _ = transcripts.observed(text)
        e = transcripts.emissions(hmm, seen)

        def worth(path):
            return hmm.start[path[0]] + sum(hmm.move[a, b] for a, b in zip(path, path[1:])) + sum(e[k, s] for k, s in enumerate(path))
        best = max(map(worth, itertools.product(range(transcripts.STATES), repeat=len(seen))))
        assert math.isclose(worth(transcripts.decode(hmm, seen, None, None)), best, rel_tol=1e-12)


def only_markers(gap):
    return all(not transcripts.marker_of(x)[1].strip() for x in gap.split("\n"))


def test_no_text_is_lost(spark, hmm):
    """Turns, and between them markers and blanks alone, make up each transcript, whole or in parts."""
    r = random.Random(3)
    bits = ["User: ", "Assistant: ", "", "", "    ", "\t", "Note: ", "Question: ", "### Response\n", "\n", "\n\n  ", "[User] ", "Speaker 2: "]
    rows, whole = [], {}
    for i in range(40):
        lines = [r.choice(bits) + r.choice(["def f(x):", "    return x  ", "why?", prose(r.randrange(99), r.randrange(1, 30)), "", "Note: do x"])
                 for _ in range(r.randrange(1, 14))]
        rows.append((i, 0, "\n".join(lines)))
        whole[i] = whole[100 + i] = rows[-1][2]
        cuts = sorted(r.sample(range(len(lines) + 1), min(2, len(lines))))
        rows += [(100 + i, k, "\n".join(lines[a:b])) for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(lines)])) if a < b]
    got = transcripts.turns(spark.createDataFrame(rows, "id long, part long, text string"), hmm).collect()
    cut = marked = 0
    for i, text in whole.items():
        at = 0
        for t in sorted((x["turn"], x["text"]) for x in got if x["id"] == i):
            found = text.index(t[1], at)
            while not only_markers(text[at:found]):
                pytest.fail(f"{text!r}: lost {text[at:found]!r}")
            at = found + len(t[1])
            cut += found > 0
            marked += any(transcripts.marker_of(x)[0] != transcripts.NONE for x in t[1].split("\n"))
        assert only_markers(text[at:]), text
    assert cut > 50 and marked > 5


def test_lines_that_look_like_markers_stay(spark, hmm):
    """With a model that opens turns at "User:" and "Assistant:" alone, turns are the slices between."""
    show = [np.log(np.full((transcripts.STATES, n), 1 / n)) for n in transcripts.CHOICES]
    show[0][:] = -50
    for role in range(3):
        show[0][2 * role, role] = 0
        show[0][2 * role + 1, [0, transcripts.NONE]] = 0
    show[0][0] = -50
    fixed = transcripts.Hmm(hmm.start, hmm.move, show)
    code = "Here it is:\n\n    def f(x):\n        return x  \n\n\nNote: do x\nSystem:\n\n\tdone  "
    text = f"User: why \n so?\n\nAssistant: {code}\n \nUser:\n  - item\n  - more\n"
    df = spark.createDataFrame([(1, 0, text, "clash", 5)], "id long, part long, text string, role string, turn int")
    cut = spark.createDataFrame([(1, k, t) for k, t in enumerate(text.split("\n"))], "id long, part long, text string")
    at = text.index("\n\n    def") + 1
    halves = spark.createDataFrame([(1, 0, text[:at]), (1, 7, text[at + 1:])], "id long, part long, text string")
    for parts in (df, halves):
        got = sorted((x["turn"], x["role"], x["text"]) for x in transcripts.turns(parts, fixed).collect())
        assert got == [(0, "user", "why \n so?"), (1, "assistant", code), (2, "user", "  - item\n  - more")]
    # a part for each line, some of them blank
    first = [x["text"] for x in sorted(transcripts.turns(cut.where("part < 9"), fixed).collect(), key=lambda x: x["turn"])]
    assert first == ["why \n so?", "Here it is:\n\n    def f(x):\n        return x  "]


def test_transcript_edge_cases(spark, hmm):
    long = "\n".join(["User: start?", *(prose(k, 9) for k in range(20_000))])
    df = spark.createDataFrame([(1, 0, None), (2, 0, " \n\t"), (3, 0, "User:"), (4, 0, "just text"), (5, 0, long), (6, 1, "b?"), (6, 1, "b?"),
                                (7, None, "User: a?"), (7, 0, None)], "id long, part long, text string")
    got = {}
    for x in transcripts.turns(df, hmm).collect():
        got.setdefault(x["id"], []).append(x)
    assert set(got) == {4, 5, 6, 7} and got[4][0]["text"] == "just text" and got[7][0]["text"] == "a?"
    assert sum(x["n_lines"] for x in got[5]) == 20_001 and sum(x["n_lines"] for x in got[6]) == 2
    assert sum(len(x["text"].split()) for x in got[5]) == 1 + sum(len(prose(k, 9).split()) for k in range(20_000))
    assert transcripts.turns(df.limit(0), hmm).count() == 0
    strange = spark.createDataFrame([(1, 0, "tool", "x"), (1, 1, None, "y"), (1, 2, "user", None)], "id long, seq long, role string, text string")
    assert transcripts.turns(df.where("id = 4"), transcripts.learn(strange)).count() == 1
    assert transcripts.learn(strange.limit(0)).move.shape == hmm.move.shape


@pytest.mark.parametrize("line,want", [("User: hi", (1, "hi")), ("### Response", (2, "")), ("[SYS] x", (0, "x")),
                                       ("<|assistant|>", (2, "")), ("Speaker 2: a", (4, "a")), ("http://x", (3, "http://x")),
                                       ("Note that: x", (3, "Note that: x"))])
def test_markers(line, want):
    assert transcripts.marker_of(line) == want
