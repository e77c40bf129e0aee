"""The registered queries of this subpackage and their DuckDB SQL.

Each query applies its operator with production parameters to the whole of its
table and derives the columns of its contract from the operator's output."""

from __future__ import annotations

import functools
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscreen.llm import (curriculum, divergence, hpylm, langid, lines, minhash, packing, records, repair, repetition,
                              styletree, templates, transcripts, transfer)
from ledgerscreen.llm.common import fresh_path, small_batches

QUERIES: dict = {}
ORACLE: dict = {}


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(table(spark, sf_dir, "documents")).drop("longest_repeat")


_L = repetition.Limits()
ORACLE["op1_suffix_repetition"] = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS (   -- windows found twice or more, for each of three widths
  SELECT doc_id, k, p FROM (
    SELECT doc_id, k, p, count(*) OVER (PARTITION BY doc_id, k, g) AS c FROM (
      SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g FROM (
        SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM d, (VALUES ({_L.base_window}), ({_L.min_words}), ({_L.longest + 1})) AS widths(k)))) WHERE c > 1),
cover AS (
  SELECT doc_id, k, count(DISTINCT q) AS n FROM (
    SELECT doc_id, k, unnest(range(p, p + k)) AS q FROM win) GROUP BY doc_id, k),
lines AS (
  SELECT doc_id, sum(c - 1) AS n FROM (
    SELECT doc_id, l, count(*) AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
    WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, l) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(a.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_span_words,
         c.n IS NOT NULL AS too_long
  FROM d LEFT JOIN lines USING (doc_id)
  LEFT JOIN (SELECT * FROM cover WHERE k = {_L.base_window}) a USING (doc_id)
  LEFT JOIN (SELECT * FROM cover WHERE k = {_L.min_words}) b USING (doc_id)
  LEFT JOIN (SELECT * FROM cover WHERE k = {_L.longest + 1}) c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_span_words,
       n_words < {_L.base_least_words} OR 100 * n_repeat_words > {_L.base_repeat_pct} * n_words AS base_failed,
       NOT (n_words < {_L.base_least_words} OR 100 * n_repeat_words > {_L.base_repeat_pct} * n_words)
         AND 100 * n_span_words <= {_L.share_pct} * n_words AND NOT too_long AS kept
FROM m
"""


@query
def op2_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "records")
    records.write(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"), end_id=0)
    return records.read_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op4_cuckoo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = lines.insert(lines.empty_index(docs), docs)
    out = lines.dedup(docs, index, refs=index.refs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE["op4_cuckoo_lines"] = """
WITH l AS (
  SELECT doc_id, i, line,
         translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)),
common AS (
  SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (
  SELECT l.*, common.key IS NOT NULL AND doc_id <> last AS lost FROM l LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (lost) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query
def op7_bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


# links between distinct shingle sets, then the smallest doc_id that they reach
ORACLE["op7_bayes_minhash"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
                          ELSE array_to_string(w[p:p + 4], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
sets AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS f FROM sh GROUP BY doc_id),
class AS (SELECT f, min(doc_id) AS r, any_value(n) AS n FROM sets GROUP BY f),
rs AS (SELECT doc_id AS r, g FROM sh JOIN class ON doc_id = r),
pairs AS (
  SELECT x.r AS a, y.r AS b, count(*) AS c FROM rs x JOIN rs y ON x.g = y.g AND x.r < y.r GROUP BY x.r, y.r),
link AS (
  SELECT a, b FROM pairs JOIN class p ON p.r = a JOIN class q ON q.r = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(r, t) AS (
  SELECT r, r FROM class UNION SELECT reach.r, edge.b FROM reach JOIN edge ON reach.t = edge.a),
least AS (SELECT r, min(t) AS component FROM reach GROUP BY r)
SELECT d.doc_id, coalesce(sets.n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id,
       coalesce(component, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN sets USING (doc_id) LEFT JOIN class USING (f) LEFT JOIN least USING (r)
"""


@query
def op8_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _plain_sql(text: str) -> str:
    return (f"regexp_split_to_array(trim(regexp_replace({text}, '{templates.MARKS}', '', 'g'), "
            "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), '[\\x20\\x09-\\x0D]+')")


def _template_sql(text: str) -> str:
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    t = f"regexp_replace({text}, '{templates.NUMBER}', '<num>', 'g')"
    for _ in range(2):
        t = f"regexp_replace({t}, '{templates.NAME}', '\\1<name>', 'g')"
    return _plain_sql(f"regexp_replace({low.format(t)}, '{templates.UNIT}', '\\1<unit>\\3', 'g')")


_BARE = f"regexp_replace(translate(coalesce(text, ''), '<>', '  '), '{templates.UNEVEN}', ' ', 'g')"
_LOW = f"translate({_BARE}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op8_template_leaks"] = f"""
WITH d AS (SELECT doc_id, {_template_sql(_BARE)} AS t, {_plain_sql(_LOW)} AS r FROM documents WHERE doc_id IS NOT NULL),
i AS (
  SELECT *, least({templates.WIDTH}, len(t)) AS k
  FROM (SELECT item_id, {_template_sql(_BARE)} AS t, {_plain_sql(_LOW)} AS r FROM benchmark WHERE item_id IS NOT NULL)
  WHERE len(t) >= {templates.SHORTEST}),
w AS (   -- every window of an item, by template and by plain words
  SELECT item_id, t, k, p, t[p:p + k - 1] AS g, r[p:p + k - 1] AS rg,
         2 * len(list_filter(t[p:p + k - 1], lambda x: NOT contains(x, '<'))) >= k AS literal,
         least(len(t) - k + 1, greatest({templates.LEAST_WORDS} - k + 1, 1)) AS need
  FROM (SELECT item_id, t, r, k, unnest(range(1, len(t) - k + 2)) AS p FROM i)),
few AS (SELECT item_id, t, count(*) FILTER (literal) < need AS raw FROM (SELECT DISTINCT * FROM w) GROUP BY item_id, t, need),
iw AS (
  SELECT DISTINCT item_id, k, p, need, raw, array_to_string(CASE WHEN raw THEN rg ELSE g END, ' ') AS g
  FROM w JOIN few USING (item_id, t) WHERE raw OR literal),
dw AS (
  SELECT doc_id, k, raw, q, array_to_string((CASE WHEN raw THEN r ELSE t END)[q:q + k - 1], ' ') AS g FROM (
    SELECT doc_id, t, r, k, raw, unnest(range(1, len(t) - k + 2)) AS q FROM d, (SELECT DISTINCT k, raw FROM iw))),
diag AS (
  SELECT doc_id, item_id, k, q - p AS shift, list(DISTINCT p) AS places, count(DISTINCT p) AS hit
  FROM dw JOIN iw USING (k, raw, g) GROUP BY doc_id, item_id, q - p, need, k, raw HAVING count(DISTINCT p) >= need),
slot AS (   -- slots inside matched windows
  SELECT diag.*, list_filter(list_transform(range(1, len(i.t) + 1),
           lambda p: CASE WHEN contains(i.t[p], '<') AND i.t[p] = d.t[p + shift]
                               AND len(list_filter(places, lambda x: x <= p AND p < x + diag.k)) > 0
                     THEN [i.r[p], d.r[p + shift]] END), lambda s: s IS NOT NULL) AS s
  FROM diag JOIN d USING (doc_id) JOIN i USING (item_id))
SELECT doc_id, item_id, max(hit) AS n_windows, bool_or(len(list_filter(s, lambda x: x[1] <> x[2])) = 0) AS verbatim
FROM slot WHERE len(list_distinct(s)) = len(list_distinct(list_transform(s, lambda x: x[1])))
GROUP BY doc_id, item_id
"""


@query
def op5_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


@query
def op3_ftrl_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = langid.in_fold(F.col("doc_id"), 4, 2)
    model = langid.train(docs.where(~held))
    return langid.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op9_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = styletree.main_text(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


#: Spellings of the speaker markers of raw transcripts: system, user, assistant.
MARKERS = (("System: ", "User: ", "Assistant: "), ("Context: ", "Human: ", "AI: "),
           ("### System\n", "### Instruction\n", "### Response\n"), ("<|system|>\n", "<|user|>\n", "<|assistant|>\n"),
           ("Note: ", "Q: ", "A: "), ("[SYS] ", "[USER] ", "[BOT] "), ("Speaker 0: ", "Speaker 1: ", "Speaker 2: "))
TURNS_PER_PART = 64


def raw_turns(conversations: DataFrame) -> DataFrame:
    """(id, seq, role, text): turns as a raw transcript shows them.  The spelling
    of the markers hangs on the conversation; a fifth of the turns has none and
    follows a blank line."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(MARKERS)))
    spelled = F.array(*(F.array(*map(F.lit, m)) for m in MARKERS))
    number = F.array_position(F.array(*map(F.lit, transcripts.ROLES)), F.col("role")) - 1
    marker = F.get(F.get(spelled, style), number.cast("int"))
    bare = F.pmod(F.xxhash64(F.lit("bare"), "conv_id", "turn"), F.lit(5)) == 0
    text = F.concat(F.when(bare, F.lit("\n")).otherwise(F.coalesce(marker, F.lit("\n"))), F.coalesce("text", F.lit("")))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").alias("id"), F.coalesce("turn", F.lit(0)).cast("long").alias("seq"), "role", text.alias("text"))


@query
def op10_hmm_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_turns(table(spark, sf_dir, "conversations"))
    model = transcripts.learn(raw.where(~langid.in_fold(F.col("id"), 4, 2)))
    lines_in = F.array_sort(F.collect_list(F.struct("seq", "role", "text")))
    parts = raw.groupBy("id", F.floor(F.col("seq") / TURNS_PER_PART).cast("long").alias("part")).agg(
        F.array_join(F.transform(lines_in, lambda x: x["text"]), "\n").alias("text"))
    out = transcripts.turns(parts, model)
    return out.select(F.col("id").alias("conv_id"), "turn", "role", "n_lines", "text",
                      transcripts.canonical(F.col("role"), F.col("text")).alias("rendered"))


@query
def op6_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hpylm.score(docs, langid.in_fold(F.col("doc_id"), 7, 2))


@query
def op12_level_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


_A = divergence.Audit()


def _rate_sql(count: str, total: str) -> str:
    return (f"CAST(CASE WHEN v = 0 THEN 0 ELSE 1 + ({_A.scale}::HUGEINT * ({count} + {_A.prior})) "
            f"// ({total} + {_A.prior} * v) END AS BIGINT)")


ORACLE["op12_level_products"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= {_A.least_documents}),
cell AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
lang AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
grp AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(lang.total, 0) AS lang_total, coalesce(c.total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN lang USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM cell GROUP BY ALL) c USING (lang, source)),
rate AS (   -- every group with every kept term of its language
  SELECT grp.lang, grp.source, term, coalesce(cell.n, 0) AS n, {_rate_sql("coalesce(cell.n, 0)", "total")} AS p,
         {_rate_sql("kept.n", "lang_total")} AS q
  FROM grp JOIN kept USING (lang) LEFT JOIN cell USING (lang, source, term)),
pair AS (
  SELECT x.lang, x.source, y.source AS item, coalesce(value, 0) AS value
  FROM grp x JOIN grp y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS other, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
             FROM rate a JOIN rate b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) s
    ON s.lang = x.lang AND s.source = x.source AND s.other = y.source),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value FROM pair
  UNION ALL SELECT lang, source, 'term', term, p - q FROM rate WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM ranked) WHERE part = 'pair' OR rank <= {_A.top}
"""


@query
def op13_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum.mixture(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken", "epochs")


_X = curriculum.Mix()
_CAPPED = f"{_X.most} * source_size <= weight * level"
# the excess of one round after another; place and the words before it are as the operator defines them
ORACLE["op13_curriculum"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, md5('{_X.seed}' || coalesce(':' || CAST(doc_id AS VARCHAR), '')) AS place,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, sum(size) AS source_size,
         [{', '.join(map(str, _X.weights))}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(_X.weights)}]::DOUBLE
           AS weight FROM d GROUP BY source),
round(k, level) AS (
  SELECT 0, 0.0::DOUBLE
  UNION ALL
  SELECT k + 1, coalesce((SELECT CAST({_X.share} * sum(source_size) - coalesce(sum({_X.most} * source_size) FILTER ({_CAPPED}), 0)
                          AS DOUBLE) / sum(weight) FILTER (NOT ({_CAPPED})) FROM s), level)
  FROM round WHERE k <= (SELECT count(*) FROM s)),
t AS (
  SELECT s.*, CASE WHEN {_CAPPED} THEN CAST({_X.most} * source_size AS DOUBLE) ELSE weight * level END AS target
  FROM s, (SELECT max(level) AS level FROM round)),
p AS (
  SELECT d.*, source_size, target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source),
o AS (
  SELECT *, [greatest(least(CAST(floor(target) AS BIGINT) - before - e * source_size, size), 0) FOR e IN range({_X.most})] AS words
  FROM p)
SELECT doc_id, source, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(list_sum(words) AS BIGINT) AS taken,
       CAST(len(list_filter(words, lambda x: x > 0)) AS BIGINT) AS epochs FROM o
"""


def damaged(conversations: DataFrame) -> DataFrame:
    """The faults that op11 repairs, dealt out by a checksum of conversation and turn."""
    blank = F.lit(" ")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    deal = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), blank))) % 20
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), deal.alias("deal")).where("deal <> 0")
    text = F.when(F.col("deal") == 1, "").when(F.col("deal") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("deal") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.sequence(F.lit(1), F.when(F.col("deal") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


@query
def op11_grammar_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kind = given.schema["conv_id"].dataType.simpleString()
    found = repair.repair(damaged(given))
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "audit"))), lambda x: x["audit"]), "")
    audits = found.audits.groupBy(F.col("conv").alias("_a")).agg(line.alias("audit"))
    shas = repair.digests(found.turns, kind).withColumnsRenamed({"conv": "_s", "sha256": "repaired_sha256"})
    out = (given.select("conv_id").distinct()
           .join(found.summary, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
           .join(audits, F.col("conv_id").eqNullSafe(F.col("_a")), "left")
           .join(shas, F.col("conv_id").eqNullSafe(F.col("_s")), "left"))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _repair_sql() -> str:
    """One step per turn over the four states of a repaired conversation: nothing yet, after system, user, assistant."""
    def least(options: list[tuple[str, str, str, str]]) -> str:
        """(state, cost, edits, condition) candidates for one state."""
        each = [f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edits}'}} END"
                for state, cost, edits, when in options]
        return f"list_min(list_filter([{', '.join(each)}], lambda x: x IS NOT NULL))"

    # insertions before the turn
    opened = {0: [("s0", "0", "", "true")], 1: [("s1", "0", "", "true")],
              2: [("s2", "0", "", "true"), ("s0", "2", "I", "true"), ("s1", "2", "I", "true"), ("s3", "2", "I", "true")],
              3: [("s3", "0", "", "true"), ("s2", "2", "I", "true"), ("s0", "4", "II", "true"), ("s1", "4", "II", "true")]}
    stays, keep, cut = "true", "NOT gone", "CAST(cut AS INTEGER)"
    user = [(f"o{k}", cut, "K", f"{keep} AND kind = 'u'") for k in (0, 1, 3)] + [(f"o{k}", f"2 + {cut}", "R", keep) for k in (0, 1, 3)]
    after = {0: [("o0", "3", "D", stays)], 1: [("o1", "3", "D", stays), ("o0", cut, "K", f"{keep} AND kind = 's'")],
             2: [("o2", "3", "D", stays), *user],
             3: [("o3", "3", "D", stays), ("o2", cut, "K", f"{keep} AND kind = 'a'"), ("o2", f"2 + {cut}", "R", keep)]}
    inner = ", ".join(f"{least(opened[k])} AS o{k}" for k in range(4))
    outer = ", ".join(f"{least(after[k])} AS s{k}" for k in range(4))
    final = least([("s0", "0", "", "true"), ("s3", "0", "", "true"), ("s2", "2", "I", "true"), ("s1", "4", "II", "true")])
    nil = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR))"
    crc = ("list_reduce(flatten(list_transform(range(1, length(k) + 1), lambda i: list_concat([CAST(ascii(substr(k, CAST(i AS INT), 1)) AS "
           "BIGINT)], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1]))), "
           "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END, 4294967295::BIGINT)")
    return f"""
WITH RECURSIVE g AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT *, (4294967295 - {crc}) % 20 AS deal FROM g),
d AS (
  SELECT conv_id, turn, CASE WHEN deal = 4 THEN 'user' ELSE role END AS role,
         CASE deal WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, range(2) WHERE deal <> 0 AND (range = 0 OR deal = 3)),
e AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS kind, lag(left(role, 1)) OVER w AS kind_before,
         rtrim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS bare
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (
  SELECT *, bare = '' AS blank, bare <> '' AND said AS duplicate, bare = '' OR said AS gone,
         bare <> '' AND NOT said AND right(bare, 1) NOT IN ('.', '!', '?') AS cut
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS said FROM e)),
n AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (kind_before IS NOT NULL AND kind_before || kind NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS s0, {nil} AS s1, {nil} AS s2, {nil} AS s3 FROM f
  UNION ALL
  SELECT conv_id, i, {outer} FROM (
    SELECT f.conv_id, f.i, gone, cut, kind, {inner}
    FROM walk JOIN f ON f.conv_id IS NOT DISTINCT FROM walk.conv_id AND f.i = walk.i + 1)),
done AS (
  SELECT conv_id, {final} AS best FROM walk
  QUALIFY i = max(i) OVER (PARTITION BY conv_id)),
edits AS (   -- each letter of an audit with the turn that it is about and the role of the result
  SELECT conv_id, p, e, CASE WHEN e <> 'I' THEN t END AS t, r FROM (
    SELECT conv_id, p, e, sum(CAST(e <> 'I' AS INT)) OVER w AS t,
           sum(CAST(e <> 'D' AS INT)) OVER w AS r FROM (
      SELECT conv_id, unnest(range(1, length(best.a) + 1)) AS p, unnest(string_split(best.a, '')) AS e FROM done WHERE best.a <> '')
    WINDOW w AS (PARTITION BY conv_id ORDER BY p)) WHERE e <> 'D'),
made AS (
  SELECT edits.conv_id, p, e, r, coalesce(f.text, '') AS text, f.role, bool_or(e = 'K' AND f.kind = 's') OVER (PARTITION BY edits.conv_id) AS sys
  FROM edits LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM edits.conv_id AND f.i = edits.t),
sha AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (r - CAST(sys AS INT)) % 2 = 1 THEN 'user' ELSE 'assistant' END
                         || ':' || text, chr(10) ORDER BY p)) AS s FROM made GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
       coalesce(s, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN sha ON sha.conv_id IS NOT DISTINCT FROM o.conv_id
"""


ORACLE["op11_grammar_repair"] = _repair_sql()
