"""Benchmark decontamination by template canonicalisation (DataFrame functions only).

A text becomes a sequence of words with marks stripped and A-Z in lower case, in
which numbers, names (capitalised words inside a sentence) and units behind a
number are replaced by typed placeholders: its template.  Windows of template
words are hash-joined with those of the benchmark items.  Windows of one document
and item that lie on one diagonal (document place minus item place) are an
alignment; with ``least_words`` consecutive words or more in windows (or all of a
shorter item) it is checked for slot consistency: over the words inside matched
windows, one value of an item's slot must always stand for one value in the document.  Equal
values mean a verbatim copy, other consistent values a re-parameterised question.

Scale: one scan of the documents; only window hits are shuffled.  The benchmark's
windows are broadcast while they are fewer than ``BROADCAST_ROWS`` (counted
first); beyond, the same join shuffles both sides.

Defined cases: null or empty texts match nothing; rows without an id are ignored;
rows that share an id count as one document; items of fewer than ``SHORTEST``
words match nothing; empty tables give an empty result.  Windows in which fewer
than half of the words are literal tell nothing and are not counted; an item that
has too few others (a calculation, a table) is matched by windows of its plain
words instead, so its copies are found.  White space of any kind is one space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscreen.llm.common import SPACES, counted, lower_ascii, written

WIDTH = 8
LEAST_WORDS = 13
SHORTEST = 4
BROADCAST_ROWS = 500_000

NUMBER = r"[0-9]+([.,:/][0-9]+)*"
NAME = r"([^.!?:\x20\x09-\x0D] )\p{Lu}\p{Ll}+"
UNITS = ("km", "cm", "mm", "kg", "mg", "ml", "mph", "kmh", "miles", "mile", "meters", "metres", "feet", "inches",
         "grams", "pounds", "tons", "litres", "liters", "seconds", "minutes", "hours", "days", "weeks", "months",
         "years", "percent", "dollars", "cents", "euros", "degrees")
UNIT = rf"(<num>[\x20]?)({'|'.join(UNITS)})([^a-z0-9]|$)"
UNEVEN = r"\x20*[\x09-\x0D][\x20\x09-\x0D]*|\x20{2,}"       # white space that is not one space
MARKS = r"[^\p{L}\p{N}<>\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    stripped = F.trim(F.regexp_replace(text, MARKS, ""), F.lit(" \t\n\x0b\f\r"))
    return F.split(stripped, SPACES)


def _even(text: Column) -> Column:
    return F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), "<>", "  "), UNEVEN, " ")


def plain(text: Column) -> Column:
    """The words that stand at the places of ``template``'s words."""
    return _words(lower_ascii(_even(text)))


def template(text: Column) -> Column:
    t = F.regexp_replace(_even(text), NUMBER, "<num>")
    for _ in range(2):              # a match holds the letter before it, so neighbours take two rounds
        t = F.regexp_replace(t, NAME, "$1<name>")
    return _words(F.regexp_replace(lower_ascii(t), UNIT, "$1<unit>$3"))


def _windows(words: Column, width: Column) -> Column:
    """Structs (place, hash) of the windows; empty where the text is shorter."""
    last = F.size(words) - width
    each = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(words, i + 1, width)))
    return F.when(last >= 0, each)


def _literal(words: Column) -> Column:
    return 2 * F.size(F.filter(words, lambda w: ~w.contains("<"))) >= F.size(words)


def _need(n: Column, width: Column) -> Column:
    """Windows that make an alignment, of an item that has ``n``."""
    return F.least(n, F.greatest(F.lit(LEAST_WORDS) - width + 1, F.lit(1)))


def item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, width, p, h, need, raw) of the items long enough; ``raw`` windows are
    of plain words."""
    t = items.where(items[id_col].isNotNull()).select(items[id_col].alias("item"), template(items[text_col]).alias("t"),
                                                      plain(items[text_col]).alias("r"))
    width = F.least(F.lit(WIDTH), F.size("t"))
    t = t.where(F.size("t") >= SHORTEST).withColumn("width", width)
    places = F.expr("sequence(0, size(t) - width)")
    literal = F.filter(places, lambda p: _literal(F.slice("t", p + 1, F.col("width"))))
    t = (t.withColumn("places", places).withColumn("literal", literal)
         .withColumn("need", _need(F.size("places"), F.col("width")))
         .withColumn("raw", F.size("literal") < F.col("need")))
    w = t.select("item", "width", "need", "raw", F.when(F.col("raw"), F.col("r")).otherwise(F.col("t")).alias("words"),
                 F.explode(F.when(F.col("raw"), F.col("places")).otherwise(F.col("literal"))).alias("p"))
    return w.select("item", "width", "p", "need", "raw", F.xxhash64(F.expr("slice(words, p + 1, width)")).alias("h")).distinct()


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per leaked (document, item): n_windows on the best diagonal, and
    ``verbatim`` (false: re-parameterised)."""
    d = docs.where(docs[id_col].isNotNull()).select(docs[id_col].alias("doc"), docs[text_col].cast("string").alias("text"))
    i = items.select(items[item_id].alias(item_id), items[item_text].alias(item_text))
    bench = written(item_windows(i, item_id, item_text), "item-windows")
    kinds = [(r["width"], r["raw"]) for r in bench.select("width", "raw").distinct().collect()]   # at most 2 * WIDTH
    probe = F.broadcast(bench) if bench.count() <= BROADCAST_ROWS else bench
    hits = None
    for width, raw in sorted(kinds) or [(WIDTH, False)]:
        words = plain if raw else template
        own = d.select("doc", words(F.col("text")).alias("t")).select(
            "doc", F.posexplode(_windows(F.col("t"), F.lit(width))).alias("q", "h"))
        part = (own.join(probe.where((F.col("width") == width) & (F.col("raw") == raw)), "h")
                .select("doc", "item", "q", "p", "need", "width", "raw"))
        hits = part if hits is None else hits.unionByName(part)
    # the places of a diagonal are places of its item: as many as the item has windows at most
    diagonals = written(hits.groupBy("doc", "item", (F.col("q") - F.col("p")).alias("shift"), "need", "width", "raw")
                        .agg(F.collect_set("p").alias("places")).withColumn("hit", F.size("places").cast("long"))
                        .where(F.col("hit") >= F.col("need")), "diagonals")
    of_docs = (d.join(diagonals.select("doc").distinct(), "doc", "left_semi")
               .select("doc", template(F.col("text")).alias("dt"), plain(F.col("text")).alias("dr")))
    of_items = i.select(F.col(item_id).alias("item"), template(F.col(item_text)).alias("it"),
                        plain(F.col(item_text)).alias("ir"))
    aligned = diagonals.join(of_docs, "doc").join(of_items, "item")
    slots = F.expr("""
        transform(filter(array_distinct(flatten(transform(places, p -> sequence(p, p + width - 1)))),
                         p -> contains(get(it, p), '<') AND get(it, p) = get(dt, p + shift)),
                  p -> struct(get(ir, p) AS i, get(dr, p + shift) AS d))""")
    judged = (aligned.select("doc", "item", "hit", slots.alias("slots"))
              .withColumn("fits", F.size(F.array_distinct("slots")) == F.size(F.array_distinct("slots.i")))
              .withColumn("same", F.expr("forall(slots, s -> s.i = s.d)")))
    return (judged.where("fits").groupBy(F.col("doc").alias(id_col), F.col("item").alias(item_id))
            .agg(F.max("hit").alias("n_windows"), F.max("same").alias("verbatim")))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose document leaks no item, with all their columns."""
    found = counted(leaks(docs, items, id_col, text_col).select(F.col(id_col).alias("__id")).distinct(), "leaked")
    return docs.join(found, docs[id_col] == found["__id"], "left_anti")
