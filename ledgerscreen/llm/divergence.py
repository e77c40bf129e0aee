"""Source divergence audit by one-hot level products.

For each language the kept terms are the rows of a matrix and (group, count level)
are its columns: a cell is 1 where the group has the term that often, so each term has
exactly one 1 in each group's columns.  The product of this matrix with its own
transpose holds, for every two groups, the joint table of their levels: how many terms occur c
times in one and d times in the other.  Everything that depends on two counts alone is
priced from the joint tables.

The product is blocked: terms are dealt into row blocks by hash, a language's sources
into column blocks of ``WIDE``.  A task multiplies two column blocks over one row block,
``ROWS`` terms at a time (at most ``ROWS * WIDE`` columns on either side); entries are
counts of at most ``ROWS`` terms, which single precision holds exactly.  Level 0 is a column like any other.

Defined cases: null text, lang and source are ''; a document without letters has no terms but
counts as its group's; repeated rows are documents of their own; a language of one source has no
pairs; an empty table gives empty results; further columns are not read."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerscreen.llm.common import array, sliced, written
from ledgerscreen.llm.running import running

ROWS, WIDE = 64, 32
#: Terms of a row block on average.
BLOCK = 512
#: Bytes that belong to a term: ASCII letters and everything outside ASCII.
TERM = re.compile(rb"[a-z\x80-\xff]+")


@dataclass(frozen=True)
class Audit:
    least_documents: int = 30
    scale: int = 1_000_000_000
    prior: int = 5
    top: int = 50


def groups_of(docs: DataFrame) -> DataFrame:
    """(lang, source) of every document, with the number of documents."""
    named = [F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    return docs.select(*named).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_documents"))


def term_counts(docs: DataFrame, flush: int = 100_000) -> DataFrame:
    """(lang, source, term, n, documents): occurrences and documents of each term.

    A task adds its documents up in memory and hands its sums on whenever it holds ``flush`` of them."""
    slim = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def rows(sums):
        keys = [(lang, source, term, n, d) for (lang, source), (count, seen) in sums.items()
                for (term, n), d in zip(count.items(), map(seen.__getitem__, count))]
        cols = list(zip(*keys)) or [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.binary()).cast(pa.string()),
             pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())], names=["lang", "source", "term", "n", "documents"])

    def run(batches):
        sums, held = defaultdict(lambda: (Counter(), Counter())), 0
        for b in sliced(batches, "text", 4_000_000):
            texts = array(b.column("text")).cast(pa.binary())
            for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), texts):
                found = Counter(TERM.findall(text.as_py().lower()))      # bytes: A-Z only
                count, seen = sums[lang, source]
                held -= len(count)
                count.update(found)
                seen.update(found.keys())
                held += len(count)
                if held >= flush:
                    yield rows(sums)
                    sums, held = defaultdict(lambda: (Counter(), Counter())), 0
        yield rows(sums)

    parts = slim.mapInArrow(run, "lang string, source string, term string, n long, documents long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def rate(count: Column, total: Column, terms: Column, audit: Audit) -> Column:
    """1 + floor(scale * (count + prior) / (total + prior * terms)), exact; 0 without terms."""
    top = F.lit(audit.scale).cast("decimal(10,0)") * (count + audit.prior).cast("decimal(19,0)")
    below = (total + audit.prior * terms).cast("decimal(20,0)")
    return F.when(terms > 0, 1 + F.call_function("div", top, below)).otherwise(F.lit(0)).cast("long")


@dataclass
class Tables:
    """``groups``: lang, source, number (its place among the language's sources), terms, total,
    p0.  ``cells``: lang, source, term, n, p, q: the counts above 0 of kept terms with the group's
    and the language's rate."""
    groups: DataFrame
    cells: DataFrame


def tables(docs: DataFrame, audit: Audit = Audit()) -> Tables:
    counts = written(term_counts(docs), "terms")
    kept = (counts.groupBy(F.col("lang").alias("_lang"), F.col("term").alias("_term"))
            .agg(F.sum("documents").alias("_docs"), F.sum("n").alias("lang_n"))
            .where(F.col("_docs") >= audit.least_documents))
    cells = counts.join(kept, (F.col("lang") == F.col("_lang")) & (F.col("term") == F.col("_term")))
    cells = written(cells.select("lang", "source", "term", "n", "lang_n"), "kept")
    langs = (cells.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
             .groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total")))
    totals = cells.groupBy(F.col("lang").alias("_l"), F.col("source").alias("_s")).agg(F.sum("n").alias("total"))
    groups = written(groups_of(docs).select("lang", "source", F.lit(1).alias("one")), "groups")
    groups = running(groups, "lang", [F.col("source").asc_nulls_last()], "one", "number")
    zero = F.lit(0).cast("long")
    groups = (groups.join(langs, F.col("lang") == F.col("_lang"), "left")
              .join(totals, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")), "left")
              .select("lang", "source", "number", F.coalesce("terms", zero).alias("terms"),
                      F.coalesce("lang_total", zero).alias("lang_total"), F.coalesce("total", zero).alias("total")))
    groups = written(groups.withColumn("p0", rate(F.lit(0).cast("long"), F.col("total"), F.col("terms"), audit)), "group_rates")
    g = groups.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "number", "terms", "total", "lang_total")
    cells = (cells.join(g, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")))
             .select("lang", "source", "number", "term", "n", rate(F.col("n"), F.col("total"), F.col("terms"), audit).alias("p"),
                     rate(F.col("lang_n"), F.col("lang_total"), F.col("terms"), audit).alias("q")))
    return Tables(groups, written(cells, "cells"))


def joint_tables(t: Tables) -> DataFrame:
    """(lang, a, b, n_a, n_b, p_a, p_b, terms): for two sources a < b (by number) of a language,
    how many kept terms occur n_a times in one and n_b times in the other, in parts that add up
    over the row blocks.  Any two sources have a row, if only with 0 terms."""
    blocks = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("terms") / BLOCK))
    size = t.groups.groupBy(F.col("lang").alias("_lang")).agg(F.first(blocks).alias("blocks"))
    part = F.floor(F.col("number") / WIDE).cast("int").alias("part")
    # a mark for each group in each block: its level 0, also where it has no term at all
    marks = (t.groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
             .select("lang", "block", part, "number", F.lit(None).cast("long").alias("term"), F.lit(0).cast("long").alias("n"),
                     F.col("p0").alias("p")))
    code = F.xxhash64("term")        # names a term inside its block of about 512
    cells = (t.cells.join(size, F.col("lang") == F.col("_lang"))
             .select("lang", F.pmod(F.xxhash64(F.lit("block"), "term"), F.col("blocks")).alias("block"), part, "number",
                     code.alias("term"), "n", "p"))
    entry = F.struct("number", "term", "n", "p")
    rows = cells.unionByName(marks).groupBy("lang", "block", "part").agg(F.collect_list(entry).alias("entries"))
    rows = written(rows, "blocks")
    left = rows.select("lang", "block", F.col("part").alias("x"), F.col("entries").alias("left"))
    right = rows.select("lang", "block", F.col("part").alias("y"), F.col("entries").alias("right"))
    tiles = left.join(right, ["lang", "block"]).where(F.col("x") <= F.col("y"))

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                one = b.slice(k, 1)
                yield from _cells(one.column("lang")[0].as_py(), _entries(one.column("left")), _entries(one.column("right")))

    return tiles.mapInArrow(run, "lang string, a long, b long, n_a long, n_b long, p_a long, p_b long, terms long")


def _entries(column) -> dict:
    flat = array(column).flatten()
    found = {f: flat.field(f) for f in ("number", "n", "p")}
    found = {f: x.to_numpy(zero_copy_only=False).astype(np.int64) for f, x in found.items()}
    found["mark"] = flat.field("term").is_null().to_numpy(zero_copy_only=False)
    found["term"] = flat.field("term").fill_null(0).to_numpy(zero_copy_only=False)
    return found


def _levels(e: dict, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The level of every (term, source): (source numbers, level of each as an index into
    (n, p)), level 0 where a term has no entry."""
    mark = e["mark"]
    sources, zero = e["number"][mark], e["p"][mark]
    order = np.argsort(sources)
    sources, zero = sources[order], zero[order]
    n = np.zeros((len(terms), len(sources)), np.int64)
    p = np.broadcast_to(zero, n.shape).copy()
    at = np.searchsorted(terms, e["term"][~mark]), np.searchsorted(sources, e["number"][~mark])
    n[at], p[at] = e["n"][~mark], e["p"][~mark]
    return sources, zero, n, p


def one_hot(n: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(matrix of terms x (source, level) columns, source place, n and p of each column)."""
    order = np.argsort(n, axis=0, kind="stable")
    by = np.take_along_axis(n, order, 0)
    new = np.ones(n.shape, bool)
    new[1:] = by[1:] != by[:-1]
    # columns are numbered source by source, in ascending level
    column = np.cumsum(new.T.ravel()).reshape(n.T.shape).T - 1
    source = np.nonzero(new.T)[0]
    x = np.zeros((n.shape[0], len(source)), np.float32)
    x[order, column] = 1
    return x, source, by.T[new.T], np.take_along_axis(p, order, 0).T[new.T]


def _cells(lang: str, left: dict, right: dict):
    """Nonzero entries of the products of two column blocks, ``ROWS`` terms at a time."""
    terms = np.unique(np.concatenate([left["term"][~left["mark"]], right["term"][~right["mark"]]]))
    a, zero_a, na, pa_ = _levels(left, terms)
    b, zero_b, nb, pb = _levels(right, terms)

    def batch(i, j, ni, nj, pi, pj, c):
        cols = (a[i], b[j], ni, nj, pi, pj, c)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string())] + [pa.array(x.astype(np.int64)) for x in cols],
                                          names=["lang", "a", "b", "n_a", "n_b", "p_a", "p_b", "terms"])

    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(a)), np.arange(len(b)), indexing="ij"))
    pick = a[i] < b[j]
    i, j = i[pick], j[pick]
    none = np.zeros(len(i), np.int64)
    yield batch(i, j, none, none, zero_a[i], zero_b[j], none)
    often = np.argsort(na.sum(1) + nb.sum(1), kind="stable")       # terms of like counts share levels
    for lo in range(0, len(terms), ROWS):
        rows = often[lo:lo + ROWS]
        x, sx, nx, px = one_hot(na[rows], pa_[rows])
        y, sy, ny, py = one_hot(nb[rows], pb[rows])
        joint = x.T @ y
        i, j = np.nonzero(joint)
        pick = a[sx[i]] < b[sy[j]]
        i, j = i[pick], j[pick]
        yield batch(sx[i], sy[j], nx[i], ny[j], px[i], py[j], joint[i, j])


def pairs(t: Tables) -> DataFrame:
    """(lang, source, item, value): the distance of any two sources of a language, both ways."""
    price = F.sum(F.col("terms") * F.abs(F.col("p_a") - F.col("p_b"))).alias("value")
    value = written(joint_tables(t).groupBy("lang", "a", "b").agg(price), "prices")
    name = t.groups.select("lang", "number", "source")
    both = value.join(name.withColumnsRenamed({"number": "a", "source": "x"}), ["lang", "a"]).join(
        name.withColumnsRenamed({"number": "b", "source": "y"}), ["lang", "b"])
    return (both.select("lang", F.col("x").alias("source"), F.col("y").alias("item"), "value")
            .unionByName(both.select("lang", F.col("y").alias("source"), F.col("x").alias("item"), "value")))


def audit(docs: DataFrame, settings: Audit = Audit()) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has every other source of the
    language by its distance, part ``term`` the ``top`` terms that the source has most above the language."""
    t = tables(docs, settings)
    near = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    found = pairs(t).withColumn("rank", F.row_number().over(near)).withColumn("part", F.lit("pair"))
    over = (t.cells.where(F.col("p") > F.col("q"))
            .select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= settings.top)
            .withColumn("part", F.lit("term")))
    return found.unionByName(over).select("lang", "source", "part", "item", "value", "rank")
