"""Reversible line dedup: sharded cuckoo filters backed by exact reference counts.

A line's key is the line without ASCII white space at its ends, A-Z in lower
case; keys of ``min_chars`` code points or more are indexed by a 128-bit hash.
An index holds

* ``refs``: exact, one row per (key, document),
* ``counts``: exact, per key its documents and the largest document id,
* ``filters``: per shard one cuckoo filter over the keys that are in
  ``min_docs`` documents or more.

``insert`` and ``delete`` take documents in and out: only keys whose count
crosses ``min_docs`` touch a filter, so the index after a deletion equals the
index that never saw the document.  ``dedup`` streams the lines of a batch past
their shard's filter first; only the few that may be common are joined with the
exact counts, which decide.

Scale: keys are distinct per document before any shuffle and counted with
map-side partial sums, so a line found in a third of all documents is one row
per task.  Filters are never collected or broadcast: each is a row, sent ahead
of the lines of its shard; a shard's lines are dealt over ``SALTS`` streams.

Defined cases: null or empty text is one empty line; rows with a null id are not
indexed and lose nothing; rows that share an id are one document; an empty table
gives an empty index.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscreen.llm.common import array, lower_ascii, partitions, written
from ledgerscreen.llm.cuckoo import CuckooFilter

BLANKS = " \t\n\x0b\f\r"
SALTS = 16
KEYS_PER_SHARD = 50_000


def key_of(line: Column) -> Column:
    return lower_ascii(F.trim(line, F.lit(BLANKS)))


def hash_of(key: Column) -> Column:
    """128 bits as a struct of two longs."""
    return F.struct(F.xxhash64(key).alias("k1"), F.xxhash64(F.lit("second"), key).alias("k2"))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def references(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, k1, k2): the distinct long keys of each document."""
    lines = docs.where(docs[id_col].isNotNull()).select(
        docs[id_col].alias("doc"), F.explode(lines_of(docs[text_col])).alias("line"))
    keys = lines.select("doc", key_of(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keys.select("doc", hash_of(F.col("key")).alias("h")).select("doc", "h.k1", "h.k2").distinct()


@dataclass(frozen=True)
class LineIndex:
    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = 5
    min_chars: int = 40


def _count(refs: DataFrame) -> DataFrame:
    return refs.groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("doc").alias("max_doc"))


def _shard(shards: int) -> Column:
    return F.pmod(F.col("k1"), F.lit(shards)).cast("int").alias("shard")


def _empty_filters(spark, shards: int) -> DataFrame:
    return spark.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(b"").alias("filter"))


def _updated(filters: DataFrame, changes: DataFrame) -> DataFrame:
    """Filters after (shard, k1, add): a group holds one shard's changed keys."""
    def run(left, right):
        data = left["filter"].iloc[0] if len(left) else b""
        f = CuckooFilter.from_bytes(data) if data else CuckooFilter(2 * KEYS_PER_SHARD)
        keys = right["k1"].to_numpy().astype("uint64")
        add = right["add"].to_numpy().astype(bool)
        f.remove(keys[~add])
        f.add(keys[add])
        shard = left["shard"].iloc[0] if len(left) else right["shard"].iloc[0]
        return left.iloc[:0].reindex(range(1)).assign(shard=shard, filter=f.to_bytes())

    return filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(run, "shard int, filter binary")


def _with_counts(index: LineIndex, refs: DataFrame, counts: DataFrame, changed: DataFrame) -> LineIndex:
    """The new version of the index; ``changed`` has (k1, k2, old n, new n) of touched keys."""
    common = counts.where(F.col("n_docs") >= index.min_docs).count()
    shards = max(index.shards, -(-common // KEYS_PER_SHARD), 1)
    over = F.col("now") >= index.min_docs
    if shards > index.shards:         # more keys than the shards were made for: deal them anew
        changes = counts.where(F.col("n_docs") >= index.min_docs).select(_shard(shards), "k1", F.lit(True).alias("add"))
        filters = _empty_filters(refs.sparkSession, shards)
    else:
        changes = (changed.where(over != (F.col("was") >= index.min_docs))
                   .select(_shard(shards), "k1", over.alias("add")))
        filters = index.filters
    return replace(index, refs=refs, counts=counts, shards=shards,
                   filters=written(_updated(filters, changes), "line-filters"))


def empty_index(docs: DataFrame, id_col: str = "doc_id", min_docs: int = 5, min_chars: int = 40) -> LineIndex:
    """An index of no documents, with ids of the type that ``docs`` has."""
    spark = docs.sparkSession
    none = docs.select(docs[id_col].alias("doc"), F.lit(0).cast("long").alias("k1"),
                       F.lit(0).cast("long").alias("k2")).where(F.lit(False))
    return LineIndex(none, _count(none), _empty_filters(spark, 0), 0, min_docs, min_chars)


def insert(index: LineIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
    """The index with these documents, too; references it already holds count once."""
    new = references(docs, id_col, text_col, index.min_chars)
    if index.shards:
        new = new.join(index.refs, ["doc", "k1", "k2"], "left_anti")
    new = written(new, "line-refs-new")
    delta = _count(new)
    if not index.shards:
        counts = written(delta, "line-counts")
        return _with_counts(index, new, counts, counts.select("k1", "k2", F.lit(0).alias("was"),
                                                              F.col("n_docs").alias("now")))
    both = index.counts.alias("o").join(delta.alias("d"), ["k1", "k2"], "full")
    counts = written(both.select(
        "k1", "k2", (F.coalesce("o.n_docs", F.lit(0)) + F.coalesce("d.n_docs", F.lit(0))).alias("n_docs"),
        F.greatest("o.max_doc", "d.max_doc").alias("max_doc"),
        F.coalesce("o.n_docs", F.lit(0)).alias("was"), F.col("d.n_docs").isNotNull().alias("touched")), "line-counts")
    changed = counts.where("touched").select("k1", "k2", "was", F.col("n_docs").alias("now"))
    return _with_counts(index, index.refs.unionByName(new), counts.drop("was", "touched"), changed)


def delete(index: LineIndex, ids: DataFrame) -> LineIndex:
    """The index without the documents whose ids are in the only column of ``ids``."""
    gone = ids.select(ids[0].alias("doc")).distinct()
    touched = index.refs.join(gone, "doc", "left_semi").select("k1", "k2").distinct()
    refs = written(index.refs.join(gone, "doc", "left_anti"), "line-refs")
    again = _count(refs.join(touched, ["k1", "k2"], "left_semi"))
    now = touched.join(again, ["k1", "k2"], "left").withColumn("touched", F.lit(True))
    both = index.counts.alias("o").join(now.alias("d"), ["k1", "k2"], "left")
    new_n = F.when(F.col("d.touched"), F.coalesce("d.n_docs", F.lit(0))).otherwise(F.col("o.n_docs"))
    counts = written(both.select("k1", "k2", new_n.alias("n_docs"),
                                 F.when(F.col("d.touched"), F.col("d.max_doc")).otherwise(F.col("o.max_doc"))
                                 .alias("max_doc"), F.col("o.n_docs").alias("was"),
                                 F.col("d.touched").isNotNull().alias("touched")), "line-counts")
    changed = counts.where("touched").select("k1", "k2", "was", F.col("n_docs").alias("now"))
    return _with_counts(index, refs, counts.where("n_docs > 0").drop("was", "touched"), changed)


def probe(index: LineIndex, refs: DataFrame) -> DataFrame:
    """The rows of (doc, k1, k2) whose key may be common, by the shard filters."""
    salt = F.pmod(F.xxhash64("doc", "k2"), F.lit(SALTS)).cast("int").alias("salt")
    rows = refs.select(_shard(max(index.shards, 1)), salt, F.lit(None).cast("binary").alias("filter"), "doc", "k1", "k2")
    ahead = index.filters.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "filter",
        F.lit(None).cast(refs.schema["doc"].dataType).alias("doc"), F.lit(None).cast("long").alias("k1"),
        F.lit(None).cast("long").alias("k2"))

    def run(batches):
        current, f = None, None
        for b in batches:
            shard = b.column("shard").to_numpy()
            head = b.column("filter").is_valid().to_numpy(zero_copy_only=False)
            k1 = b.column("k1").fill_null(0).to_numpy().astype("uint64")
            hit = shard < 0
            edges = [0, *[i for i in range(1, len(shard)) if shard[i] != shard[i - 1]], len(shard)]
            for lo, hi in zip(edges, edges[1:]):
                if shard[lo] != current:
                    current, f = shard[lo], None
                for i in range(lo, hi):
                    if not head[i]:
                        break
                    f = CuckooFilter.from_bytes(b.column("filter")[i].as_py())
                if f is not None:
                    hit[lo:hi] = f.has(k1[lo:hi]) & ~head[lo:hi]
            keep = pa.array(hit)
            yield pa.RecordBatch.from_arrays([array(b.column(c).filter(keep)) for c in ("doc", "k1", "k2")],
                                             names=["doc", "k1", "k2"])

    stream = (rows.unionByName(ahead).repartition(partitions(refs.sparkSession), "shard", "salt")
              .sortWithinPartitions("shard", F.col("filter").isNull()))
    return stream.mapInArrow(run, refs.schema)


def dropped(index: LineIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            refs: DataFrame | None = None) -> DataFrame:
    """(doc, keys): the hashes of the lines each document loses."""
    refs = references(docs, id_col, text_col, index.min_chars) if refs is None else refs
    exact = index.counts.where(F.col("n_docs") >= index.min_docs)
    lost = probe(index, refs).join(exact, ["k1", "k2"]).where(F.col("doc") != F.col("max_doc"))
    return lost.groupBy("doc").agg(F.collect_set(F.struct("k1", "k2")).alias("keys"))


def dedup(docs: DataFrame, index: LineIndex, id_col: str = "doc_id", text_col: str = "text",
          refs: DataFrame | None = None) -> DataFrame:
    """The rows with their common lines removed; ``n_lines`` (before) and
    ``n_dropped`` are added, in place of columns of these names."""
    lost = dropped(index, docs, id_col, text_col, refs).select(F.col("doc").alias("__doc"), F.col("keys").alias("__lost"))
    joined = docs.join(lost, docs[id_col] == lost["__doc"], "left")
    lines = lines_of(F.col(text_col))
    stay = F.filter(lines, lambda x: ~F.array_contains(F.col("__lost"), hash_of(key_of(x))))
    none = F.col("__lost").isNull()
    kept = F.when(none, lines).otherwise(stay)
    return (joined.withColumn("__kept", kept).withColumn("n_lines", F.size(lines).cast("long"))
            .withColumn("n_dropped", F.col("n_lines") - F.size("__kept"))
            .withColumn(text_col, F.when(none, F.col(text_col)).otherwise(F.array_join("__kept", "\n")))
            .drop("__doc", "__lost", "__kept"))
