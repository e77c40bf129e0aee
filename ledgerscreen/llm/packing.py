"""Packing along a space-filling curve.

Every document is encoded once; its token ids are hashed into a short vector of
counts, which a fixed random matrix projects to a few dimensions.  Scaled to the
corpus's mean and deviation, the point is a cell of a grid, and the cell's place
on the Hilbert curve is the document's key (hashed id bits behind it part equal
keys).  Documents are dealt by key ranges, sorted within, and laid end to end along
the whole curve; the stream is cut every ``length`` tokens.  So neighbours on the
curve share sequences, and only the last sequence is shorter than the rest.

Scale: the encoded table is written once; there are as many tasks and ranges as its
tokens ask for; the ranges come from approximate quantiles of the key, so a group of equal documents is spread like any other;
global token offsets need one sum per range, nothing else crosses tasks.

Defined cases: null text is the end id alone; a null id is kept as it is; equal
rows are packed each; an empty table gives no piece.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerscreen.llm.common import array, partitions, sliced, starts_of, written
from ledgerscreen.llm.encoding import encoder
from ledgerscreen.llm.hilbert import hilbert_key
from ledgerscreen.llm.shingles import mixed


@dataclass(frozen=True)
class Layout:
    length: int = 2048
    end_id: int = 1
    features: int = 256       # hashed count vector
    dims: int = 4
    bits: int = 10            # per dimension
    tie_bits: int = 20        # of the hashed id
    seed: int = 7
    slice_bytes: int = 4_000_000
    task_tokens: int = 16_000_000     # about what one task lays out
    ranges: int = 4           # of the key, for each task


def coordinates(flat: np.ndarray, counts: np.ndarray, lay: Layout) -> np.ndarray:
    """The projected point of each document (rows), from its token ids."""
    feature = (mixed(np.arange(int(flat.max(initial=0)) + 1, dtype=np.uint64)) % np.uint64(lay.features)).astype(np.int64)
    matrix = np.random.default_rng(lay.seed).standard_normal((lay.features, lay.dims))
    out = np.zeros((len(counts), lay.dims))
    at = starts_of(counts)
    for lo in range(0, len(counts), 512):          # a block of dense vectors at a time
        hi = min(lo + 512, len(counts))
        row = np.repeat(np.arange(hi - lo), counts[lo:hi])
        cell = row * lay.features + feature[flat[at[lo]:at[hi]]]
        v = np.bincount(cell, minlength=(hi - lo) * lay.features).reshape(hi - lo, lay.features)
        v = np.sqrt(v)
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        out[lo:hi] = (v / np.where(norm == 0, 1, norm)) @ matrix
    return out


def encoded(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, lay: Layout) -> DataFrame:
    """(id, n_tokens, width, ids, c0, c1, ...): ids are little-endian of ``width`` bytes."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    axes = [f"c{k}" for k in range(lay.dims)]

    def run(batches):
        e = encoder(tokenizer)
        small = max(e.tokenizer.get_vocab_size(), lay.end_id + 1) <= 1 << 16
        for b in sliced(batches, "text", lay.slice_bytes):
            counts, flat = e.encode(array(b.column("text")))
            points = coordinates(flat, counts, lay)
            flat = np.insert(flat.astype("<u2" if small else "<u4"), np.cumsum(counts), lay.end_id)
            counts = counts + 1
            at = (starts_of(counts) * flat.itemsize).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(at), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays(
                [array(b.column("id")), pa.array(counts), pa.array(np.full(len(counts), flat.itemsize)), ids,
                 *(pa.array(points[:, k]) for k in range(lay.dims))], names=["id", "n_tokens", "width", "ids", *axes])

    return src.mapInArrow(run, f"id {kind}, n_tokens long, width long, ids binary, " +
                          ", ".join(f"{c} double" for c in axes))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         lay: Layout = Layout()) -> DataFrame:
    """One row per piece: id, start, length, ids (binary, u32 little endian),
    doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    axes = [f"c{k}" for k in range(lay.dims)]
    rows = written(encoded(docs, tokenizer, id_col, text_col, lay), "encoded")
    stats = rows.agg(*(f(c) for c in axes for f in (F.avg, F.stddev_pop)), F.sum("n_tokens").alias("total")).first()
    tasks = max(partitions(spark), -(-(stats["total"] or 0) // lay.task_tokens))
    mean = np.array([stats[2 * k] or 0.0 for k in range(lay.dims)])
    spread = np.array([stats[2 * k + 1] or 1.0 for k in range(lay.dims)])

    @F.pandas_udf("long")
    def place(tie, *points):
        z = (np.column_stack([p.to_numpy() for p in points]) - mean) / spread
        side = 1 << lay.bits
        cells = np.clip(np.floor((z + 3) / 6 * side), 0, side - 1).astype(np.int64)
        key = (hilbert_key(cells, lay.bits) << lay.tie_bits) | tie.to_numpy()
        return type(tie)(key)

    tie = F.pmod(F.xxhash64("id"), F.lit(1 << lay.tie_bits))
    keyed = rows.withColumn("key", place(tie, *axes)).drop(*axes)
    n = lay.ranges * tasks
    cuts = keyed.agg(F.percentile_approx("key", [k / n for k in range(1, n)], 20 * n).alias("q")).first()["q"] or []
    bounds = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def range_of(key):
        return type(key)(np.searchsorted(bounds, key.to_numpy(), side="left").astype(np.int32))

    ranged = keyed.withColumn("part", range_of("key"))
    totals = ranged.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)       # one row per range
    base = totals.select("part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("base"))
    along = (Window.partitionBy("part").orderBy("key", F.col("id").asc_nulls_first(), F.xxhash64("ids"))
             .rowsBetween(Window.unboundedPreceding, -1))              # rows, as equal rows lie one after another
    ranged = ranged.repartition(tasks, "part")
    laid = ranged.withColumn("before", F.coalesce(F.sum("n_tokens").over(along), F.lit(0)))
    laid = laid.join(F.broadcast(base), "part").select(
        "id", "n_tokens", "width", "ids", (F.col("base") + F.col("before")).alias("at"))
    kind = laid.schema["id"].dataType.simpleString()

    def run(batches):
        for b in sliced(batches, "ids", lay.slice_bytes):
            n_tokens, at = (b.column(c).to_numpy() for c in ("n_tokens", "at"))
            first, last = at // lay.length, (at + n_tokens - 1) // lay.length
            doc = np.repeat(np.arange(b.num_rows), last - first + 1)
            seq = np.arange(len(doc)) - np.repeat(starts_of(last - first + 1)[:-1] - first, last - first + 1)
            begin = np.maximum(at[doc], seq * lay.length)
            end = np.minimum((at + n_tokens)[doc], (seq + 1) * lay.length)
            start = begin - at[doc]
            raw = [np.frombuffer(x.as_buffer(), f"<u{w}") for x, w in zip(b.column("ids"), b.column("width").to_pylist())]
            ids = [raw[d][s:s + m].astype("<u4").tobytes() for d, s, m in zip(doc, start, end - begin)]
            yield pa.RecordBatch.from_arrays(
                [array(b.column("id")).take(pa.array(doc)), pa.array(start), pa.array(end - begin), pa.array(ids, pa.binary()),
                 pa.array(n_tokens[doc]), pa.array(seq), pa.array(begin - seq * lay.length)],
                names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    out = laid.mapInArrow(run, f"id {kind}, start long, length long, ids binary, doc_tokens long, "
                               "sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
