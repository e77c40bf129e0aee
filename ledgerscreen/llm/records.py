"""Length-delimited binary token records with masked checksums and an offset index.

File format (fixed; one shard is a run of records):

    u64  payload length                     little endian, as all numbers here
    u32  masked crc32 of those eight bytes
    payload
    u32  masked crc32 of the payload
    u8   0x0A, which closes the record

    payload: u8 1 if the document has an id, else 0; i64 id; u8 bytes per token
    (2 or 4); the token ids

    masked crc: rotate the crc right by 15 bits and add 0xA282EAD8 (mod 2**32)

Shards are written through Spark's own file sink (the closing byte is its line
separator), so they land on any file system that Spark reaches, each task's
file appears only when the task has been committed, and a lost executor's tasks
are written again.  Documents are range-partitioned and sorted by id, so shard
numbers and positions ascend with the id.  The index is a Parquet table beside
the shards, made by scanning what was written: one row per record with its
shard, byte offset, id, token count and the tokens before it in the shard.

Defined cases: null text is an empty sequence (the end id alone); null ids come
first; rows with one id are ordered by a hash of their text; an empty table gives no
record; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerscreen.llm.common import array, partitions, sliced
from ledgerscreen.llm.encoding import encoder

HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<IB")
SEQUENCE = struct.Struct("<BqB")
CLOSE = 0x0A


def masked(data) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """The record without its closing byte, which the sink appends."""
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def serialized(doc: int | None, ids: np.ndarray) -> bytes:
    """The payload; ``ids`` are of two or four bytes each."""
    return SEQUENCE.pack(doc is not None, doc or 0, ids.dtype.itemsize) + ids.tobytes()


def payload_at(data: memoryview, offset: int) -> memoryview:
    length, _ = HEAD.unpack_from(data, offset)
    return data[offset + HEAD.size:offset + HEAD.size + length]


def scan(data: memoryview):
    """(offset, payload) of each record; raises if a record is damaged."""
    at, end = 0, len(data)
    while at < end:
        length, crc = HEAD.unpack_from(data, at)
        if masked(data[at:at + 8]) != crc:
            raise ValueError(f"length checksum differs at byte {at}")
        payload = data[at + HEAD.size:at + HEAD.size + length]
        crc, close = TAIL.unpack_from(data, at + HEAD.size + length)
        if masked(payload) != crc or close != CLOSE:
            raise ValueError(f"payload checksum differs at byte {at}")
        yield at, payload
        at += HEAD.size + length + TAIL.size


def sequence_ids(payload) -> tuple[int | None, np.ndarray]:
    """(document id, token ids as little-endian u32)."""
    has, doc, width = SEQUENCE.unpack_from(payload)
    ids = np.frombuffer(payload, "<u2" if width == 2 else "<u4", offset=SEQUENCE.size).astype("<u4")
    return (doc if has else None), ids


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
          text_col: str = "text", shards: int | None = None, slice_bytes: int = 4_000_000) -> None:
    """Encode every text, close it with ``end_id`` and write shards and index below ``path``."""
    src = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    n = shards or max(partitions(docs.sparkSession), src.rdd.getNumPartitions())
    place = [F.col("id").asc_nulls_first(), F.xxhash64("text")]       # the sampled keys stay small
    order = [*place, F.col("text").asc_nulls_first()]

    def run(batches):
        e = encoder(tokenizer)
        kind = np.dtype("<u2" if max(e.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        for b in sliced(batches, "text", slice_bytes):
            counts, flat = e.encode(array(b.column("text")))
            ends = np.cumsum(counts)
            flat = np.insert(flat.astype(kind), ends, end_id)      # an end id behind each document
            ends += np.arange(1, len(ends) + 1)
            out = [frame(serialized(doc, flat[lo:hi]))
                   for doc, lo, hi in zip(b.column("id").to_pylist(), ends - counts - 1, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    (src.repartitionByRange(n, *place).sortWithinPartitions(*order)
        .mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
        .write.text(f"{path}/shards", lineSep="\n"))
    scanned(docs.sparkSession, path).write.parquet(f"{path}/index")


INDEX = "shard long, record long, doc_id long, offset long, n_tokens long, start_in_shard long, ids_crc32 long"


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """(shard number, content): a shard is bounded by the writer's partition count."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/shards")
    return files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("shard"), "content")


def scanned(spark: SparkSession, path: str) -> DataFrame:
    """The index rows, from the shards themselves; checks every checksum."""
    def run(batches):
        for b in batches:
            for shard, content in zip(b.column("shard").to_pylist(), b.column("content")):
                rows, before = [], 0
                for k, (at, payload) in enumerate(scan(memoryview(content.as_buffer()))):
                    doc, ids = sequence_ids(payload)
                    rows.append((shard, k, doc, at, len(ids), before, zlib.crc32(ids)))
                    before += len(ids)
                cols = list(zip(*rows)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 names=[x.split()[0] for x in INDEX.split(", ")])

    return shard_files(spark, path).mapInArrow(run, INDEX)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index with each record's ``start``: the tokens before it in all shards.

    One row per shard is summed in order; shards are megabytes each, so that
    list is smaller than the data by the same factor."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    base = totals.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    return index.join(base, "shard").withColumn("start", F.col("base") + F.col("start_in_shard")).drop("base")


def read_shuffled(spark: SparkSession, path: str, seed: int = 0, epoch: int = 0) -> DataFrame:
    """(doc_id, ids) in an order drawn from the seed and epoch.  The order comes
    from the index alone; records are cut out of their shards by offset."""
    wanted = (spark.read.schema(INDEX).parquet(f"{path}/index")
              .select("shard", "offset", F.xxhash64(F.lit(seed), F.lit(epoch), "shard", "record").alias("place")))
    per_shard = wanted.groupBy("shard").agg(F.collect_list(F.struct("place", "offset")).alias("wanted"))

    def run(batches):
        for b in batches:
            for content, want in zip(b.column("content"), b.column("wanted").to_pylist()):
                data = memoryview(content.as_buffer())
                out = []
                for w in want:
                    doc, ids = sequence_ids(payload_at(data, w["offset"]))
                    out.append((w["place"], doc, ids))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                     pa.array([x[2] for x in out], pa.list_(pa.int64()))], names=["place", "doc_id", "ids"])

    cut = shard_files(spark, path).join(per_shard, "shard").mapInArrow(run, "place long, doc_id long, ids array<long>")
    return cut.orderBy("place", "doc_id").drop("place")
