"""Shared helpers: word splitting in Arrow, batch slicing, written tables."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscreen.session import scratch_path

#: A side of a join that is a table of keys is broadcast only while it is counted to have no more rows.
BROADCAST_ROWS = 500_000

#: Java form of one run of the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z and nothing else (no locale, no Unicode case mapping)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (null: none).

    Returns (words per text, all words in order)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        row = np.repeat(np.arange(len(counts)), counts)[full]
        counts = np.bincount(row, minlength=len(counts)).astype(np.int64)
        flat = flat.filter(pa.array(full))
    return counts, flat


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Exclusive prefix sums with the total at the end."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def released() -> None:
    """Give the memory of freed arrays back to the system.  A Python worker outlives its task,
    and there are several for each core; idle ones would hold what their largest slice took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim:
        trim(0)


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """The rows again in slices of at most ``most`` bytes of ``column`` (one row
    at least) and ``rows`` rows, so that the arrays made from a slice stay bounded."""
    for b in batches:
        if b.num_rows == 0:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < b.num_rows:
            base = size[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(size, base + most, side="right")))
            hi = min(hi, lo + rows)
            yield b.slice(lo, hi - lo)
            lo = hi
    released()


def array(x) -> pa.Array:
    """One contiguous Arrow array (a batch column, combined and offset-free)."""
    return pa.concat_arrays([x])


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")


_watched: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Gives the list of the tables written inside; those still in it at the end are
    deleted.  Results that outlive the block are written and their folder taken off the list."""
    paths: list[str] = []
    _watched.append(paths)
    try:
        yield paths
    finally:
        _watched.remove(paths)
        for path in paths:
            deleted(spark, path)


def deleted(spark: SparkSession, path: str) -> None:
    """Remove a written table by Hadoop's file system, which knows the shared folder's scheme."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives
    the loss of executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    for paths in _watched:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str) -> DataFrame:
    """A table of keys, written and counted.  The planner takes such a side of a join to be as
    large as the tables it is made from and shuffles the texts on the other side; counted,
    one of few rows is broadcast and the texts stay where they are."""
    side = written(df, name)
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def swept(spark: SparkSession) -> None:
    """The shuffle files of finished jobs go now: Spark deletes them when the driver's garbage,
    of which there is little here, is next collected."""
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 2,000 rows (and Spark's byte limit): texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
