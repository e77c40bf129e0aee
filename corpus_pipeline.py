"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``; all but the last return the
columns of ``documents``.  The same limits and parameters hold at every size.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscreen.llm import lines, minhash, packing, repetition, templates
from ledgerscreen.llm.common import deleted, scratch, small_batches, written
from ledgerscreen.llm.queries import table, vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the suffix-array repetition rules keep."""
    small_batches(spark)
    return repetition.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that five or more documents share (the last of them keeps each)."""
    small_batches(spark)
    index = lines.insert(lines.empty_index(docs), docs)
    out = lines.dedup(docs, index, refs=index.refs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    small_batches(spark)
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return templates.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens along the Hilbert curve."""
    small_batches(spark)
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("pack", pack)]

#: The token ids come from a tokenizer, which SQL cannot express; tests/llm
#: compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    last = None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as tables:          # a stage's own tables go once its result is written
            docs = written(stage(spark, docs, sf_dir), name)
            result = tables.pop()
        if last:
            deleted(spark, last)                # so does the result before it
        last = result
    return STAGES[-1][1](spark, docs, sf_dir)
