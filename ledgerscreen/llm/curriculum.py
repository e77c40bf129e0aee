"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target (words that the mix takes of it) and a weight schedule
over the training time 0 to 1, linear between knots.  The integral of the schedule,
scaled to the target, is the source's cumulative demand.  A source's documents
follow one another in hashed order, in as many epochs as the target needs; each
occurrence fills an interval of that demand, and the time at which the demand reaches
its middle is the occurrence's training position.  All occurrences are then
range-sorted by position.

Defined cases: a null text has size 0; a null source is a source, the last one; a
document of size 0 takes part and takes nothing; rows that agree in id and text are told
apart by their place only; an empty table gives empty results; further columns of the
input are not read.  The last occurrence of a source is cut where the target (rounded down) is
reached, so that at most one document of a source is cut."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscreen.llm.common import written
from ledgerscreen.llm.running import running

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """``weights`` and ``schedules`` go to the sources in turn, by code point; a schedule
    is a list of (time, weight) knots from time 0 to 1 with an integral above 0."""
    share: float = 1.5           # words of the mix over words of all documents
    most: int = 2                # epochs of a source at most
    weights: tuple = (5.0, 2.0, 1.0)
    schedules: tuple = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),       # early
                        ((0.0, 1.0), (1.0, 1.0)),                   # all the time
                        ((0.0, 0.5), (0.8, 1.0), (1.0, 3.0)))       # late
    seed: int = 13


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          mix: Mix = Mix()) -> DataFrame:
    """(id, source, size, place): words of each document and its hashed place in its source."""
    text = docs[text_col].cast("string")
    return docs.select(docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.md5(F.concat_ws(":", F.lit(mix.seed), docs[id_col].cast("string"))).alias("place"),
                       F.xxhash64(text).alias("tie"))


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, source_size, weight, target, knots) of each source of ``sizes``.

    Targets share ``share`` x all words by weight; a target above ``most`` x its source's size
    stops there and the excess is shared again until none is above.  A round is one
    aggregate over the table of sources; sources only ever stop, so it ends."""
    per_source = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                         .select("source", "source_size", F.lit(0).alias("all"), F.lit(1).alias("one")), "sources")
    turn = F.array(*[F.struct(F.lit(w).alias("w"), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(v).alias("w"))
                                                             for t, v in s]).alias("knots"))
                     for w, s in zip(_cycled(mix.weights, mix), _cycled(mix.schedules, mix))])
    ranked = running(per_source, "all", [F.col("source").asc_nulls_last()], "one", "number")
    ranked = written(ranked.withColumn("_turn", F.get(turn, (F.col("number") % F.size(turn)).cast("int")))
                     .select("source", "source_size", (F.lit(mix.most) * F.col("source_size")).alias("cap"),
                             F.col("_turn.w").alias("weight"), F.col("_turn.knots").alias("knots")), "ranked")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        stops = F.col("cap") <= F.col("weight") * F.lit(level)
        r = ranked.agg(F.count_if(stops).alias("n"), F.coalesce(F.sum(F.when(stops, F.col("cap"))), F.lit(0)).alias("cap"),
                       F.sum(F.when(~stops, F.col("weight"))).alias("weight")).first()
        if r["n"] == stopped or not r["weight"]:
            break
        stopped, level = r["n"], (mix.share * total - r["cap"]) / r["weight"]
    target = F.when(F.col("cap") <= F.col("weight") * F.lit(level), F.col("cap").cast("double")).otherwise(
        F.col("weight") * F.lit(level))
    return ranked.select("source", "source_size", "weight", target.alias("target"), "knots")


def _cycled(values: tuple, mix: Mix) -> list:
    import math
    n = math.lcm(len(mix.weights), len(mix.schedules))
    return [values[k % len(values)] for k in range(n)]


def segments(knots: Column) -> Column:
    """The schedule's linear pieces with their share of the whole integral:
    array of (t, dt, w, v, before, area), ``before`` the share of the pieces before."""
    pairs = F.zip_with(F.slice(knots, F.lit(1), F.size(knots) - 1), F.slice(knots, F.lit(2), F.size(knots) - 1),
                       lambda a, b: F.struct(a["t"].alias("t"), (b["t"] - a["t"]).alias("dt"), a["w"].alias("w"),
                                             b["w"].alias("v"), ((a["w"] + b["w"]) / 2 * (b["t"] - a["t"])).alias("area")))
    whole = F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x["area"])
    return F.transform(pairs, lambda x, i: F.struct(
        x["t"].alias("t"), x["dt"].alias("dt"), (x["w"] / whole).alias("w"), (x["v"] / whole).alias("v"),
        (F.aggregate(F.slice(pairs, F.lit(1), i), F.lit(0.0), lambda s, y: s + y["area"]) / whole).alias("before")))


def time_at(demand: Column, pieces: Column) -> Column:
    """The time at which the integral of the schedule reaches ``demand`` (0 to 1)."""
    s = F.element_at(F.filter(pieces, lambda x: x["before"] <= demand), -1)
    area = demand - s["before"]
    slope = (s["v"] - s["w"]) / s["dt"]
    root = F.sqrt(F.greatest(s["w"] * s["w"] + 2.0 * area * slope, F.lit(0.0)))
    return s["t"] + F.coalesce(F.try_divide(2.0 * area, s["w"] + root), F.lit(0.0))


def occurrences(docs: DataFrame, mix: Mix = Mix(), **columns) -> tuple[DataFrame, DataFrame]:
    """(documents, mixed).

    documents: row_id, id, source, size, source_size, target - one row per input row.
    mixed: row_id, id, source, epoch, words, position, first_word - one row per
    occurrence, range-sorted by position (0 to 1); ``first_word`` counts the words of the mix before it."""
    sizes = written(sized(docs, mix=mix, **columns), "sizes")
    goal = targets(sizes, mix).withColumnRenamed("source", "_source")
    placed = running(sizes, "source", [F.col(c).asc_nulls_last() for c in ("place", "id", "size", "tie")], "size", "before")
    placed = placed.join(goal, placed["source"].eqNullSafe(goal["_source"])).drop("_source", "tie")
    limit = F.floor("target").cast("long")

    def one(epoch: int) -> Column:
        at = F.col("before") + F.lit(epoch) * F.col("source_size")
        words = F.greatest(F.least(limit - at, F.col("size")), F.lit(0))
        return F.struct(F.lit(epoch).alias("epoch"), words.alias("words"),
                        F.try_divide(at + words / 2.0, limit).alias("demand"))

    placed = written(placed, "placed")
    mixed = (placed.withColumn("pieces", segments(F.col("knots")))
             .select("row_id", "id", "source", "place", "pieces",
                     F.explode(F.array(*map(one, range(mix.most)))).alias("o"))
             .where(F.col("o.words") > 0)
             .select(F.col("row_id").alias("doc_row"), "id", "source", "place", "o.epoch", "o.words",
                     time_at(F.col("o.demand"), F.col("pieces")).alias("position"), F.lit(0).alias("all")))
    mixed = running(written(mixed, "mixed"), "all",
                    [F.col(c).asc_nulls_last() for c in ("position", "source", "place", "id", "epoch", "doc_row")],
                    "words", "first_word")
    return (placed.select("row_id", "id", "source", "size", "source_size", "target"),
            mixed.select(F.col("doc_row").alias("row_id"), "id", "source", "epoch", "words", "position", "first_word"))


def mixture(docs: DataFrame, mix: Mix = Mix(), **columns) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, taken (words, repeats
    counted), epochs, first_word (null if not taken)."""
    documents, mixed = occurrences(docs, mix, **columns)
    per_row = mixed.groupBy("row_id").agg(F.sum("words").alias("taken"), F.count(F.lit(1)).alias("epochs"),
                                          F.min("first_word").alias("first_word"))
    return documents.join(per_row, "row_id", "left").select(
        "id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"),
        F.coalesce("epochs", F.lit(0)).alias("epochs"), "first_word")
