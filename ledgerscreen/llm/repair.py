"""Conversation structure repair by a grammar-compressed dynamic programme.

Turns are read in order of turn (nulls first), then role, then text.  Each is a letter of role
class and fault; a conversation is cut into stretches of at most ``STRETCH`` letters.
Equal stretches of all conversations are solved once: Re-Pair rules counted over all of them
carry one min-plus transfer matrix with its audit rope each (transfer.py), and a stretch is the
product of the few symbols that are left of it.  Conversations of several stretches
are combined in a tree of ``FAN`` children, in which ranks stand for the strings; the
chosen states then go down the tree, so no task holds a long conversation.

Defined cases: a null role or text reads as one blank; a null conversation is one like any other,
as is a null turn; rows that agree in all columns are copies, all but the first a duplicate; an empty table
gives empty results; further columns are not read."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscreen.llm import transfer
from ledgerscreen.llm.common import array, partitions, written
from ledgerscreen.llm.running import running

STRETCH, FAN = 512, 256
#: Rules of the grammar at most, and rounds of making them: they bound what is broadcast,
#: not the results.
RULES, ROUNDS = 1_000, 12
BLANK = " \t\n\x0b\x0c\r"
ROLES = {2: "user", 3: "assistant"}
PLACE = ["conv", "range", "stretch"]
SHAPE = "letters string, costs array<long>, ranks array<int>, audits array<string>, illegal long"


@dataclass
class Repaired:
    """``summary``: conv, rows, gaps, blank, duplicate, truncated, illegal, cost.
    ``audits``: conv, number, audit: edits' initials per stretch, in order of number.
    ``turns``: the repaired turns (conv, range, stretch, slot, edit, role, text), in that order."""
    summary: DataFrame
    audits: DataFrame
    turns: DataFrame


def conversation_rows(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies) and the turn's fault as if it were alone."""
    text = F.coalesce(rows["text"].cast("string"), F.lit(" "))
    slim = rows.select(rows["conv_id"].alias("conv"), rows["turn"].alias("turn"),
                       F.coalesce(rows["role"].cast("string"), F.lit(" ")).alias("role"), text.alias("text"))
    cells = slim.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    bare = F.rtrim("text", F.lit(BLANK))
    last = F.substring(bare, -1, 1)
    fault = F.when(bare == "", "blank").when(~last.isin(".", "!", "?"), "truncated").otherwise("none")
    return cells.withColumn("alone", fault).withColumn("key", F.sha2("text", 256))


def faults(cells: DataFrame) -> DataFrame:
    """``cells`` with ``fault``: a text that its role has said in an earlier turn is a duplicate.

    Only texts found in several turns are looked up again."""
    again = (cells.where(F.col("alone") != "blank").groupBy(F.col("conv").alias("_c"), F.col("role").alias("_r"), F.col("key").alias("_k"))
             .agg(F.min(F.struct("turn")).alias("_first"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1))
    same = cells["conv"].eqNullSafe(again["_c"]) & (cells["role"] == again["_r"]) & (cells["key"] == again["_k"])
    later = F.col("_n").isNotNull() & (F.col("alone") != "blank") & ~F.col("turn").eqNullSafe(F.col("_first.turn"))
    return (cells.join(again, same, "left").withColumn("fault", F.when(later, "duplicate").otherwise(F.col("alone")))
            .drop("_c", "_r", "_k", "_first", "_n", "key", "alone"))


def letter(fault: Column) -> Column:
    kind = F.instr(F.lit(transfer.CLASSES), F.substring("role", 1, 1)) - 1
    kind = F.when((F.length("role") > 0) & (kind >= 0), kind).otherwise(F.lit(len(transfer.CLASSES)))
    place = F.when(fault == "none", 0).when(fault == "truncated", 1).otherwise(2)
    return F.substring(F.lit(transfer.LETTERS), (kind * len(transfer.FAULTS) + place + 1).cast("int"), F.lit(1))


def stretches(cells: DataFrame, most: int = STRETCH) -> DataFrame:
    """Every turn with its place: (conv, range, stretch, at, letter, role, text); copies are
    turns of their own.  Ranges of the sorted table deal a long conversation over many tasks;
    64 code points of the text, which sort as the texts do, are enough to deal by."""
    n = max(partitions(cells.sparkSession), cells.rdd.getNumPartitions())
    copy = F.when(F.col("fault") == "blank", F.col("fault")).otherwise(F.lit("duplicate"))
    slim = cells.select("conv", "turn", "role", "text", "copies", letter(F.col("fault")).alias("letter"), letter(copy).alias("more"))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role")]
    kind = cells.schema["conv"].dataType.simpleString()
    ranged = (slim.repartitionByRange(n, *order, F.substring("text", 1, 64).asc()).sortWithinPartitions(*order, "text")
              .select("conv", F.spark_partition_id().cast("long").alias("range"), "role", "text", "copies", "letter", "more"))

    def run(batches):
        last, seen, any_ = None, 0, False
        for b in batches:
            rows, out = b.to_pydict(), {c: [] for c in ("row", "stretch", "at", "letter")}

            def taken():
                picked = b.take(pa.array(out["row"], pa.int64()))
                return pa.RecordBatch.from_arrays(
                    [picked.column("conv"), picked.column("range"), pa.array(out["stretch"], pa.int64()),
                     pa.array(out["at"], pa.int32()), pa.array(out["letter"], pa.string()), picked.column("role"), picked.column("text")],
                    names=["conv", "range", "stretch", "at", "letter", "role", "text"])

            for k, (conv, copies) in enumerate(zip(rows["conv"], rows["copies"])):
                if not any_ or conv != last:
                    last, seen, any_ = conv, 0, True
                for c in range(copies):
                    for name, v in (("row", k), ("stretch", seen // most), ("at", seen % most),
                                    ("letter", rows["more" if c else "letter"][k])):
                        out[name].append(v)
                    seen += 1
                    if len(out["row"]) >= 10_000:
                        yield taken()
                        out = {c: [] for c in out}
            yield taken()

    return ranged.mapInArrow(run, f"conv {kind}, range long, stretch long, at int, letter string, role string, text string")


def learn(shapes: DataFrame) -> transfer.Grammar:
    """Re-Pair rules from the pair counts of all stretches (``letters``, ``times``).  A round counts
    what the rules so far have left; the driver sees a bounded list of pairs."""
    grammar = transfer.Grammar()
    for _ in range(ROUNDS):
        def run(batches, g=grammar):
            for b in batches:
                pairs: dict = {}
                for letters, weight in zip(b.column("letters").to_pylist(), b.column("times").to_pylist()):
                    symbols, k = g.compress(letters), 0
                    while k + 1 < len(symbols):
                        pair = symbols[k], symbols[k + 1]
                        pairs[pair] = pairs.get(pair, 0) + weight
                        k += 2 if pair[0] == pair[1] and symbols[k + 2:k + 3] == [pair[0]] else 1
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in pairs], pa.int32()), pa.array([x[1] for x in pairs], pa.int32()),
                                                  pa.array(list(pairs.values()), pa.int64())], names=["a", "b", "n"])

        counts = shapes.mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        top = counts.where("n > 1").orderBy(F.desc("n"), "a", "b").limit(RULES - len(grammar)).collect()
        if not grammar.add([(r["a"], r["b"]) for r in top]) or len(grammar) >= RULES:
            break
    return grammar


def solved(shapes: DataFrame, grammar: transfer.Grammar) -> DataFrame:
    """Cost, rank and audit of every distinct stretch, for each two states."""
    def run(batches):
        for b in batches:
            out = []
            for letters in b.column("letters").to_pylist():
                m = grammar.matrix(letters)
                costs, ranks = transfer.ranked(m)
                at = [(i, j) for i in range(transfer.STATES) for j in range(transfer.STATES)]
                out.append((letters, costs, ranks, [str(m[x][1]) if x in m else None for x in at], transfer.illegal(letters)))
            yield _batch(out, ["letters", "costs", "ranks", "audits", "illegal"],
                         [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64()])

    return shapes.mapInArrow(run, SHAPE)


def _batch(rows: list, names: list, types: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _combined(nodes: DataFrame, kind: str, fan: int) -> tuple[DataFrame, DataFrame]:
    """(children per parent, the parents as nodes)."""
    child = F.struct("number", "costs", "ranks", "first", "last", "illegal", "count")
    grouped = nodes.groupBy("conv", F.floor(F.col("number") / fan).cast("long").alias("parent")).agg(
        F.array_sort(F.collect_list(child)).alias("children"))          # fan at most
    grouped = written(grouped, "children")

    def run(batches):
        for b in batches:
            out = []
            for parent, children in zip(b.column("parent").to_pylist(), b.column("children").to_pylist()):
                m = None
                for c in children:
                    one = transfer.from_ranks(c["costs"], c["ranks"])
                    m = one if m is None else transfer.times(m, one)
                wrong = sum(c["illegal"] for c in children) + sum(
                    transfer.illegal(x["last"] + y["first"]) for x, y in zip(children, children[1:]))
                out.append((parent, *transfer.ranked(m), children[0]["first"], children[-1]["last"], wrong, sum(c["count"] for c in children)))
            made = _batch(out, ["number", "costs", "ranks", "first", "last", "illegal", "count"],
                          [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.string(), pa.string(), pa.int64(), pa.int64()])
            yield pa.RecordBatch.from_arrays([b.column("conv"), *made.columns], names=["conv", *made.schema.names])

    parents = grouped.mapInArrow(run, f"conv {kind}, number long, costs array<long>, ranks array<int>, first string, last string, "
                                      "illegal long, count long")
    return grouped, written(parents, "nodes")


def _passed_down(chosen: DataFrame, grouped: DataFrame, kind: str) -> DataFrame:
    """States of the children, from those of their parents (conv, number, start, end)."""
    both = grouped.join(chosen.withColumnRenamed("conv", "_c"), F.col("conv").eqNullSafe(F.col("_c")) & (F.col("parent") == F.col("number")))
    both = both.select("conv", F.transform("children", lambda c: F.struct(c["number"].alias("number"), c["costs"].alias("costs"),
                                                                         c["ranks"].alias("ranks"))).alias("children"), "start", "end")

    def run(batches):
        for b in batches:
            row, out = [], []
            for k, (children, start, end) in enumerate(zip(*(b.column(c).to_pylist() for c in ("children", "start", "end")))):
                states = transfer.path([transfer.from_ranks(c["costs"], c["ranks"]) for c in children], start, end)
                out += [(c["number"], i, j) for c, i, j in zip(children, states, states[1:])]
                row += [k] * len(children)
            made = _batch(out, ["number", "start", "end"], [pa.int64(), pa.int32(), pa.int32()])
            yield pa.RecordBatch.from_arrays([array(b.column("conv")).take(pa.array(row, pa.int64())), *made.columns],
                                             names=["conv", *made.schema.names])

    return both.mapInArrow(run, f"conv {kind}, number long, start int, end int")


def repair(rows: DataFrame, stretch: int = STRETCH, fan: int = FAN) -> Repaired:
    """Cheapest repair of every conversation of ``rows`` (conv_id, turn, role, text).  ``stretch`` and
    ``fan`` (2 at least) are how the work is dealt out; they don't change the result."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    cells = written(faults(written(conversation_rows(rows), "turns")), "faults")
    extra = F.col("copies") - 1
    again = F.when(F.col("fault").isin("blank", "duplicate"), F.lit(0)).otherwise(F.lit(1))
    counts = cells.groupBy("conv").agg(
        F.sum("copies").alias("rows"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.coalesce(F.sum(F.when(F.col("fault") == "blank", F.col("copies"))), F.lit(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "blank", F.lit(0)).otherwise(extra + 1 - again)).alias("duplicate"),
        F.count_if(F.col("fault") == "truncated").alias("truncated"))

    lines = written(stretches(cells, stretch), "lines")
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "letter"))), lambda x: x["letter"]), "")
    blocks = written(lines.groupBy(*PLACE).agg(letters.alias("letters")).withColumn("one", F.lit(1)), "stretches")
    shapes = written(blocks.groupBy("letters").agg(F.count(F.lit(1)).alias("times")), "shapes")
    answers = written(solved(shapes, learn(shapes)), "answers")
    numbered = running(blocks, "conv", [F.col("range").asc(), F.col("stretch").asc()], "one", "number")
    numbered = written(numbered.drop("one", "row_id"), "numbered")
    ends = (F.substring("letters", 1, 1).alias("first"), F.substring("letters", -1, 1).alias("last"))
    nodes = numbered.join(answers, "letters").select("conv", "number", "costs", "ranks", *ends, "illegal", F.lit(1).cast("long").alias("count"))

    levels = []
    while True:                                         # until every conversation is one node
        grouped, nodes = _combined(nodes, kind, fan)
        levels.append(grouped)
        if (nodes.agg(F.max("number")).first()[0] or 0) == 0:
            break

    @F.udf("int")
    def ending(costs, ranks):
        return transfer.last_state(costs, ranks)

    root = written(nodes.select("conv", "number", "illegal", F.col("costs"), F.lit(0).alias("start"), ending("costs", "ranks").alias("end"),
                                F.col("count").alias("stretches")), "roots")
    close = F.get(F.array(*[F.lit(transfer.TAIL[j]) for j in range(transfer.STATES)]), F.col("end"))
    summary = (counts.join(root.withColumnRenamed("conv", "_c"), F.col("conv").eqNullSafe(F.col("_c")))
               .select("conv", "rows", "gaps", "blank", "duplicate", "truncated", "illegal",
                       (F.get("costs", F.col("end")) + transfer.INSERT * F.length(close)).alias("cost")))
    chosen = root.select("conv", "number", "start", "end")
    for grouped in reversed(levels):
        chosen = written(_passed_down(chosen, grouped, kind), "states")
    # the closing insertions belong to the last stretch
    tail = root.select(F.col("conv").alias("_t"), (F.col("stretches") - 1).alias("_last"), close.alias("_close"))
    c = chosen.select(F.col("conv").alias("_c"), F.col("number").alias("_n"), "start", "end")
    pieces = (numbered.join(c, numbered["conv"].eqNullSafe(c["_c"]) & (numbered["number"] == c["_n"]))
              .join(answers.select("letters", "audits"), "letters")
              .join(tail, F.col("conv").eqNullSafe(F.col("_t")) & (F.col("number") == F.col("_last")), "left"))
    pieces = written(pieces.select(*PLACE, "number", "start", F.concat(
        F.get("audits", F.col("start") * transfer.STATES + F.col("end")), F.coalesce("_close", F.lit(""))).alias("audit")), "pieces")
    return Repaired(summary, pieces.select("conv", "number", "audit"), repaired_turns(lines, pieces, PLACE, kind))


def repaired_turns(lines: DataFrame, pieces: DataFrame, by: list[str], kind: str) -> DataFrame:
    """The kept, re-roled and inserted turns: a stretch's audit (at -1) comes before its turns."""
    both = (lines.select(*PLACE, "at", F.lit(0).alias("start"), "role", "text")
            .unionByName(pieces.select(*PLACE, F.lit(-1).alias("at"), "start", F.lit("").alias("role"), F.col("audit").alias("text"))))
    dealt = both.repartition(*by).sortWithinPartitions(*PLACE, "at")

    def run(batches):
        audit, at, state, slot = "", 0, 0, 0
        for b in batches:
            rows, out = b.to_pydict(), []

            def inserted(k):
                nonlocal at, state, slot
                while at < len(audit) and audit[at] == "I":
                    state = 3 if state == 2 else 2
                    out.append((k, slot, "I", ROLES[state], ""))
                    at, slot = at + 1, slot + 1

            for k, (place, role, text) in enumerate(zip(rows["at"], rows["role"], rows["text"])):
                if place < 0:
                    audit, at, state, slot = text, 0, rows["start"][k], 0
                else:
                    edit, at = audit[at], at + 1
                    if edit == "K":
                        state = transfer.STEP[state, transfer.CLASSES.index(role[0])]
                        out.append((k, slot, edit, role, text))
                    elif edit == "R":
                        state = 3 if state == 2 else 2
                        out.append((k, slot, edit, ROLES[state], text))
                    slot += edit != "D"
                inserted(k)
            made = _batch([x[1:] for x in out], ["slot", "edit", "role", "text"], [pa.int64(), pa.string(), pa.string(), pa.string()])
            taken = b.take(pa.array([x[0] for x in out], pa.int64()))
            yield pa.RecordBatch.from_arrays([*(taken.column(c) for c in PLACE), *made.columns], names=[*PLACE, *made.schema.names])

    return dealt.mapInArrow(run, f"conv {kind}, range long, stretch long, slot long, edit string, role string, text string")


def digests(turns: DataFrame, kind: str) -> DataFrame:
    """(conv, sha256 of ``role:text``, newline-joined).  Such a digest reads a conversation from
    its first turn to its last: one task per conversation, in a stream of constant memory."""
    dealt = turns.select(*PLACE, "slot", "role", "text").repartition("conv").sortWithinPartitions(*PLACE, "slot")

    def run(batches):
        last, state = None, None

        def closed():
            return _batch([(last, state.hexdigest())], ["conv", "sha256"], [conv_type, pa.string()])

        for b in batches:
            conv_type = b.schema.field("conv").type
            for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv", "role", "text"))):
                if state is None or conv != last:
                    if state is not None:
                        yield closed()
                    last, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
        if state is not None:
            yield closed()

    return dealt.mapInArrow(run, f"conv {kind}, sha256 string")
