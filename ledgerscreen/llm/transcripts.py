"""Transcript parsing: roles by a hidden Markov model, then canonical turns.

A transcript is a run of lines, some of which begin with a speaker marker
("User:", "### Response", "<|system|>", "Speaker 2:") and some do not.  Hidden
states are role x (first line of a turn, later line).  A line shows a marker
class, whether a blank line stands before it, whether it ends in a question mark
and a length class; the emission is their product.  Transitions and emissions are
counted, with add-one smoothing, on lines whose role is known.  Viterbi finds the
states, and a new turn begins wherever a first-line state stands.  Only then is a
marker cut, and only where it fits the role found: inside a turn every character
stays, blank lines, indentation and lines that look like a marker too.

Long transcripts come in parts (rows of ``id, part, text``).  Viterbi stays exact
over parts: each part gives its matrix of best scores between an entry and an exit
state, the matrices of one id (a handful of numbers per part) are chained, and
each part is decoded between the states so fixed.  No transcript is gathered
whole.

Defined cases: null or empty text has no turn; a null id is ignored; lines before
any marker belong to the role the model prefers there; markers alone on a line
belong to the next line with text; blank lines between two turns, markers and the
blanks around them belong to no turn; rows of one (id, part) are one part, in the
order of their text, and a null part is part 0; turns of other roles are not
learned from; further columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerscreen.llm.common import array, written

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)                 # 2 * role: first line; 2 * role + 1: later line

# fixed values: words that speakers are marked with
SPEAKERS = {
    "system": "system sys context note".split(),
    "user": "user human q question instruction customer prompt".split(),
    "assistant": "assistant ai bot a answer response model agent".split(),
}
NONE, OTHER = len(ROLES), len(ROLES) + 1
CLASS = {w: k for k, r in enumerate(ROLES) for w in SPEAKERS[r]}
MARKER = re.compile(r"[ \t]*(?:<\|([A-Za-z]+)\|>|\[([A-Za-z]+)\]|#{2,4}[ \t]*([A-Za-z]+)[ \t]*:?[ \t]*$"
                    r"|([A-Za-z]+(?: [0-9]+)?)[ \t]*:(?=[ \t]|$))[ \t]*")
CHOICES = (len(ROLES) + 2, 2, 2, 4)     # values of: marker class, blank before, question, length class


@dataclass
class Hmm:
    start: np.ndarray       # log probabilities
    move: np.ndarray
    show: list[np.ndarray]  # per feature: states x values


def marker_of(line: str) -> tuple[int, str]:
    """(marker class, the line behind the marker)."""
    m = MARKER.match(line)
    if not m:
        return NONE, line
    word = (m[1] or m[2] or m[3] or m[4]).lower()
    if word in CLASS:
        return CLASS[word], line[m.end():]
    speaker = m[4] is not None and (word[-1].isdigit() or word == "speaker")
    return (OTHER, line[m.end():]) if speaker else (NONE, line)


@dataclass
class Line:
    """A line with text."""
    before: list[str]       # raw lines since the line with text before it: blanks and markers alone
    raw: str
    own: int                # class of the marker on the line itself
    rest: str               # what stands behind that marker

    def opening(self, role: int) -> str:
        """The beginning of a turn of ``role``: markers that fit it are cut."""
        if self.own != NONE:
            return self.rest if self.own in (role, OTHER) else self.raw
        for k in range(len(self.before) - 1, -1, -1):
            kind, _ = marker_of(self.before[k])
            if kind != NONE:
                return self.raw if kind in (role, OTHER) else "\n".join([*self.before[k:], self.raw])
        return self.raw


def observed(text: str) -> tuple[np.ndarray, list[Line], list[str]]:
    """Feature values (lines x features), the lines with text, the raw lines behind the last of them."""
    rows, kept, before, blank, waiting = [], [], [], 0, NONE
    for line in text.split("\n"):
        kind, rest = marker_of(line)
        if not rest.strip():
            before.append(line)
            blank, waiting = (blank or kind == NONE) * 1, kind if kind != NONE else waiting
            continue
        kept.append(Line(before, line, kind, rest))
        n = len(rest)
        rows.append((waiting if kind == NONE else kind, blank, int(rest.rstrip().endswith("?")),
                     0 if n < 60 else 1 if n < 200 else 2 if n < 600 else 3))
        before, blank, waiting = [], 0, NONE
    return np.array(rows, np.int64).reshape(-1, len(CHOICES)), kept, before


def emissions(m: Hmm, seen: np.ndarray) -> np.ndarray:
    return sum(m.show[k][:, seen[:, k]].T for k in range(len(CHOICES)))


def part_matrix(m: Hmm, seen: np.ndarray) -> np.ndarray:
    """Best score from each state before the part to each state at its end."""
    score = np.where(np.eye(STATES, dtype=bool), 0.0, -np.inf)
    for e in emissions(m, seen):
        score = (score[:, :, None] + m.move[None]).max(axis=1) + e
    return score


def decode(m: Hmm, seen: np.ndarray, entry: int | None, exit: int | None) -> np.ndarray:
    """Best states; ``entry`` is the state before the part (None: its first line opens the transcript)."""
    e = emissions(m, seen)
    back = np.zeros(e.shape, np.int64)
    score = (m.start if entry is None else m.move[entry]) + e[0]
    for t in range(1, len(e)):
        step = score[:, None] + m.move
        back[t] = step.argmax(axis=0)
        score = step.max(axis=0) + e[t]
    out = np.zeros(len(e), np.int64)
    out[-1] = score.argmax() if exit is None else exit
    for t in range(len(e) - 1, 0, -1):
        out[t - 1] = back[t, out[t]]
    return out


def learn(turns: DataFrame) -> Hmm:
    """Count the model on (id, seq, role, text): raw turns, markers included, of
    known roles in the order ``seq``.  Only sums per state reach the driver."""
    def count(batches):
        total = np.zeros(STATES * sum(CHOICES))
        more = np.zeros(2 * len(ROLES))                  # later lines that follow, turns
        for b in batches:
            for role, text in zip(b.column("role").to_pylist(), b.column("text").to_pylist()):
                seen, _, _ = observed(text or "")
                r = ROLES.index(role)
                more[2 * r] += max(len(seen) - 1, 0)
                more[2 * r + 1] += len(seen) > 0
                for k, values in enumerate(seen):
                    at = (2 * r + (k > 0)) * sum(CHOICES)
                    for f, v in enumerate(values):
                        total[at + sum(CHOICES[:f]) + v] += 1
        both = np.concatenate([total, more])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both))), pa.array(both)], names=["k", "n"])

    known = turns.where(F.col("role").isin(*ROLES))
    got = known.select("role", "text").mapInArrow(count, "k long, n double").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    sums = np.zeros(STATES * sum(CHOICES) + 2 * len(ROLES))
    sums[got["k"].to_numpy(np.int64)] = got["n"].to_numpy()
    table = sums[:STATES * sum(CHOICES)].reshape(STATES, sum(CHOICES)) + 1
    show, at = [], 0
    for n in CHOICES:
        part = table[:, at:at + n]
        show.append(np.log(part / part.sum(axis=1, keepdims=True)))
        at += n
    later, begun = sums[STATES * sum(CHOICES):].reshape(-1, 2).T
    follow = Window.partitionBy("id").orderBy("seq", "role", "text")
    pairs = known.select("role", F.lag("role").over(follow).alias("was")).groupBy("was", "role").count().collect()
    first, switch = np.ones(len(ROLES)), np.ones((len(ROLES), len(ROLES)))
    for p in pairs:                                      # at most (roles + 1) * roles rows
        r = ROLES.index(p["role"])
        if p["was"] is None:
            first[r] += p["count"]
        else:
            switch[ROLES.index(p["was"]), r] += p["count"]
    stay = (later + 1) / (later + begun + 2)             # a line is followed by another of its turn
    start, move = np.full(STATES, -np.inf), np.full((STATES, STATES), -np.inf)
    start[::2] = np.log(first / first.sum())
    for r in range(len(ROLES)):
        for s in (2 * r, 2 * r + 1):
            move[s, 2 * r + 1] = np.log(stay[r])
            move[s, ::2] = np.log((1 - stay[r]) * switch[r] / switch[r].sum())
    return Hmm(start, move, show)


def boundaries(m: Hmm, parts: DataFrame) -> DataFrame:
    """(id, part, entry, exit) of the parts of ids that have several with text."""
    def matrices(batches):
        for b in batches:
            ids, at, out = [], [], []
            for k, text in enumerate(b.column("text").to_pylist()):
                seen, _, _ = observed(text or "")
                if len(seen):
                    ids.append(k)
                    out.append(part_matrix(m, seen).ravel())
                    # the first line of a transcript starts it: its own scores from the start
                    opened = m.start + emissions(m, seen[:1])[0]
                    at.append((opened[:, None] + part_matrix(m, seen[1:])).max(axis=0))
            take = pa.array(ids, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [array(b.column("id")).take(take), array(b.column("part")).take(take),
                 pa.array([list(x) for x in out], pa.list_(pa.float64())),
                 pa.array([list(x) for x in at], pa.list_(pa.float64()))], names=["id", "part", "m", "open"])

    kind = parts.schema["id"].dataType.simpleString()
    scores = written(parts.mapInArrow(matrices, f"id {kind}, part long, m array<double>, open array<double>"), "parts")
    several = scores.groupBy("id").count().where("count > 1").select("id")

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        score = np.array(group["open"].iloc[0])
        back = []
        for x in group["m"].iloc[1:]:
            step = score[:, None] + np.array(x).reshape(STATES, STATES)
            back.append(step.argmax(axis=0))
            score = step.max(axis=0)
        exits = [int(score.argmax())]
        for b in reversed(back):
            exits.append(int(b[exits[-1]]))
        exits.reverse()
        return pd.DataFrame({"id": group["id"].to_numpy(), "part": group["part"].to_numpy(),
                             "entry": [-1, *exits[:-1]], "exit": exits})

    return scores.join(several, "id", "left_semi").groupBy("id").applyInPandas(
        chain, f"id {kind}, part long, entry long, exit long")


def turns(parts: DataFrame, m: Hmm) -> DataFrame:
    """(id, turn, role, text, n_lines) from (id, part, text)."""
    parts = parts.where(parts["id"].isNotNull()).select(
        "id", F.coalesce(parts["part"].cast("long"), F.lit(0)).alias("part"), parts["text"].cast("string").alias("text"))
    parts = parts.groupBy("id", "part").agg(F.array_join(F.array_sort(F.collect_list("text")), "\n").alias("text"),
                                            F.count("text").alias("n")).where("n > 0").drop("n")
    kind = parts.schema["id"].dataType.simpleString()
    fixed = parts.join(boundaries(m, parts), ["id", "part"], "left")

    def run(batches):
        for b in batches:
            rows = []
            for id_, part, text, entry, exit in zip(*(b.column(c).to_pylist() for c in
                                                      ("id", "part", "text", "entry", "exit"))):
                seen, lines, tail = observed(text or "")
                if not lines:                  # blanks inside a turn, if it goes on
                    rows.append((id_, part, 0, False, None, None, text, 0))
                    continue
                states = decode(m, seen, None if entry in (None, -1) else entry, exit)
                local, begin = 0, 0
                for k in range(1, len(lines) + 1):
                    if k == len(lines) or states[k] % 2 == 0:
                        opens, role = bool(states[begin] % 2 == 0), int(states[begin] // 2)
                        local += opens
                        first = lines[begin]
                        body = [first.opening(role)] if opens else [*first.before, first.raw]
                        for x in lines[begin + 1:k]:
                            body += [*x.before, x.raw]
                        rows.append((id_, part, local, opens, ROLES[role], "\n".join(body),
                                     "\n".join(tail) if tail and k == len(lines) else None, k - begin))
                        begin = k
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    (b.column("id").type, pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int64()))],
                names=["id", "part", "local", "opens", "role", "text", "tail", "n_lines"])

    pieces = written(fixed.select("id", "part", "text", "entry", "exit").mapInArrow(
        run, f"id {kind}, part long, local long, opens boolean, role string, text string, tail string, n_lines long"), "turns")
    opened = pieces.groupBy("id", "part").agg(F.sum(F.col("opens").cast("long")).alias("n"))
    ahead = Window.partitionBy("id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # a row per part
    base = opened.select("id", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    placed = pieces.join(base, ["id", "part"]).withColumn("turn", F.col("base") + F.col("local") - 1)
    # a turn's pieces in order; what stands behind the last one with text is no part of it
    body = F.expr("array_sort(collect_list(struct(part, text, tail)))")
    turns = placed.where("turn >= 0").groupBy("id", "turn").agg(F.max("role").alias("role"), body.alias("body"),
                                                                F.sum("n_lines").alias("n_lines"))
    last = F.expr("array_max(transform(body, (x, k) -> if(x.text IS NULL, -1, k)))")
    kept = F.expr("flatten(transform(slice(body, 1, last + 1), (x, k) -> "
                  "array_compact(array(x.text, if(k < last, x.tail, null)))))")
    return turns.withColumn("last", last).select("id", "turn", "role", F.array_join(kept, "\n").alias("text"), "n_lines")


def canonical(role, text):
    """One turn in the chat format: role marker, text, end marker."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>\n"))
