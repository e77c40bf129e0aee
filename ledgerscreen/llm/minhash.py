"""MinHash near-dedup with sequential Bayesian verification.

1. A pass over the texts gives each its shingle set's size, a 128-bit set
   fingerprint and a MinHash signature.  Equal fingerprints are one class; only
   one representative per class goes on, so copies cost one row each.
2. Representatives that agree in a band of the signature share a bucket.  The pairs
   of a bucket of at most ``few`` members are candidates.
3. A larger bucket names one hub, the best connected document that a member shares
   any bucket with, and only its pairs with the members are compared, on their full
   sets: one row per member and band, not a row per pair.  That leaves the pairs of members that are
   not both linked to the hub.  If two members share none of the shingles that the
   hub lacks, their intersection is at most the smaller of their intersections with
   the hub, and with the threshold that leaves few pairs; they become candidates.
   Members that share such a shingle, with enough in common to reach the threshold,
   form a new bucket without the hub.  Of such a bucket, ``few`` members that are not linked to
   the hub are paired with the others; from ``most`` members down it is one block, whose exact
   intersections are one matrix product in a task and of which only links leave it; a larger
   one goes through step 3 again with a hub of its own members.  It ends
   when every bucket is done; no link is lost and no group is written out in pairs.
4. The candidates' signatures are compared in batches.  After each batch, with m of n
   hashes equal and a uniform prior, the similarity has a Beta(m+1, n-m+1)
   posterior; the pair is pruned as soon as P(similarity >= threshold) is below
   ``miss``.  Survivors are verified on their full shingle sets.
5. The links' connected components give the result.

Texts are shuffled once at most, for the shingle sets of the classes that share a bucket, and once
more to drop rows; neither while the ids in question are few enough to be broadcast.  Tables
are deleted as soon as the next is written.

Defined cases: texts without words are linked with nothing; rows that share an
id and differ in text are separate documents; a row without an id takes part and
is never dropped; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerscreen.llm.common import array, counted, deleted, scratch, sliced, starts_of, swept, written
from ledgerscreen.llm.components import components
from ledgerscreen.llm.shingles import mixed, shingle_sets


@dataclass(frozen=True)
class Scheme:
    width: int = 5
    percent: int = 75            # links: 100 * intersection >= percent * union
    bands: int = 40
    rows: int = 5                # a pair of similarity 0.75 shares no band with probability 2e-5
    few: int = 8                 # buckets of so many members are compared pair by pair
    most: int = 1024             # what a hub leaves of a bucket is one block from so many members down
    batch: int = 40              # hashes compared between two looks at the posterior
    miss: float = 1e-6           # pruning threshold on the posterior
    slice_bytes: int = 2_000_000

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def least_matches(scheme: Scheme) -> list[tuple[int, int]]:
    """(n, smallest m that is not pruned) for each look."""
    x = (np.arange(20_000) + 0.5) / 20_000
    tail = x >= scheme.percent / 100
    out = []
    for n in range(scheme.batch, scheme.hashes + 1, scheme.batch):
        for m in range(n + 1):
            log = m * np.log(x) + (n - m) * np.log1p(-x)
            w = np.exp(log - log.max())
            if w[tail].sum() / w.sum() >= scheme.miss:
                out.append((n, m))
                break
    return out


def signatures(values: np.ndarray, counts: np.ndarray, scheme: Scheme) -> np.ndarray:
    """One row of ``hashes`` u32 per non-empty set."""
    some = counts[counts > 0]
    at = starts_of(some)[:-1]
    seeds = mixed(np.arange(1, 2 * scheme.hashes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.empty((scheme.hashes, len(some)), np.uint32)
    for k in range(scheme.hashes):
        v = (values ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint64(1))
        out[k] = np.minimum.reduceat(v, at) >> np.uint64(32) if len(some) else 0
    return np.ascontiguousarray(out.T)


def fingerprints(values: np.ndarray, counts: np.ndarray, salt: int) -> np.ndarray:
    """64 bits of each set, 0 for an empty one."""
    out = np.zeros(len(counts), np.uint64)
    full = counts > 0
    if full.any():
        out[full] = np.add.reduceat(mixed(values + np.uint64(salt)), starts_of(counts[full])[:-1])
        out[full] = mixed(out[full] ^ counts[full].astype(np.uint64))
    return out.view(np.int64)


def described(docs: DataFrame, id_col: str, text_col: str, scheme: Scheme) -> DataFrame:
    """(id, n, s, s2, sig): set size, fingerprint halves and signature; the
    last three are null for an empty set."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        for b in sliced(batches, "text", scheme.slice_bytes):
            counts, values = shingle_sets(array(b.column("text")), scheme.width)
            full = counts > 0
            prints = [pa.array(fingerprints(values, counts, salt), mask=~full) for salt in (1, 2)]
            rows = iter(signatures(values, counts, scheme))
            sig = pa.array([next(rows).tobytes() if f else None for f in full], pa.binary())
            yield pa.RecordBatch.from_arrays([array(b.column("id")), pa.array(counts), *prints, sig],
                                             names=["id", "n", "s", "s2", "sig"])

    return src.mapInArrow(run, f"id {kind}, n long, s long, s2 long, sig binary")


def not_pruned(pairs: DataFrame, sigs: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) that the sequential test lets pass."""
    looks = least_matches(scheme)
    size = scheme.batch

    def run(batches):
        for b in batches:
            n = b.num_rows
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(n, -1) for c in ("x", "y"))
            alive, equal = np.arange(n), np.zeros(n, np.int64)
            for done, least in looks:
                part = slice(done - size, done)
                equal = equal + (x[alive, part] == y[alive, part]).sum(axis=1)
                go = equal >= least
                alive, equal = alive[go], equal[go]
            yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(alive)), b.column("b").take(pa.array(alive))],
                                             names=["a", "b"])

    left = sigs.select(F.col("s").alias("a"), F.col("sig").alias("x"), F.col("n").alias("na"))
    right = sigs.select(F.col("s").alias("b"), F.col("sig").alias("y"), F.col("n").alias("nb"))
    fits = 100 * F.least("na", "nb") >= scheme.percent * F.greatest("na", "nb")     # sizes alone can rule a pair out
    return (pairs.join(left, "a").join(right, "b").where(fits).select("a", "b", "x", "y")
            .mapInArrow(run, "a long, b long"))


def shingle_table(texts: DataFrame, scheme: Scheme) -> DataFrame:
    """(s, set) from (s, text): sorted u64 hashes.  Texts that are not the class's own
    (their rows share its id) drop out; a text given without a class names its own."""
    def sets(batches):
        for b in sliced(batches, "text", scheme.slice_bytes):
            counts, values = shingle_sets(array(b.column("text")), scheme.width)
            at = starts_of(counts)
            prints, given = fingerprints(values, counts, 1), array(b.column("s"))
            own = (counts > 0) & (given.is_null().to_numpy(zero_copy_only=False) | (prints == given.fill_null(0).to_numpy()))
            out = [values[lo:hi].tobytes() if k else None for lo, hi, k in zip(at, at[1:], own)]
            both = pa.RecordBatch.from_arrays([pa.array(prints), pa.array(out, pa.binary())], names=["s", "set"])
            yield both.filter(pa.array(own))

    return texts.mapInArrow(sets, "s long, set binary").dropDuplicates(["s"])


def compared(pairs: DataFrame, sets: DataFrame, with_rest: bool = True) -> DataFrame:
    """(h, m) pairs to (h, m, nh, nm, both, rest): set sizes, size of the intersection
    and the shingles of m that h lacks."""
    def run(batches):
        for b in batches:
            rows = []
            for x, y in zip(b.column("x"), b.column("y")):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.minimum(np.searchsorted(p, q), len(p) - 1)
                same = p[at] == q
                rows.append((len(p), len(q), int(same.sum()), q[~same].view(np.int64) if with_rest else None))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column("h"), b.column("m"), *(pa.array(c, pa.int64()) for c in cols[:3]),
                 pa.array(cols[3], pa.list_(pa.int64()))], names=["h", "m", "nh", "nm", "both", "rest"])

    left = sets.select(F.col("s").alias("h"), F.col("set").alias("x"))
    right = sets.select(F.col("s").alias("m"), F.col("set").alias("y"))
    return (pairs.join(left, "h").join(right, "m").select("h", "m", "x", "y")
            .mapInArrow(run, "h long, m long, nh long, nm long, both long, rest array<long>"))


def linked_together(sets: list, percent: int) -> np.ndarray:
    """For each of at most ``most`` sets, the first that it is linked with, directly or over
    others.  All intersections come from one product of the sets' indicator rows, a piece of
    their common shingles at a time; entries are counts below 2 ** 24, exact in single precision."""
    sizes = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, name, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times > 1
    column, shared = (np.cumsum(common) - 1)[name], common[name]
    order = np.argsort(column[shared], kind="stable")
    row, column = row[shared][order], column[shared][order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(common.sum()), 4096):
        a, b = np.searchsorted(column, [lo, lo + 4096])
        x = np.zeros((len(sets), 4096), np.float32)
        x[row[a:b], column[a:b] - lo] = 1
        both += x @ x.T
    both = both.astype(np.int64)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    np.fill_diagonal(linked, True)
    label = np.arange(len(sets))
    while True:
        least = np.where(linked, label[None, :], len(sets)).min(axis=1)
        least = np.minimum(least, least[least])
        if (least == label).all():
            return label
        label = least


def block_links(members: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """Links (a, b) that connect what is linked inside each bucket of at most ``most`` members:
    a bucket is one row of its members' sets, and only links leave it, one per member at most."""
    rows = members.select("b", "s").join(sets, "s").groupBy("b").agg(F.collect_list(F.struct("s", "set")).alias("m"))

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                m = array(b.column("m").slice(k, 1)).flatten()
                ids = m.field("s").to_numpy(zero_copy_only=False)
                label = linked_together([np.frombuffer(x.as_buffer(), np.uint64) for x in m.field("set")], scheme.percent)
                other = label != np.arange(len(label))
                yield pa.RecordBatch.from_arrays([pa.array(ids[label[other]]), pa.array(ids[other])], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def links(sigs: DataFrame, keyed: DataFrame, first: DataFrame, scheme: Scheme) -> DataFrame:
    """Links (a, b) that connect all classes of similarity ``percent`` or more; ``keyed`` has
    the texts (id, text) and ``first`` the id (s, id) whose text stands for a class."""
    step = 4 * scheme.rows
    parts = sigs.select("s", "sig", F.explode(F.sequence(F.lit(0), F.lit(scheme.bands - 1))).alias("band"))
    bucket = F.xxhash64("band", F.expr(f"substring(sig, band * {step} + 1, {step})")).alias("b")
    every = parts.select("s", bucket)
    shared = every.groupBy("b").agg(F.count("*").alias("c")).where("c > 1")
    members = written(every.join(shared, "b").select("b", "s", "c"), "members")
    swept(sigs.sparkSession)
    needed = counted(members.select("s").distinct(), "needed")
    of_id = counted(first.join(needed, "s", "left_semi"), "needed-ids")
    # texts without an id are found by their own fingerprint
    wanted = keyed.join(of_id, "id").select("s", "text").unionByName(
        keyed.where("id IS NULL").select(F.lit(None).cast("long").alias("s"), "text"))
    sets = written(shingle_table(wanted, scheme).join(needed, "s", "left_semi"), "sets")
    sigs = written(sigs.join(needed, "s", "left_semi"), "signatures")
    linked = 100 * F.col("both") >= scheme.percent * (F.col("nh") + F.col("nm") - F.col("both"))
    # the largest set that a member can link with, if they share nothing but the hub's shingles
    room = F.floor((100 + scheme.percent) * F.col("both") / scheme.percent) - F.col("nm")
    few = scheme.few
    found, near, first = [], [_pairs_of(members, few)], True
    members = members.where(F.col("c") > few)
    # one order for all rounds: a hub stands above all of its members, so the topmost member
    # of the buckets it leaves is lower each round and the loop ends with no bucket given up
    order = written(members.groupBy("s").agg(F.sum("c").alias("reach")), "order")
    while not members.isEmpty():
        ranked = members.join(order, "s")
        # the topmost member of a bucket; at first, of all buckets that its members are in
        hubs = ranked.groupBy("b").agg(F.max(F.struct("reach", "s")).alias("top"))
        if first:
            best = members.join(hubs, "b").groupBy("s").agg(F.max("top").alias("best"))
            hubs = members.join(best, "s").groupBy("b").agg(F.max("best").alias("top"))
        hubs = hubs.select("b", F.col("top.s").alias("h"))
        first = False
        pairs = written(members.join(hubs, "b").where("s <> h").select("h", F.col("s").alias("m")).distinct(), "pairs")
        group = written(compared(pairs, sets).withColumn("linked", linked).withColumn("room", room), "compared")
        found.append(group.where("linked").select(F.col("h").alias("a"), F.col("m").alias("b")))
        open_ = (group.groupBy("h").agg(F.max(~F.col("linked")).alias("open"), F.min("nm").alias("least"),
                                        F.max(F.when(~F.col("linked"), F.col("room"))).alias("most")).where("open"))
        rows = group.join(open_, "h")
        outer = rows.where("NOT linked AND room >= least").select("h", F.col("m").alias("a"), F.col("nm").alias("na"),
                                                                  F.col("room").alias("ra"))
        inner = rows.where("nm <= most").select("h", F.col("m").alias("b"), "nm", "room", "linked")
        near.append(written(outer.join(inner, "h").where("nm <= ra AND na <= room AND (linked OR a < b) AND a <> b")
                            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near"))
        # common shingles two linking members must have beside the hub's, by what each has of the hub's; of those
        # of a member, rarest first, as many are left out as cannot hold the first common one
        need = F.ceil(scheme.percent * F.col("nm") / 100) - F.col("both")
        least = group.where("NOT linked").groupBy("h").agg(F.min(need).alias("k_open"))
        rest = (rows.join(least, "h").withColumn("k", F.greatest(need, F.lit(1), F.when(F.col("linked"), F.col("k_open"))))
                .select("h", "m", "k", (~F.col("linked")).alias("open"), F.explode("rest").alias("g")))
        common = rest.groupBy("h", "g").agg(F.count("*").alias("c")).where("c > 1")
        own = Window.partitionBy("h", "m")                                      # the shingles of one document
        rest = written(rest.join(common, ["h", "g"]).withColumn("at", F.row_number().over(own.orderBy("c", "g")))
                       .withColumn("r", F.count("*").over(own)).where("at <= r - k + 1").select("h", "m", "g", "open"), "rest")
        crowd = (rest.groupBy("h", "g").agg(F.count("*").alias("c"), F.sum(F.col("open").cast("long")).alias("o"),
                                            F.sum(F.xxhash64("m").cast("decimal(38,0)")).alias("who")).where("c > 1 AND o > 0"))
        one = crowd.groupBy("h", "c", "o", "who").agg(F.min("g").alias("g"))    # equal groups once
        members = written(rest.join(one, ["h", "g"]).select(F.xxhash64("h", "g").alias("b"), F.col("m").alias("s"), "c",
                                                            "o", "open"), "members")
        small = members.where((F.col("c") <= few) | (F.col("o") <= few))
        near.append(_pairs_of(small.where("c <= o"), few).union(written(
            small.where("c > o AND open").select("b", F.col("s").alias("a"))
            .join(small.where("c > o").select("b", F.col("s").alias("z"), "open"), "b")
            .where("a <> z AND (NOT open OR a < z)").select(F.least("a", "z").alias("a"), F.greatest("a", "z").alias("b"))
            .distinct(), "near")))
        left = members.where((F.col("c") > few) & (F.col("o") > few))
        found.append(written(block_links(left.where(F.col("c") <= scheme.most), sets, scheme), "blocks"))
        members = left.where(F.col("c") > scheme.most).select("b", "s", "c")
    close = written(reduce(DataFrame.union, near).distinct(), "close")
    passed = not_pruned(close, sigs, scheme).select(F.col("a").alias("h"), F.col("b").alias("m"))
    verified = compared(passed, sets, with_rest=False).where(linked)
    found.append(verified.select(F.col("h").alias("a"), F.col("m").alias("b")))
    return written(reduce(DataFrame.union, found), "found")


def _pairs_of(members: DataFrame, few: int) -> DataFrame:
    """The pairs (a, b) of the buckets of at most ``few`` members."""
    small = members.where(F.col("c") <= few)
    return written(small.select("b", F.col("s").alias("a")).join(small.select("b", F.col("s").alias("z")), "b")
                   .where("a < z").select("a", F.col("z").alias("b")).distinct(), "near")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    scheme: Scheme = Scheme()) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id that
    links reach) and kept (the row has that id)."""
    spark = docs.sparkSession
    with scratch(spark) as tables:
        shingled = written(described(docs, id_col, text_col, scheme), "shingled")
        rows = written(shingled.select("id", "n", "s"), "rows")
        tables.pop()
        # one signature per class (equal sets have equal ones), and the text of its smallest id
        classes = written(shingled.where("n > 0").groupBy("s", "s2", "n").agg(
            F.min("id").alias("least"), F.first("sig").alias("sig")), "classes")
        deleted(spark, tables.pop(0))
        swept(spark)
        keyed = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
        found = links(classes.select("s", "n", "sig"), keyed, classes.select("s", F.col("least").alias("id")), scheme)
        labels = components(found).withColumnRenamed("node", "s")
        labelled = classes.select("s", "least").join(labels, "s", "left").select(
            "s", "least", F.coalesce("label", "s").alias("label"))
        least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
        reach = written(labelled.join(least, "label").select("s", "component_id"), "reach")
        tables.pop()
    swept(spark)
    out = rows.select("id", "n", "s").join(reach, "s", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scheme: Scheme = Scheme()) -> DataFrame:
    """The rows that are kept, with all their columns; equal rows are one."""
    with scratch(docs.sparkSession) as tables:
        verdict = near_duplicates(docs, id_col, text_col, scheme).where(F.col(id_col).isNotNull())
        per_id = verdict.groupBy(F.col(id_col).alias("__id")).agg(F.max("kept").alias("__kept"), F.count("*").alias("__rows"))
        # the ids whose rows are not simply kept; every id has a verdict
        other = counted(per_id.where(~F.col("__kept") | (F.col("__rows") > 1)), "verdict")
        tables.pop()
    same = docs[id_col] == other["__id"]
    once = docs.join(other, same, "left_anti")
    more = docs.join(other.where("__kept"), same, "left_semi").dropDuplicates([id_col, text_col])
    return once.unionByName(more)
