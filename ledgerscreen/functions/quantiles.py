"""Exact, linearly interpolated quantiles per group, for groups of any size.

Order statistics are found by distributed rank selection.  A mergeable quantile sketch
per group brackets each target rank, and one exact pass counts the rows below and
inside the bracket; where that shows that the bracket misses the rank, the whole group is
the bracket.  A bracket of few rows is finished with a window over just those rows;
a larger one is narrowed by counting its rows per value bucket, with map-side partial sums,
to the one bucket that holds the rank and to that bucket's own smallest and largest value.
Every pass takes rows out of a bracket whose ends differ, so the loop runs until all
targets are closed; it has no pass limit.  A rank that the group does not have is null.

A row meets one joined row per group (its open targets as an array), not one per
target, and no task ever holds a group.

Interpolation: pos = p*(n-1), ``(hi-pos)*v_lo + (pos-lo)*v_hi``, and ``v_lo``
when the two order statistics are equal.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscreen.params import DEFAULT_PARAMS, Params
from ledgerscreen.session import scratch_path

_BUCKETS = 4096
_FINISH_ROWS = 20000
_BROADCAST_TARGETS = 100_000
# a sketch bracket spans this share of a group to either side of its target
_MARGIN = 0.01
_ACCURACY = 500


def interpolate(pos, v_lo, v_hi):
    lo = F.floor(pos)
    hi = F.ceil(pos)
    return (F.when((lo == hi) | (v_lo == v_hi), v_lo)
            .otherwise((hi - pos) * v_lo + (pos - lo) * v_hi))


def group_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                    p: Params = DEFAULT_PARAMS) -> DataFrame:
    """keys + ``n`` + one column per entry of ``probs``.  Null values and rows
    with a null key are ignored (pandas ``groupby`` semantics)."""
    data = df.select(*keys, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    for k in keys:
        data = data.where(F.col(k).isNotNull())
    sizes = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return _by_selection(data, sizes, keys, probs)


def _by_selection(data: DataFrame, sizes: DataFrame, keys: list[str],
                  probs: dict[str, float]) -> DataFrame:
    targets = rank_targets(sizes, keys, probs)
    stats = select_ranks(data, targets.select(*keys, "_name", "_k"), keys, probs)
    return interpolated(stats, targets, keys, probs)


def rank_targets(sizes: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """keys, n, _name, _pos and the one or two ranks _k around each position, from keys + ``n``."""
    targets = None
    for name, q in probs.items():
        pos = (F.col("n") - 1).cast("double") * F.lit(float(q))
        t = sizes.select(*keys, "n", F.lit(name).alias("_name"), pos.alias("_pos"))
        t = t.select(*keys, "n", "_name", "_pos",
                     F.explode(F.array(F.floor("_pos").cast("long"), F.ceil("_pos").cast("long"))).alias("_k"))
        targets = t if targets is None else targets.unionByName(t)
    return targets.dropDuplicates([*keys, "_name", "_k"])


def interpolated(stats: DataFrame, targets: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """keys, n and one column per name, from the values _v at the ranks of ``targets``."""
    base = targets.select(*keys, "n", "_name", "_pos").dropDuplicates([*keys, "_name"])
    lo = stats.select(*keys, "_name", F.col("_k").alias("_klo"), F.col("_v").alias("_vlo"))
    hi = stats.select(*keys, "_name", F.col("_k").alias("_khi"), F.col("_v").alias("_vhi"))
    per = (base.join(lo, [*keys, "_name"]).join(hi, [*keys, "_name"])
           .where((F.col("_klo") == F.floor("_pos")) & (F.col("_khi") == F.ceil("_pos")))
           .select(*keys, "n", "_name", interpolate(F.col("_pos"), F.col("_vlo"), F.col("_vhi")).alias("_q")))
    return per.groupBy(*keys, "n").pivot("_name", list(probs.keys())).agg(F.first("_q"))


def order_statistics(df: DataFrame, value: str, ranks: list[int], n: int | None = None) -> dict[int, float | None]:
    """Exact k-th smallest values (0-based ranks) of one column over the whole table
    (of about ``n`` rows, if that is known)."""
    spark = df.sparkSession
    data = df.select(F.lit(0).alias("_g"), F.col(value).cast("double").alias("_x")).where(
        F.col("_x").isNotNull())
    targets = spark.createDataFrame([(0, f"r{int(k)}", int(k)) for k in sorted(set(ranks))],
                                    "_g int, _name string, _k long")
    near = {f"r{int(k)}": min(max(k / n, 0.0), 1.0) for k in set(ranks)} if n else None
    rows = select_ranks(data, targets, ["_g"], near).select("_k", "_v").collect()
    return {int(r["_k"]): r["_v"] for r in rows}


def _saved(df: DataFrame) -> DataFrame:
    """State written to the shared folder and read back: computed once, lineage cut (an
    eager ``checkpoint`` computes its rows twice)."""
    path = scratch_path(df.sparkSession, f"ranks-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sketched(data: DataFrame, keys: list[str], near: dict[str, float]) -> DataFrame:
    """Per group: ``_n``, ``_mn``, ``_mx`` and, for each name, a narrow bracket around its share
    of the rows, from one mergeable quantile sketch, with the exact number of rows below
    it (``_b{i}``) and inside it (``_c{i}``)."""
    shares = [s for q in near.values() for s in (max(0.0, q - _MARGIN), min(1.0, q + _MARGIN))]
    first = data.groupBy(*keys).agg(
        F.min("_x").alias("_mn"), F.max("_x").alias("_mx"), F.count("_x").alias("_n"),
        F.percentile_approx("_x", shares, _ACCURACY).alias("_s"))
    ends = [F.get("_s", 2 * i + e).alias(f"_{side}{i}") for i in range(len(near)) for e, side in ((0, "l"), (1, "h"))]
    first = _saved(first.select(*keys, "_mn", "_mx", "_n", *ends))
    counts = [F.count_if(test).alias(f"_{name}{i}") for i in range(len(near)) for name, test in (
        ("b", F.col("_x") < F.col(f"_l{i}")), ("c", (F.col("_x") >= F.col(f"_l{i}")) & (F.col("_x") <= F.col(f"_h{i}"))))]
    exact = data.join(first.select(*keys, *[f"_{side}{i}" for i in range(len(near)) for side in "lh"]), keys).groupBy(*keys).agg(*counts)
    return first.join(exact, keys)


def select_ranks(data: DataFrame, targets: DataFrame, keys: list[str], near: dict[str, float] | None = None) -> DataFrame:
    """Order statistics by narrowing brackets.

    ``data``: keys + ``_x``; ``targets``: keys + ``_name`` + ``_k`` (0-based).
    Returns targets + ``_v`` (null where the group has no such rank).  ``near`` may tell
    the share of a group's rows below the targets of a name: a quantile sketch then gives the
    first brackets.  The sketch only narrows: a bracket is used if exact counts show that it holds
    its rank, else the whole group is the bracket.  State is written
    to the shared checkpoint folder so the loop's lineage stays short.
    """
    near = near or {}
    if near:
        bounds = _sketched(data, keys, near)
        picked = F.lit(None).cast("struct<l:double,h:double,b:bigint,c:bigint>")
        for i, name in enumerate(near):
            b = F.struct(F.col(f"_l{i}").alias("l"), F.col(f"_h{i}").alias("h"), F.col(f"_b{i}").alias("b"), F.col(f"_c{i}").alias("c"))
            held = (F.col(f"_b{i}") <= F.col("_k")) & (F.col("_k") < F.col(f"_b{i}") + F.col(f"_c{i}"))
            picked = F.when((F.col("_name") == name) & held, b).otherwise(picked)
    else:
        bounds = data.groupBy(*keys).agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"), F.count("_x").alias("_n"))
        picked = F.lit(None).cast("struct<l:double,h:double,b:bigint,c:bigint>")
    inside = F.coalesce((F.col("_k") >= 0) & (F.col("_k") < F.col("_n")), F.lit(False))
    state = targets.join(bounds, keys, "left").withColumn("_p", picked).select(
        *keys, "_name", "_k", inside.alias("_in"), F.coalesce("_p.l", "_mn").alias("_lo"), F.coalesce("_p.h", "_mx").alias("_hi"),
        F.coalesce("_p.b", F.lit(0)).cast("long").alias("_below"), F.coalesce("_p.c", "_n").alias("_c"))
    state = state.select(*keys, "_name", "_k", "_lo", "_hi", "_below", "_c",
                         F.when(F.col("_in") & (F.col("_lo") == F.col("_hi")), F.col("_lo")).alias("_v"),
                         (~F.col("_in") | (F.col("_lo") == F.col("_hi"))).alias("_closed"))
    return narrowed(data, state, keys)


def narrowed(data: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """keys, _name, _k, _v once every bracket of ``state`` is closed: keys, _name, _k, _lo, _hi (the
    bracket's ends), _below (rows under it), _c (rows in it), _v (the value once _closed)."""
    state = _saved(state)
    tk = [*keys, "_name", "_k"]

    def rows_in(brackets: DataFrame) -> DataFrame:
        """(keys, _x, target, bracket) for every open target whose bracket holds the row."""
        rest = [c for c in brackets.columns if c not in keys]
        per_key = brackets.groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("_t"))   # one per target
        held = F.filter("_t", lambda t: (F.col("_x") >= t["_lo"]) & (F.col("_x") <= t["_hi"]))
        # the open targets are broadcast only while their counted number is small
        return (data.join(F.broadcast(per_key) if few["all"] <= _BROADCAST_TARGETS else per_key, keys).select(*keys, "_x", F.explode(held).alias("_t"))
                .select(*keys, "_x", "_t.*"))

    while True:
        open_ = state.where(~F.col("_closed")).select(*tk, "_lo", "_hi", "_below", "_c")
        few = open_.agg(F.count_if(F.col("_c") <= _FINISH_ROWS).alias("few"), F.count(F.lit(1)).alias("all")).first()
        if not few["all"]:
            return state.select(*tk, "_v")
        if few["few"]:
            # brackets with few rows are finished exactly with a window over only those rows
            place = F.row_number().over(Window.partitionBy(*tk).orderBy("_x")) - 1 + F.col("_below")
            fin = (rows_in(open_.where(F.col("_c") <= _FINISH_ROWS)).withColumn("_r", place)
                   .where(F.col("_r") == F.col("_k")).select(*tk, F.col("_x").alias("_fv")))
            state = _saved(state.join(fin, tk, "left").withColumn("_v", F.coalesce("_v", "_fv"))
                           .withColumn("_closed", F.col("_closed") | F.col("_fv").isNotNull()).drop("_fv"))
        if few["few"] == few["all"]:
            continue
        width = (F.col("_hi") - F.col("_lo")) / F.lit(float(_BUCKETS))
        place = F.floor((F.col("_x") - F.col("_lo")) / width).cast("long")
        # the ends have buckets of their own, so they part in every pass
        bucket = F.when(F.col("_x") == F.col("_hi"), F.lit(_BUCKETS)).when(
            F.col("_x") == F.col("_lo"), F.lit(-1)).otherwise(
            F.least(F.greatest(F.coalesce(place, F.lit(0)), F.lit(0)), F.lit(_BUCKETS - 1)))
        hist = (rows_in(open_.where(F.col("_c") > _FINISH_ROWS)).groupBy(*tk, "_below", bucket.alias("_b"))
                .agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_bmn"), F.max("_x").alias("_bmx")))
        w = Window.partitionBy(*tk).orderBy("_b")
        before = F.col("_below") + F.sum("_n").over(w) - F.col("_n")
        hit = (hist.withColumn("_nbelow", before)
               .where((F.col("_nbelow") <= F.col("_k")) & (F.col("_k") < F.col("_nbelow") + F.col("_n")))
               .select(*tk, F.col("_bmn").alias("_nlo"), F.col("_bmx").alias("_nhi"), "_nbelow", F.col("_n").alias("_nc")))
        found = F.coalesce("_v", F.when(F.col("_nlo") == F.col("_nhi"), F.col("_nlo")))
        state = _saved(state.join(hit, tk, "left").select(
            *tk, F.coalesce("_nlo", "_lo").alias("_lo"), F.coalesce("_nhi", "_hi").alias("_hi"),
            F.coalesce("_nbelow", "_below").alias("_below"), F.coalesce("_nc", "_c").alias("_c"), found.alias("_v"),
            (F.col("_closed") | found.isNotNull()).alias("_closed")))
