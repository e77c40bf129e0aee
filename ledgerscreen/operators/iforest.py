"""Isolation Forest on Spark (Liu, Ting & Zhou, ICDM 2008).

* Randomness is hashed, never drawn from seeded state: every decision is a
  function of md5('seed:tree:node:...'), so the forest is independent of
  partitioning and reproducible by any engine with md5.
* Sampling: the M = min(N, T*psi) rows with the smallest md5('seed:pool:id') form
  the pool, in that order, and are dealt circularly: tree t takes the places
  t*psi' .. (t+1)*psi'-1 modulo M, with psi' = min(psi, N).  One law for every N.
* Fit: ``groupBy(tree).applyInPandas`` -- each group is one tree's sample
  (<= psi rows), so a task never holds more than psi rows whatever the data
  size or skew.  Candidates at a node are the numeric features that vary in it and
  the (column, value) pairs that some of its rows have and some have not -- the
  one-hot indicators of the node's own values, no list of categories.  A node
  splits on the candidate with the smallest md5('seed:tree:node:feature'); the
  threshold is min + u*(max - min) with u from md5('seed:tree:node:split'); x <
  split goes left (node 2k), else right (2k+1): for a pair, rows with the value go
  right.  Leaves: size <= 1, no candidate, or depth = ceil(log2(psi)).
* Score: the model (<= T * 2^(depth+1) nodes, bounded) is broadcast as dense
  arrays and a pandas UDF over the feature columns alone walks all trees for a
  batch of rows at once; every other column stays in the JVM.
  Path lengths are summed in fixed point (1e-9 units) so the sum is exact and
  order-independent; s = 2^(-E[h]/c(psi)).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscreen.functions.exprs import round_half_even
from ledgerscreen.functions.quantiles import order_statistics
from ledgerscreen.operators.features import NUMERIC, model_frame
from ledgerscreen.params import DEFAULT_PARAMS, Params
from ledgerscreen.schema import FOREST_MODEL
from ledgerscreen.session import stored

FIXED = 10 ** 9          # fixed-point unit for path lengths
EULER_GAMMA = 0.5772156649015329
BLOCK = 128              # rows walked at once


def c_factor(n: int) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def leaf_value(depth: int, size: int) -> int:
    return depth * FIXED + int(math.floor(c_factor(size) * FIXED + 0.5))


def max_depth_for(psi: int) -> int:
    return int(math.ceil(math.log2(max(psi, 2))))


def _md5(text: str) -> str:
    return hashlib.md5(text.encode("utf-8")).hexdigest()


def _unit(text: str) -> float:
    return (int(_md5(text)[:8], 16) + 0.5) / 4294967296.0


def sample(frame: DataFrame, n_rows: int, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """``frame`` rows with their ``tree``: each tree's subsample (see module doc).
    The features travel with the rows, so nothing is joined back on the id."""
    t, psi = p.n_trees, min(p.max_samples, n_rows)
    need = min(n_rows, t * p.max_samples)
    if not need:
        return frame.where(F.lit(False)).withColumn("tree", F.lit(0))
    h = F.md5(F.concat_ws(":", F.lit(str(p.seed)), F.lit("pool"), F.col("transaction_id")))
    hashed = frame.withColumn("_h", h)
    order = ["_h", "transaction_id", *[c for c in frame.columns if c != "transaction_id"]]
    # A filter on the hash's first 32 bits keeps ~3x the needed rows before the
    # bounded top-k; it is widened if fewer than needed pass, so the pool is exact.
    frac = min(1.0, 3.0 * need / n_rows)
    while True:
        cand = hashed.where(F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") < F.lit(int(frac * 4294967296.0)))
        pool = stored(cand.orderBy(*order).limit(need), "forest-pool")
        if frac >= 1.0 or pool.count() >= need:
            break
        frac = min(1.0, frac * 2)
    # <= T*psi rows: a single ordered window over the pool is bounded
    r = F.row_number().over(Window.orderBy(*order)).cast("long") - 1
    slots = t * psi
    dealt = pool.withColumn("_r", r).where(F.col("_r") < slots).withColumn(
        "_slot", F.explode(F.sequence(F.col("_r"), F.lit(slots - 1).cast("long"), F.lit(need).cast("long"))))
    return dealt.withColumn("tree", F.floor(F.col("_slot") / psi).cast("int")).drop("_h", "_r", "_slot")


def _fit_tree(numeric: list[str], cats: list[str], seed: int, max_depth: int):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf[[f"x_{n}" for n in numeric]].to_numpy(dtype=np.float64)
        values = [pdf[f"c_{c}"].to_numpy(dtype=object) for c in cats]
        out = []
        stack = [(1, 0, np.arange(len(x)))]
        while stack:
            node, depth, idx = stack.pop()
            n = len(idx)
            found = []          # (hash, label, feature, value or None)
            if n > 1 and depth < max_depth:
                sub = x[idx]
                mn, mx = sub.min(axis=0), sub.max(axis=0)
                found = [(numeric[j], numeric[j], None, j) for j in np.nonzero(mx > mn)[0]]
                for c, v in zip(cats, values):
                    own, count = np.unique([w for w in v[idx] if w is not None], return_counts=True)
                    found += [(f"{c}_{w}", c, str(w), None) for w, k in zip(own, count) if k < n]
            if not found:
                out.append((tree, node, depth, n, None, None, None, leaf_value(depth, n)))
                continue
            _, label, feature, value, j = min((_md5(f"{seed}:{tree}:{node}:{f[0]}"), *f) for f in found)
            u = _unit(f"{seed}:{tree}:{node}:split")
            if value is None:
                split = mn[j] + u * (mx[j] - mn[j])
                left = x[idx, j] < split
            else:
                split = u           # the indicator is 0 or 1, u lies between
                left = values[cats.index(feature)][idx] != value
            out.append((tree, node, depth, n, feature, value, float(split), None))
            stack.append((2 * node, depth + 1, idx[left]))
            stack.append((2 * node + 1, depth + 1, idx[~left]))
        return pd.DataFrame(out, columns=[f.name for f in FOREST_MODEL.fields])
    return fit


def fit(frame: DataFrame, n_rows: int, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """The forest as a node table (tree, node, depth, size, feature, category, split,
    leaf_value) from the rows of ``features.model_frame``."""
    rows = sample(frame, n_rows, p)
    fn = _fit_tree(list(NUMERIC), list(p.categorical_cols), p.seed, max_depth_for(min(p.max_samples, n_rows)))
    # spread the trees over all task slots: an explicit repartition by tree is
    # not coalesced by AQE, and the grouping reuses its partitioning
    slots = max(1, min(p.n_trees, rows.sparkSession.sparkContext.defaultParallelism))
    return rows.repartition(slots, "tree").groupBy("tree").applyInPandas(fn, FOREST_MODEL)


class ForestArrays:
    """Node arrays per level for vectorized traversal.

    Node ``k`` of tree ``t`` lies on level ``d`` (2^d <= k < 2^(d+1)) at place
    ``t * 2^d + k - 2^d``; the children of place ``g`` are 2g and 2g + 1 on the next
    level.  A place is one number, ``code << 16 | feature``.  A numeric node's code is the
    rank of its split among the forest's splits of that feature and it sends x >= split
    right; a category node's code stands for its value and it sends an equal code right.
    A place without a node has a code above all others, so a walk of ``max_depth`` steps
    needs no leaf mask; a leaf's value stands below it on the last level, all to the left."""

    def __init__(self, model_rows, numeric: list[str], cats: list[str], n_trees: int, max_depth: int):
        pos = {n: i for i, n in enumerate([*numeric, *cats])}
        self.cuts = [np.unique([r["split"] for r in model_rows if r["feature"] == n]).astype(np.float64) for n in numeric]
        self.levels = [np.full(n_trees << d, 1 << 40, np.int64) for d in range(max_depth)]
        self.leaf = np.zeros(n_trees << max_depth, dtype=np.int64)
        self.codes: list[dict[str, int]] = [{} for _ in cats]      # values that the model tests
        for r in model_rows:
            d = r["node"].bit_length() - 1
            g = (r["tree"] << d) + r["node"] - (1 << d)
            if r["feature"] is None:
                self.leaf[g << (max_depth - d)] = r["leaf_value"]
                continue
            f = pos[r["feature"]]
            if r["category"] is None:
                code = int(np.searchsorted(self.cuts[f], r["split"])) + 1
            else:
                own = self.codes[f - len(numeric)]
                code = own.setdefault(r["category"], len(own))
            self.levels[d][g] = code << 16 | f
        self.n_trees = n_trees
        self.n_numeric = len(numeric)

    def matrix(self, columns: list[pd.Series]) -> np.ndarray:
        """Feature values of a batch: numbers, then category codes (-1: no tested value)."""
        parts = [c.to_numpy(dtype=np.float64) for c in columns[:self.n_numeric]]
        parts += [c.map(own).fillna(-1).to_numpy(dtype=np.float64)
                  for c, own in zip(columns[self.n_numeric:], self.codes)]
        return np.column_stack(parts)


def path_sums(arrs: ForestArrays, x: np.ndarray) -> np.ndarray:
    """Sum over trees of fixed-point path lengths, for each row of x (finite values)."""
    n, k = x.shape
    numbers = arrs.n_numeric
    codes = np.empty(x.shape, np.int64)            # of a number: how many splits it reaches
    codes[:, numbers:] = x[:, numbers:]
    for j, cuts in enumerate(arrs.cuts):
        codes[:, j] = np.searchsorted(cuts, x[:, j], side="right")
    out = np.zeros(n, np.int64)
    roots = np.arange(arrs.n_trees)[None, :]
    for at in range(0, n, BLOCK):                  # a block's arrays fit in the cache
        flat = codes[at:at + BLOCK].ravel()
        row = (np.arange(len(flat) // k) * k)[:, None]
        g = np.repeat(roots, len(row), axis=0)
        for nodes in arrs.levels:
            node = nodes.take(g)
            feature = node & 0xFFFF
            over = flat.take(feature + row) - (node >> 16)
            g *= 2
            g += (over == 0) | ((over > 0) & (feature < numbers))
        out[at:at + BLOCK] = arrs.leaf.take(g).sum(axis=1)
    return out


def score(e: DataFrame, model: DataFrame, n_rows: int, p: Params = DEFAULT_PARAMS,
          keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``e`` + path_sum (BIGINT) + iso_score (s in (0,1]).

    Only the feature columns pass through Python (Arrow batches)."""
    keep = keep or ["transaction_id"]
    psi = min(p.max_samples, n_rows)
    cats = list(p.categorical_cols)
    rows = model.collect()          # bounded: <= n_trees * 2^(depth+1) rows
    arrs = ForestArrays(rows, list(NUMERIC), cats, p.n_trees, max_depth_for(psi))
    bc = e.sparkSession.sparkContext.broadcast(arrs)

    c_psi, n_trees = c_factor(psi), p.n_trees

    @F.pandas_udf("path_sum long, iso_score double")
    def walk(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        a = bc.value
        for columns in batches:
            total = path_sums(a, a.matrix(list(columns))) if len(columns[0]) else np.zeros(0, np.int64)
            mean_path = (total / float(FIXED)) / float(n_trees)
            # trees of a single row have no path to compare with: their rows are as average as any
            ratio = mean_path / c_psi if c_psi else np.ones(len(total))
            yield pd.DataFrame({"path_sum": total.astype(np.int64), "iso_score": np.power(2.0, -ratio)})

    features = [f"x_{n}" for n in NUMERIC] + [f"c_{c}" for c in cats]
    rest = [c for c in keep if c not in features]
    frame = model_frame(e, p, keep=rest)
    return frame.select(*rest, walk(*features).alias("_w")).select(*rest, "_w.path_sum", "_w.iso_score")


def ml_stats(scored: DataFrame, n_rows: int, p: Params = DEFAULT_PARAMS) -> dict:
    """Reference statistics of a scored table: min / max score and the
    contamination threshold on the exact path sums.

    The flag marks the rows whose -s is below the 5th percentile of -s
    (linear interpolation).  Because -s increases with the exact fixed-point
    path sum, that is decided on path sums: rows below the order statistic at
    rank floor(pos), plus that rank itself when the percentile interpolates
    strictly between two different values.  Without rows there is nothing to compare with."""
    if not n_rows:
        return {"smin": 0.0, "smax": 0.0, "path_threshold": 0.0, "inclusive": False}
    pos = p.contamination * (n_rows - 1)
    lo = int(math.floor(pos))
    frac = pos - lo
    hi_rank = min(lo + 1, n_rows - 1)
    stats = order_statistics(scored, "path_sum", [lo, hi_rank], n_rows)
    v_lo, v_hi = stats[lo], stats[hi_rank]
    mm = scored.agg(F.min("iso_score").alias("smin"), F.max("iso_score").alias("smax")).first()
    return {"smin": mm["smin"], "smax": mm["smax"], "path_threshold": float(v_lo),
            "inclusive": bool(frac > 0 and v_hi > v_lo)}


def ml_columns(scored: DataFrame, n_rows: int, p: Params = DEFAULT_PARAMS, stats: dict | None = None) -> DataFrame:
    """H3 + H4: inverted min-max score (4 dp) and the contamination flag,
    relative to ``stats`` (default: the statistics of ``scored`` itself).  Where all
    scores are equal (one row, equal rows) they are 0 and no row is flagged."""
    st = stats or ml_stats(scored, n_rows, p)
    ps = F.col("path_sum").cast("double")
    thr = F.lit(st["path_threshold"])
    is_anom = (ps <= thr) if st["inclusive"] else (ps < thr)
    span = st["smax"] - st["smin"]
    score = (F.lit(0.0) if not span else
             round_half_even((F.col("iso_score") - F.lit(st["smin"])) / F.lit(span), 4))
    return (scored.withColumn("ml_anomaly_score", score)
            .withColumn("ml_flag", F.when(is_anom, "anomaly").otherwise("normal")))
