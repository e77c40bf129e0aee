"""Table counts of many dishes at once, drawn for a Gibbs sampler on numpy.

A dish of n customers whose new tables weigh a (its parent's share) has k tables with
chance in proportion to a^k S(n, k), S the generalised Stirling numbers of the discount d:
S(n + 1, k) = S(n, k - 1) + (n - d k) S(n, k).  One Gibbs move takes all customers of a
dish away and draws its number of tables anew from just that, so a single sweep has
moved every customer, be they three or three million.

* Up to ``EXACT`` customers the chances are added up.
* Beyond it tables are, but for one law at n = ``EXACT``, a Poisson number of small ones: the
  sum over k of a^k S(n, k) z^n / n! is exp(a/d) exp(-(a/d) (1 - z)^d), whose second factor
  hangs, for large n, on a / n^d alone.  So k is a draw at ``EXACT`` customers with weight
  a (EXACT / n)^d, plus Poisson of the weight left over, divided by d.
* Where a exceeds ``DENSE`` n^d, tables are many and small; k is normal, its mean
  and variance from the saddle point of the same series.

Randomness is a hash of the dish's key and the step, so a draw depends on nothing but
its own dish and can be made again anywhere."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from ledgerscreen.llm.shingles import mixed

EXACT = 256
DENSE = 0.5
CELLS = 1_000_000          # chances held at once


def uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    x = mixed(keys ^ mixed(np.array([salt], np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    return (x >> np.uint64(11)).astype(float) / float(1 << 53)


@lru_cache(maxsize=8)
def log_stirling(discount: float) -> np.ndarray:
    """log S(n, k) for 0 <= n, k <= EXACT; -inf where there is no such seating."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[0, 0] = 0.0
    k = np.arange(1, EXACT + 1)
    for n in range(EXACT):
        with np.errstate(divide="ignore"):
            stay = out[n, 1:] + np.log(np.maximum(n - discount * k, 0.0))
        out[n + 1, 1:] = np.logaddexp(out[n, :-1], stay)
    return out


def _summed(n: int, weight: np.ndarray, u: np.ndarray, discount: float) -> np.ndarray:
    """Draws for dishes of the same number n <= EXACT of customers."""
    k = np.arange(1, n + 1)
    row = log_stirling(discount)[n, 1:n + 1]
    out = np.empty(len(weight), np.int64)
    step = max(1, CELLS // n)
    for at in range(0, len(weight), step):
        x = np.log(weight[at:at + step, None]) * k + row
        x = np.cumsum(np.exp(x - x.max(axis=1, keepdims=True)), axis=1)
        out[at:at + step] = 1 + (x[:, :-1] <= u[at:at + step, None] * x[:, -1:]).sum(axis=1)
    return out


def _normal(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.sqrt(-2.0 * np.log1p(-u)) * np.cos(2.0 * np.pi * v)


def _poisson(mean: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    out = np.maximum(np.rint(mean + np.sqrt(mean) * _normal(u, v)), 0).astype(np.int64)
    few = np.flatnonzero(mean < 30.0)
    chance = np.exp(-mean[few])
    left, count, k = u[few] - chance, np.zeros(len(few), np.int64), 0
    while len(few) and k < 200:
        over = left >= 0
        if not over.any():
            break
        k += 1
        count[over] += 1
        chance = chance * mean[few] / k
        left = left - chance
    out[few] = count
    return out


def _saddle(n: np.ndarray, weight: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of the tables where n = a x (1 - x)^(d - 1)."""
    lo, hi = np.full(len(n), -60.0), np.zeros(len(n))           # of log(1 - x)
    for _ in range(60):
        mid = (lo + hi) / 2
        above = np.log(-np.expm1(mid)) + (discount - 1) * mid + np.log(weight) > np.log(n)
        lo, hi = np.where(above, mid, lo), np.where(above, hi, mid)
    rest = np.exp((lo + hi) / 2)
    x = 1 - rest
    mean = weight * (1 - rest ** discount) / discount
    spread = n * (1 + x * (1 - discount) / rest)                # variance of the customers
    return mean, np.maximum(mean - n * (n / spread), 0.0)


def tables(n: np.ndarray, weight: np.ndarray, keys: np.ndarray, discount: float, salt: int) -> np.ndarray:
    """Number of tables of each dish: 0 without customers, 1 for one, else drawn."""
    n = n.astype(np.int64)
    out = np.minimum(n, 1)
    many = np.flatnonzero(n > 1)
    if not len(many):
        return out
    many = many[np.argsort(n[many], kind="stable")]
    m, a = n[many], np.maximum(weight[many], 1e-300)
    u = uniform(keys[many], 3 * salt)
    got = np.empty(len(many), np.int64)
    few = int(np.searchsorted(m, EXACT, side="right"))
    cut = np.flatnonzero(np.diff(m[:few], prepend=-1))
    for lo, hi in zip(cut, np.append(cut[1:], few)):
        got[lo:hi] = _summed(int(m[lo]), a[lo:hi], u[lo:hi], discount)
    if few < len(m):
        v, w = uniform(keys[many[few:]], 3 * salt + 1), uniform(keys[many[few:]], 3 * salt + 2)
        size, a, u = m[few:].astype(float), a[few:], u[few:]
        dense = a > DENSE * size ** discount
        big = np.empty(len(size), np.int64)
        mean, var = _saddle(size[dense], a[dense], discount)
        big[dense] = np.rint(mean + np.sqrt(var) * _normal(v[dense], w[dense]))
        loose = ~dense
        near = a[loose] * (EXACT / size[loose]) ** discount
        big[loose] = (_summed(EXACT, near, u[loose], discount)
                      + _poisson((a[loose] - near) / discount, v[loose], w[loose]))
        got[few:] = np.clip(big, 1, m[few:])
    out[many] = got
    return out
