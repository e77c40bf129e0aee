"""Word shingles of a slice of texts as sorted distinct 64-bit hashes per text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from ledgerscreen.llm.common import split_words, starts_of

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(set size per text, all sets in order, each ascending).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a text of fewer
    than ``width`` words has the whole sequence as its only shingle."""
    counts, words = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    if len(words) == 0:
        return np.zeros(len(counts), np.int64), np.empty(0, np.uint64)
    coded = words.dictionary_encode()
    names = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    h = names[coded.indices.to_numpy(zero_copy_only=False)]
    row = np.repeat(np.arange(len(counts)), counts)
    n = len(h)
    value = np.zeros(n, np.uint64)
    for k in range(width):                    # a short text ends early: its last terms are missing
        value[:n - k] += np.where(row[k:] == row[:n - k], h[k:] * _ODD[k], np.uint64(0)) if k < n else np.uint64(0)
    value = mixed(value)
    s = starts_of(counts)
    place = np.arange(n) - s[row]
    whole = (place + width <= counts[row]) | ((counts[row] < width) & (place == 0))
    row, value = row[whole], value[whole]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return np.bincount(row[first], minlength=len(counts)).astype(np.int64), value[first]
