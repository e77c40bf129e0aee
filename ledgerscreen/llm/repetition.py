"""Suffix-array repetition rules.

Every text is a sequence of words.  A suffix array over the words of a slice of
documents (suffixes never cross a document) is built by prefix doubling with
numpy; the longest common prefixes of neighbours come from the ranks of the
doubling steps.  A suffix's longest repeated prefix is the widest LCP interval
it lies in, i.e. a maximal repeated substring; the union of these spans is the
repeated part of the text.  Two limits give the verdict: the repeated share
(spans of at least ``min_words`` words) and the longest repeat.

One pass without a shuffle: each document is judged alone, in a Python task
that sees slices of bounded size.

Defined cases: null or empty text has no words and fails the base rules; a
repeated row is judged twice; an empty table gives an empty table; other
columns of the input are ignored by ``judge`` and passed on by ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ledgerscreen.llm.common import array, sliced, split_words, starts_of

SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Limits:
    base_window: int = 5          # words in the base rule's windows
    base_least_words: int = 10
    base_repeat_pct: int = 20     # repeated words per 100
    min_words: int = 10           # shortest repeat that counts for the share
    share_pct: int = 15           # covered words per 100, of such repeats
    longest: int = 50             # words of the longest repeat
    slice_bytes: int = 4_000_000  # text in one suffix array


def suffix_ranks(codes: np.ndarray, doc: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranks by the first 1, 2, 4, ... words; the last is the full order.

    A rank is the place of the group's first suffix in sorted order, so equal
    ranks mean equal prefixes and refined groups stay within their place."""
    n = len(codes)
    key = doc * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    levels = []
    rank = np.empty(n, np.int64)
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    levels.append(rank)
    active = order[np.repeat(np.diff(np.append(first, n)) > 1, np.diff(np.append(first, n)))]
    step = 1
    while len(active):
        old = levels[-1]
        behind = active + step
        inside = behind < end[active]
        second = np.where(inside, old[np.minimum(behind, n - 1)], -1)
        own = old[active]
        o = np.lexsort((second, own))
        active, own, second = active[o], own[o], second[o]
        new_group = np.diff(own, prepend=-1) != 0
        new_sub = new_group | (np.diff(second, prepend=-2) != 0)
        at = np.arange(len(active))
        in_group = at - np.maximum.accumulate(np.where(new_group, at, 0))
        sub = np.flatnonzero(new_sub)
        sizes = np.diff(np.append(sub, len(active)))
        rank = old.copy()
        rank[active] = np.repeat(own[sub] + in_group[sub], sizes)
        levels.append(rank)
        active = active[np.repeat(sizes > 1, sizes)]
        step *= 2
    return levels


def longest_repeats(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each word position the length of the longest prefix of its suffix
    that is found at another position of the same document."""
    n = len(codes)
    found = np.zeros(n, np.int64)
    if n < 2:
        return found
    doc = np.repeat(np.arange(len(counts)), counts)
    end = np.repeat(np.cumsum(counts), counts)
    levels = suffix_ranks(codes.astype(np.int64), doc, end)
    order = np.empty(n, np.int64)
    order[levels[-1]] = np.arange(n)
    a, b = order[:-1], order[1:]
    same = levels[0][a] == levels[0][b]
    a, b = a[same], b[same]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        ok = (x < end[a]) & (y < end[b])
        ok[ok] = levels[k][x[ok]] == levels[k][y[ok]]
        lcp[ok] += 1 << k
    np.maximum.at(found, a, lcp)
    np.maximum.at(found, b, lcp)
    return found


def covered(found: np.ndarray, least: int, counts: np.ndarray) -> np.ndarray:
    """Words per document in the union of the repeats of ``least`` words or more."""
    n = len(found)
    p = np.flatnonzero(found >= least)
    change = np.bincount(p, minlength=n + 1) - np.bincount(p + found[p], minlength=n + 1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(change[:n]) > 0)])
    s = starts_of(counts)
    return inside[s[1:]] - inside[s[:-1]]


def measure(texts: pa.Array, lim: Limits) -> dict[str, np.ndarray]:
    counts, words = split_words(texts)
    n_docs = len(counts)
    s = starts_of(counts)
    chars = np.concatenate([[0], np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False))])
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    found = longest_repeats(codes, counts)
    filled = pc.fill_null(texts, "")
    symbols = pc.count_substring_regex(filled, SYMBOLS).to_numpy(zero_copy_only=False)
    lines = pc.split_pattern(filled, "\n")
    per = lines.value_lengths().to_numpy(zero_copy_only=False)
    flat = lines.flatten()
    has_word = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0).to_numpy(zero_copy_only=False)
    code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(n_docs), per)[has_word]
    code = code[has_word]
    pairs = np.unique(row * (int(code.max(initial=0)) + 1) + code, return_index=True)[1]
    n_lines = np.bincount(row, minlength=n_docs)
    distinct = np.bincount(row[pairs], minlength=n_docs)
    repeat = covered(found, lim.base_window, counts)
    span = covered(found, lim.min_words, counts)
    longest = np.zeros(n_docs, np.int64)
    some = counts > 0
    if some.any():
        longest[some] = np.maximum.reduceat(found, s[:-1][some])
    failed = (counts < lim.base_least_words) | (100 * repeat > lim.base_repeat_pct * counts)
    kept = ~failed & (100 * span <= lim.share_pct * counts) & (longest <= lim.longest)
    return {"n_words": counts, "word_chars": chars[s[1:]] - chars[s[:-1]], "n_symbols": symbols.astype(np.int64),
            "n_dup_lines": n_lines - distinct, "n_repeat_words": repeat, "n_span_words": span,
            "longest_repeat": longest, "base_failed": failed, "kept": kept}


COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "n_span_words long, longest_repeat long, base_failed boolean, kept boolean")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lim: Limits = Limits()) -> DataFrame:
    """One row per input row: the id, the measures and the verdict ``kept``."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches):
        for b in sliced(batches, "text", lim.slice_bytes):
            m = measure(array(b.column("text")), lim)
            yield pa.RecordBatch.from_arrays([array(b.column("id")), *(pa.array(v) for v in m.values())],
                                             names=["id", *m])

    return src.mapInArrow(run, f"id {id_type}, {COLUMNS}").withColumnRenamed("id", id_col)


def keep(docs: DataFrame, text_col: str = "text", lim: Limits = Limits()) -> DataFrame:
    """The rows whose verdict is ``kept``, with all their columns."""
    def run(batches):
        for b in sliced(batches, text_col, lim.slice_bytes):
            m = measure(array(b.column(text_col)), lim)
            yield b.filter(pa.array(m["kept"]))

    return docs.mapInArrow(run, docs.schema)
