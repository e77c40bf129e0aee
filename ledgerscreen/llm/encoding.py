"""Token ids of many texts with a public tokenizer, piece by piece.

A text is cut at places where the pre-tokenizers of the public files always
cut, so the ids of a text are the ids of its pieces in order: before a lone
blank or newline between two characters that are certainly not white space,
behind such a newline, and between an ASCII letter or digit and a plain mark.
Each distinct piece of an Arrow slice is encoded once; a bounded memory per
Python process keeps the ids of pieces seen before.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerscreen.llm.common import starts_of

#: Distinct pieces remembered per Python process.
MEMORY = 800_000

_OTHER, _SPACE, _WORD, _MARK, _HIGH = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[:0x21] = _SPACE
_KIND[0x7F] = _SPACE
for _c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789":
    _KIND[_c] = _WORD
for _c in b".,!?;:#*$%&()":       # none of the apostrophe and < | >, which special tokens and contractions hold
    _KIND[_c] = _MARK
_KIND[0x80:] = _HIGH
_LEADS = np.array([0xC2, 0xE1, 0xE2, 0xE3], np.uint8)

_LOADED: dict[str, Encoder] = {}


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # the pieces seen before, and their ids end to end
        self.words = pa.array([], pa.string())
        self.begin = np.zeros(1, np.int64)
        self.table = np.empty(0, np.uint32)

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        full = pa.concat_arrays([pc.fill_null(texts, "")])
        _, offsets, data = full.buffers()
        at = np.frombuffer(offsets, np.int32)[full.offset:full.offset + len(full) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.empty(0, np.uint8)
        at = at - at[0]
        n = len(raw)
        cut = np.zeros(n + 1, bool)
        if n > 2:
            kind = _KIND[raw]
            # the last byte of a character of two or three bytes that could be white space
            doubt = (kind == _HIGH)
            doubt[1:] &= (raw[:-1] == 0xC2) | ((raw[:-1] >= 0x80) & (raw[:-1] < 0xC0))
            solid = (kind != _SPACE) & ~doubt                    # certainly no white space, as a character's last byte
            opens = (kind != _SPACE) & ~np.isin(raw, _LEADS)     # the same, as a character's first byte
            lone = np.flatnonzero(((raw[1:-1] == 0x20) | (raw[1:-1] == 0x0A)) & solid[:-2] & opens[2:]) + 1
            cut[lone] = True
            cut[lone[raw[lone] == 0x0A] + 1] = True
            cut[1:n] |= (kind[:-1] == _WORD) & (kind[1:] == _MARK)
        cut[at] = True
        cut[n] = True
        edges = np.flatnonzero(cut)
        pieces = pa.Array.from_buffers(pa.string(), len(edges) - 1,
                                       [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(raw)])
        before = np.cumsum(cut)
        return np.diff(before[at]).astype(np.int64), pieces

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text, all ids in order as uint32)."""
        counts, pieces = self._pieces(texts)
        if len(pieces) == 0:
            return np.zeros(len(counts), np.int64), np.empty(0, np.uint32)
        coded = pieces.dictionary_encode()
        which, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        place = pc.fill_null(pc.index_in(names, value_set=self.words), -1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(place < 0)
        unseen = names.take(pa.array(missing))
        more, size = array("I"), []
        for e in self.tokenizer.encode_batch_fast(unseen.to_pylist(), add_special_tokens=False):
            ids = e.ids
            more.extend(ids)
            size.append(len(ids))
        begin = np.append(self.begin, self.begin[-1] + np.cumsum(np.array(size, np.int64)))
        table = np.concatenate([self.table, np.frombuffer(more, np.uint32)]) if size else self.table
        place[missing] = len(self.words) + np.arange(len(missing))
        length = np.diff(begin)[place]
        each = length[which]
        total = starts_of(each)
        flat = table[np.arange(total[-1]) - np.repeat(total[:-1] - begin[place][which], each)]
        if len(begin) <= MEMORY:
            self.words, self.begin, self.table = pa.concat_arrays([self.words, unseen]), begin, table
        else:                                    # full: start anew with the pieces of this slice
            at = starts_of(length)
            self.table = table[np.arange(at[-1]) - np.repeat(at[:-1] - begin[place], length)]
            self.words, self.begin = names, at
        return np.diff(total[starts_of(counts)]), flat


def encoder(path: str) -> Encoder:
    """The process's encoder for this file (loaded once per Python worker)."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]
