"""Encoding, binary records and packing: exact round trips."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerscreen.llm import encoding, hilbert, packing, records
from ledgerscreen.llm.common import starts_of

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_encode_as_whole_texts(path, monkeypatch):
    monkeypatch.setattr(encoding, "MEMORY", 300)
    r = random.Random(3)
    letters = list("ab' \n\té 　’ Σ1,#<|.%") + [" "] * 6
    texts = [None, "", " ", "  a  b ", "a b c　 d", "<|endoftext|> a<|endoftext|>b.<|startoftext|>", "it's we'll.x",
             "́a b́ ́c", "x\x1c y \x7f z", "a \x85 b\x85 c"]
    texts += ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(500)]
    e, whole = encoding.Encoder(path), Tokenizer.from_file(path)
    for part in (texts, texts[::-1]):
        counts, flat = e.encode(pa.array(part))
        at = starts_of(counts)
        for k, t in enumerate(part):
            assert flat[at[k]:at[k + 1]].tolist() == whole.encode(t or "", add_special_tokens=False).ids, repr(t)


def truth(path, end, rows):
    t = Tokenizer.from_file(path)
    return [(i, np.array(t.encode(x or "", add_special_tokens=False).ids + [end], "<u4")) for i, x in rows]


def test_records_round_trip(spark, edge_docs, tmp_path):
    records.write(edge_docs, str(tmp_path), BYTE, shards=3)
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    want = truth(BYTE, 0, rows)
    got = records.read_index(spark, str(tmp_path)).orderBy("shard", "record").collect()
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    assert sorted(map(str, ((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got))) == sorted(
        map(str, ((i, len(x), zlib.crc32(x)) for i, x in want)))
    for seed in (1, 2):
        mixed = records.read_shuffled(spark, str(tmp_path), seed).collect()
        assert sorted(map(str, ((r["doc_id"], r["ids"]) for r in mixed))) == sorted(map(str, ((i, x.tolist()) for i, x in want)))
    orders = [[r["doc_id"] for r in records.read_shuffled(spark, str(tmp_path), 1, e).collect()] for e in (0, 0, 1)]
    assert orders[0] == orders[1] != orders[2]


def test_damage_is_found():
    data = bytearray(records.frame(records.serialized(7, np.arange(5, dtype="<u2"))) + b"\n")
    (at, payload), = records.scan(memoryview(bytes(data)))
    assert at == 0 and records.sequence_ids(payload)[0] == 7 and records.sequence_ids(payload)[1].tolist() == [0, 1, 2, 3, 4]
    assert struct.unpack_from("<Q", data)[0] == len(payload)
    for k in range(len(data)):
        bad = bytearray(data)
        bad[k] ^= 1
        with pytest.raises((ValueError, struct.error)):
            list(records.scan(memoryview(bytes(bad))))


def test_records_empty_table(spark, no_docs, tmp_path):
    records.write(no_docs, str(tmp_path), BYTE)
    assert records.read_index(spark, str(tmp_path)).count() == 0


def test_hilbert_curve_visits_every_cell_by_steps():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    key = hilbert.hilbert_key(cells, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def check_pieces(pieces, want, length):
    from collections import defaultdict
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p["ids"]), "<u4")
        assert len(ids) == p["length"] > 0
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        docs[(p["doc_id"], p["doc_tokens"])].append((p["start"], ids))
    for key, got in docs.items():
        got.sort(key=lambda x: x[0])
        copies = [x for i, x in want if i == key[0] and len(x) == key[1]]
        assert sum(len(x) for _, x in got) == sum(map(len, copies))
        if len(copies) == 1:
            assert np.array_equal(np.concatenate([x for _, x in got]), copies[0])
    assert sum(k[1] for k in docs) > 0
    for s, parts in sequences.items():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        assert sum(n for _, n in parts) == length or s == max(sequences)


def test_packing_round_trip(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    lay = packing.Layout(length=256)
    check_pieces(packing.pack(edge_docs, WORD, lay=lay).collect(), truth(WORD, 1, rows), 256)
    assert packing.pack(no_docs, WORD).count() == 0
    # more tasks than shuffle partitions, as the tokens ask for
    many = packing.pack(edge_docs, WORD, lay=packing.Layout(length=256, task_tokens=500))
    check_pieces(many.collect(), truth(WORD, 1, rows), 256)
