"""Hierarchical Pitman-Yor language model over words.

A restaurant per context (the word before) serves the next words; its tables are
the customers of one shared parent restaurant over words, whose base is uniform
over the training words and one more.  Every word is a context with a restaurant of
its own, numbered by a 62-bit hash.  The seating of every restaurant
is sampled by Gibbs (see ``seating``); a text's probability uses the predictive
probability averaged over the kept samples.

How it runs on Spark.  Tokens are dealt to buckets by their word, those of frequent
words by word and context, so a bucket has all customers of a dish and a hot word
is spread.  Pass 1 samples the seatings in every bucket and gives its customers and
tables per restaurant and kept sample; these are added up per restaurant, in parts of
the restaurants, and each bucket gets back the sums of those that it asked for.
Pass 2 makes the same seatings again (their randomness is hashed), now with the exact
sums, and scores all tokens of the bucket.  While a seating is sampled, a restaurant's
tables are those of the pair of words in hand and, for the others, the bucket's share
scaled up; the probabilities use exact totals, so they sum to one.  What reaches the
driver is bounded by ``frequent``; no number of contexts is.

Defined cases: null or empty text is the end token alone; a null id stays; equal
rows are scored each; without training rows every token has the uniform base.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscreen.llm.common import array, sliced, split_words, starts_of, swept, written
from ledgerscreen.llm.seating import tables as drawn
from ledgerscreen.llm.shingles import mixed

END = ""            # the token behind the last word; also the context of the first
CHUNKS = 16


@dataclass(frozen=True)
class Settings:
    classes: int = 1 << 62        # numbers of restaurants: the hash of a context; frequent words take the first ones
    frequent: int = 2_000         # a word of more than 1/frequent of all tokens is frequent
    discount: tuple[float, float] = (0.5, 0.8)      # parent, contexts
    strength: tuple[float, float] = (10.0, 1.0)
    burn: int = 3
    samples: int = 3
    bucket_tokens: int = 2_500_000
    least_buckets: int = 64
    slice_bytes: int = 6_000_000


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(tokens per text, code of each token, words by code); code 0 is the end."""
    counts, words = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = words.dictionary_encode()
    flat = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    return counts + 1, np.insert(flat, np.cumsum(counts), 0), [END, *coded.dictionary.to_pylist()]


def hashes(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def frequent_words(texts: DataFrame, s: Settings) -> tuple[dict[str, int], int]:
    """({frequent word: number}, all tokens).  A word that frequent is so in some
    slice, too; a slice reports its own frequent words only."""
    def run(batches):
        for b in sliced(batches, "text", s.slice_bytes):
            _, flat, words = tokens(array(b.column("text")))
            n = np.bincount(flat, minlength=len(words))
            at = np.flatnonzero(n * 2 * s.frequent >= len(flat))
            yield pa.RecordBatch.from_arrays([pa.array([words[k] for k in at] + [None], pa.string()),
                                              pa.array(np.append(n[at], len(flat)))], names=["w", "n"])

    got = written(texts.select("text").mapInArrow(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")), "frequent")
    total = got.where("w IS NULL").first()
    if total is None:
        return {}, 0
    words = sorted(r["w"] for r in got.where((F.col("n") * s.frequent >= total["n"]) & F.col("w").isNotNull()).collect())
    return {w: k for k, w in enumerate(words)}, total["n"]


def squeezed(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.tobytes() for c in columns))


def packed(names: list[str], counts, own, place, docs) -> bytes:
    """Tokens of one bucket of one slice, by word: compressed columns.  Restaurants are
    listed once, in ``own``, and named by their place in the list."""
    text = "\n".join(names).encode("utf-8", "surrogatepass")
    step = np.diff(docs, prepend=0).astype(np.uint16) if docs is not None else np.empty(0, np.uint16)
    head = struct.pack("<IIIII", len(names), len(own), len(place), len(text), len(step))
    return squeezed(np.frombuffer(head, np.uint8), own.astype("<i8"), counts.astype("<u4"), place.astype("<i4"), step,
                    np.frombuffer(text, np.uint8))


def unpacked(blob: bytes):
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n_names, n_own, n, n_text, n_docs = struct.unpack_from("<IIIII", raw)
    at = 20
    own = np.frombuffer(raw, "<i8", n_own, at)
    at += 8 * n_own
    counts = np.frombuffer(raw, "<u4", n_names, at)
    place = np.frombuffer(raw, "<i4", n, at + 4 * n_names)
    at += 4 * n_names + 4 * n
    docs = np.cumsum(np.frombuffer(raw, "<u2", n_docs, at), dtype=np.uint16) if n_docs else None
    return raw[at + 2 * n_docs:].decode("utf-8", "surrogatepass").split("\n"), counts, own, place, docs


def in_order(*columns: tuple[np.ndarray, int]) -> list[np.ndarray]:
    """The rows of (codes, bound of the codes) columns, sorted by all of them.  Codes that fit
    in 63 bits together are sorted as one number."""
    bits = [int(bound).bit_length() for _, bound in columns]
    if sum(bits) > 63:
        order = np.lexsort([c for c, _ in reversed(columns)])
        return [c[order] for c, _ in columns]
    key = np.zeros(len(columns[0][0]), np.int64)
    for (codes, _), b in zip(columns, bits):
        key = (key << b) | codes
    key.sort()
    out = []
    for b in reversed(bits):
        out.append(key & ((1 << b) - 1))
        key >>= b
    return out[::-1]


def dealt(docs: DataFrame, frequent: dict[str, int], buckets: int, s: Settings, train_only: bool) -> DataFrame:
    """(bucket, slice, held, blob, ids, n_tokens, held_rows) from (id, text, held).

    A slice's training and other tokens are separate rows; one row of each slice
    carries its ids.  ``train_only`` leaves all document places out, and of the other
    tokens all but their restaurants."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for b in sliced(batches, "text", s.slice_bytes):
            counts, flat, words = tokens(array(b.column("text")))
            h = hashes(words)
            hot = np.array([frequent.get(w, -1) for w in words])
            own = np.where(hot >= 0, hot, len(frequent) + (h % np.uint64(s.classes - len(frequent))).astype(np.int64))
            classes, rank = np.unique(own, return_inverse=True)
            cls = np.empty_like(flat)               # rank of the restaurant; a text's first word stands behind an end
            cls[1:] = rank[flat[:-1]]
            cls[0] = rank[0]
            bucket = h[flat]
            some = np.flatnonzero(hot[flat] >= 0)
            bucket[some] += mixed(classes.astype(np.uint64))[cls[some]]
            bucket = (mixed(bucket) % np.uint64(buckets)).astype(np.int64)
            row = np.repeat(np.arange(len(counts)), counts)
            held = b.column("held").to_numpy(zero_copy_only=False)[row]
            group = 2 * bucket + held
            if train_only:
                group, flat, cls = in_order((group, 2 * buckets), (flat, len(words)), (cls, len(classes)))
            else:
                group, flat, at = in_order((group, 2 * buckets), (flat, len(words)), (np.arange(len(flat)), len(flat)))
                cls, row = cls[at], row[at]
            cut = np.flatnonzero(np.diff(group, prepend=-1))
            out = []
            place, there = np.empty(len(classes), np.int32), np.zeros(len(classes), bool)
            for lo, hi in zip(cut, np.append(cut[1:], len(group))):
                c = cls[lo:hi]
                there[c] = True
                asked = np.flatnonzero(there)
                there[asked], place[asked] = False, np.arange(len(asked))
                if train_only and group[lo] % 2:
                    out.append((int(group[lo]) // 2, True,
                                packed([END], np.array([len(asked)]), classes[asked], np.arange(len(asked)), None)))
                    continue
                w = flat[lo:hi]
                first = np.flatnonzero(np.diff(w, prepend=-1))
                blob = packed([words[k] for k in w[first]], np.diff(np.append(first, hi - lo)), classes[asked], place[c],
                              None if train_only else row[lo:hi])
                out.append((int(group[lo]) // 2, bool(group[lo] % 2), blob))
            ids = None if train_only else array(b.column("id"))
            rest = len(out) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([number] * len(out), pa.int64()),
                 pa.array([x[1] for x in out]), pa.array([x[2] for x in out], pa.binary()),
                 pa.array([None if ids is None else ids.to_pylist()] + [None] * rest, pa.list_(b.column("id").type)),
                 pa.array([counts.tolist()] + [None] * rest, pa.list_(pa.int64())),
                 pa.array([b.column("held").to_pylist()] + [None] * rest, pa.list_(pa.bool_()))],
                names=["bucket", "slice", "held", "blob", "ids", "n_tokens", "held_rows"])
            number += 1

    return docs.mapInArrow(run, f"bucket long, slice long, held boolean, blob binary, ids array<{kind}>, "
                                "n_tokens array<long>, held_rows array<boolean>")


class Bucket:
    """The tokens of one bucket: codes of words, classes, pairs and their seatings."""

    def __init__(self, held, blobs, frequent: dict[str, int], s: Settings, scale: int):
        parts = [unpacked(b) for b in blobs]
        names = pa.array([w for p in parts for w in p[0]], pa.string()).dictionary_encode()
        code = names.indices.to_numpy(zero_copy_only=False)
        self.names = names.dictionary.to_pylist()
        sizes = [len(p[0]) for p in parts]
        at = starts_of(np.array(sizes, np.int64))
        self.word = np.concatenate([np.repeat(code[lo:hi], p[1]) for p, lo, hi in zip(parts, at, at[1:])]).astype(np.int64)
        self.context, place = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
        at = starts_of(np.array([len(p[2]) for p in parts], np.int64))
        self.place = np.concatenate([place[lo:hi][p[3]] for p, lo, hi in zip(parts, at, at[1:])])
        self.part = np.repeat(np.arange(len(parts)), [len(p[3]) for p in parts])
        self.doc = np.concatenate([p[4] for p in parts]) if parts[0][4] is not None else None
        self.hot = np.array([frequent.get(w, -1) for w in self.names])
        self.s, self.scale = s, scale
        train = ~np.asarray(held, bool)[self.part]
        pair = self.word * len(self.context) + self.place
        self.pair, self.n = np.unique(pair[train], return_counts=True)
        self.where = np.searchsorted(self.pair, pair)               # of every token; may miss
        self.where[self.where == len(self.pair)] = 0
        self.found = self.pair[self.where] == pair if len(self.pair) else np.zeros(len(pair), bool)
        self.pw, self.pc = self.pair // len(self.context), self.pair % len(self.context)
        self.count = np.bincount(self.word[train], minlength=len(self.names))
        self.hash = hashes(self.names)

    @property
    def cls(self) -> np.ndarray:
        """Restaurant of every token."""
        return self.context[self.place]

    def sampled(self):
        """Yield (tables per pair, customers and tables per word of the parent) of each kept sample."""
        s, words = self.s, len(self.names)
        d0, d1 = s.discount
        r0, r1 = s.strength
        up = np.where(self.hot >= 0, self.scale, 1)                 # a frequent word is on all buckets
        keys = mixed(self.hash[self.pw] ^ mixed(self.context[self.pc].astype(np.uint64)))
        t = np.minimum(self.n, 1)
        root, types = np.ones(words, np.int64), max(int((self.count > 0).sum()), 1)
        for sweep in range(s.burn + s.samples):
            customers = np.bincount(self.pw, t, words).astype(np.int64)
            all_customers = max(int(customers.sum()), 1) * self.scale
            all_root = int(np.where(customers > 0, root, 0).sum()) * self.scale
            base = 1.0 / (types * self.scale + 1)
            p = np.maximum(customers * up - d0 * root, 0) + (r0 + d0 * all_root) * base
            p /= r0 + all_customers
            # a word's other tables in a restaurant lie on all buckets alike, its own on this one
            tables = np.bincount(self.pc, t, len(self.context))[self.pc] - t
            t = drawn(self.n, (r1 + d1 * (t + tables * self.scale)) * p[self.pw], keys, d1, sweep)
            customers = np.bincount(self.pw, t, words).astype(np.int64)
            root = root_tables(customers, self.hash, (r0 + d0 * all_root) * base, sweep, s)
            if sweep >= s.burn:
                yield t, customers, root


def root_tables(customers: np.ndarray, keys: np.ndarray, weight: float, sweep: int, s: Settings) -> np.ndarray:
    return drawn(customers, np.full(len(customers), weight), mixed(keys + np.uint64(sweep)), s.discount[0], 1_000_000 + sweep)


@dataclass
class Totals:
    tokens: int              # training tokens
    types: int
    asked: DataFrame | None  # part, bucket, v: customers and tables of a bucket's restaurants
    parent: np.ndarray       # per sample: customers of the parent
    root: np.ndarray         # per sample: its tables
    hot_count: np.ndarray    # per frequent word: training tokens
    hot_customers: np.ndarray    # sample x frequent word

    def seats(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(customers, sample x tables) of given restaurants, on the driver."""
        samples = len(self.parent)
        parts = [_added(g[1]["v"], samples) for g in self.asked.toPandas().groupby("part")]
        own = np.concatenate([p[0] for p in parts])
        sums = np.concatenate([p[1] for p in parts], axis=1)
        order = np.argsort(own)
        at = np.searchsorted(own, context, sorter=order)
        at = order[np.minimum(at, len(own) - 1)]
        got = np.where(own[at] == context, sums[:, at], 0)
        return got[0], got[1:]


def by_part(context: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the restaurants by part, bounds of the parts)."""
    part = (mixed(context.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    return np.argsort(part, kind="stable"), starts_of(np.bincount(part, minlength=parts))


def _opened(blob: bytes, samples: int) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = len(raw) // (8 + 4 * (1 + samples))
    return np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<u4", offset=8 * n).reshape(1 + samples, n)


def _added(blobs, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(restaurants, customers and tables of each, place of every asked one in them)."""
    opened = [_opened(b, samples) for b in blobs]
    own, place = np.unique(np.concatenate([o for o, _ in opened]), return_inverse=True)
    values = np.concatenate([v for _, v in opened], axis=1)
    return own, np.array([np.bincount(place, v, len(own)) for v in values]).astype(np.int64), place


def totals(train: DataFrame, frequent: dict[str, int], buckets: int, s: Settings) -> Totals:
    """Pass 1.  Each bucket gives one vector of sums, cut in chunks and added up, and what it
    has of each of its restaurants, by part."""
    hot = len(frequent)
    # tokens, types, per sample (parent, root); frequent counts; frequent customers
    width = 2 + 2 * s.samples + hot * (1 + s.samples)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        b = Bucket(group["held"].to_numpy(), group["blob"], frequent, s, buckets)
        common = b.hot >= 0
        at = b.hot[common]
        parent, own, hot_customers = [], [np.bincount(b.pc, b.n, len(b.context))], []
        for t, customers, root in b.sampled():
            parent.append((customers.sum(), root[~common].sum()))
            own.append(np.bincount(b.pc, t, len(b.context)))
            hot_customers.append(np.bincount(at, customers[common], hot))
        v = np.concatenate([[b.count.sum(), (b.count[~common] > 0).sum()], np.ravel(parent),
                            np.bincount(at, b.count[common], hot), *hot_customers]).astype(np.int64)
        order, bounds = by_part(b.context, buckets)
        own = np.array(own).astype("<u4")
        asked = [(k, squeezed(b.context[order[lo:hi]].astype("<i8"), own[:, order[lo:hi]]))
                 for k, (lo, hi) in enumerate(zip(bounds, bounds[1:])) if hi > lo]
        rows = [(k, None, x.tobytes()) for k, x in enumerate(np.array_split(v, CHUNKS))] + [(None, k, x) for k, x in asked]
        out = pd.DataFrame(rows, columns=["chunk", "part", "v"])
        return out.astype({"chunk": "Int32", "part": "Int32"}).assign(bucket=group["bucket"].iloc[0])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        v = sum(np.frombuffer(x, np.int64) for x in group["v"])
        return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "v": [v.tobytes()]})

    rows = written(train.groupBy("bucket").applyInPandas(run, "chunk int, part int, v binary, bucket long"), "seatings")
    got = rows.where("chunk IS NOT NULL").select("chunk", "v").groupBy("chunk").applyInPandas(add, "chunk int, v binary").collect()
    v = np.concatenate([np.frombuffer(bytes(r["v"]), np.int64) for r in sorted(got, key=lambda r: r["chunk"])]) \
        if got else np.zeros(width, np.int64)
    head, per_hot = v[:2 + 2 * s.samples], v[2 + 2 * s.samples:].reshape(1 + s.samples, hot)
    parent, root = head[2:].reshape(s.samples, 2).T
    return Totals(int(head[0]), int(head[1] + (per_hot[0] > 0).sum()), rows.where("part IS NOT NULL").select("part", "bucket", "v"),
                  parent, root, per_hot[0], per_hot[1:])


def answers(asked: DataFrame, s: Settings) -> DataFrame:
    """(bucket, part, v): the sums of the restaurants that a bucket asked for, in its order."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        _, sums, place = _added(group["v"], s.samples)
        at = starts_of(np.array([len(_opened(b, s.samples)[0]) for b in group["v"]]))
        return pd.DataFrame({"bucket": group["bucket"].to_numpy(), "part": group["part"].to_numpy(),
                             "v": [squeezed(sums[:, place[lo:hi]].astype("<i8")) for lo, hi in zip(at, at[1:])]})

    return asked.groupBy("part").applyInPandas(run, "bucket long, part int, v binary")


def answered(b: Bucket, rows: pd.DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(customers, sample x tables) of a bucket's restaurants from its ``answers``."""
    order, _ = by_part(b.context, buckets)
    got = np.empty((1 + b.s.samples, len(b.context)), np.int64)
    parts = [np.frombuffer(zstandard.ZstdDecompressor().decompress(v), "<i8").reshape(1 + b.s.samples, -1)
             for v in rows.sort_values("part")["v"]]
    got[:, order] = np.concatenate(parts, axis=1)
    return got[0], got[1:]


def token_scores(b: Bucket, g: Totals, hot_root: np.ndarray, seats=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known, log10 of the base probability, log10 of the model's) per token; ``seats``:
    customers and tables of the bucket's restaurants, if they are not to be fetched."""
    s = b.s
    all_customers, all_tables = seats or g.seats(b.context)
    (d0, d1), (r0, r1) = s.discount, s.strength
    common = b.hot >= 0
    count = b.count.copy()
    count[common] = g.hot_count[b.hot[common]]
    base = np.log10((count + 1) / (g.tokens + g.types + 1))
    total = np.zeros(len(b.word))
    for k, (t, customers, root) in enumerate(b.sampled()):
        customers, root = customers.copy(), root.copy()
        customers[common] = g.hot_customers[k][b.hot[common]]
        root[common] = hot_root[k][b.hot[common]]
        all_root = g.root[k] + hot_root[k].sum()
        p = (customers - d0 * root + (r0 + d0 * all_root) / (g.types + 1)) / (r0 + g.parent[k])
        n = all_customers[b.place]
        seen = np.zeros(len(b.word))
        if len(b.n):
            seen = np.where(b.found, (b.n - d1 * t)[b.where], 0.0)
        total += (seen + (r1 + d1 * all_tables[k][b.place]) * p[b.word]) / (r1 + n)
    return (count > 0)[b.word], base[b.word], np.log10(total / s.samples)


def score(docs: DataFrame, held, id_col: str = "doc_id", text_col: str = "text", s: Settings = Settings()) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigram) and score, both log10; rows where the column
    ``held`` is true are not learned from."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), held.alias("held"))
    kind = src.schema["id"].dataType.simpleString()
    frequent, n = frequent_words(src, s)
    buckets = max(s.least_buckets, -(-n // s.bucket_tokens))
    g = totals(dealt(src, frequent, buckets, s, True), frequent, buckets, s)
    swept(docs.sparkSession)         # pass 1's tokens; pass 2 deals them again
    hot_keys = hashes(sorted(frequent, key=frequent.get))
    hot_root = np.array([root_tables(g.hot_customers[k], hot_keys, s.discount[0], k, s) for k in range(s.samples)])
    shared = docs.sparkSession.sparkContext.broadcast((replace(g, asked=None), hot_root))
    n_train = g.tokens

    def run(group: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        b = Bucket(group["held"].to_numpy(), group["blob"], frequent, s, buckets)
        known, base, score = token_scores(b, *shared.value, answered(b, own, buckets))
        group = group.reset_index(drop=True)
        at = starts_of(np.bincount(b.part, minlength=len(group)))
        out = []
        for lo, hi in zip(at, at[1:]):
            d = b.doc[lo:hi].astype(np.int64)
            rows, inv = np.unique(d, return_inverse=True)
            sums = [np.bincount(inv, x[lo:hi], len(rows)) for x in (known, base, score)]
            out.append(rows.astype("<u2").tobytes() + sums[0].astype("<u4").tobytes() + sums[1].tobytes() + sums[2].tobytes())
        return pd.DataFrame({"slice": group["slice"], "sums": out, "ids": group["ids"], "n_tokens": group["n_tokens"],
                             "held_rows": group["held_rows"]})

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        head = group[group["ids"].notna()].iloc[0]
        rows = len(head["ids"])
        known, base, own = np.zeros(rows, np.int64), np.zeros(rows), np.zeros(rows)
        for blob in group["sums"]:
            n = len(blob) // 22
            d = np.frombuffer(blob, "<u2", n)
            known[d] += np.frombuffer(blob, "<u4", n, 2 * n)
            base[d] += np.frombuffer(blob, "<f8", n, 6 * n)
            own[d] += np.frombuffer(blob, "<f8", n, 14 * n)
        return pd.DataFrame({"id": pd.Series(list(head["ids"]), dtype=object), "held_out": head["held_rows"],
                             "n_tokens": head["n_tokens"], "n_known": known, "train_tokens": n_train,
                             "base_score": base, "score": own})

    dealt_all = dealt(src, frequent, buckets, s, False)
    sums = dealt_all.groupBy("bucket").cogroup(answers(g.asked, s).groupBy("bucket")).applyInPandas(
        run, f"slice long, sums binary, ids array<{kind}>, n_tokens array<long>, held_rows array<boolean>")
    out = sums.groupBy("slice").applyInPandas(
        gather, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)
