"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes a word boundary, and
n-grams of one to three characters are hashed into ``features`` columns.  Document
frequencies are counted over every training row.  The weights are learned with
follow-the-regularised-leader (per-coordinate steps, L1 and L2 penalties, so most
weights stay zero) on a sample of at most ``sample`` different labelled texts, the same
number for each label, drawn by hash; a fifth of it fits the softmax temperature.

Defined cases: null text or text without a letter is ``und`` with score 0; ties
go to the label that sorts first; rows without a label are never learned from;
without any label every row is ``und``; empty tables give an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerscreen.llm.common import array, sliced, written
from ledgerscreen.llm.shingles import mixed

UNKNOWN = "und"
MOST_LABELS = 10_000        # more are joined without a broadcast


@dataclass(frozen=True)
class Settings:
    features: int = 1 << 14
    sample: int = 6000          # different labelled texts that the weights are learned from, at most
    calibrate_every: int = 5    # of the sample, every fifth row fits the temperature only
    epochs: int = 2
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    block: int = 64             # documents in one dense block of counts
    slice_bytes: int = 1_000_000


_LETTER: list[np.ndarray] = []


def letters(points: np.ndarray) -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0xD800)] + [False] * 0x800 +
                                [chr(c).isalpha() for c in range(0xE000, 0x110000)]))
    return _LETTER[0][points]


def gram_features(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hashed n-gram) of every n-gram, rows ascending, and whether a row has a letter."""
    low = [t.replace("\0", " ") for t in pc.utf8_lower(pc.fill_null(texts, "")).to_pylist()]
    points = np.frombuffer(("\0" + "\0".join(low) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.cumsum(points == 0) - 1
    c = np.where(letters(points), points, 0).astype(np.uint64)
    keep = (c > 0) | (np.append(0, c[:-1]) > 0) | (points == 0)      # one boundary between words
    c, row = c[keep], row[keep]
    in_word = c > 0
    one = np.flatnonzero(in_word)
    two = np.flatnonzero(in_word[:-1] | in_word[1:])
    two = two[row[two] == row[two + 1]] if len(two) else two
    three = np.flatnonzero(in_word[1:-1]) if len(c) > 2 else np.empty(0, np.int64)
    three = three[row[three] == row[three + 2]] if len(three) else three
    key = np.concatenate([c[one], (c[two] << np.uint64(21) | c[two + 1]) + np.uint64(1 << 62),
                          (c[three] << np.uint64(42) | c[three + 1] << np.uint64(21) | c[three + 2])
                          ^ np.uint64(1 << 63)])
    feature = (mixed(key) % np.uint64(size)).astype(np.int64)
    rows = np.concatenate([row[one], row[two], row[three]])
    order = np.argsort(rows, kind="stable")
    some = np.zeros(len(low), bool)
    some[row[one]] = True
    return rows[order], feature[order], some


def count_blocks(texts: pa.Array, s: Settings):
    """(first row, dense counts, has a letter) of each block of documents."""
    rows, feature, some = gram_features(texts, s.features)
    for lo in range(0, len(texts), s.block):
        hi = min(lo + s.block, len(texts))
        a, b = np.searchsorted(rows, [lo, hi])
        cell = (rows[a:b] - lo) * s.features + feature[a:b]
        yield lo, np.bincount(cell, minlength=(hi - lo) * s.features).reshape(hi - lo, s.features), some[lo:hi]


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm == 0, 1, norm)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def learn(rows: list[tuple[np.ndarray, np.ndarray, int]], labels: int, s: Settings) -> tuple[np.ndarray, float]:
    """(weights with the bias as the last row, temperature) from sparse rows
    (features, values, label number), by FTRL-proximal."""
    z = np.zeros((s.features + 1, labels))
    n = np.zeros_like(z)
    l1 = np.full((s.features + 1, 1), s.l1)
    l1[-1] = 0

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * l1[at]) / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2)
        return np.where(np.abs(z[at]) <= l1[at], 0.0, w)

    rows = [(np.append(f, s.features), np.append(v, 1.0), y) for f, v, y in rows]
    held = [r for k, r in enumerate(rows) if k % s.calibrate_every == s.calibrate_every - 1]
    fit = [r for k, r in enumerate(rows) if k % s.calibrate_every != s.calibrate_every - 1]
    for _ in range(s.epochs):
        for f, v, y in fit:
            w = weights(f)
            p = softmax(v @ w)
            p[y] -= 1
            g = v[:, None] * p
            sigma = (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / s.alpha
            z[f] += g - sigma * w
            n[f] += g * g
    w = weights(np.arange(s.features + 1))
    if not held:
        return w, 1.0
    logits = np.array([v @ w[f] for f, v, _ in held])
    truth = np.array([y for *_, y in held])

    def loss(log_t):
        return -np.log(softmax(logits / np.exp(log_t))[np.arange(len(truth)), truth] + 1e-12).mean()

    lo, hi, g = -1.0, 4.0, (5 ** 0.5 - 1) / 2        # golden section
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return w, float(np.exp((lo + hi) / 2))


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float


def document_frequencies(rows: DataFrame, s: Settings) -> tuple[np.ndarray, int]:
    """Of every feature over all rows of (text), and the number of rows; what
    reaches the driver is one number per feature."""
    def run(batches):
        df = np.zeros(s.features + 1, np.int64)
        for b in sliced(batches, "text", s.slice_bytes):
            for _, counts, _ in count_blocks(array(b.column("text")), s):
                df[:-1] += (counts > 0).sum(axis=0)
                df[-1] += len(counts)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["f", "n"])

    got = rows.select("text").mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(s.features + 1, np.int64)
    out[got["f"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out[:-1], int(out[-1])


def texts_per_label(rows: DataFrame) -> DataFrame:
    """(label, c): about how many different texts each label has."""
    return written(rows.groupBy("label").agg(F.approx_count_distinct(F.xxhash64("text")).alias("c")), "labels")


def drawn(rows: DataFrame, per_label: DataFrame, quota: int) -> DataFrame:
    """(label, u, text): at most ``quota`` different texts of each label, by hash.

    A threshold leaves about twice the quota of each label; copies of a text fall together
    in every task before anything is shuffled, and the rank then cuts exactly."""
    u = F.pmod(F.xxhash64("text", "label"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    near = rows.join(F.broadcast(per_label), "label") if per_label.count() <= MOST_LABELS else rows.join(per_label, "label")
    near = near.withColumn("u", u).where(F.col("u") * F.col("c") < 2 * quota).select("label", "u", "text").distinct()
    rank = F.row_number().over(Window.partitionBy("label").orderBy("u", "text"))
    return near.withColumn("r", rank).where(F.col("r") <= quota).select("label", "u", "text")


def train(docs: DataFrame, label_col: str = "lang", text_col: str = "text", s: Settings = Settings()) -> Model:
    """Learn from the labelled rows of ``docs``."""
    rows = docs.where(docs[label_col].isNotNull() & docs[text_col].isNotNull()).select(
        docs[label_col].cast("string").alias("label"), docs[text_col].cast("string").alias("text"))
    df, n = document_frequencies(rows, s)
    idf = np.log((1 + n) / (1 + df)) + 1
    per_label = texts_per_label(rows)
    labels = per_label.count()
    if not labels:
        return Model([], idf, np.zeros((s.features + 1, 0)), 1.0)
    chosen = drawn(rows, per_label, max(1, s.sample // labels))

    def sparse(batches):
        for b in sliced(batches, "text", s.slice_bytes):
            f, v = [], []
            for _, counts, _ in count_blocks(array(b.column("text")), s):
                x = weighted(counts, idf)
                for r in x:
                    at = np.flatnonzero(r)
                    f.append(at.astype(np.int32).tobytes())
                    v.append(r[at].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("label"), b.column("u"), pa.array(f, pa.binary()),
                                              pa.array(v, pa.binary())], names=["label", "u", "f", "v"])

    def fit(group: pd.DataFrame) -> pd.DataFrame:      # at most ``sample`` rows
        group = group.sort_values(["u", "label"])
        names = sorted(group["label"].unique())
        number = {x: k for k, x in enumerate(names)}
        rows = [(np.frombuffer(f, np.int32).astype(np.int64), np.frombuffer(v, np.float32).astype(float), number[y])
                for f, v, y in zip(group["f"], group["v"], group["label"])]
        w, t = learn(rows, len(names), s)
        return pd.DataFrame({"labels": [names], "w": [w.astype(np.float32).tobytes()], "t": [t]})

    sample = chosen.mapInArrow(sparse, "label string, u double, f binary, v binary")
    got = sample.groupBy(F.lit(0).alias("all")).applyInPandas(fit, "labels array<string>, w binary, t double").first()
    w = np.frombuffer(bytes(got["w"]), np.float32).reshape(s.features + 1, -1)
    return Model(list(got["labels"]), idf, w, got["t"])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            s: Settings = Settings()) -> DataFrame:
    """(id, lang_pred, score) of every row."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)      # features x labels numbers

    def run(batches):
        m = shared.value
        for b in sliced(batches, "text", s.slice_bytes):
            lang, score = np.full(b.num_rows, UNKNOWN, object), np.zeros(b.num_rows)
            if m.labels:
                for lo, counts, some in count_blocks(array(b.column("text")), s):
                    p = softmax((weighted(counts, m.idf) @ m.weights[:-1] + m.weights[-1]) / m.temperature)
                    at = lo + np.flatnonzero(some)
                    lang[at] = np.array(m.labels, object)[p.argmax(axis=1)[some]]
                    score[at] = p.max(axis=1)[some]
            yield pa.RecordBatch.from_arrays([array(b.column("id")), pa.array(lang, pa.string()), pa.array(score)],
                                             names=["id", "lang_pred", "score"])

    return src.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def in_fold(id_col: Column, folds: int, fold: int) -> Column:
    """Whether the crc32 of the id's text leaves this remainder (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == fold
