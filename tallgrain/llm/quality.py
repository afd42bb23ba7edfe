"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL.

Words are runs of letters, digits or symbols.  A text's features are its single words, pairs of
neighbours, one to three neighbouring word shapes (case, digits, which symbol, "as before"), and
a mark for each four words that stood in the text before; all hashed into one space.  Each kind
is scaled to a sum of one, so a score is a sparse dot product that does not grow with the text.

Training reads a bounded sample of the labelled rows (``max_rows``), chosen by a seeded hash of
the id before any text moves, once per epoch in a seeded order; follow-the-regularised-leader keeps per-weight rates and
makes rare weights exactly zero.  Only the weights, ``2 ** bits`` numbers, go to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Hasher, crc_remainder, mixed, sampled_texts, steps, text_bytes

LETTER, UPPER, DIGIT, SYMBOL = 1, 2, 4, 8

_KIND = np.zeros(256, np.uint8)
_KIND[ord("a") : ord("z") + 1] = LETTER
_KIND[128:] = LETTER
_KIND[ord("A") : ord("Z") + 1] = LETTER | UPPER
_KIND[ord("0") : ord("9") + 1] = DIGIT
for _c in range(33, 127):
    if not _KIND[_c]:
        _KIND[_c] = SYMBOL

_HASH = Hasher(seed=11)
_NEXT = np.uint64(0xD6E8FEB86659FD93)


class Words:
    """Word starts, ends, hashes and shapes of several documents at once."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        kind = _KIND[data]
        group = kind & ~np.uint8(UPPER)
        first = np.ones(len(data), bool)
        first[1:] = group[1:] != group[:-1]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        first[inner] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(data))
        real = group[starts] > 0
        self.start, self.end = starts[real], ends[real]
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.hash = _HASH.spans(_HASH.prefix(data), self.start, self.end)
        uppers = np.concatenate([[0], np.cumsum((kind & UPPER) > 0)])
        upper = uppers[self.end] - uppers[self.start]
        size = self.end - self.start
        code = group[self.start].astype(np.int64) * 64
        capital = (kind[self.start] & UPPER) > 0
        code += np.where(upper == 0, 0, np.where((upper == 1) & capital, 1, np.where(2 * upper > size, 2, 3)))
        symbol = group[self.start] == SYMBOL
        code = np.where(symbol, 1024 + 128 * np.minimum(size, 4) + data[self.start], code)
        self.shape = mixed(code.astype(np.uint64) + np.uint64(77))

    def same_doc(self, n: int) -> np.ndarray:
        """Places where ``n`` words of one document begin."""
        if len(self.doc) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.doc[n - 1 :] == self.doc[: len(self.doc) - n + 1])


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, document) of each feature, one pair of arrays per kind."""
    if not len(data):
        return
    w, shift = Words(data, offsets), np.uint64(64 - bits)
    if not len(w.doc):
        return
    yield (w.hash >> shift).astype(np.int64), w.doc
    two = w.same_doc(2)
    yield (mixed(w.hash[two] * _NEXT + w.hash[two + 1]) >> shift).astype(np.int64), w.doc[two]
    shape = w.shape.copy()
    shape[1:] += (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    for n in (1, 2, 3):
        at = w.same_doc(n)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * _NEXT + shape[at + k]
        yield (mixed(h) >> shift).astype(np.int64), w.doc[at]
    at = w.same_doc(4)
    h = w.doc[at].astype(np.uint64)
    for k in range(4):
        h = h * _NEXT + w.hash[at + k]
    order = np.argsort(h, kind="stable")
    seen = np.zeros(len(at), np.int64)
    seen[order[1:]] = h[order[1:]] == h[order[:-1]]
    yield (mixed(seen.astype(np.uint64) + np.uint64(5)) >> shift).astype(np.int64), w.doc[at]


def _score_step(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bits: int) -> np.ndarray:
    n = len(offsets) - 1
    z = np.full(n, weights[-1], np.float64)
    for bucket, doc in features(data, offsets, bits):
        count = np.bincount(doc, minlength=n)
        z += np.bincount(doc, weights[bucket], n) / np.maximum(count, 1)
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass(frozen=True)
class QualityModel:
    """Weights of the buckets, with the bias last."""

    weights: np.ndarray
    bits: int

    def score(self, df: DataFrame, text: str = "text", score: str = "score") -> DataFrame:
        """``df`` with the probability of label 1 in column ``score``; reads whole texts.

        An empty or null text gets the bias alone.
        """
        if score in df.columns:
            raise ValueError(f"column {score!r} exists already")
        weights = df.sparkSession.sparkContext.broadcast(self.weights)  # 2 ** bits floats
        bits, names = self.bits, df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = text_bytes(batch.column(names.index(text)))
                found = [
                    _score_step(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], weights.value, bits)
                    for i, j in steps(offsets)
                ]
                column = pa.array(np.concatenate([np.zeros(0), *found]), pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns, column], [*names, score])

        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
        return df.mapInArrow(run, ", ".join([*fields, f"`{score}` double"]))


class Ftrl:
    """Follow-the-regularised-leader for one bias and ``2 ** bits`` weights."""

    def __init__(self, bits: int, alpha: float, beta: float, l1: float, l2: float):
        self.z = np.zeros((1 << bits) + 1)
        self.n = np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ value, -40, 40)))
        g = (p - label) * value
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def _sparse(data: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text with their values, the bias last."""
    kinds = [b for b, _ in features(data, np.array([0, len(data)]), bits)]
    kinds = [b for b in kinds if len(b)]
    if not kinds:
        return np.array([1 << bits]), np.ones(1)
    share = np.concatenate([np.full(len(b), 1 / len(b)) for b in kinds])
    at, back = np.unique(np.concatenate(kinds), return_inverse=True)
    return np.append(at, 1 << bits), np.append(np.bincount(back, share), 1.0)


def fit(
    sample: DataFrame,
    text: str = "text",
    label: str = "label",
    key: str = "doc_id",
    *,
    epochs: int = 4,
    bits: int = 18,
    alpha: float = 2.0,
    beta: float = 1.0,
    l1: float = 1e-4,
    l2: float = 1e-3,
    seed: int = 5,
) -> QualityModel:
    """Train on all rows of a bounded sample; rows with a null label take no part.

    With no row at all every weight is zero and every score 0.5.  One task reads the texts, in
    another order each epoch, and holds one Arrow batch of them at a time.
    """
    some = sample.where(F.col(label).isNotNull()).withColumn("_key", F.col(key))
    rows = (
        some.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"), F.col("_key"))
        .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
        .withColumn("_u", F.xxhash64(F.lit(seed), "epoch", "_key"))
        .repartition(1)
        .sortWithinPartitions("epoch", "_u", "_key", "text", "label")
        .select("text", "label")
    )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ftrl(bits, alpha, beta, l1, l2)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for k, y in enumerate(batch.column(1).to_pylist()):
                model.learn(*_sparse(data[offsets[k] : offsets[k + 1]], bits), y)
        packed = model.weights().astype(np.float32).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["weights"])

    found = rows.mapInArrow(train, "weights binary").collect()
    packed = found[0][0] if found else b""
    weights = np.frombuffer(packed, np.float32) if packed else np.zeros((1 << bits) + 1, np.float32)
    return QualityModel(weights, bits)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: remainder 1 of crc32 of the id as text, modulo 3."""
    return crc_remainder(doc_id, 3) == 1


def fit_on_labels(docs: DataFrame, labels: DataFrame, max_rows: int = 8000, seed: int = 5, **options) -> QualityModel:
    """Train on at most ``max_rows`` of the documents that ``labels`` marks, without the held-out third."""
    known = labels.select("doc_id", F.col("quality").alias("label")).where(~held_out(F.col("doc_id")) & F.col("label").isin(0, 1))
    sample = sampled_texts(docs, known, "doc_id", max_rows, seed)
    return fit(sample, seed=seed, **options)
