"""Language of a text: averaged hashed subword embeddings under a linear softmax.

Subwords are the two, three and four bytes at every place of the lower-cased letters of a text
(all else is one blank), hashed into ``2 ** bits`` embeddings.  A text is the mean of its
subwords' embeddings; a linear softmax gives the languages.  Both are trained together by
stochastic gradient descent in numpy, on a bounded sample (``max_rows``) chosen by a seeded hash.

Because the softmax layer is linear, embedding and layer are multiplied once after training: to
score a text, one row of as many numbers as languages is looked up for each subword.

A fifth of the sample is kept from training.  It sets the softmax temperature, and the score below
which a prediction is rejected: the lowest one above which ``precision`` of the kept rows are right.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Hasher, crc_remainder, early, seeded, steps, text_bytes, written

#: The answer for a text without any letter.
UNKNOWN = "und"
WIDTHS = (2, 3, 4)
#: Rows that each language has in the sample, if it has as many.
FLOOR = 20

_LOWER = np.full(256, 32, np.uint8)
_LOWER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LOWER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LOWER[128:] = np.arange(128, 256)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LETTER = regex.compile(r"\p{L}")
_HASH = Hasher(seed=23)


def subwords(data: np.ndarray, offsets: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first place, bucket) of every subword inside a document; places ascend per width."""
    low = _LOWER[data]
    prefix = _HASH.prefix(low)
    blank = low == 32
    last = np.repeat(offsets[1:], np.diff(offsets))
    for width in WIDTHS:
        n = len(low) - width + 1
        if n <= 0:
            continue
        # A subword stays in its document and does not begin with two blanks.
        at = np.flatnonzero((np.arange(n) + width <= last[:n]) & ~(blank[:n] & blank[1 : n + 1]))
        h = _HASH.spans(prefix, at, at + width)
        yield at, (h >> np.uint64(64 - bits)).astype(np.int64)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each document holds a letter of any script."""
    total = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    found = total[offsets[1:]] > total[offsets[:-1]]
    for i in np.flatnonzero(~found):
        text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = _LETTER.search(text) is not None
    return found


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def logits(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Mean of the table's rows over each document's subwords, plus the bias."""
    n, bits = len(offsets) - 1, len(table).bit_length() - 1
    total, count = np.zeros((n, len(bias))), np.zeros(n)
    for at, bucket in subwords(data, offsets, bits):
        doc = np.searchsorted(offsets, at, "right") - 1
        count += np.bincount(doc, minlength=n)
        for k in range(len(bias)):
            total[:, k] += np.bincount(doc, table[bucket, k], n)
    return total / np.maximum(count, 1)[:, None] + bias


@dataclass(frozen=True)
class LanguageModel:
    """``table``: a row of language scores per bucket; ``langs`` in the table's column order."""

    langs: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def predict(self, df: DataFrame, text: str = "text") -> DataFrame:
        """``df`` with lang_pred, score (0 to 1) and accepted; reads whole texts.

        Null and letterless texts give ``und``, score 0, not accepted; so does every text if the
        model has learnt no language.
        """
        if taken := {"lang_pred", "score", "accepted"} & set(df.columns):
            raise ValueError(f"columns {sorted(taken)} exist already")
        model = df.sparkSession.sparkContext.broadcast(self)  # 2 ** bits rows, a column a language
        names = df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = model.value
            for batch in batches:
                data, offsets = text_bytes(batch.column(names.index(text)))
                lang, score = [], []
                for i, j in steps(offsets):
                    d, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                    known = has_letter(d, o) if m.langs else np.zeros(j - i, bool)
                    if known.any():
                        p = softmax(logits(d, o, m.table, m.bias) / m.temperature)
                        best = p.argmax(axis=1)
                        score += np.where(known, p[np.arange(j - i), best], 0.0).tolist()
                        lang += [m.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
                    else:
                        score += [0.0] * (j - i)
                        lang += [UNKNOWN] * (j - i)
                sure = [a != UNKNOWN and s >= m.reject_below for a, s in zip(lang, score)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(sure, pa.bool_())],
                    [*names, "lang_pred", "score", "accepted"],
                )

        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
        return df.mapInArrow(run, ", ".join([*fields, "lang_pred string, score double, accepted boolean"]))


class Trainer:
    """Embeddings and softmax layer under stochastic gradient descent, one text at a time."""

    def __init__(self, langs: int, bits: int, dim: int, rate: float, total: int, seed: int):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 1 / dim, (1 << bits, dim)).astype(np.float32)
        self.layer = np.zeros((dim, langs), np.float32)
        self.bias = np.zeros(langs, np.float32)
        self.bits, self.rate, self.done, self.total = bits, rate, 0, max(total, 1)

    def learn(self, data: np.ndarray, lang: int) -> None:
        found = [bucket for _, bucket in subwords(data, np.array([0, len(data)]), self.bits)]
        bucket = np.concatenate([np.zeros(0, np.int64), *found])
        if not len(bucket):
            return
        at, count = np.unique(bucket, return_counts=True)
        share = (count / len(bucket)).astype(np.float32)
        mean = share @ self.embed[at]
        error = softmax(mean @ self.layer + self.bias)
        error[lang] -= 1
        step = self.rate * (1 - self.done / self.total) + self.rate / 100
        back = self.layer @ error
        self.layer -= step * np.outer(mean, error)
        self.bias -= 0.1 * step * error
        # A subword's share is small, so its embedding moves by the square root of it.
        self.embed[at] -= step * np.sqrt(share)[:, None] * back
        self.done += 1


def _calibrate(raw: np.ndarray, truth: np.ndarray, precision: float) -> tuple[float, float]:
    """(temperature with the least log loss, score below which to reject) on kept rows."""
    if not len(truth):
        return 1.0, 0.0
    rows, grid = np.arange(len(truth)), np.exp(np.linspace(-3, 3, 61))
    loss = [-np.log(np.maximum(softmax(raw / t)[rows, truth], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = softmax(raw / temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == truth
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= precision)
    return temperature, float(score[order[good[-1]]]) if len(good) else 1.0


def _dealt(marks: DataFrame, kept: Column, max_rows: int) -> DataFrame:
    """(_key, _turn): at most ``max_rows`` keys; ``_turn`` is 0 for the first of each language."""
    # Tasks drop all but the first rows of a language before they are shuffled, and each of the parts
    # into which a language is dealt drops all but its first.
    best = [kept, F.col("_u"), F.col("_key")]
    part = F.row_number().over(Window.partitionBy("_lang", F.pmod(F.xxhash64("_key"), F.lit(64))).orderBy(*best))
    parted = marks.withColumn("_part", part).where(F.col("_part") <= FLOOR).select(*marks.columns).distinct()
    place = F.row_number().over(Window.partitionBy("_lang").orderBy(*best))
    firsts = written(parted.withColumn("_place", place).where(F.col("_place") <= FLOOR), "language-firsts")
    one = firsts.where("_place = 1").select("_key", "_u", F.lit(0).alias("_turn"))
    few = firsts.orderBy("_place", "_u", "_key").limit(max_rows // 2).select("_key", "_u", F.lit(1).alias("_turn"))
    rest = early(marks.select("_key", "_u"), F.col("_u"), max_rows)
    rest = rest.orderBy("_u", "_key").limit(max_rows).select("_key", "_u", F.lit(2).alias("_turn"))
    turns = one.unionByName(few).unionByName(rest).groupBy("_key", "_u").agg(F.min("_turn").alias("_turn"))
    return written(turns.orderBy("_turn", "_u", "_key").limit(max_rows).select("_key", "_turn"), "language-keys")


def fit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    *,
    max_rows: int = 4000,
    epochs: int = 3,
    bits: int = 16,
    dim: int = 16,
    rate: float = 1.0,
    precision: float = 0.99,
    seed: int = 9,
) -> LanguageModel:
    """Train on at most ``max_rows`` rows with text and language; others take no part.

    The sample is taken on keys and languages alone: the first rows of each language that any row
    has, ``FLOOR`` if they fill at most half of the sample, then rows of all languages by chance.
    A language is left out only if there are more languages than ``max_rows``.  One task reads the
    texts once per epoch in a seeded order; the rows kept for calibration come last.  Without any
    row the model knows no language.
    """
    named = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    some = named.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    kept = F.pmod(F.xxhash64(F.lit(seed + 1), "_key"), F.lit(5)) == 0
    slim = some.select("_key", seeded(seed, F.col("_key")).alias("_u"), F.col("lang").alias("_lang"))
    marks = written(slim, "language-marks")  # texts are read for them once
    keys = _dealt(marks, kept, max_rows)
    kept = kept & (F.col("_turn") > 0)  # what a language has first is learnt from
    # One row of each key, so that the sample is bounded however often a key occurs.
    near = F.broadcast(keys.select(F.col("_key").alias("_chosen"), "_turn"))
    met = some.join(near, F.col("_key").eqNullSafe(F.col("_chosen"))).drop("_chosen")
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang")).alias("least")
    single = met.groupBy("_key", "_turn").agg(least).select("_key", "_turn", "least.text", "least.lang")
    sample = written(single, "language-sample")
    rows = (
        sample.withColumn("epoch", F.explode(F.when(kept, F.array(F.lit(epochs + 1))).otherwise(F.sequence(F.lit(1), F.lit(epochs)))))
        .withColumn("_u", F.xxhash64(F.lit(seed), "epoch", "_key"))
        .repartition(1)
        .sortWithinPartitions("epoch", "_u", "_key", "text", "lang")
        .select("text", "lang", "epoch")
    )
    langs = tuple(r[0] for r in sample.select("lang").distinct().orderBy("lang").collect())  # at most max_rows
    if not langs:
        return LanguageModel((), np.zeros((1 << bits, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(len(langs), bits, dim, rate, epochs * max_rows, seed)
        number = {name: k for k, name in enumerate(langs)}
        raw, truth, folded = [], [], None
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for k, (name, epoch) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                one = data[offsets[k] : offsets[k + 1]]
                if epoch <= epochs:
                    trainer.learn(one, number[name])
                    continue
                if folded is None:
                    folded = trainer.embed @ trainer.layer
                raw.append(logits(one, np.array([0, len(one)]), folded, trainer.bias)[0])
                truth.append(number[name])
        temperature, below = _calibrate(np.array(raw), np.array(truth, np.int64), precision)
        model = LanguageModel(langs, trainer.embed @ trainer.layer, trainer.bias, temperature, below)
        packed = pickle.dumps((model.table, model.bias, temperature, below))
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["model"])

    return LanguageModel(langs, *pickle.loads(rows.mapInArrow(train, "model binary").collect()[0][0]))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: remainder 0 of crc32 of the id as text, modulo 5."""
    return crc_remainder(doc_id, 5) == 0
