"""What the operators of this package share: written intermediates and text as byte arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

# Odd multipliers of the 64-bit hashes; any odd numbers would do.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)

#: Bytes of text that one numpy step takes at most; a longer document is one step of its own.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the cluster's shared folder and read back.

    Cuts the lineage in a way that survives a lost executor.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def seeded(seed: int, *cols: Column) -> Column:
    """A uniform number in [0, 1) from a seed and key columns; the same on every run."""
    top = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11)
    return top.cast("double") / F.lit(float(1 << 53))


def crc_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def early(marks: DataFrame, u: Column, max_rows: int) -> DataFrame:
    """Different rows of a slim table with small ``u``, the ``max_rows`` smallest among them.

    Rows above a threshold, set from the number of all rows, are dropped where they are read, so that
    tasks don't send ``max_rows`` each to the one that ends the choice.  Where many rows are equal the
    threshold may leave too few; then all are looked at.
    """
    below = (2 * max_rows + 64) / max(1, marks.count())
    few = marks.where(u < below).distinct()
    return few if below >= 1 or few.limit(max_rows).count() == max_rows else marks.distinct()


def sampled(marks: DataFrame, key: str, max_rows: int, seed: int) -> DataFrame:
    """At most ``max_rows`` different rows of a slim table, chosen by a seeded hash of the key."""
    u = seeded(seed, F.col(key))
    return early(marks, u, max_rows).orderBy(u, *sorted(marks.columns)).limit(max_rows)


def one_text(rows: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """(keys, text): of rows with equal keys the one whose text has the least hash."""
    least = F.min(F.struct(F.xxhash64(text).alias("h"), F.col(text).alias("t"))).alias("least")
    return rows.groupBy(*keys).agg(least).select(*keys, F.col("least.t").alias(text))


def sampled_texts(docs: DataFrame, marks: DataFrame, key: str, max_rows: int, seed: int) -> DataFrame:
    """(key, marks, text) of at most ``max_rows`` rows: a sample of ``marks``, each with one text of its key.

    Only keys and marks move before the choice.
    """
    chosen = docs.select(key, "text").join(F.broadcast(sampled(marks, key, max_rows, seed)), key)
    return one_text(chosen, marks.columns, "text")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets) of an Arrow string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of at most ``limit`` bytes, or one document each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(33))) * _MIX1
    h = (h ^ (h >> np.uint64(29))) * _MIX2
    return h ^ (h >> np.uint64(32))


class Hasher:
    """Hashes of any substring of a byte array, from prefix sums modulo 2^64.

    Each byte stands for a random 64-bit number, so a substring's hash is a polynomial over
    them; multiplying by the inverse power makes it independent of the place.
    """

    def __init__(self, seed: int = 1):
        self.letters = mixed((np.arange(256, dtype=np.uint64) + np.uint64(seed)) * _BASE)
        self.inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        self.power = self.back = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 2 * len(self.power))
            for name, base in (("power", _BASE), ("back", self.inverse)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.power[: len(data)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of [start, end); the length takes part."""
        h = (prefix[end] - prefix[start]) * self.back[start]
        return mixed(h + (end - start).astype(np.uint64) * _MIX1)

    def windows(self, prefix: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all substrings of ``width`` bytes."""
        n = len(prefix) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = (prefix[width:] - prefix[:n]) * self.back[:n]
        return mixed(h + np.array(width, np.uint64) * _MIX1)
