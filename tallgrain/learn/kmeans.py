"""k-means on scaled columns, for several numbers of clusters at once.

A step reads the points once and moves the centres of all clusterings together: each task sums its
points by clustering and nearest centre, and one small aggregation adds the sums up.  So the elbow
of nine clusterings costs as many reads as its slowest one alone.  Starts are seeded by hashes of a
key and the sums don't depend on how rows lie, so a run can be repeated.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import hash_number
from ..operators.ranks import present
from ..session import stored
from .scaler import ColumnScaler

# Centres count as settled once none moves further than this, in deviations.
SETTLED = 0.005
# Points of the sample in which starts are looked for, far from each other.
START_POINTS = 512
# Distances that one numpy step fills.
CELLS = 1 << 22


@dataclass
class Clustering:
    """Centres in scaled columns, in ascending order, and the sum of squared distances to them."""

    cols: list[str]
    scaler: ColumnScaler
    centres: np.ndarray
    cost: float

    def number(self) -> Column:
        """The nearest centre's number from 0, over the unscaled columns."""
        parts = []
        for centre in self.centres.tolist():
            terms = []
            for c, place in zip(self.cols, centre):
                mean, sd = self.scaler.stats[c]
                terms.append(f"pow((cast(`{c}` as double) - ({mean!r}D)) / ({sd or 1.0!r}D) - ({place!r}D), 2)")
            parts.append(F.expr(" + ".join(terms)))
        return _first_least(parts)


def _first_least(gaps: Sequence[Column]) -> Column:
    listed = F.array(*gaps)
    return (F.array_position(listed, F.array_min(listed)) - 1).cast("int")


def nearest(copied: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """Number of the nearest centre, from 0, as a plain expression."""
    return _first_least(
        [F.expr(" + ".join(f"pow({z} - ({float(c)!r}D), 2)" for z, c in zip(copied, centre))) for centre in centres]
    )


def _starts(points: DataFrame, rows: int, most: int) -> np.ndarray:
    """``most`` points of a seeded sample, each as far as possible from those before it."""
    share = (2 * START_POINTS + 64) / max(1, rows)  # so that tasks send only what may be chosen
    few = points.where(F.col("u") < int(share * 2**32)) if share < 1 else points
    found = few.orderBy("u", "key", "x").limit(START_POINTS).collect()
    if len(found) < min(START_POINTS, rows):  # many rows with one key
        found = points.orderBy("u", "key", "x").limit(START_POINTS).collect()
    if not found:
        return np.zeros((0, 0))
    x = np.array([r["x"] for r in found], float)
    chosen, gap = [0], ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < most:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def _sums(points: DataFrame, models: Mapping[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Per clustering the number of points of each centre, their sums and the sum of squared distances."""
    sizes = {k: len(c) for k, c in models.items()}
    starts = dict(zip(sizes, np.cumsum([0, *sizes.values()]).tolist()))
    every = np.concatenate(list(models.values()))
    dims = every.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(every), dims + 2))  # number, squared distances, sums
        step = max(1, CELLS // max(len(every), dims))
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims)
            for i in range(0, len(flat), step):
                x = flat[i : i + step]
                gaps = np.zeros((len(x), len(every)))
                for d in range(dims):
                    gaps += (x[:, d, None] - every[None, :, d]) ** 2
                for k, first in starts.items():
                    own = gaps[:, first : first + sizes[k]]
                    near = own.argmin(axis=1)
                    at = first + near
                    total[:, 0] += np.bincount(at, minlength=len(every))
                    total[:, 1] += np.bincount(at, own[np.arange(len(x)), near], len(every))
                    for d in range(dims):
                        total[:, d + 2] += np.bincount(at, x[:, d], len(every))
        place = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel())], ["place", "value"])

    added = points.select("x").mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros(len(every) * (dims + 2))
    for place, value in added.collect():  # a number per centre and dimension
        total[place] = value
    total = total.reshape(len(every), dims + 2)
    return {
        k: (total[a : a + sizes[k], 0], total[a : a + sizes[k], 2:], float(total[a : a + sizes[k], 1].sum()))
        for k, a in starts.items()
    }


def fit_kmeans(
    df: DataFrame,
    cols: Sequence[str],
    ks: Sequence[int],
    seed: int = 0,
    key: str | None = None,
    max_iter: int = 100,
    settled: float = SETTLED,
) -> dict[int, Clustering]:
    """Lloyd's steps for every number of clusters in ``ks``, together.

    Rows with a missing value take no part.  ``key`` is hashed to choose the starts; without one
    the values are.  A clustering stops when no centre moves further than ``settled``; a centre
    that loses all its points stays where it is.  With fewer rows than clusters some are empty.
    """
    if not ks or min(ks) < 1:
        raise ValueError("numbers of clusters must be at least 1")
    cols = list(cols)
    full = present(df, cols)
    scaler = ColumnScaler(cols).fit(full)
    scaled = [F.col(c) for c in cols]
    u = hash_number(seed, key, "kmeans") if key else F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 32))
    named = full.select(u.alias("u"), (F.col(key) if key else F.lit(0)).alias("key"), *cols)
    points = stored(scaler.transform(named).select("u", "key", F.array(*scaled).alias("x")), "kmeans-input")
    start = _starts(points, scaler.rows or 0, max(ks))
    if not len(start):
        return {k: Clustering(cols, scaler, np.zeros((0, len(cols))), 0.0) for k in ks}
    now = {k: start[:k] for k in sorted(set(ks))}
    moving = set(now)
    for _ in range(max_iter):
        for k, (n, sums, _cost) in _sums(points, {k: now[k] for k in sorted(moving)}).items():
            new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], now[k])
            if np.sqrt(((new - now[k]) ** 2).sum(axis=1)).max() <= settled:
                moving.discard(k)
            now[k] = new
        if not moving:
            break
    costs = _sums(points, now)
    return {k: Clustering(cols, scaler, np.array(sorted(now[k].tolist())), costs[k][2]) for k in now}


def kmeans(
    df: DataFrame, cols: Sequence[str], k: int, seed: int = 0, out: str = "cluster_pred", **how
) -> DataFrame:
    """Original rows with their cluster.  Clusters are numbered in the order of their centres."""
    return present(df, cols).withColumn(out, fit_kmeans(df, cols, [k], seed, **how)[k].number())


def kmeans_many(df: DataFrame, cols: Sequence[str], ks: Sequence[int], seed: int = 0, out: str = "cluster_", **how) -> DataFrame:
    """Original rows with their clusters for every number of them, in ``<out><k>``."""
    found = fit_kmeans(df, cols, ks, seed, **how)
    return present(df, cols).withColumns({f"{out}{k}": found[k].number() for k in ks})


def elbow(df: DataFrame, cols: Sequence[str], ks: Sequence[int] = range(1, 10), seed: int = 0, **how) -> DataFrame:
    """Within-cluster sum of squares per number of clusters."""
    found = fit_kmeans(df, cols, ks, seed, **how)
    rows = [(k, found[k].cost) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, wcss double")


def single_cluster_cost(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    full = present(df, cols)
    scaled = ColumnScaler(list(cols)).fit(full).transform(full)
    parts = sum((F.var_pop(c) * F.count(c) for c in cols), F.lit(0.0))
    return scaled.agg(parts.alias("wcss")).select(F.lit(1).alias("k"), "wcss")
