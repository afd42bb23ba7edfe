"""Exact top-k by inner product: Fagin's threshold algorithm over sorted lists per dimension.

Vectors are cut into blocks; a block keeps, for every dimension, its vectors sorted by that
component.  A query reads the lists side by side from their better ends, scores in full each vector
it meets for the first time, and stops as soon as the best score that an unmet vector could have,
the sum of the components just read times the query's, is below the kth best score so far.  That
score carries over from block to block of a task, so later blocks stop sooner.

Queries go to the blocks in batches of at most ``batch`` vectors, each a job of its own, so what is
broadcast is bounded whatever the table's size; vectors are never shuffled again.  Each task sends
at most k rows a query onward, and each batch's result is written before the next begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import written

#: Vectors of a block, list positions read between two looks at the bound, queries of a batch.
BLOCK, STEP, BATCH = 4096, 48, 8192


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null for vectors that take no part.

    Those are null vectors and ones that hold a null or non-finite component.
    """
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


class Block:
    """Vectors of equal length with their sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, times: np.ndarray):
        self.ids, self.vectors, self.times = ids, vectors, times
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)
        self.most = int(np.abs(vectors).max()) if vectors.size else 0
        self.cast: dict[type, np.ndarray] = {}

    def kind(self, query: np.ndarray) -> type:
        """The cheapest number type in which the scores are exact."""
        bound = self.most * int(np.abs(query).max(initial=0)) * max(len(query), 1)
        return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object

    def scores(self, at: np.ndarray, query: np.ndarray, kind: type) -> np.ndarray:
        if kind not in self.cast:
            self.cast[kind] = self.vectors.astype(kind)
        return (self.cast[kind][at] @ query.astype(kind)).astype(np.int64)

    def search(self, own: int, query: np.ndarray, times: int, best: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
        """The k best (-score, id) of ``best`` and this block, without the id ``own``.

        A vector counts as often as it occurs, times the occurrences of the query.
        """
        n, kind = len(self.ids), self.kind(query)
        used = np.flatnonzero(query)
        up, down = used[query[used] > 0], used[query[used] < 0]
        met = np.zeros(n, bool)
        for low in range(0, max(n, 1), STEP):
            high = min(low + STEP, n)
            new = np.zeros(n, bool)
            new[self.order[n - high : n - low, up]] = True
            new[self.order[low:high, down]] = True
            if not len(used):  # every score is 0: there is no list to read
                new[:] = True
            at = np.flatnonzero(new & ~met)
            met |= new
            if len(at):
                score = self.scores(at, query, kind)
                if len(best) >= k:
                    good = score >= -best[k - 1][0]
                    score, at = score[good], at[good]
                if len(score) > k:  # ties at the kth score stay in
                    good = score >= np.partition(score, -k - 1)[-k - 1]
                    score, at = score[good], at[good]
                lines = zip(score.tolist(), self.ids[at].tolist(), self.times[at].tolist())
                found = [(-s, i) for s, i, n in lines if i != own for _ in range(min(k, n * times))]
                best = sorted(best + found)[:k]
            if high >= n or met.all():
                break
            bound = int((self.sorted[n - high, up] * query[up]).sum() + (self.sorted[high - 1, down] * query[down]).sum())
            if len(best) >= k and bound < -best[k - 1][0]:  # an equal score could have a smaller id
                break
        return best


def _searched(vectors: DataFrame, queries: list, k: int) -> DataFrame:
    """The k best of each task's vectors for each query."""
    sent = vectors.sparkSession.sparkContext.broadcast([(q[0], np.array(q[1], np.int64), q[2]) for q in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {}
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                some = batch.slice(i, BLOCK)
                column = some.column(1)
                sizes = np.diff(np.asarray(column.offsets))
                flat = column.flatten().to_numpy(zero_copy_only=False)
                ids, times = (some.column(c).to_numpy(zero_copy_only=False) for c in (0, 2))
                ends = np.cumsum(sizes)
                for size in np.unique(sizes):
                    at = np.flatnonzero(sizes == size)
                    block = Block(ids[at], flat[(ends[at] - size)[:, None] + np.arange(size)], times[at])
                    for own, query, often in sent.value:
                        if len(query) == size:
                            best[own] = block.search(own, query, often, best.get(own, []), k)
        rows = [(own, i, -s) for own, found in best.items() for s, i in found]
        made = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in made], ["query_id", "vec_id", "score"])

    return vectors.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    batch: int = BATCH,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best others of each row for which ``is_query`` holds.

    ``is_query`` is a condition on the key.  Ties go to the smaller key.  Vectors meet those of
    equal length only.  Rows without a key take no part.  Every row is a candidate, for all queries
    but those of its own key: rows that share a key count one by one, and a key of several queries
    has the k best of all their pairs.  An empty table gives no rows.

    Components so large that a score could pass 64 bits raise a ValueError before the search.
    """
    spark = df.sparkSession
    numbers = df.select(F.col(key).cast("long").alias("id"), whole_numbers(F.col(vector), scale).alias("v"))
    # One shuffle evens out the blocks and makes equal rows one, with their number.
    counted = numbers.where("id is not null and v is not null").groupBy("id", "v").agg(F.count("*").alias("times"))
    vectors = written(counted, "topk-vectors")
    sizes = vectors.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))), F.max(F.size("v"))).first()
    if sizes[0] is not None and sizes[0] ** 2 * sizes[1] >= float(1 << 63):
        raise ValueError("the components are too large for scores of 64 bits")
    queries = vectors.withColumnRenamed("id", key).where(is_query).withColumnRenamed(key, "id")
    batches = -(-queries.count() // batch)
    path = shared_dir(spark, "topk-found")
    schema = "query_id long, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    for b in range(batches):
        chosen = queries.where(F.pmod(F.xxhash64("id", "v"), F.lit(batches)) == b).collect()  # about ``batch`` rows
        found = _searched(vectors, chosen, k).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
        found.select("query_id", "vec_id", "score").write.mode("append").parquet(path)
    # queries of one key may lie in different batches
    ranked = spark.read.schema(schema).parquet(path).withColumn("rank", F.row_number().over(first))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
