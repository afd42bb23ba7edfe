"""Train and test rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.text import hash_number


def split(df: DataFrame, frac: float, seed: int, key: str) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that together are everything.

    A row's side depends on its key and the seed alone, so it survives repartitioning and
    lost executors; the sizes are close to the fraction but not exact.
    """
    side = hash_number(seed, key, "split") < int(frac * 2**32)
    return df.filter(side), df.filter(~side)
