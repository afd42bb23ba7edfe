"""Joins, key tests and grids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keyless(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> DataFrame:
    """Keys holding at least ``share`` of the rows with a key: at most ``1 / share`` of them."""
    counted = df.filter(~_keyless(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counted.agg(F.sum("_n"))
    return counted.filter(F.col("_n") >= total.scalar() * share).select(*keys)


def spread_join(facts: DataFrame, dims: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Inner or left join of facts to a smaller table, safe for any spread of keys.

    One read of each side.  The facts of a hot key are split between tasks by adaptive execution
    (``session.tune``), which repeats the key's few lines of ``dims`` for each piece; a side whose
    measured size is small is broadcast.  Rows without a key match nothing: an inner join drops
    them before the shuffle, a left join spreads them by a hash of the row.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    on = list(on)
    keyed = dims.filter(~_keyless(on))
    if how == "inner":
        return facts.filter(~_keyless(on)).join(keyed, on)
    # keyless rows get a number of their own to be dealt by; dims have none that is not null
    spread = F.when(_keyless(on), F.xxhash64(*facts.columns)).otherwise(F.lit(0))
    dealt = facts.withColumn("_spread", spread).join(keyed.withColumn("_spread", F.lit(0).cast("long")), [*on, "_spread"], how)
    return dealt.drop("_spread")


def aligned_ratio(num: DataFrame, den: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Divide two keyed columns; a key missing on one side, or a zero below, gives null."""
    a = num.select(*keys, F.col(value).alias("_num"))
    b = den.select(*keys, F.col(value).alias("_den"))
    return a.join(b, list(keys), "full_outer").select(*keys, F.try_divide("_num", "_den").alias("ratio"))


def scenario_grid(df: DataFrame, **lists: Sequence) -> DataFrame:
    """Every row with every combination of a few short lists of values.

    The lists are exploded row by row: no join and no shuffle.
    """
    for name, values in lists.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row count.

    Children are counted per key first, so a hot key is one row in the join; a null key
    satisfies the constraint.
    """
    counted = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(child_key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return counted.join(parent, counted[child_key] == parent[parent_key], "left_anti")


def cascade_delete(child: DataFrame, deleted: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children that remain once the given parents are deleted."""
    return child.join(deleted, child[child_key] == deleted[parent_key], "left_anti")

