"""Counting, shares, cross-tabs and modes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(
    df: DataFrame, col: str, dropna: bool = True, by: str = "count", out: str = "count"
) -> DataFrame:
    """Rows per value, most frequent first, or in order of the value (``by='key'``)."""
    base = df.filter(F.col(col).isNotNull()) if dropna else df
    counted = base.groupBy(col).agg(F.count(F.lit(1)).alias(out))
    key = F.col(col).asc_nulls_last()
    return counted.orderBy(key) if by == "key" else counted.orderBy(F.col(out).desc(), key)


def value_counts_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Value counts of many columns, nulls included, in one aggregation."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in cols
        ]
    )
    return (
        df.select(F.inline(pairs))
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(F.col(col).asc_nulls_last())


def top_value(df: DataFrame, col: str) -> DataFrame:
    """The most frequent value; of equally frequent ones the smallest."""
    return value_counts(df, col).limit(1)


def repeated_values(df: DataFrame, col: str, more_than: int = 1) -> DataFrame:
    return value_counts(df, col).filter(F.col("count") > more_than)


def top_in_group(df: DataFrame, group: str, col: str) -> DataFrame:
    """Per group the most frequent inner value (ties: the smallest)."""
    counted = df.dropna(subset=[group, col]).groupBy(group, col).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("neg"), F.col(col).alias("value")))
    return (
        counted.groupBy(group)
        .agg(best.alias("_best"))
        .select(group, F.col("_best.value").alias(col), (-F.col("_best.neg")).alias("count"))
    )


def share_by(df: DataFrame, cond: Column, keys: Sequence[str], out: str = "share") -> DataFrame:
    """Share of the rows meeting a condition, per key, in one pass."""
    hit = F.when(cond, 1.0).otherwise(0.0)
    return df.groupBy(*keys).agg(F.avg(hit).alias(out), F.count(F.lit(1)).alias("n"))


def argmax(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """The row of keys with the largest value (ties: the smallest keys)."""
    best = F.min(F.struct((-F.col(value)).alias("neg"), *keys))
    return df.filter(F.col(value).isNotNull()).agg(best.alias("_b")).select(
        *[F.col(f"_b.{k}") for k in keys], (-F.col("_b.neg")).alias(value)
    )


def idx_extremes(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys of the largest and the smallest value (ties: the smallest key)."""
    some = df.filter(F.col(value).isNotNull())
    return some.agg(
        F.min(F.struct((-F.col(value)).alias("v"), F.col(key).alias("k")))["k"].alias("idxmax"),
        F.min(F.struct(F.col(value).alias("v"), F.col(key).alias("k")))["k"].alias("idxmin"),
    )


def crosstab(df: DataFrame, a: str, b: str, levels: Sequence) -> DataFrame:
    """Counts of ``a`` by given levels of ``b``; absent combinations are 0."""
    return (
        df.groupBy(a)
        .agg(*[F.count_if(F.col(b) == v).alias(str(v)) for v in levels])
    )


def n_unique(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct values per column.

    The exact counts come from one long table of (column, value): several distinct
    counts in one aggregation would copy every row once per column.
    """
    if approx:
        return df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
    seen = value_counts_all(df, cols).filter(F.col("value").isNotNull())
    return seen.agg(*[F.count_if(F.col("column_name") == c).alias(c) for c in cols])


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Most frequent non-null value per column; all columns in one job.

    Counting happens per (column, value), so no task holds the value map of a column.
    Ties go to the smallest value: by number for numeric columns, else by text.
    """
    if not cols:
        return {}
    kinds = dict(df.dtypes)
    texty = {c for c in cols if kinds[c] in ("string", "boolean", "date")}
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("c"),
                F.col(c).cast("string").alias("v"),
                (F.lit(None) if c in texty else F.col(c)).cast("double").alias("num"),
            )
            for c in cols
        ]
    )
    counted = (
        df.select(F.inline(pairs))
        .filter(F.col("v").isNotNull())
        .groupBy("c", "v")
        .agg(F.count(F.lit(1)).alias("n"), F.first("num").alias("num"))
    )
    best = F.min(F.struct((-F.col("n")).alias("neg"), "num", "v"))
    found = {r["c"]: r["b"]["v"] for r in counted.groupBy("c").agg(best.alias("b")).collect()}
    out: dict[str, object] = {}
    for c in cols:
        text = found.get(c)
        if text is None:
            out[c] = None
        elif kinds[c] in ("int", "bigint", "smallint", "tinyint"):
            out[c] = int(text)
        elif kinds[c] in ("double", "float"):
            out[c] = float(text)
        elif kinds[c] == "boolean":
            out[c] = text == "true"
        else:
            out[c] = text
    return out


def rounded_mean(c, digits: int = 2, per: int = 1) -> Column:
    """Mean rounded half up, worked out in decimals: sums of doubles would decide ties at random."""
    c = F.col(c) if isinstance(c, str) else c
    exact = F.try_divide(F.sum(c.cast("decimal(20,4)")), F.count(c) * per)
    return F.round(exact, digits).cast("double")


def count_by(df: DataFrame, keys: Sequence[str], out: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def having_more(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], more_than: int):
    """Groups of more than so many rows with their aggregates."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_rows"), *[a.alias(k) for k, a in aggs.items()])
    return out.filter(F.col("num_rows") > more_than)
