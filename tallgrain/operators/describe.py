"""Summaries of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import exact_quantiles, present, quantiles_wide, value_grid


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles and max; one row per group and column.

    The moments are aggregated side by side and only the few results are turned into rows.
    """
    by = list(by)
    df = present(df, by)
    keys = [*by, "column"]
    aggregates, lines = [], []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        parts = {
            "count": F.count(x),
            "mean": F.avg(x),
            "std": F.stddev_samp(x),
            "min": F.min(x),
            "max": F.max(x),
        }
        aggregates += [a.alias(f"_{k}{i}") for k, a in parts.items()]
        line = [F.col(f"_{k}{i}").alias(k) for k in parts]
        lines.append(F.struct(F.lit(c).alias("column"), *line))
    moments = df.groupBy(*by).agg(*aggregates).select(*by, F.inline(F.array(*lines)))
    places = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    quart = exact_quantiles(df, cols, list(places.values()), by).groupBy(*keys).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(k) for k, p in places.items()]
    )
    return moments.join(quart, keys, "left").select(
        *keys, "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def column_stats(df: DataFrame, col: str) -> DataFrame:
    """sum, min, max, non-null count, mean and exact median of one column."""
    return df.agg(
        F.sum(col).alias("sum"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
        F.count(col).alias("count"),
        F.avg(col).alias("mean"),
    ).withColumn("median", quantiles_wide(df, col, {"median": 0.5}).scalar())


def mean_median_by(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    means = df.groupBy(*by).agg(F.avg(value).alias("mean"))
    return means.join(quantiles_wide(df, value, {"median": 0.5}, by), list(by))


def mean_by(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Bar heights with a normal 95 % interval of the mean."""
    half = 1.959963984540054 * F.stddev_samp(value) / F.sqrt(F.count(value))
    return df.groupBy(*by).agg(
        F.avg(value).alias("mean"),
        (F.avg(value) - half).alias("ci_low"),
        (F.avg(value) + half).alias("ci_high"),
        F.count(value).alias("n"),
    )


def box_stats(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers at the last values within 1.5 IQR, and outliers beyond them."""
    by = list(by)
    df = present(df, [col, *by])
    grid = value_grid(df, [col], by)
    quart = quantiles_wide(df, col, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by, grid=grid)
    if by:
        joined = df.join(F.broadcast(quart) if grid.small() else quart, by)
    else:
        row = quart.first()
        joined = df.withColumns({c: F.lit(row[c]).cast("double") for c in quart.columns})
    joined = joined.withColumn("iqr", F.col("q3") - F.col("q1")).withColumns(
        {"_low": F.col("q1") - 1.5 * F.col("iqr"), "_high": F.col("q3") + 1.5 * F.col("iqr")}
    )
    inside = F.col(col).between(F.col("_low"), F.col("_high"))
    # the quartiles are constant per group: they ride along as keys of a pre-aggregated group
    return (
        joined.groupBy(*by, "q1", "median", "q3", "iqr")
        .agg(
            F.min(F.when(inside, F.col(col))).alias("whisker_low"),
            F.max(F.when(inside, F.col(col))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def collapse_by_key(
    df: DataFrame,
    key: str,
    mean: Sequence[str] = (),
    flags: Sequence[str] = (),
    lowest: Sequence[str] = (),
    first: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One row per key: means, flags by maximum, ``lowest`` by minimum, others from the first row.

    Only ``first`` needs a whole row to be kept per key; the rest is plain hash aggregation.
    """
    picked = []
    if first:
        picked = [F.min_by(F.struct(*first), F.struct(*(order_by or first))).alias("_first")]
    out = df.groupBy(key).agg(
        *[F.avg(c).alias(c) for c in mean],
        *[F.max(c).alias(c) for c in flags],
        *[F.min(c).alias(c) for c in lowest],
        *picked,
    )
    return out.select(key, *mean, *flags, *lowest, "_first.*") if first else out


def approx_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Approximate distinct count, filled rows, smallest and largest value per column."""
    stats = df.agg(
        *[F.approx_count_distinct(c).alias(f"{i}_d") for i, c in enumerate(cols)],
        *[F.count(c).alias(f"{i}_n") for i, c in enumerate(cols)],
        *[F.min(c).cast("string").alias(f"{i}_lo") for i, c in enumerate(cols)],
        *[F.max(c).cast("string").alias(f"{i}_hi") for i, c in enumerate(cols)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{i}_d").alias("approx_distinct"),
            F.col(f"{i}_n").alias("non_null"),
            F.col(f"{i}_lo").alias("smallest"),
            F.col(f"{i}_hi").alias("largest"),
        )
        for i, c in enumerate(cols)
    ]
    return stats.select(F.inline(F.array(*rows)))
