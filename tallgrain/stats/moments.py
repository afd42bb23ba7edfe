"""Tests and effect sizes that need only counts, means and variances: one pass each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pvalues as P
from ..operators.ranks import ValueGrid, present, quantiles_wide, value_grid


def _grouped(df: DataFrame, by: Sequence[str]):
    return present(df, by).groupBy(*by)


def side_by_side(by: Sequence[str], *tables: DataFrame) -> DataFrame:
    """Tables of one row per group and different numeric columns as one such table."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    names = [c for c in stacked.columns if c not in by]
    return stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in names])


def skewness(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Biased (population) skewness, one column per input column."""
    return _grouped(df, by).agg(*[F.skewness(c).alias(c) for c in cols])


def ttest_rel(
    df: DataFrame,
    after: str,
    before: str,
    by: Sequence[str] = (),
    alternative: str = "greater",
    p_value: bool = True,
) -> DataFrame:
    """Paired t-test with Cohen's d of the differences."""
    pairs = present(df, [after, before]).withColumn("_d", F.col(after) - F.col(before))
    out = _grouped(pairs, by).agg(
        F.count("_d").alias("n"), F.avg("_d").alias("mean_diff"), F.stddev_samp("_d").alias("sd_diff")
    )
    out = out.withColumn("cohen_d", F.try_divide("mean_diff", "sd_diff"))
    out = out.withColumn("t", F.col("cohen_d") * F.sqrt("n"))
    return out.withColumn("p_value", P.t_tail(F.col("t"), F.col("n") - 1, alternative)) if p_value else out


def two_groups(df: DataFrame, value: str, group: str, a, b, by: Sequence[str] = ()) -> DataFrame:
    """n, mean and variance of two groups side by side."""
    some = df.filter(F.col(group).isin(a, b) & F.col(value).isNotNull())
    sides = []
    for tag, name in (("a", a), ("b", b)):
        x = F.when(F.col(group) == name, F.col(value))
        sides += [
            F.count(x).alias(f"n_{tag}"),
            F.avg(x).alias(f"mean_{tag}"),
            F.var_samp(x).alias(f"var_{tag}"),
        ]
    return _grouped(some, by).agg(*sides)


def ttest_ind(
    df: DataFrame, value: str, group: str, a, b, by: Sequence[str] = (), p_value: bool = True
) -> DataFrame:
    """Independent t-test with equal variances, pooled Cohen's d and its size in words."""
    out = two_groups(df, value, group, a, b, by)
    dof = F.col("n_a") + F.col("n_b") - 2
    squares = (F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")
    pooled = F.sqrt(F.try_divide(squares, dof))
    diff = F.col("mean_a") - F.col("mean_b")
    one = F.lit(1.0)
    scale = F.sqrt(F.try_divide(one, F.col("n_a")) + F.try_divide(one, F.col("n_b")))
    out = out.withColumns(
        {
            "dof": dof,
            "cohen_d": F.try_divide(diff, pooled),
            "t": F.try_divide(diff, pooled * scale),
        }
    ).withColumn("effect", effect_size_label("cohen_d"))
    return out.withColumn("p_value", P.t_tail(F.col("t"), F.col("dof"))) if p_value else out


def effect_size_label(d: str):
    """negligible below 0.2, small below 0.5, medium below 0.8, else large."""
    size = F.abs(F.col(d))
    return (
        F.when(size < 0.2, "negligible")
        .when(size < 0.5, "small")
        .when(size < 0.8, "medium")
        .when(size.isNotNull(), "large")
    )


def levene(
    df: DataFrame,
    value: str,
    group: str,
    by: Sequence[str] = (),
    p_value: bool = True,
    grid: ValueGrid | None = None,
) -> DataFrame:
    """Equality of variances, centred at the exact group medians."""
    keys = [*by, group]
    some = present(df, [value, *keys]).select(*keys, value)
    grid = grid or value_grid(some, [value], keys)
    medians = quantiles_wide(some, value, {"_med": 0.5}, keys, grid=grid)
    near = F.broadcast(medians) if grid.small() else medians
    spread = some.join(near, keys).withColumn("_z", F.abs(F.col(value) - F.col("_med")))
    per_group = spread.groupBy(*keys).agg(
        F.count("_z").alias("n"), F.avg("_z").alias("m"), F.var_pop("_z").alias("v")
    )
    grand = per_group.groupBy(*by).agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"))
    joined = per_group.join(grand, list(by)) if by else per_group.withColumn("grand", grand.scalar())
    sums = joined.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("n_groups"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
        F.sum(F.col("n") * (F.col("m") - F.col("grand")) ** 2).alias("between"),
    )
    out = sums.select(
        *by,
        "n",
        "n_groups",
        F.try_divide(
            (F.col("n") - F.col("n_groups")) * F.col("between"), (F.col("n_groups") - 1) * F.col("within")
        ).alias("w"),
    )
    tail = P.f_tail(F.col("w"), F.col("n_groups") - 1, F.col("n") - F.col("n_groups"))
    return out.withColumn("p_value", tail) if p_value else out


def levene_columns(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), **how) -> DataFrame:
    """The same between columns instead of groups."""
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    return levene(doubles.unpivot(list(by), list(cols), "_col", "_v"), "_v", "_col", by, **how)


def linear_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Regression line per group."""
    return _grouped(present(df, [x, y]), by).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
        F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept"),
        F.regr_r2(F.col(y).cast("double"), F.col(x).cast("double")).alias("r2"),
    )


def with_corr_p(df: DataFrame, r: str = "r", n: str = "n") -> DataFrame:
    """p-value of a correlation from n - 2 degrees of freedom."""
    rr = F.col(r) * F.col(r)
    t = F.when(
        (F.col(n) > 2) & (rr < 1), F.col(r) * F.sqrt((F.col(n) - 2) / F.nullif(1 - rr, F.lit(0.0)))
    )
    p = P.t_tail(t, F.col(n) - 2)
    exact = F.when((F.col(n) > 2) & (rr >= 1), F.lit(0.0))
    return df.withColumn("p_value", F.coalesce(exact, p))


def pearson(df: DataFrame, x: str, y: str, by: Sequence[str] = (), p_value: bool = True) -> DataFrame:
    out = _grouped(present(df, [x, y]), by).agg(
        F.count(F.lit(1)).alias("n"), F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("r")
    )
    return with_corr_p(out) if p_value else out
