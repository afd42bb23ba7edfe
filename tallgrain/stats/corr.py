"""Correlations of many variables with many measures, per group, in one plan.

Every column is ranked once: one table of ties holds all columns, the ranks go back to the rows as
one join, and one aggregation sums the products of all pairs.  What is shuffled grows with the
number of columns, not with the number of pairs, and the number of exchanges with neither.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import lookup_join, present, tie_table, value_grid
from ..session import stored
from .moments import pearson, with_corr_p
from .ranktests import spearman


def rank_matrix(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """(group, _n, c0, c1, ...): per distinct row its number and each column's rank inside the group.

    Ranks are given as their distance from the middle rank.  Rows must have all values.
    """
    names = [f"c{i}" for i in range(len(cols))]
    doubles = df.select(F.col(group).alias("_group"), *[F.col(c).cast("double").alias(n) for c, n in zip(cols, names)])
    counted = doubles.groupBy("_group", *names).agg(F.count(F.lit(1)).alias("_n"))
    # written, so that a row keeps its number whenever a task runs again
    rows = stored(counted.withColumn("_id", F.monotonically_increasing_id()), "corr-rows")
    cells = F.array(*[F.struct(F.lit(i).alias("_column"), F.col(n).alias("_value")) for i, n in enumerate(names)])
    long = rows.select("_id", "_group", "_n", F.inline(cells))
    keys = ["_group", "_column"]
    grid = value_grid(long, ["_value"], keys)
    ties = tie_table(long, "_value", keys, weights={"lines": F.count(F.lit(1))}, grid=grid, rows="_n")
    off = (F.col("rank") - (F.col("total") + 1) / 2).alias("_off")
    ranked = lookup_join(long, ties.select(*keys, "_value", "lines", off), [*keys, "_value"], "_value", "lines", grid)
    back = [F.max(F.when(F.col("_column") == i, F.col("_off"))).alias(n) for i, n in enumerate(names)]
    return ranked.groupBy("_id", F.col("_group").alias(group), "_n").agg(*back).drop("_id")


def _pairs(sums: DataFrame, group: str, lines: Sequence[Column]) -> DataFrame:
    return sums.select(group, F.inline(F.array(*lines)))


def corr_matrix(
    df: DataFrame,
    group: str,
    variables: Sequence[str],
    measures: Sequence[str],
    dichotomous: Iterable[str] = (),
    normal: Iterable[tuple] = (),
    p_value: bool = True,
) -> DataFrame:
    """One row per group, variable and measure.

    Two-valued variables use Pearson where the measure is normal in the group (listed in
    ``normal`` as (group, measure)); everything else uses Spearman.  A pair is correlated over the
    rows that have both values; only pairs with a column that lacks some are ranked on their own.
    """
    dichotomous, normal = set(dichotomous), list(normal)
    cols = list(dict.fromkeys([*variables, *measures]))
    df = present(df, [group]).select(group, *cols)
    gaps = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(f"g{i}") for i, c in enumerate(cols)]).first()
    whole = [c for i, c in enumerate(cols) if not gaps[i]]
    number = {c: f"c{i}" for i, c in enumerate(whole)}
    pairs = [(v, m) for v in variables for m in measures]
    full = [(v, m) for v, m in pairs if v in number and m in number]
    rest = [(v, m) for v, m in pairs if (v, m) not in full]
    parts = []
    if full:
        n, used = F.col("_n"), sorted({x for pair in full for x in pair}, key=cols.index)
        squares = [F.sum(n * F.col(number[c]) ** 2).alias(f"s{number[c]}") for c in used]
        products = [F.sum(n * F.col(number[v]) * F.col(number[m])).alias(f"p{i}") for i, (v, m) in enumerate(full)]
        sums = rank_matrix(df, group, whole).groupBy(group).agg(F.sum(n).alias("n"), *squares, *products)
        lines = [
            F.struct(
                F.lit(v).alias("variable"),
                F.lit(m).alias("measure"),
                F.col("n"),
                F.try_divide(F.col(f"p{i}"), F.sqrt(F.col(f"s{number[v]}") * F.col(f"s{number[m]}"))).alias("r"),
            )
            for i, (v, m) in enumerate(full)
        ]
        parts.append(_pairs(sums, group, lines))
    for v, m in rest:
        alone = spearman(df.select(group, F.col(v).alias("_a"), F.col(m).alias("_b")), "_a", "_b", [group], p_value=False)
        parts.append(alone.select(group, F.lit(v).alias("variable"), F.lit(m).alias("measure"), "n", "r"))
    spread = parts[0]
    for part in parts[1:]:
        spread = spread.unionByName(part)
    linear = [(g, v, m) for v in variables if v in dichotomous for g, m in normal if m in measures]
    both = spread.withColumn("method", F.lit("Spearman"))
    if linear:
        is_linear = F.lit(False)
        for g, v, m in linear:
            is_linear = is_linear | ((F.col(group) == g) & (F.col("variable") == v) & (F.col("measure") == m))
        cells = [
            F.struct(F.lit(v).alias("variable"), F.lit(m).alias("measure"), F.col(v).cast("double").alias("x"), F.col(m).cast("double").alias("y"))
            for v, m in dict.fromkeys((v, m) for _, v, m in linear)
        ]
        some = df.where(F.col(group).isin([g for g, _, _ in linear])).select(group, F.inline(F.array(*cells))).where(is_linear)
        direct = pearson(some, "x", "y", [group, "variable", "measure"], p_value=False)
        both = both.where(~is_linear).unionByName(direct.withColumn("method", F.lit("Pearson")))
    return with_corr_p(both) if p_value else both


def corr_summary(matrix: DataFrame, alpha: float = 0.05) -> DataFrame:
    """The matrix with a sentence on significance."""
    p = F.col("p_value")
    text = (
        F.when(p.isNull() | F.isnan(p), "not computable")
        .when(p < alpha, f"significant (p < {alpha})")
        .otherwise(f"not significant (p >= {alpha})")
    )
    return matrix.withColumn("interpretation", text)
