"""Tests on ranks and cumulative counts.

All of them read the tie table of ``operators.ranks``: one line per distinct value with its
counts and running totals.  No group is ever sorted as a whole.

Where many tests run on the same columns, a ``grid`` made once can be handed to all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pvalues as P
from ..operators.ranks import (
    ValueGrid,
    lookup_join,
    present,
    quantiles_wide,
    tie_table,
    value_grid,
)
from .moments import side_by_side, with_corr_p

# Places one line of the normality test sums at most; longer runs of ties are split.
PLACES_PER_LINE = 100_000


def _ties(n: str = "n") -> Column:
    """Sum of t^3 - t over the tied values, whatever the lines are split by."""
    t = F.col("tie").cast("double")
    return F.sum(F.col(n) * (t * t - 1)).alias("ties")


def wilcoxon(
    df: DataFrame, col: str, by: Sequence[str] = (), transform: str | None = None, p_value: bool = True
) -> DataFrame:
    """Signed-rank test that the values lie above zero, with effect size r.

    ``transform='log'`` tests the logarithm; values without one are dropped and counted.
    Zeros are dropped from the ranks, but r is scaled by all rows, zeros included.
    """
    by = list(by)
    some = present(df, [col, *by])
    size, positive = signed_size(F.col(col).cast("double"), transform)
    sized = some.select(*by, size.alias("_size"), positive.alias("_positive"))
    table = tie_table(sized, "_size", by, weights={"positive": F.count_if("_positive")})
    return signed_rank_of(table, by, p_value)


def signed_size(x: Column, transform: str | None = None) -> tuple[Column, Column]:
    """(size, positive) of the values of a signed-rank test; a value without a logarithm has size -1."""
    if transform == "log":
        x = F.when(x > 0, F.log(x))
    return F.coalesce(F.abs(x), F.lit(-1.0)), F.coalesce(x > 0, F.lit(False))


def signed_rank_of(table: DataFrame, by: Sequence[str], p_value: bool = True) -> DataFrame:
    """The signed-rank test of each group from its ties of ``_size`` (n, tie, rank, positive).

    What was dropped and what is zero come first in the order, so their number is what ranks are
    too large by.
    """
    by = list(by)
    size, t = F.col("_size"), F.col("tie").cast("double")
    sums = table.groupBy(*by).agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(size < 0, F.col("n"))), F.lit(0)).alias("n_dropped"),
        F.coalesce(F.sum(F.when(size == 0, F.col("n"))), F.lit(0)).alias("n_zero"),
        F.coalesce(F.sum(F.when(size > 0, F.col("n"))), F.lit(0)).alias("n_used"),
        F.sum(F.when(size > 0, F.col("positive") * F.col("rank"))).alias("_w"),
        F.sum(F.when(size > 0, F.col("positive"))).alias("_p"),
        F.sum(F.when(size > 0, F.col("n") * (t * t - 1))).alias("ties"),
    )
    w = F.col("_w") - F.col("_p") * (F.col("n_dropped") + F.col("n_zero"))
    out = sums.select(*by, "n_rows", "n_dropped", "n_zero", "n_used", w.alias("w"), "ties")
    n = F.col("n_rows").cast("double")
    z = (F.col("w") - n * (n + 1) / 4) / F.sqrt(n * (n + 1) * (2 * n + 1) / 24)
    out = out.withColumn("effect_r", z / F.sqrt(n))
    if p_value:
        tail = P.signed_rank_tail(
            F.col("w"), F.col("n_used").cast("double"), F.col("ties"), F.col("n_zero").cast("double")
        )
        out = out.withColumn("p_value", tail)
    return out


def mannwhitney(
    df: DataFrame, value: str, group: str, a, b, by: Sequence[str] = (), p_value: bool = True,
    grid: ValueGrid | None = None,
) -> DataFrame:
    """U of group ``a`` against ``b``, two-sided."""
    some = df.filter(F.col(group).isin(a, b))
    table = tie_table(
        some,
        value,
        by,
        weights={"in_a": F.count_if(F.col(group) == a), "in_b": F.count_if(F.col(group) == b)},
        grid=grid,
    )
    sums = table.groupBy(*by).agg(
        F.sum("in_a").alias("n_a"),
        F.sum("in_b").alias("n_b"),
        F.sum(F.col("in_a") * (F.col("in_b_before") + F.col("in_b") / 2)).alias("u"),
        _ties(),
    )
    if not p_value:
        return sums
    tail = P.rank_sum_tail(F.col("u"), F.col("n_a"), F.col("n_b"), F.col("ties"))
    return sums.withColumn("p_value", tail)


def kruskal(
    df: DataFrame, value: str, group: str, by: Sequence[str] = (), p_value: bool = True,
    grid: ValueGrid | None = None,
) -> DataFrame:
    """Kruskal-Wallis H over all groups, corrected for ties."""
    by = list(by)
    table = tie_table(present(df, [group]), value, by, split=[group], grid=grid)
    # deviations from the middle rank, so that large samples keep their precision
    off = F.col("rank") - (F.col("total") + 1) / 2
    per_group = table.groupBy(*by, group).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * off).alias("off"),
        _ties(),
    )
    sums = per_group.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("n_groups"),
        F.sum(F.col("off") * F.col("off") / F.col("n")).alias("s"),
        F.sum("ties").alias("ties"),
    )
    n = F.col("n").cast("double")
    # all values equal, or a single one: no spread of ranks and no statistic
    spread = 1 - F.try_divide(F.col("ties"), n * n * n - n)
    h = F.try_divide(12 / (n * (n + 1)) * F.col("s"), spread)
    out = sums.select(*by, "n", "n_groups", h.alias("h"))
    return out.withColumn("p_value", P.chi2_tail(F.col("h"), F.col("n_groups") - 1)) if p_value else out


def ks_2samp(
    df: DataFrame, value: str, group: str, a, b, by: Sequence[str] = (), p_value: bool = True,
    grid: ValueGrid | None = None,
) -> DataFrame:
    """Largest distance of two empirical distributions."""
    some = df.filter(F.col(group).isin(a, b))
    table = tie_table(
        some,
        value,
        by,
        weights={"in_a": F.count_if(F.col(group) == a), "in_b": F.count_if(F.col(group) == b)},
        grid=grid,
    )
    # a side without rows gives no distance
    share_a = F.try_divide(F.col("in_a_before") + F.col("in_a"), F.col("in_a_total"))
    share_b = F.try_divide(F.col("in_b_before") + F.col("in_b"), F.col("in_b_total"))
    out = table.groupBy(*by).agg(
        F.sum("in_a").alias("n_a"), F.sum("in_b").alias("n_b"), F.max(F.abs(share_a - share_b)).alias("d")
    )
    return out.withColumn("p_value", P.ks_tail(F.col("d"), F.col("n_a"), F.col("n_b"))) if p_value else out


def ks_columns(df: DataFrame, first: str, second: str, by: Sequence[str] = (), **how) -> DataFrame:
    """The same between two columns of one table."""
    doubles = df.select(*by, F.col(first).cast("double").alias(first), F.col(second).cast("double").alias(second))
    long = doubles.unpivot(list(by), [first, second], "_col", "_v")
    return ks_2samp(long, "_v", "_col", first, second, by, **how)


def median_table(
    df: DataFrame, value: str, group: str, a, b, by: Sequence[str] = (), grid: ValueGrid | None = None
) -> DataFrame:
    """Counts above and below the common exact median; values equal to it are left out."""
    by = list(by)
    some = present(df.filter(F.col(group).isin(a, b)), [value, *by]).select(*by, group, value)
    grid = grid or value_grid(some, [value], by)
    middle = quantiles_wide(some, value, {"median": 0.5}, by, grid=grid)
    if by:
        both = some.join(F.broadcast(middle) if grid.small() else middle, by)
    else:
        both = some.withColumn("median", middle.scalar())
    v, m = F.col(value), F.col("median")
    return both.groupBy(*by, "median").agg(
        F.count_if((F.col(group) == a) & (v > m)).alias("above_a"),
        F.count_if((F.col(group) == b) & (v > m)).alias("above_b"),
        F.count_if((F.col(group) == a) & (v < m)).alias("below_a"),
        F.count_if((F.col(group) == b) & (v < m)).alias("below_b"),
    )


def fisher_exact(table: DataFrame, p_value: bool = True) -> DataFrame:
    """Odds ratio of a 2x2 table of counts and the exact one-sided (greater) p-value."""
    num = F.col("above_a").cast("double") * F.col("below_b")
    den = F.col("below_a").cast("double") * F.col("above_b")
    odds = F.when(den != 0, num / F.nullif(den, F.lit(0.0))).when(num > 0, F.lit(float("inf")))
    out = table.withColumn("odds_ratio", odds)
    if not p_value:
        return out
    above = F.col("above_a") + F.col("above_b")
    total = above + F.col("below_a") + F.col("below_b")
    drawn = F.col("above_a") + F.col("below_a")
    return out.withColumn("p_value", P.hypergeom_tail(F.col("above_a"), total, above, drawn))


def mood_p(table: DataFrame) -> DataFrame:
    """Chi-square test of the median table with continuity correction."""
    a, b, c, d = (F.col(k).cast("double") for k in ("above_a", "above_b", "below_a", "below_b"))
    n = a + b + c + d
    gap = F.greatest(F.abs(a * d - b * c) - n / 2, F.lit(0.0))
    margins = F.nullif((a + b) * (c + d) * (a + c) * (b + d), F.lit(0.0))
    out = table.withColumn("chi2", n * gap * gap / margins)
    return out.withColumn("p_value", P.chi2_tail(F.col("chi2"), F.lit(1.0)))


def spearman(
    df: DataFrame, x: str, y: str, by: Sequence[str] = (), p_value: bool = True,
    grid: ValueGrid | None = None,
) -> DataFrame:
    """Rank correlation per group; groups of one row give no coefficient.

    Equal pairs are counted first.  The ranks of x and y come from their tie tables and the
    correlation is a weighted sum over the distinct pairs.
    """
    by = list(by)
    some = present(df, [x, y, *by]).select(
        *by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")
    )
    grid = grid.renamed(_x=x, _y=y) if grid else value_grid(some, ["_x", "_y"], by)
    pairs = some.groupBy(*by, "_x", "_y").agg(F.count(F.lit(1)).alias("_n"))
    ranked = pairs
    for c in ("_x", "_y"):
        # lines = distinct pairs holding the value
        table = tie_table(
            pairs, c, by, weights={"lines": F.count(F.lit(1))}, grid=grid, rows="_n"
        ).select(
            *by,
            c,
            "lines",
            (F.col("rank") - (F.col("total") + 1) / 2).alias(f"{c}_off"),
        )
        ranked = lookup_join(ranked, table, [*by, c], c, "lines", grid).drop("lines")
    n, a, b = F.col("_n"), F.col("_x_off"), F.col("_y_off")
    sums = ranked.groupBy(*by).agg(
        F.sum("_n").alias("n"),
        F.sum(n * a * b).alias("_ab"),
        F.sum(n * a * a).alias("_aa"),
        F.sum(n * b * b).alias("_bb"),
    )
    rho = F.try_divide(F.col("_ab"), F.sqrt(F.col("_aa") * F.col("_bb")))
    out = sums.select(*by, "n", rho.alias("r"))
    return with_corr_p(out) if p_value else out


def shapiro(
    df: DataFrame, col: str, by: Sequence[str] = (), p_value: bool = True, grid: ValueGrid | None = None
) -> DataFrame:
    """Shapiro-Wilk W per group.

    The statistic needs the sum of score times value over all places.  A value with its run
    of tied places is a line; long runs are cut, and the scores of each piece are summed on
    their own.  The p-value is meant for 3 to 5,000 values per group.
    """
    by = list(by)
    some = present(df, [col, *by]).select(*by, F.col(col).cast("double").alias("_v"))
    table = tie_table(some, "_v", by, grid=grid.renamed(_v=col) if grid else None)
    spread = some.groupBy(*by).agg((F.var_pop("_v") * F.count("_v")).alias("ss"))
    return shapiro_of(table, spread, by, p_value)


def shapiro_of(table: DataFrame, spread: DataFrame, by: Sequence[str], p_value: bool = True) -> DataFrame:
    """The test of each group from its ties of ``_v`` (before, tie, total) and its sum of squares ``ss``."""
    by = list(by)
    piece = F.lit(PLACES_PER_LINE)
    pieces = table.select(
        *by,
        "_v",
        "before",
        "tie",
        "total",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("tie") - 1) / piece))).alias("_k"),
    ).withColumns(
        {
            "_start": F.col("before") + F.col("_k") * piece,
            "_stop": F.col("before") + F.least((F.col("_k") + 1) * piece, F.col("tie")),
        }
    )
    # a long run of ties must not be scored by the one task that held its line
    pieces = pieces.repartition(*by, "_v", "_k")
    places = pieces.withColumn("_i", F.explode(F.sequence(F.col("_start") + 1, F.col("_stop"))))
    scored = places.withColumn("_s", P.normal_score(F.col("_i"), F.col("total")))

    def at(place: Column) -> Column:
        hit = (F.col("before") < place) & (place <= F.col("before") + F.col("tie"))
        return F.max(F.when(hit, F.col("_v")))

    total = F.col("total")
    sums = scored.groupBy(*by).agg(
        F.max("total").alias("n"),
        F.sum(F.col("_s") * F.col("_s")).alias("score_sq"),
        F.sum(F.col("_s") * F.col("_v")).alias("score_x"),
        at(F.lit(1)).alias("x1"),
        at(F.lit(2)).alias("x2"),
        at(total - 1).alias("y2"),
        at(total).alias("y1"),
    )
    both = side_by_side(by, sums, spread)
    w = P.shapiro_stat(
        *[F.col(c) for c in ("n", "score_sq", "score_x", "ss", "x1", "x2", "y2", "y1")]
    )
    out = both.withColumn("w", w).select(*by, "n", "w")
    return out.withColumn("p_value", P.shapiro_tail(F.col("w"), F.col("n"))) if p_value else out
