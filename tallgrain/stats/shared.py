"""Many tests from one table of ties.

A line of the table is a value of a measure with the rows of each group that have it, and for each
group the rows below it.  Ranks inside a group, ranks over all groups and the common order of any
two groups can all be read off a line, so every test below is an aggregate over the lines: the
scores are counted and put in order once, however many tests and pairs of groups there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pvalues as P
from ..operators.ranks import ValueGrid, present, tie_table, value_grid
from ..session import stored
from .moments import effect_size_label
from .ranktests import fisher_exact, mood_p, shapiro_of, signed_rank_of

#: Groups of one table at most; each is a column of its counts.
MOST_GROUPS = 64


def group_names(df: DataFrame, group: str) -> list:
    """The groups in order; more than ``MOST_GROUPS`` are an error."""
    found = df.where(F.col(group).isNotNull()).select(group).distinct().limit(MOST_GROUPS + 1).collect()
    if len(found) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups")
    return sorted(r[0] for r in found)


@dataclass
class SharedTies:
    """``lines``: (by, measure, value, tie, before, total, rank, here, below, whole, above_zero).

    The last four are arrays with a number per name of ``names``: rows of the group with this value,
    with a smaller one, with any, and those of the first whose sign is positive.
    """

    lines: DataFrame
    names: list
    by: list[str]
    group: str
    grid: ValueGrid

    def of(self, *measures: str) -> DataFrame:
        return self.lines.where(F.col("measure").isin(*measures))

    def own(self, *measures: str) -> DataFrame:
        """(by, measure, group, value, n, tie, before, total, rank, positive): ranks inside each group."""
        i = F.lit(len(self.names) - 1)
        cells = F.transform(
            F.sequence(F.lit(0), i),
            lambda k: F.struct(
                F.get(F.array(*[F.lit(n) for n in self.names]), k).alias(self.group),
                F.get("here", k).alias("n"),
                F.get("below", k).alias("before"),
                F.get("whole", k).alias("total"),
                F.get("above_zero", k).alias("positive"),
            ),
        )
        flat = self.of(*measures).select(*self.by, "measure", "value", F.inline(cells)).where("n > 0")
        return flat.withColumns({"tie": F.col("n"), "rank": F.col("before") + (F.col("n") + 1) / 2})

    def pairs(self, measures: Sequence[str], pairs: Sequence[tuple] | None = None) -> DataFrame:
        """Sizes, U, ties, distance and median table of pairs of groups, from one aggregation.

        (by, measure, a, b, n_a, n_b, u, ties, d, median, above_a, above_b, below_a, below_b)
        """
        asked = self.asked(pairs)
        cells = F.transform(
            F.array(*[F.struct(F.lit(self.names.index(a)).alias("i"), F.lit(self.names.index(b)).alias("j")) for a, b in asked]),
            lambda p: F.struct(
                p["i"].alias("i"),
                p["j"].alias("j"),
                *[F.get(c, p[k]).alias(f"{c}_{s}") for c in ("here", "below", "whole") for k, s in (("i", "a"), ("j", "b"))],
            ),
        )
        flat = self.of(*measures).select(*self.by, "measure", "value", F.inline(cells)).where("here_a + here_b > 0")
        n, seen = F.col("whole_a") + F.col("whole_b"), F.col("below_a") + F.col("below_b")
        t = F.col("here_a") + F.col("here_b")

        def hit(place: Column) -> Column:
            return (seen <= place) & (place < seen + t)

        to = [(F.col(f"below_{s}") + F.col(f"here_{s}")) for s in "ab"]
        shares = [F.try_divide(x, F.col(f"whole_{s}")) for x, s in zip(to, "ab")]
        middle = F.struct("value", to[0].alias("to_a"), to[1].alias("to_b"), "below_a", "below_b")
        found = flat.groupBy(*self.by, "measure", "i", "j").agg(
            F.max("whole_a").alias("n_a"),
            F.max("whole_b").alias("n_b"),
            F.sum(F.col("here_a") * (F.col("below_b") + F.col("here_b") / 2)).alias("u"),
            F.sum(t * (t.cast("double") * t - 1)).alias("ties"),
            F.max(F.abs(shares[0] - shares[1])).alias("d"),
            F.max(F.when(hit(F.floor((n - 1) / 2)), middle)).alias("_low"),
            F.max(F.when(hit(F.floor(n / 2)), F.col("value"))).alias("_high"),
        )
        names = F.array(*[F.lit(x) for x in self.names])
        one = F.col("_low.value") == F.col("_high")  # else the median lies between two values
        return found.select(
            *self.by,
            "measure",
            F.get(names, F.col("i")).alias("a"),
            F.get(names, F.col("j")).alias("b"),
            "n_a",
            "n_b",
            "u",
            "ties",
            "d",
            ((F.col("_low.value") + F.col("_high")) / 2).alias("median"),
            *[(F.col(f"n_{s}") - F.col(f"_low.to_{s}")).alias(f"above_{s}") for s in "ab"],
            *[F.when(one, F.col(f"_low.below_{s}")).otherwise(F.col(f"_low.to_{s}")).alias(f"below_{s}") for s in "ab"],
        )

    def asked(self, pairs: Sequence[tuple] | None) -> list[tuple]:
        """The pairs whose groups there are; all of them by default."""
        wanted = combinations(self.names, 2) if pairs is None else pairs
        return [(a, b) for a, b in wanted if a in self.names and b in self.names]

    def side_by_side(self, table: DataFrame, pairs: Sequence[tuple] | None, *columns: str) -> DataFrame:
        """(by, measure, a, b, <column>_a, <column>_b) from a table of one row per by, measure and group."""
        keys = [*self.by, "measure"]
        listed = table.groupBy(*keys).agg(F.collect_list(F.struct(self.group, *columns)).alias("_all"))
        wanted = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in self.asked(pairs)])
        both = listed.select(*keys, "_all", F.inline(wanted))

        def side(name: str) -> Column:
            return F.get(F.filter("_all", lambda x: x[self.group] == F.col(name)), F.lit(0))

        found = both.select(*keys, "a", "b", side("a").alias("_a"), side("b").alias("_b")).where("_a is not null and _b is not null")
        return found.select(*keys, "a", "b", *[F.col(f"_{s}.{c}").alias(f"{c}_{s}") for c in columns for s in "ab"])


def shared_ties(
    df: DataFrame,
    measures: Mapping[str, Column],
    group: str,
    by: Sequence[str] = (),
    signs: Mapping[str, Column] | None = None,
) -> SharedTies:
    """The table of ties of all ``measures`` (numbers) over ``df``, written once.

    ``signs`` gives, for some measures, a condition whose rows are counted apart.  Rows without a
    group or a value of a measure take no part in it.
    """
    by, signs = list(by), dict(signs or {})
    names = group_names(df, group)
    cells = [
        F.struct(F.lit(m).alias("measure"), c.cast("double").alias("value"), signs.get(m, F.lit(False)).alias("_positive"))
        for m, c in measures.items()
    ]
    long = present(df.where(F.col(group).isNotNull()), by).select(*by, group, F.inline(F.array(*cells)))
    keys = [*by, "measure"]
    long = present(long, ["value"])
    grid = value_grid(long, ["value"], keys)
    is_in = [F.col(group) == F.lit(n) for n in names]
    weights = {f"n{i}": F.count_if(x) for i, x in enumerate(is_in)}
    weights |= {f"p{i}": F.count_if(x & F.col("_positive")) for i, x in enumerate(is_in)} if signs else {}
    table = tie_table(long, "value", keys, weights=weights, grid=grid)

    def array(pattern: str) -> Column:
        columns = [F.col(pattern.format(i)) for i in range(len(names))]
        return F.array(*columns) if columns else F.array().cast("array<bigint>")

    lines = table.select(
        *keys,
        "value",
        *("tie", "before", "total", "rank"),
        array("n{}").alias("here"),
        array("n{}_before").alias("below"),
        array("n{}_total").alias("whole"),
        (array("p{}") if signs else array("n{}")).alias("above_zero"),
    )
    return SharedTies(stored(lines, "shared-ties"), names, by, group, grid)


def group_medians(ties: SharedTies, *measures: str) -> DataFrame:
    """(by, measure, group, median) of each group."""
    own = ties.own(*measures)
    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("before") <= place) & (place < F.col("before") + F.col("n")), F.col("value")))

    found = own.groupBy(*ties.by, "measure", ties.group).agg(at(low).alias("_a"), at(high).alias("_b"))
    return found.select(*ties.by, "measure", ties.group, ((F.col("_a") + F.col("_b")) / 2).alias("median"))


def levene_pairs(ties: SharedTies, measures: Sequence[str], pairs: Sequence[tuple] | None = None) -> DataFrame:
    """Equality of two groups' variances, centred at the medians: (by, measure, a, b, n, w, p_value)."""
    keys = [*ties.by, "measure", ties.group]
    medians = group_medians(ties, *measures)
    near = F.broadcast(medians) if ties.grid.small(len(ties.names)) else medians
    gap = F.abs(F.col("value") - F.col("median"))
    spread = ties.own(*measures).join(near, keys).groupBy(*keys).agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("n") * gap) / F.sum("n")).alias("m"),
        (F.sum(F.col("n") * gap * gap) / F.sum("n")).alias("q"),
    )
    spread = spread.withColumn("v", F.col("q") - F.col("m") * F.col("m"))
    both = ties.side_by_side(spread, pairs, "n", "m", "v")
    n = F.col("n_a") + F.col("n_b")
    grand = (F.col("n_a") * F.col("m_a") + F.col("n_b") * F.col("m_b")) / n
    between = sum(F.col(f"n_{s}") * (F.col(f"m_{s}") - grand) ** 2 for s in "ab")
    within = F.col("n_a") * F.col("v_a") + F.col("n_b") * F.col("v_b")
    out = both.select(*ties.by, "measure", "a", "b", n.alias("n"), F.try_divide((n - 2) * between, within).alias("w"))
    return out.withColumn("p_value", P.f_tail(F.col("w"), F.lit(1), F.col("n") - 2))


def ttest_pairs(ties: SharedTies, moments: DataFrame, pairs: Sequence[tuple] | None = None) -> DataFrame:
    """Independent t-tests from (by, measure, group, n, mean, var): (by, measure, a, b, n, t, cohen_d, effect, p_value)."""
    both = ties.side_by_side(moments, pairs, "n", "mean", "var")
    dof = F.col("n_a") + F.col("n_b") - 2
    squares = (F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")
    d = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(F.try_divide(squares, dof)))
    scale = F.sqrt(F.lit(1.0) / F.col("n_a") + F.lit(1.0) / F.col("n_b"))
    out = both.select(*ties.by, "measure", "a", "b", (dof + 2).alias("n"), d.alias("cohen_d"), (d / scale).alias("t"))
    return out.withColumn("effect", effect_size_label("cohen_d")).withColumn("p_value", P.t_tail(F.col("t"), F.col("n") - 2))


def kruskal_all(ties: SharedTies, *measures: str) -> DataFrame:
    """Kruskal-Wallis over all groups: (by, measure, n, n_groups, h, p_value)."""
    off = F.col("rank") - (F.col("total") + 1) / 2
    keys = [*ties.by, "measure"]
    places = range(len(ties.names))
    sums = ties.of(*measures).groupBy(*keys).agg(
        F.max("total").alias("n"),
        F.sum(F.col("tie") * (F.col("tie").cast("double") * F.col("tie") - 1)).alias("ties"),
        F.array(*[F.sum(F.get("here", F.lit(i)) * off) for i in places]).alias("_off"),
        F.array(*[F.max(F.get("whole", F.lit(i))) for i in places]).alias("_whole"),
    )
    parts = F.zip_with("_off", "_whole", lambda o, w: F.coalesce(F.try_divide(o * o, w), F.lit(0.0)))
    n = F.col("n").cast("double")
    spread = 1 - F.try_divide(F.col("ties"), n * n * n - n)
    h = F.try_divide(12 / (n * (n + 1)) * F.aggregate(parts, F.lit(0.0), lambda a, x: a + x), spread)
    out = sums.select(*keys, "n", F.size(F.filter("_whole", lambda w: w > 0)).alias("n_groups"), h.alias("h"))
    return out.withColumn("p_value", P.chi2_tail(F.col("h"), F.col("n_groups") - 1))


def shapiro_all(ties: SharedTies, moments: DataFrame, *measures: str) -> DataFrame:
    """Shapiro-Wilk of each group: (by, measure, group, n, w, p_value); ``moments`` has n and var."""
    keys = [*ties.by, "measure", ties.group]
    spread = moments.select(*keys, (F.col("var") * (F.col("n") - 1)).alias("ss"))
    table = ties.own(*measures).withColumnRenamed("value", "_v")
    return shapiro_of(table, spread, keys)


def signed_rank_all(ties: SharedTies, measure: str) -> DataFrame:
    """Signed-rank test of each group over a measure from ``signed_size``: (by, measure, group, ...)."""
    return signed_rank_of(ties.own(measure).withColumnRenamed("value", "_size"), [*ties.by, "measure", ties.group])


def median_tests(pairs: DataFrame) -> DataFrame:
    """The pairs with odds ratio and p-value of the exact test, and Mood's chi-square with its own."""
    exact = fisher_exact(pairs).withColumnRenamed("p_value", "fisher_p")
    return mood_p(exact).withColumnRenamed("p_value", "mood_p")


def spearman_own(df: DataFrame, ties: SharedTies, x: str, y: str) -> DataFrame:
    """Rank correlation of two columns inside each group, by their ranks in the shared ties.

    The measures must bear the columns' names, and every row must have both or neither.
    """
    keys = [*ties.by, ties.group]
    some = present(df, [x, y, *keys])
    pairs = some.groupBy(*keys, F.col(x).cast("double").alias(x), F.col(y).cast("double").alias(y)).agg(
        F.count(F.lit(1)).alias("_n")
    )
    off = F.col("rank") - (F.col("total") + 1) / 2
    for c in (x, y):
        ranks = ties.own(c).select(*keys, F.col("value").alias(c), off.alias(f"_{c}"))
        pairs = pairs.join(ranks, [*keys, c])
    n, a, b = F.col("_n"), F.col(f"_{x}"), F.col(f"_{y}")
    sums = pairs.groupBy(*keys).agg(
        F.sum("_n").alias("n"), F.sum(n * a * b).alias("_ab"), F.sum(n * a * a).alias("_aa"), F.sum(n * b * b).alias("_bb")
    )
    return sums.select(*keys, "n", F.try_divide(F.col("_ab"), F.sqrt(F.col("_aa") * F.col("_bb"))).alias("r"))
