"""Report of a before/after experiment with several groups.

The score columns are melted once into (domain, group, pre, post, diff) and put in order once, in
a table of ties.  Every test is an aggregate over it for all domains, groups and pairs of groups,
so the number of jobs does not depend on them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pvalues as P
from ..functions.pvalues import decide
from ..operators.describe import describe, mean_median_by
from ..session import stored
from ..stats import moments as M
from ..stats import ranktests as T
from ..stats import shared as S


def long_scores(df: DataFrame, group: str, domains: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per subject and domain; group names are trimmed."""
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("domain"),
                F.col(pre).cast("double").alias("pre"),
                F.col(post).cast("double").alias("post"),
            )
            for name, (pre, post) in domains.items()
        ]
    )
    long = df.select(F.trim(group).alias("group"), F.inline(cells))
    return long.withColumn("diff", F.col("post") - F.col("pre"))


def _line(df: DataFrame, test: str | Column, about: Column, n: str, stat: str, effect: str | None = None, p: str | None = "p_value"):
    return df.select(
        "domain",
        (F.lit(test) if isinstance(test, str) else test).alias("test"),
        about.alias("about"),
        F.col(n).cast("bigint").alias("n"),
        F.col(stat).cast("double").alias("statistic"),
        (F.col(effect) if effect else F.lit(None)).cast("double").alias("effect"),
        (F.col(p) if p else F.lit(None)).cast("double").alias("p_value"),
    )


def _group_moments(long: DataFrame) -> DataFrame:
    """(domain, group, measure, n, mean, var, skewness) of pre, post and diff, from one read."""
    names = ("pre", "post", "diff")
    wide = long.groupBy("domain", "group").agg(
        *[
            F.struct(
                F.lit(c).alias("measure"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.var_samp(c).alias("var"),
                F.skewness(c).alias("skewness"),
            ).alias(c)
            for c in names
        ]
    )
    return wide.select("domain", "group", F.inline(F.array(*names)))


def experiment_report(
    df: DataFrame,
    group: str,
    domains: Mapping[str, tuple[str, str]],
    treated: str | None = None,
    other: str | None = None,
    alpha: float = 0.05,
) -> DataFrame:
    """All tests as lines: domain, test, what it is about, n, statistic, effect, p, decision.

    ``treated`` and ``other`` name the two groups compared with each other; without them every
    pair of groups is.  The scores are put in order once, in a table of ties that all tests read;
    its cost does not grow with the number of tests or pairs.
    """
    long = stored(long_scores(df, group, domains), "scores")
    size, positive = T.signed_size(F.col("diff"), "log")
    sized = F.when(F.col("diff").isNotNull(), size)
    measures = {"pre": F.col("pre"), "post": F.col("post"), "diff": F.col("diff"), "log_diff": sized}
    ties = S.shared_ties(long, measures, "group", ["domain"], signs={"log_diff": positive})
    moments = stored(_group_moments(long), "score-moments")
    pairs = [(treated, other)] if treated is not None and other is not None else None
    one, two = F.col("group"), F.concat_ws(" / ", "a", "b")

    about = F.col("group")
    normal = S.shapiro_all(ties, moments, "pre", "post", "diff")
    skew = moments.withColumn("none", F.lit(None))
    paired = M.ttest_rel(long, "post", "pre", ["domain", "group"])
    line = M.linear_fit(long, "pre", "post", ["domain", "group"])
    linear = M.with_corr_p(M.pearson(long, "pre", "post", ["domain", "group"], p_value=False))
    monotone = M.with_corr_p(S.spearman_own(long, ties, "pre", "post"))
    signed = S.signed_rank_all(ties, "log_diff")
    parts = [
        _line(normal, F.concat(F.lit("shapiro_"), "measure"), about, "n", "w"),
        _line(skew, F.concat(F.lit("skewness_"), "measure"), about, "n", "skewness", p=None),
        _line(paired, "paired_t", about, "n", "t", "cohen_d"),
        _line(signed, "wilcoxon_log", about, "n_used", "w", "effect_r"),
        _line(line, "line_pre_post", about, "n", "slope", "intercept", p=None),
        _line(linear, "pearson_pre_post", about, "n", "r", "r"),
        _line(monotone, "spearman_pre_post", about, "n", "r", "r"),
    ]

    two = F.concat_ws(" / ", "a", "b")
    met = S.median_tests(stored(ties.pairs(["diff"], pairs), "score-pairs"))
    met = met.withColumns(
        {
            "n": F.col("n_a") + F.col("n_b"),
            "cells": F.col("above_a") + F.col("above_b") + F.col("below_a") + F.col("below_b"),
            "whitney_p": P.rank_sum_tail(F.col("u"), F.col("n_a"), F.col("n_b"), F.col("ties")),
            "smirnov_p": P.ks_tail(F.col("d"), F.col("n_a"), F.col("n_b")),
            # share of pairs in which the first is larger, less the share in which it is smaller
            "biserial": F.try_divide(2 * F.col("u"), F.col("n_a") * F.col("n_b")) - 1,
        }
    )
    met = stored(met, "pair-tests")
    student = S.ttest_pairs(ties, moments.where("measure = 'diff'"), pairs)
    parts += [
        _line(met, "mann_whitney", two, "n", "u", "biserial", "whitney_p"),
        _line(met, "kolmogorov_smirnov", two, "n", "d", "d", "smirnov_p"),
        _line(met, "fisher_median", two, "cells", "odds_ratio", "odds_ratio", "fisher_p"),
        _line(met, "mood_median", two, "cells", "chi2", p="mood_p"),
        _line(student, "independent_t", two, "n", "t", "cohen_d"),
        _line(S.levene_pairs(ties, ["diff"], pairs), "levene", two, "n", "w"),
        _line(S.kruskal_all(ties, "diff"), "kruskal_wallis", F.lit("all groups"), "n", "h"),
    ]
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("decision", decide("p_value", alpha))


def experiment_summary(df: DataFrame, group: str, domains: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Describe table of pre, post and difference per domain and group."""
    return describe(long_scores(df, group, domains), ["pre", "post", "diff"], ["domain", "group"])


def change_table(df: DataFrame, group: str, domains: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Mean and median per domain, group and moment (pre, post)."""
    long = long_scores(df, group, domains)
    moments = long.unpivot(["domain", "group"], ["pre", "post"], "moment", "score")
    return mean_median_by(moments, "score", ["domain", "group", "moment"])
