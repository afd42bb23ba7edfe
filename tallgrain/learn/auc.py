"""Area under the ROC curve from tie tables: exact and without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import present, tie_table


def auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Probability that a positive row outranks a negative one; ties count one half."""
    table = tie_table(
        present(df, [label]),
        score,
        by,
        weights={"pos": F.count_if(F.col(label) == 1), "neg": F.count_if(F.col(label) != 1)},
    )
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2))
    sums = table.groupBy(*by).agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), wins.alias("_wins")
    )
    area = F.try_divide(F.col("_wins"), F.col("n_pos").cast("double") * F.col("n_neg"))
    return sums.select(*by, "n_pos", "n_neg", area.alias("auc"))


def auc_pairs(df: DataFrame, scores: str, label: str, classes: Sequence) -> DataFrame:
    """One row per ordered pair (class, other): AUC of the class's score on these two classes.

    ``scores`` is an array column with one score per class; another length is an error.  Every class's scores are walked
    once with the running counts of all classes, instead of one pass per pair.
    """
    whole = F.when(F.size(scores) == len(classes), F.col(scores)).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {len(classes)} scores, found "), F.size(scores).cast("string")))
    )
    long = present(df, [label, scores]).select(F.col(label).alias("_y"), F.posexplode(whole).alias("_cls", "_score"))
    names = [f"c{j}" for j in range(len(classes))]
    weights = {n: F.count_if(F.col("_y") == c) for n, c in zip(names, classes)}
    table = tie_table(long, "_score", ["_cls"], weights=weights)
    own = F.element_at(F.array(*names), F.col("_cls") + 1).cast("double")
    sums = table.groupBy("_cls").agg(
        F.sum(own).alias("_own"),
        *[F.sum(F.col(n)).alias(f"{n}_n") for n in names],
        *[F.sum(own * (F.col(f"{n}_before") + F.col(n) / 2)).alias(f"{n}_wins") for n in names],
    )
    pairs = F.array(
        *[
            F.struct(
                F.lit(j).alias("_other"),
                F.try_divide(F.col(f"{n}_wins"), F.col("_own") * F.col(f"{n}_n")).alias("auc"),
            )
            for j, n in enumerate(names)
        ]
    )
    known = F.array(*[F.lit(c) for c in classes])
    return (
        sums.select("_cls", F.inline(pairs))
        .filter(F.col("_cls") != F.col("_other"))
        .select(
            F.element_at(known, F.col("_cls") + 1).alias("class"),
            F.element_at(known, F.col("_other") + 1).alias("other"),
            "auc",
        )
    )


def auc_ovo(df: DataFrame, scores: str, label: str, classes: Sequence) -> DataFrame:
    """One-against-one macro average: the mean over pairs of both directions."""
    return auc_pairs(df, scores, label, classes).agg(F.avg("auc").alias("auc"))
