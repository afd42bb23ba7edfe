"""Constraints of a table, all counted in one scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import orphans


@dataclass
class Rule:
    """A named condition; ``broken`` is true for a row that violates it."""

    name: str
    broken: Column


def not_null(col: str) -> Rule:
    return Rule(f"not_null({col})", F.col(col).isNull())


def in_range(col: str, low=None, high=None) -> Rule:
    """Closed range; a null value passes, as in SQL."""
    tests = []
    if low is not None:
        tests.append(F.col(col) < low)
    if high is not None:
        tests.append(F.col(col) > high)
    return Rule(f"range({col})", F.coalesce(reduce(or_, tests), F.lit(False)))


def member(col: str, values: Sequence) -> Rule:
    return Rule(f"member({col})", F.coalesce(~F.col(col).isin(*values), F.lit(False)))


def max_length(col: str, n: int) -> Rule:
    return Rule(f"length({col})", F.coalesce(F.length(col) > n, F.lit(False)))


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rows checked, rows broken, passed."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(rules)],
    )
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.col("n").alias("n_rows"),
            F.col(f"r{i}").alias("n_broken"),
            (F.col(f"r{i}") == 0).alias("passed"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


def check_pk(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Primary key: rows with a null part, keys used more than once, rows holding those keys."""
    cols = list(cols)
    missing = reduce(or_, [F.col(c).isNull() for c in cols])
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("n_null_key"),
        F.count_if(~missing & (F.col("_n") > 1)).alias("n_repeated_keys"),
        F.coalesce(F.sum(F.when(~missing & (F.col("_n") > 1), F.col("_n"))), F.lit(0)).alias(
            "n_rows_repeated"
        ),
    )


def check_fk(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Foreign key: child keys without a parent and the rows holding them."""
    found = orphans(child, parent.select(parent_key), child_key, parent_key)
    return found.agg(
        F.count(F.lit(1)).alias("n_orphan_keys"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_orphan_rows"),
    )
