"""Unions, melting and pivoting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both; a column missing on one side is null there."""
    return a.unionByName(b, allowMissingColumns=True)


def append_rows(df: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    return df.unionByName(df.sparkSession.createDataFrame(list(rows), df.schema))


def melt(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "variable", value: str = "value"
) -> DataFrame:
    """Wide to long."""
    return df.unpivot(list(ids), list(values), var, value)


def unstack(df: DataFrame, rows: Sequence[str], col: str, levels: Sequence, value: str) -> DataFrame:
    """Long to wide for given levels; without a matching row the cell is null."""
    return df.groupBy(*rows).agg(
        *[F.max(F.when(F.col(col) == v, F.col(value))).alias(str(v)) for v in levels]
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def shuffle_rows(df: DataFrame, seed: int) -> DataFrame:
    """Rows in random order.  Only useful as the last step: later operators lose the order."""
    return df.orderBy(F.rand(seed))
