"""Choosing, typing and ordering columns and rows by position or label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*cols)


def first_columns(df: DataFrame, key: str, n: int = 17) -> DataFrame:
    """Key first, then the first other columns, ``n`` in all."""
    return df.select(key, *[c for c in df.columns if c != key][: n - 1])


def to_number(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast to double; text that is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def compact_types(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Cast to smaller types.  Half floats do not exist in Spark, so they become float."""
    short = {"int32": "int", "float16": "float", "bool": "boolean", "category": "string"}
    return df.withColumns({c: F.col(c).try_cast(short.get(t, t)) for c, t in spec.items()})


def exclude(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """All rows but those holding a listed member; nulls stay."""
    return df.filter(~F.col(col).isin(*values) | F.col(col).isNull())


def by_label(df: DataFrame, key: str, labels: Sequence, cols: Sequence[str]) -> DataFrame:
    """Rows by key label, columns by name."""
    return df.filter(F.col(key).isin(*labels)).select(*cols)


def alternate(c, odd: Column, even: Column) -> Column:
    """One expression for odd numbers, another for even ones (as text: types must agree)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c % 2 != 0, odd.cast("string")).otherwise(even.cast("string"))


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, type, filled and all rows, from a single scan."""
    kinds = dict(df.dtypes)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column_name"),
                F.lit(kinds[c]).alias("type"),
                F.col(f"c{i}").alias("non_null"),
                F.col("n").alias("n_rows"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select(F.inline(entries))


def head(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def tail(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The last rows in order: a reversed top-n, so nothing is sorted as a whole."""
    return df.orderBy(*[F.col(c).desc_nulls_first() for c in order_by]).limit(n)


def order(df: DataFrame, cols: Sequence[str], ascending: Sequence[bool] | bool = True) -> DataFrame:
    """Sort with missing values last in both directions."""
    ups = [ascending] * len(cols) if isinstance(ascending, bool) else list(ascending)
    keys = [
        F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in zip(cols, ups)
    ]
    return df.orderBy(*keys)


def top_k(df: DataFrame, col: str, k: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(col).desc_nulls_last(), *tiebreak).limit(k)


def first_by(df: DataFrame, order_by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Columns of the first row in order, as an aggregate instead of a sort."""
    picked = F.min_by(F.struct(*cols), F.struct(*order_by))
    return df.agg(picked.alias("_row")).select("_row.*")


def with_default(c, default) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(default))

