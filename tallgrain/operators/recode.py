"""Replacing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import percent, leading_number


def _as_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def recode_value(c, mapping: Mapping, unmapped: str = "keep") -> Column:
    """Look values up; others are kept or become null."""
    c = F.col(c) if isinstance(c, str) else c
    found = F.try_element_at(_as_map(mapping), c)
    return found if unmapped == "null" else F.coalesce(found, c)


def recode(df: DataFrame, col: str, mapping: Mapping, unmapped: str = "keep") -> DataFrame:
    return df.withColumn(col, recode_value(col, mapping, unmapped))


def range_flags(
    df: DataFrame, col: str, ranges: Mapping[str, tuple[int | None, int | None]], drop: bool = True
) -> DataFrame:
    """One 0/1 column per closed range of codes; a null code is in none of them.

    The ranges are fixed, so a batch that lacks some code still gets the same columns.
    """
    flags = {}
    for name, (low, high) in ranges.items():
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col(col) >= low)
        if high is not None:
            inside = inside & (F.col(col) <= high)
        flags[name] = F.coalesce(inside.cast("int"), F.lit(0))
    out = df.withColumns(flags)
    return out.drop(col) if drop else out


def clean_percent(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, percent(col))


def term_to_months(df: DataFrame, col: str = "term") -> DataFrame:
    return df.withColumn(f"{col}_in_months", leading_number(col)).drop(col)


def text_is(df: DataFrame, col: str, text: str) -> DataFrame:
    """Text column to boolean."""
    return df.withColumn(col, F.col(col) == text)


def fill_constant(df: DataFrame, value, cols: Sequence[str] | None = None) -> DataFrame:
    return df.fillna(value, subset=list(cols) if cols else None)
