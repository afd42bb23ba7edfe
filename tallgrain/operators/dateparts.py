"""Date columns and their parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date10


def to_date10(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: date10(c) for c in cols})


class DateParts:
    """Day, month and year columns in place of dates.

    ``fit`` finds with one aggregation which dates are empty throughout; those give
    no part columns, and the choice stays the same for later batches.
    """

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)
        self.filled: list[str] | None = None

    def fit(self, df: DataFrame) -> DateParts:
        row = df.agg(*[F.count(c).alias(c) for c in self.cols]).first()
        self.filled = [c for c in self.cols if row[c] > 0]
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.filled is None:
            raise ValueError("fit has not been called")
        parts = {}
        for c in self.filled:
            parts[f"day_{c}"] = F.dayofmonth(c)
            parts[f"month_{c}"] = F.month(c)
            parts[f"year_{c}"] = F.year(c)
        return df.withColumns(parts).drop(*self.cols) if parts else df.drop(*self.cols)


def date_parts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return DateParts(cols).fit(df).transform(df)
