"""Standard scores of chosen columns."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


class ColumnScaler:
    """Scale the named columns by mean and population deviation; the others stay as they are.

    ``'*'`` stands for all numeric columns.  Column order is kept.  A constant column is only
    centred.
    """

    def __init__(self, cols: Sequence[str] | str):
        if cols != "*" and len(set(cols)) < len(cols):
            warnings.warn("a column is listed more than once", stacklevel=2)
        self.cols = cols if cols == "*" else list(dict.fromkeys(cols))
        self.stats: dict[str, tuple[float, float]] | None = None
        self.rows: int | None = None

    def fit(self, df: DataFrame) -> ColumnScaler:
        cols = self.cols
        if cols == "*":
            cols = [c for c, t in df.dtypes if t in NUMBERS or t.startswith("decimal")]
        row = df.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
            *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)],
        ).first()
        self.rows = row["n"]
        self.stats = {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.stats is None:
            raise ValueError("fit has not been called")
        scaled = {}
        for c, (mean, sd) in self.stats.items():
            if mean is not None:
                scaled[c] = (F.col(c).cast("double") - F.lit(mean)) / F.lit(sd or 1.0)
        return df.withColumns(scaled) if scaled else df

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, m, s) for c, (m, s) in (self.stats or {}).items()]
        return spark.createDataFrame(rows, "column string, mean double, deviation double")

    @classmethod
    def from_table(cls, table: DataFrame) -> ColumnScaler:
        """Back from the saved table, which has one row per column."""
        rows = table.collect()
        out = cls([r["column"] for r in rows])
        out.stats = {r["column"]: (r["mean"], r["deviation"]) for r in rows}
        return out
