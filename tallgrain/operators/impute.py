"""Filling missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .counts import modes


class Impute:
    """Fill nulls by rule: ``'mean'``, ``'mode'`` or a constant per column.

    All means come from one aggregation and all modes from another, whatever the number of
    columns.  Nulls never count as a mode; a column without any value stays null and is
    listed in ``empty``.
    """

    def __init__(self, rules: Mapping[str, object]):
        self.rules = dict(rules)
        self.values: dict[str, object] | None = None
        self.empty: list[str] = []

    def fit(self, df: DataFrame) -> Impute:
        means = [c for c, r in self.rules.items() if r == "mean"]
        commons = [c for c, r in self.rules.items() if r == "mode"]
        found = {c: r for c, r in self.rules.items() if r not in ("mean", "mode")}
        if means:
            found.update(df.agg(*[F.avg(c).alias(c) for c in means]).first().asDict())
        found.update(modes(df, commons))
        self.empty = [c for c, v in found.items() if v is None]
        self.values = {c: v for c, v in found.items() if v is not None}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Columns filled by their mean become doubles, so that no mean is cut to an int."""
        if self.values is None:
            raise ValueError("fit has not been called")
        kinds = dict(df.dtypes)
        filled = {}
        for c, v in self.values.items():
            if self.rules[c] == "mean":
                filled[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
            else:
                filled[c] = F.coalesce(F.col(c), F.lit(v).cast(kinds[c]))
        return df.withColumns(filled) if filled else df


@dataclass
class Roles:
    one_hot: list[str]
    date_parts: list[str]
    numeric: list[str]
    categorical: list[str]


def column_roles(df: DataFrame, prefixes: Sequence[str], key: str) -> Roles:
    """Sort columns into roles by name prefix and type."""
    roles = Roles([], [], [], [])
    for c, t in df.dtypes:
        if c == key:
            continue
        if c.startswith(tuple(prefixes)):
            roles.one_hot.append(c)
        elif c.startswith(("day_", "month_", "year_")):
            roles.date_parts.append(c)
        elif t in ("double", "float", "int", "bigint"):
            roles.numeric.append(c)
        elif t == "string":
            roles.categorical.append(c)
    return roles


def impute_by_role(df: DataFrame, prefixes: Sequence[str], key: str) -> Impute:
    """The usual rules: flags 0, numbers by mean, categories and date parts by mode."""
    roles = column_roles(df, prefixes, key)
    rules: dict[str, object] = {c: 0 for c in roles.one_hot}
    rules.update({c: "mean" for c in roles.numeric})
    rules.update({c: "mode" for c in [*roles.categorical, *roles.date_parts]})
    return Impute(rules).fit(df)
