"""Binning by fixed edges, equal widths and quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import exact_quantiles


def bin_label(
    c,
    edges: Sequence,
    labels: Sequence | None = None,
    right: bool = True,
    include_lowest: bool = False,
) -> Column:
    """Label of the interval ``(a, b]`` (or ``[a, b)``) a value lies in, else null.

    Edges may be numbers or columns.
    """
    c = F.col(c) if isinstance(c, str) else c
    lit = [e if isinstance(e, Column) else F.lit(e) for e in edges]
    out = None
    for i in range(len(lit) - 1):
        if right:
            low = c >= lit[i] if include_lowest and i == 0 else c > lit[i]
            test = low & (c <= lit[i + 1])
        else:
            last = include_lowest and i == len(lit) - 2
            test = (c >= lit[i]) & (c <= lit[i + 1] if last else c < lit[i + 1])
        label = F.lit(labels[i] if labels is not None else i)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out


def cut(df: DataFrame, col: str, edges: Sequence, labels=None, out: str | None = None, **how):
    """Fixed bins.  The word ``'max'`` as last edge stands for the largest value."""
    out = out or f"{col}_bin"
    if edges[-1] != "max":
        return df.withColumn(out, bin_label(col, edges, labels, **how))
    top = df.agg(F.max(col)).first()[0]
    if top is None:
        return df.withColumn(out, F.lit(None).cast("string" if labels else "int"))
    return df.withColumn(out, bin_label(col, [*edges[:-1], top], labels, **how))


def cut_equal(df: DataFrame, col: str, n: int = 7, out: str | None = None) -> DataFrame:
    """``n`` bins of equal width: bin number from 0 and the rounded middle of the bin.

    As usual for this kind of cut the first edge is lowered by 0.1 % of the range, so
    that the smallest value falls inside; a column of one value is widened the same way.
    """
    out = out or f"{col}_bin"
    low, high = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    if low is None:
        return df.withColumns({out: F.lit(None).cast("int"), f"{out}_mid": F.lit(None).cast("int")})
    flat = low == high
    if flat:
        pad = 0.001 if low == 0 else abs(low) * 0.001
        low, high = low - pad, high + pad
    width = (high - low) / n
    # how many inner edges the value exceeds: the same comparison a sorted edge list makes
    number = sum((F.when(F.col(col) > low + i * width, 1).otherwise(0) for i in range(1, n)), F.lit(0))
    middles = []
    for i in range(n):
        left = low + i * width - ((high - low) * 0.001 if i == 0 and not flat else 0.0)
        middles.append(F.lit(round((left + low + (i + 1) * width) / 2)))
    middle = F.element_at(F.array(*middles), F.col(out) + 1)
    numbered = df.withColumn(out, F.when(F.col(col).isNotNull(), number))
    return numbered.withColumn(f"{out}_mid", middle.cast("int"))


def quantile_edges(df: DataFrame, col: str, q: int, approx: bool = False) -> list[float]:
    """The ``q + 1`` quantile edges, a handful of numbers on the driver."""
    probs = [i / q for i in range(q + 1)]
    if approx:
        return list(df.agg(F.percentile_approx(col, probs, 100000)).first()[0])
    rows = exact_quantiles(df, [col], probs).select("prob", "quantile").collect()
    found = {r["prob"]: r["quantile"] for r in rows}
    return [found[p] for p in probs]


def qcut(df: DataFrame, col: str, q: int = 4, out: str | None = None, approx: bool = False):
    """Quantile bins numbered from 0; the lowest value belongs to the first bin."""
    edges = sorted(set(quantile_edges(df, col, q, approx)))
    out = out or f"{col}_q"
    return df.withColumn(out, bin_label(col, edges, include_lowest=True))


def decade(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (F.floor(c / 10) * 10).cast("int")


def above_median(df: DataFrame, col: str, out: str = "target") -> DataFrame:
    """1 where the value is above the exact median, else 0."""
    middle = quantile_edges(df, col, 2)[1]
    return df.withColumn(out, F.when(F.col(col) > middle, 1).otherwise(0))
