"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date10(c) -> Column:
    """Date from the first ten characters; null where that is no date."""
    return F.to_date(F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")))


def parse_date(c, fmt: str) -> Column:
    """Date from text in the given pattern; null where it does not fit."""
    return F.to_date(F.try_to_timestamp(c, F.lit(fmt)))


def weekday(c) -> Column:
    """Monday 0 to Sunday 6."""
    return F.weekday(c)


def hour_text(c) -> Column:
    """Hour out of ``HHMM`` text."""
    return F.substring(c, 1, 2)


def past_midnight(c, start: int = 400) -> Column:
    """HHMM numbers before ``start`` counted on from the evening before."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c < start, c + 2400).otherwise(c)
