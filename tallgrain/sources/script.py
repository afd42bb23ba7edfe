"""SQL scripts of several statements."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# quoted text, quoted names and comments are passed over as a whole; what is left is code
_PIECE = re.compile(r"'(?:[^']|'')*'|\"[^\"]*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|[^;'\"`\-/]+|.", re.S)


def statements(text: str) -> list[str]:
    """Split at semicolons outside of quotes and comments; comments are dropped."""
    out, now = [], []
    for piece in _PIECE.findall(text):
        if piece == ";":
            out.append("".join(now).strip())
            now = []
        elif not piece.startswith(("--", "/*")):
            now.append(piece)
    out.append("".join(now).strip())
    return [s for s in out if s]


def run_script(
    spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None
) -> DataFrame | None:
    """Run every statement; the result of the last one that returns rows is returned.

    ``views`` are made available to the script under their names.
    """
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    result = None
    for statement in statements(text):
        df = spark.sql(statement)
        if df.columns:
            result = df
    return result
