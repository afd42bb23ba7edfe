"""Column names: cleaning, restoring, checking.  Works on names only, never on rows."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame


def snake_name(name: str) -> str:
    """ASCII snake_case form of one name."""
    decomposed = unicodedata.normalize("NFD", name.lower())
    ascii_like = "".join(c for c in decomposed if unicodedata.category(c) != "Mn")
    return re.sub(r"[^a-z0-9]+", "_", ascii_like).strip("_")


def collapse_spelled(name: str) -> str:
    """``a_n_n_u_a_l`` becomes ``annual``; other names stay."""
    if re.fullmatch(r"[^_](_[^_])+", name):
        return name.replace("_", "")
    return name


def _rename_free(df: DataFrame, wanted: Iterable[tuple[str, str]]) -> DataFrame:
    """Rename where the new name is not in use; the first claim wins."""
    taken, plan = set(df.columns), {}
    for old, new in wanted:
        if new != old and new not in taken:
            plan[old] = new
            taken.add(new)
            taken.discard(old)
    return df.withColumnsRenamed(plan) if plan else df


def normalize_names(df: DataFrame) -> DataFrame:
    return _rename_free(df, [(c, snake_name(c)) for c in df.columns])


def collapse_names(df: DataFrame) -> DataFrame:
    return _rename_free(df, [(c, collapse_spelled(c)) for c in df.columns])


def restore_names(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Give ``annualinc`` its underscores back where ``annual_inc`` is expected."""
    found = [(e.replace("_", ""), e) for e in expected if e.replace("_", "") in df.columns]
    return _rename_free(df, found)


def check_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per expected column: the name it was found under, or null."""
    by_form: dict[str, str] = {}
    for c in df.columns:
        by_form.setdefault(snake_name(c), c)
    rows = [(e, by_form.get(e), e in by_form) for e in expected]
    return df.sparkSession.createDataFrame(rows, "expected string, found_as string, present boolean")


def clean_column_names(
    columns: Sequence[str], keep: Iterable[str] = (), prefixes: Sequence[str] = ()
) -> list[str]:
    """Valid and unique names.  Kept names and prefixes lose only control characters."""
    keep, used, out = set(keep), set(), []
    for name in columns:
        if name in keep or name.startswith(tuple(prefixes)):
            base = re.sub(r"[\x00-\x1f\x7f]", "", name)
        else:
            base = re.sub(r"[^a-zA-Z0-9]+", "_", name).strip("_")
        new, n = base, 0
        while new in used:
            n += 1
            new = f"{base}_{n}"
        used.add(new)
        out.append(new)
    return out


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)
