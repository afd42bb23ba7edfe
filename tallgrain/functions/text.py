"""Text expressions; everything stays inside generated JVM code."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_table() -> tuple[str, str]:
    """Precomposed letters (Latin, Greek, Cyrillic ranges) and their bare letter."""
    marked, bare = [], []
    for code in [*range(0xC0, 0x530), *range(0x1E00, 0x2000)]:
        letter = chr(code)
        base = "".join(
            c for c in unicodedata.normalize("NFD", letter) if unicodedata.category(c) != "Mn"
        )
        if len(base) == 1 and base != letter:
            marked.append(letter)
            bare.append(base)
    return "".join(marked), "".join(bare)


_MARKED, _BARE = _accent_table()


def strip_accents(c) -> Column:
    """Letters without their accents; loose combining marks are removed too.

    Text of as many bytes as characters is plain ASCII and passes untouched.
    """
    c = F.col(c) if isinstance(c, str) else c
    plain = F.octet_length(c) == F.char_length(c)
    return F.when(plain, c).otherwise(F.regexp_replace(F.translate(c, _MARKED, _BARE), r"\p{Mn}", ""))


def normalize_text(c) -> Column:
    """Lower case, no accents, blanks as underscores."""
    return F.translate(strip_accents(F.lower(c)), " ", "_")


def strip_control(c) -> Column:
    """Without control characters."""
    return F.regexp_replace(c, r"[\x00-\x1F\x7F]", "")


def percent(c) -> Column:
    """``' 13.5%'`` as 13.5; unreadable text gives null."""
    return F.trim(F.regexp_replace(c, "%", "")).try_cast("double")


def leading_number(c) -> Column:
    """First run of digits as an int (``' 36 months'`` gives 36)."""
    digits = F.regexp_extract(c, r"(\d+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("int")


def hash_number(seed, key, label: str) -> Column:
    """A number in [0, 2**32) fixed by seed, key and label, whatever the partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"), F.lit(label))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
