"""What counts as missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that fill a field without saying anything (compared in lower case, trimmed).
FILLER_WORDS = [
    "", "-", "--", "n/a", "na", "nan", "none", "null", "unknown", "not specified", "not provided",
    "information not provided", "not available", "not applicable", "tbd", "error", "invalid unit entry",
]


def is_blank(col: Column, words: list[str] = FILLER_WORDS) -> Column:
    """True for null, blank and filler words; a parameterised test, as callers disagree on the words."""
    text = F.lower(F.regexp_replace(col.cast("string"), r"^[\s\u00a0]+|[\s\u00a0]+$", ""))
    return F.coalesce(text.isin(words), F.lit(True))
