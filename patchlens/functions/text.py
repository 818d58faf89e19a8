"""Text column expressions: lengths, word counts, regex flags, marks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchlens import config


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ci_regex(pattern: str) -> str:
    """Case-insensitive, Unicode-aware Java regex (``(?i)`` alone is ASCII-only)."""
    return "(?iu)" + pattern


def rlike_ci(c, pattern: str) -> Column:
    """Substring regex search, case-insensitive; null -> false."""
    return F.coalesce(_c(c).rlike(ci_regex(pattern)), F.lit(False))


def char_length(c) -> Column:
    return F.length(_c(c))


def word_count(c) -> Column:
    """Number of whitespace-separated tokens; null/blank -> 0.

    ``(?U)`` makes ``\\S`` Unicode-aware so that e.g. NBSP separates words.
    """
    return F.coalesce(F.regexp_count(_c(c), F.lit(r"(?U)\S+")), F.lit(0)).cast("int")


def count_char(c, ch: str) -> Column:
    s = _c(c)
    return (F.length(s) - F.length(F.replace(s, F.lit(ch), F.lit("")))).cast("int")


def has_colon(c) -> Column:
    return F.coalesce(_c(c).contains(":"), F.lit(False))


def has_brackets(c) -> Column:
    return F.coalesce(_c(c).rlike(r"[\[\](){}]"), F.lit(False))


def subject_flags(c) -> list[Column]:
    """The eight keyword flags, each aliased to its name."""
    return [rlike_ci(c, pat).alias(name) for name, pat in config.SUBJECT_FLAGS]


def keyword_pattern(keywords: list[str]) -> str:
    return "|".join(keywords)


def truncate_text(c, n: int = config.DESCRIPTION_MAX_CHARS, suffix: str = "...") -> Column:
    s = _c(c)
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit(suffix))).otherwise(s)


def clean_text(c, default: str = "unknown") -> Column:
    """null or blank -> ``default``; anything else unchanged."""
    s = _c(c)
    return F.when(s.isNull() | (F.trim(s) == ""), F.lit(default)).otherwise(s)
