"""Author column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchlens import config


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_member(c, values: list[str]) -> Column:
    """``isin`` a literal set; null -> false."""
    return F.coalesce(_c(c).isin(*values), F.lit(False))


def is_scheduler_maintainer(c) -> Column:
    return is_member(c, config.SCHEDULER_MAINTAINERS)


def author_is_maintainer(c) -> Column:
    """Any maintainer domain as a substring of the lower-cased address."""
    low = F.lower(_c(c))
    hit = None
    for d in config.MAINTAINER_DOMAINS:
        e = low.contains(d)
        hit = e if hit is None else (hit | e)
    return F.coalesce(hit, F.lit(False))


def author_domain_length(c) -> Column:
    """Length of the text after the last '@'; 0 without '@' or for null."""
    s = _c(c)
    return F.when(s.contains("@"), F.length(F.substring_index(s, "@", -1))).otherwise(F.lit(0)).cast("int")


def is_frequent_author(count_col, min_count: int = config.FREQUENT_AUTHOR_MIN) -> Column:
    return F.coalesce(_c(count_col) >= min_count, F.lit(False))
