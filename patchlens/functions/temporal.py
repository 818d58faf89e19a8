"""Calendar features from epoch-millisecond send times (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchlens import config


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_ts(c) -> Column:
    """Epoch ms -> timestamp; unparsable strings -> null (``try_cast``)."""
    return F.timestamp_millis(_c(c).try_cast("bigint"))


def calendar_parts(ts) -> list[Column]:
    return list(calendar_parts_by_name(ts).values())


def calendar_parts_by_name(ts) -> dict[str, Column]:
    t = _c(ts)
    hour = F.hour(t)
    dow = F.weekday(t)  # Monday = 0
    lo, hi = config.BUSINESS_HOURS
    return {
        "hour": hour.alias("hour"),
        "day_of_week": dow.alias("day_of_week"),
        "month": F.month(t).alias("month"),
        "year": F.year(t).alias("year"),
        "is_business_hours": F.coalesce(hour.between(lo, hi), F.lit(False)).alias("is_business_hours"),
        "is_weekend": F.coalesce(dow.isin(*config.WEEKEND_DAYS), F.lit(False)).alias("is_weekend"),
    }
