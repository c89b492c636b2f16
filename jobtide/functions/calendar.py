"""Dates, weeks, safe ratios and the trend label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_week(c: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(c) - 1


def week_start(c: Column, first_day: str = "monday") -> Column:
    """First day of the week holding ``c``; weeks begin on Monday unless asked otherwise."""
    if first_day == "monday":
        return F.to_date(F.date_trunc("week", c))
    if first_day == "sunday":
        return F.date_sub(F.to_date(c), day_of_week(c))
    raise ValueError(f"first_day must be monday or sunday, not {first_day!r}")


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; null where ``whole`` is null or zero."""
    return part / F.nullif(whole, F.lit(0))


def percent_text(ratio: Column) -> Column:
    """Whole percent, ties to even; a small negative ratio reads ``-0%``."""
    whole = F.bround(ratio * 100, 0).cast("long")
    sign = F.when((ratio < 0) & (whole == 0), F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, whole.cast("string"), F.lit("%"))


def trend_direction(ratio: Column) -> Column:
    """``up``, ``flat`` or ``down``; an unknown ratio also reads ``down``."""
    return F.when(ratio > 0, F.lit("up")).when(ratio == 0, F.lit("flat")).otherwise(F.lit("down"))
