"""Week-over-week trend."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.functions.calendar import percent_text, safe_ratio, trend_direction, week_start
from jobtide.operators.aggregate import sum_by
from jobtide.operators.filters import to_date_days

TO_DATE, COMPLETE = "to_date", "complete"


def weekly_sums(daily: DataFrame, first_day: str = "monday") -> DataFrame:
    """Sum of the daily counts per category and week (not a weekly distinct count)."""
    weeks = daily.select("JOB_CATEGORY", week_start(F.col("date"), first_day).alias("week_start"), "total_jobs")
    return sum_by(weeks, ["JOB_CATEGORY", "week_start"], "total_jobs", "jobs_sum")


def with_previous_week(weekly: DataFrame) -> DataFrame:
    """Previous *present* week of the category; an absent week is skipped.

    The window holds one row per week, after aggregation, so its groups stay small.
    """
    weeks = Window.partitionBy("JOB_CATEGORY").orderBy("week_start")
    return weekly.withColumn("lastweek_jobs_sum", F.lag("jobs_sum", 1).over(weeks))


def wow_trend(
    daily: DataFrame,
    as_of: dt.date | None = None,
    mode: str = TO_DATE,
    first_day: str = "monday",
) -> DataFrame:
    """Weekly total, the week before, their difference and its ratio.

    ``to_date`` counts each week up to the weekday of ``as_of`` and nothing after the
    day before it, so the current week ends one weekday earlier than the others.
    ``complete`` counts whole weeks.
    """
    if mode == TO_DATE:
        if as_of is None:
            raise ValueError("the to-date trend needs as_of")
        daily = to_date_days(daily, as_of)
    elif mode != COMPLETE:
        raise ValueError(f"unknown mode {mode!r}")
    this, last = F.col("jobs_sum"), F.col("lastweek_jobs_sum")
    return with_previous_week(weekly_sums(daily, first_day)).select(
        "JOB_CATEGORY",
        "week_start",
        this.alias("this_week_jobs"),
        last.alias("last_week_jobs"),
        (this - last).alias("wow_diff"),
        safe_ratio(this - last, last).alias("wow_diff_pct"),
    )


def latest_trend(trend: DataFrame, rows: int = 3) -> DataFrame:
    """The newest rows of the trend; equal weeks are taken in category order."""
    return trend.orderBy(F.desc("week_start"), "JOB_CATEGORY").limit(rows)


def with_trend_label(trend: DataFrame) -> DataFrame:
    """Adds the percent text and the direction shown next to it."""
    ratio = F.col("wow_diff_pct")
    return trend.withColumn("wow_text", percent_text(ratio)).withColumn("direction", trend_direction(ratio))
