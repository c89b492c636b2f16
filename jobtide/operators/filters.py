"""Row filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.functions.calendar import day_of_week
from jobtide.functions.text import has_phrase, has_substring
from jobtide.schema import SEARCH_TITLES

ALL = "All"


def title_phrase_filter(df: DataFrame, column: str = "TITLE", phrases: list[str] = SEARCH_TITLES) -> DataFrame:
    """Rows whose title holds a whole phrase; a null title is dropped."""
    return df.where(has_phrase(F.col(column), phrases))


def title_contains_filter(df: DataFrame, column: str = "TITLE", phrases: list[str] = SEARCH_TITLES) -> DataFrame:
    """Substring form, wider than :func:`title_phrase_filter`."""
    return df.where(has_substring(F.col(column), phrases))


def facet_filter(df: DataFrame, **choices: str) -> DataFrame:
    """AND of equality filters; a choice of ``All`` filters nothing."""
    for column, value in choices.items():
        if value != ALL:
            df = df.where(F.col(column) == value)
    return df


def before_newest(df: DataFrame, column: str = "date", newest_of: DataFrame | None = None) -> DataFrame:
    """Drop the newest (still filling) day, found by a scalar subquery."""
    newest = (newest_of if newest_of is not None else df).select(F.max(column)).scalar()
    return df.where(F.col(column) < newest)


def with_report_params(df: DataFrame, as_of: dt.date) -> DataFrame:
    """The one-row parameter relation, as literal columns that fold into the plan."""
    return (
        df.withColumn("report_date", F.date_sub(F.lit(as_of), 1))
        .withColumn("report_dow", day_of_week(F.lit(as_of)))
    )


def to_date_days(df: DataFrame, as_of: dt.date, column: str = "date") -> DataFrame:
    """Days up to today's weekday in every week, and never after yesterday."""
    day = F.col(column)
    return df.where(
        (day_of_week(day) <= day_of_week(F.lit(as_of))) & (day <= F.date_sub(F.lit(as_of), 1))
    )
