"""Aggregations: count-distinct marts, weekly sums, collapse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_distinct_mart(
    df: DataFrame,
    dims: list[str],
    key: str = "ID",
    name: str = "total_jobs",
) -> DataFrame:
    """Distinct keys per group.

    Rows meet on (dims, key), so a group holding most of the rows is still spread over
    all tasks; only one partial count per task and group reaches the last shuffle.
    """
    return df.groupBy(*dims).agg(F.countDistinct(key).alias(name))


def daily_columns(days: DataFrame) -> DataFrame:
    """Daily counts laid out as the daily mart; month and year follow from the day."""
    return days.select(
        F.to_date("JOB_DATE").alias("date"),
        F.month("JOB_DATE").alias("month"),
        F.year("JOB_DATE").alias("Year"),
        "JOB_CATEGORY",
        "total_jobs",
    )


def daily_mart(df: DataFrame) -> DataFrame:
    """Distinct postings per category and day."""
    return daily_columns(count_distinct_mart(df, ["JOB_CATEGORY", "JOB_DATE"]))


def sum_by(df: DataFrame, keys: list, value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def collapse(df: DataFrame, keys: list[str], greatest: list[str]) -> DataFrame:
    """One row per distinct ``keys`` (null equals null) with the greatest of the others."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in greatest])


def bounds(df: DataFrame, column: str = "date") -> DataFrame:
    return df.agg(F.min(column).alias("MIN_DATE"), F.max(column).alias("MAX_DATE"))


def distinct_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of one column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()
