"""The six marts over the conformed table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.operators.aggregate import count_distinct_mart, daily_columns
from jobtide.operators.copies import CopyFilter, copy_filter, count_distinct_split
from jobtide.operators.trend import wow_trend

# Grouping columns of the four count-distinct marts.
MART_DIMS = {
    "by_city": ["JOB_CATEGORY", "CITY"],
    "by_org": ["ORGANIZATION", "JOB_CATEGORY"],
    "by_state": ["JOB_CATEGORY", "STATE"],
    "by_type": ["JOB_CATEGORY"],
}
MART_PROBE = ["ID", "JOB_CATEGORY"]


def mart(conformed: DataFrame, name: str) -> DataFrame:
    return count_distinct_mart(conformed, MART_DIMS[name])


def count_marts(conformed: DataFrame, again: CopyFilter | None = None) -> dict[str, DataFrame]:
    """The five count-distinct marts.

    All of them count IDs within a category, so one narrow shuffle of a hash of
    (ID, category) finds the rows that could be counted twice.  The others are counted
    where they lie, instead of shuffling every row once per mart.  ``again`` is that
    filter where it has been made: of these rows, or of the cleaned rows they are made from.
    """
    alone, repeated = (again or copy_filter(conformed, MART_PROBE)).split(conformed)
    counted = {name: count_distinct_split(alone, repeated, dims) for name, dims in MART_DIMS.items()}
    days = count_distinct_split(alone, repeated, ["JOB_CATEGORY", "JOB_DATE"])
    return {**counted, "daily": daily_columns(days)}


def merged_mart(stored: DataFrame, added: DataFrame, name: str = "total_jobs") -> DataFrame:
    """Counts of rows whose IDs differ from all that were counted before, added to the stored counts."""
    dims = [c for c in stored.columns if c != name]
    return stored.unionByName(added).groupBy(*dims).agg(F.sum(name).alias(name))


def all_marts(conformed: DataFrame, as_of: dt.date) -> dict[str, DataFrame]:
    """Every mart by name; the trend reads the daily mart."""
    made = count_marts(conformed)
    return {**made, "wow_trend": wow_trend(made["daily"], as_of)}
