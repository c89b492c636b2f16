"""Orderings.

Where the asked-for keys repeat a lot, further columns are appended as tie-breaks:
the order asked for still holds, and a range sort can split a key that holds a large
share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.rules import UNKNOWN_STATE

# Read order of each model; "-" means descending.
READ_ORDER = {
    "by_city": ["JOB_CATEGORY", "CITY", "-total_jobs"],
    "by_org": ["ORGANIZATION", "JOB_CATEGORY", "-total_jobs"],
    "by_state": ["JOB_CATEGORY", "STATE"],
    "by_type": ["JOB_CATEGORY", "-total_jobs"],
    "wow_trend": ["JOB_CATEGORY", "-week_start"],
    "posting_links": ["JOB_CATEGORY", "ID", "TITLE"],
}


def sort_keys(*names: str) -> list[Column]:
    """Keys as the warehouse sorts them: null counts as the greatest value."""
    return [
        F.col(n[1:]).desc_nulls_first() if n.startswith("-") else F.col(n).asc_nulls_last()
        for n in names
    ]


def in_order(df: DataFrame, *names: str) -> DataFrame:
    return df.orderBy(*sort_keys(*names))


def read_order(df: DataFrame, model: str) -> DataFrame:
    return in_order(df, *READ_ORDER[model])


def unknown_last(column: str = "STATE") -> list[Column]:
    """Sort keys that put the unknown state after all others."""
    return [F.when(F.col(column) == UNKNOWN_STATE, 1).otherwise(0), *sort_keys(column)]


def by_total_descending(df: DataFrame, total: str = "total_jobs") -> DataFrame:
    ties = [c for c in df.columns if c != total]
    return df.orderBy(F.desc(total), *ties)


def first_rows(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The first ``n`` rows under an explicit order (a frame has none of its own)."""
    return df.orderBy(*keys).limit(n)


def last_rows(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The last ``n`` rows under ``keys``, newest key first."""
    return df.orderBy(*[F.desc(k) for k in keys]).limit(n)
