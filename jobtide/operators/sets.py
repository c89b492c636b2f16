"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_union(frames: list[DataFrame], column: str) -> DataFrame:
    """Sorted distinct non-null values of ``column`` over all ``frames``."""
    parts = [f.select(column).where(F.col(column).isNotNull()) for f in frames]
    return reduce(DataFrame.union, parts).distinct().orderBy(column)


def facet_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(facet, value)``: the distinct non-null values of several columns in one pass."""
    pairs = df.select(*columns).unpivot([], columns, "facet", "value")
    return pairs.where(F.col("value").isNotNull()).distinct().orderBy("facet", "value")
