"""MAX over text columns by hash.

Spark can only hash-aggregate buffers of fixed width, so MAX over texts sorts the rows at full
width.  Here each text is replaced by its place in the order of the texts of its column, the greatest
place is taken by hash, and the texts come back by place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.operators.aggregate import collapse
from jobtide.operators.lookup import BROADCAST_LIMIT, keep, measure


def text_places(df: DataFrame, columns: list[str], limit: int = BROADCAST_LIMIT) -> DataFrame | None:
    """(column, value, place) of the distinct texts of some columns; None where they do not fit a broadcast.

    The order is made in one task for each column, over what fits.
    """
    values = df.select(*columns).unpivot([], columns, "column", "value").where("value IS NOT NULL").distinct()
    side = measure(values, limit)
    if not side.fits:
        return None
    place = F.row_number().over(W.partitionBy("column").orderBy("value"))
    return keep(side.frame.withColumn("place", place))


def collapse_by_place(df: DataFrame, keys: list[str], greatest: list[str], limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The rows of :func:`jobtide.operators.aggregate.collapse`, without a sort while the distinct texts fit a broadcast."""
    places = text_places(df, greatest, limit)
    if places is None:
        return collapse(df, keys, greatest)
    sides = {c: places.where(F.col("column") == c).select(F.col("value").alias(f"_{c}"), F.col("place").alias(f"_{c}_place")) for c in greatest}
    numbered = df.select(*keys, *greatest)
    for column, side in sides.items():
        numbered = numbered.join(F.broadcast(side), F.col(column) == F.col(f"_{column}"), "left").drop(column, f"_{column}")
    found = collapse(numbered, keys, [f"_{c}_place" for c in greatest])
    for column, side in sides.items():
        back = side.select(F.col(f"_{column}").alias(column), F.col(f"_{column}_place").alias("_back"))
        found = found.join(F.broadcast(back), F.col(f"_{column}_place") == F.col("_back"), "left").drop(f"_{column}_place", "_back")
    return found.select(*keys, *greatest)
