"""Joins to a side that is unique on its key, safe for hot keys and for any size.

A side is broadcast only after its size was measured.  Past the limit, the few keys
that hold a large share of the rows are joined to a broadcast of just their own
entries (their number is bounded by the share), and the remaining keys, none of them
hot, go through an ordinary shuffle join.  Both ways give the same rows.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.schema import MISSING_TEXT

BROADCAST_LIMIT = 64 * 1024 * 1024
# At least this many keys can be hot, however few partitions a shuffle has.
HOT_SHARE = 1000

_KEY = "__lookup_key"
_scopes = threading.local()


def _kept() -> list[list[DataFrame]]:
    if not hasattr(_scopes, "held"):
        _scopes.held = [[]]
    return _scopes.held


def release() -> None:
    """Drop the cached lookup sides of the innermost scope of this thread."""
    held = _kept()[-1]
    while held:
        held.pop().unpersist()


@contextmanager
def lookup_scope() -> Iterator[None]:
    """Lookup sides cached inside the block are dropped at its end, those of other jobs are not."""
    _kept().append([])
    try:
        yield
    finally:
        release()
        _kept().pop()


def keep(df: DataFrame) -> DataFrame:
    """``df`` cached until :func:`release`."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    _kept()[-1].append(held)
    return held


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        size = size + F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) + 8
    return size


class Measured(NamedTuple):
    """A frame with its row count and whether it may be broadcast."""

    frame: DataFrame
    rows: int
    fits: bool


def measure(df: DataFrame, limit: int = BROADCAST_LIMIT) -> Measured:
    """Whether ``df`` fits in memory, by one aggregate job that also keeps it for the join.

    The frame is computed once, in its own partitions; what exceeds the executors' memory stays on
    their disks.
    """
    held = keep(df)
    rows, size = held.agg(F.count(F.lit(1)), F.sum(_row_bytes(held).cast("long"))).first()
    return Measured(held, rows, (size or 0) <= limit)


def hot_share(df: DataFrame) -> int:
    """A key is hot when it holds at least 1/share of the rows: an average shuffle partition."""
    return max(HOT_SHARE, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(fact: DataFrame, on: str) -> DataFrame:
    """The keys (null included) that hold 1/share of the rows each; at most share of them."""
    counts = fact.groupBy(F.col(on).alias(_KEY)).count()
    total = counts.select(F.sum("count")).scalar()
    return counts.where(F.col("count") * hot_share(fact) >= total).select(_KEY)


def _match(fact: DataFrame, side: DataFrame, on: str, how: str, null_safe: bool) -> DataFrame:
    left, right = F.col(on), F.col(_KEY)
    joined = fact.join(side, left.eqNullSafe(right) if null_safe else left == right, how)
    return joined.drop(_KEY)


def _split_match(fact: DataFrame, side: DataFrame, on: str, how: str, null_safe: bool) -> DataFrame:
    """Hot keys against a broadcast of their own entries, the others by shuffle."""
    hot = F.broadcast(hot_keys(fact, on))
    hot_side = side.join(hot.withColumnRenamed(_KEY, "__hot"), F.col(_KEY).eqNullSafe(F.col("__hot")), "left_semi")
    hot_rows = _match(fact, hot, on, "left_semi", True)
    cold_rows = _match(fact, hot, on, "left_anti", True)
    return _match(hot_rows, F.broadcast(hot_side), on, how, null_safe).unionByName(
        _match(cold_rows, side, on, how, null_safe)
    )


def join_measured(
    fact: DataFrame, side: Measured, on: str, side_key: str, how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Join ``fact`` to a measured side that is unique on ``side_key``."""
    entries = side.frame.withColumnRenamed(side_key, _KEY)
    if side.fits:
        return _match(fact, F.broadcast(entries), on, how, null_safe)
    return _split_match(fact, entries, on, how, null_safe)


def lookup_join(
    fact: DataFrame,
    side: DataFrame,
    on: str,
    how: str = "inner",
    null_safe: bool = False,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Join ``fact`` to ``side`` (unique on ``on``); ``how`` is inner, left, left_semi or left_anti."""
    return join_measured(fact, measure(side, limit), on, on, how, null_safe)


def keep_new(batch: DataFrame, history: DataFrame, on: str = "ID", limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``history`` (null keys match each other).

    Only the key column of the history is read.  While the batch keys fit a broadcast
    the history is scanned in place and never shuffled; otherwise both key sets are
    reduced to distinct keys before they meet.
    """
    keys = measure(batch.select(on).distinct(), limit)
    old = history.select(on)
    if keys.fits:
        known = join_measured(old, keys, on, on, "left_semi", null_safe=True).distinct()
    else:
        known = _match(keys.frame, old.distinct().withColumnRenamed(on, _KEY), on, "left_semi", True)
    return lookup_join(batch, known, on, "left_anti", null_safe=True, limit=limit)


def map_values(
    df: DataFrame,
    columns: list[str],
    dictionary: DataFrame,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Replace values found in ``dictionary(value, translated)``; others keep their text.

    The dictionary is first cut down to the values each column holds, so what may be
    broadcast depends on the distinct values of the batch, not on the dictionary.  A
    value listed twice takes its greatest entry.
    """
    words = dictionary.groupBy("value").agg(F.max("translated").alias("translated"))
    occurring = df.select(*columns).unpivot([], columns, "column", "value").distinct()
    used = measure(occurring.join(words, "value"), limit)
    for column in columns:
        side = used.frame.where(F.col("column") == column).select(
            F.col("value").alias(_KEY), F.col("translated").alias("__translated")
        )
        entries = used._replace(frame=side) if used.fits else measure(side, limit)
        df = join_measured(df, entries, column, _KEY, "left").withColumn(
            column, F.coalesce("__translated", column)
        ).drop("__translated")
    return df


def normalise_via_dictionary(
    df: DataFrame,
    columns: list[str],
    dictionary: DataFrame,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """:func:`map_values`, then missing or empty text becomes the text for "missing"."""
    mapped = map_values(df, columns, dictionary, limit)
    return mapped.withColumns({
        c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(MISSING_TEXT)) for c in columns
    })
