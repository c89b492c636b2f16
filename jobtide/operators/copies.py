"""Duplicate handling that shuffles only the rows that may have a copy.

A 64-bit hash of a few key columns is counted first.  A row whose hash occurs once
cannot have a copy, so it needs no shuffle at all; the others take the exact path.
Keys that differ but share a hash only send a few rows too many down that path.

The hashes that repeat are kept in a scratch table and told to every task: as they are while
they fit a broadcast, else as a Bloom filter whose size follows from their number, so that a stated
share of the rows that are alone is mistaken at most.  Where even that filter is larger than what may
be broadcast, no row is taken for alone and all take the exact path.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.operators.aggregate import count_distinct_mart
from jobtide.operators.bloom import Bloom, bloom_filter
from jobtide.operators.lookup import BROADCAST_LIMIT
from jobtide.sources.tables import stored_scratch

_TAG = "__copy_tag"
# Memory one hash takes in a broadcast table.
_HASH_BYTES = 32
# The share of rows that are alone which a Bloom filter may mistake, and the most memory it may take.
FALSE_SHARE = 0.01
FILTER_LIMIT = 8 * BROADCAST_LIMIT


@dataclass(frozen=True)
class CopyFilter:
    """Which rows of a frame may have a copy, by a hash of its ``probe`` columns.

    It can be asked about any rows of that frame, or rows made from them with the same ``probe`` columns.
    """

    probe: tuple[str, ...]
    repeated: int  # hashes that repeat
    hashes: DataFrame | None = None  # the hashes, while they are broadcast as they are
    bloom: Bloom | None = None

    def split(self, df: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
        """``(alone, repeated)``: rows that have no copy, and the rest.  None stands for no rows."""
        if not self.repeated:
            return df, None
        tagged = df.withColumn(_TAG, F.xxhash64(*self.probe))
        if self.hashes is not None:
            sides = F.broadcast(self.hashes)
            return tuple(tagged.join(sides, _TAG, how).drop(_TAG) for how in ("left_anti", "left_semi"))
        if self.bloom is None:
            return None, df
        flagged = self.bloom.flagged(tagged, _TAG, "__again")
        return tuple(flagged.where(side).drop(_TAG, "__again") for side in (~F.col("__again"), F.col("__again")))


def copy_filter(
    df: DataFrame, probe: list[str], limit: int = BROADCAST_LIMIT, share: float = FALSE_SHARE, filter_limit: int = FILTER_LIMIT,
) -> CopyFilter:
    """Count the hashes of ``probe`` once and keep those that repeat."""
    counts = df.groupBy(F.xxhash64(*probe).alias(_TAG)).agg(F.count(F.lit(1)).alias("n"))
    again = stored_scratch(counts.where("n > 1").select(_TAG), "copies")
    repeated = again.count()
    if repeated * _HASH_BYTES <= limit:
        return CopyFilter(tuple(probe), repeated, again)
    return CopyFilter(tuple(probe), repeated, None, bloom_filter(again, _TAG, repeated, share, filter_limit))


def split_copies(
    df: DataFrame, probe: list[str], limit: int = BROADCAST_LIMIT, share: float = FALSE_SHARE
) -> tuple[DataFrame | None, DataFrame | None]:
    """``(alone, repeated)`` of a frame by its own filter.

    Rows equal in ``probe`` always land on the same side.  The second is None when nothing
    repeats, the first where a filter would be too large.
    """
    return copy_filter(df, probe, limit, share).split(df)


def distinct_split(
    df: DataFrame, columns: list[str], probe: list[str], limit: int = BROADCAST_LIMIT, again: CopyFilter | None = None
) -> DataFrame:
    """The rows of a DISTINCT over ``columns``; ``probe`` is a few of them."""
    rows = df.select(*columns)
    alone, repeated = again.split(rows) if again else split_copies(rows, probe, limit)
    if repeated is None:
        return alone
    return repeated.distinct() if alone is None else alone.unionByName(repeated.distinct())


def count_distinct_split(
    alone: DataFrame | None, repeated: DataFrame | None, dims: list[str], key: str = "ID", name: str = "total_jobs"
) -> DataFrame:
    """The rows of :func:`count_distinct_mart` over both sides of a split.

    The split must have been made on the key and some of ``dims``: then no key of a
    group is on both sides, and on the first side every non-null key counts once.
    """
    if alone is None:
        return count_distinct_mart(repeated, dims, key, name)
    single = alone.groupBy(*dims).agg(F.count(key).alias(name))
    if repeated is None:
        return single
    both = single.unionByName(count_distinct_mart(repeated, dims, key, name))
    return both.groupBy(*dims).agg(F.sum(name).alias(name))
