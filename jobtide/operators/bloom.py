"""Bloom filters of 64-bit hashes as DataFrames: built by shuffled bitmaps, asked by one broadcast join.

A filter is cut into blocks of one bitmap each.  A hash belongs to one block, in which a few bits
are set for it, so that asking is a join on the block and a test of these bits.  The size
follows from the number of hashes and the share of strangers that may be mistaken.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.sources.tables import stored_scratch

# Fixed by Spark: bits of one bitmap of its bitmap functions.
_BITMAP_BITS = 1 << 15
# Bits set for a hash; each is 15 bits of one of two further hashes.
_PROBES = 6


def blocks_for(hashes: int, share: float) -> int:
    """Blocks of a filter: the size for half the share, as hashes are dealt unevenly."""
    bits = -_PROBES / log(1 - (share / 2) ** (1 / _PROBES))
    return max(1, ceil(hashes * bits / _BITMAP_BITS))


def _places(tag: Column) -> list[Column]:
    """The bits of a hash within its block."""
    wide, narrow = F.xxhash64(tag), F.hash(tag).cast("bigint")
    mask = F.lit(_BITMAP_BITS - 1).cast("bigint")
    return [F.shiftrightunsigned(wide, 15 * k).bitwiseAND(mask) for k in range(4)] + [
        F.shiftrightunsigned(narrow, 15 * k).bitwiseAND(mask) for k in range(_PROBES - 4)]


def _words(bitmap: str) -> Column:
    """A bitmap as whole numbers of 32 bits, which are looked up without making texts of bytes."""
    def word(i: Column) -> Column:
        first = F.lit(0).cast("bigint")
        for k in range(4):
            byte = F.conv(F.hex(F.substring(F.col(bitmap), i * 4 + k + 1, F.lit(1))), 16, 10).cast("bigint")
            first = first + F.call_function("shiftleft", byte, F.lit(8 * k))
        return F.when(first >= 1 << 31, first - (1 << 32)).otherwise(first).cast("int")

    return F.transform(F.sequence(F.lit(0), F.lit(_BITMAP_BITS // 32 - 1)), word)


@dataclass(frozen=True)
class Bloom:
    """A stored filter: (block, words of its bitmap) rows, small enough to be broadcast."""

    blocks: int
    maps: DataFrame

    def flagged(self, df: DataFrame, tag: str, name: str) -> DataFrame:
        """``df`` with whether the hash in column ``tag`` may be in the filter."""
        def bit(place: Column) -> Column:
            word = F.get("__map", F.shiftright(place, 5).cast("int"))
            return F.getbit(word, place.bitwiseAND(F.lit(31).cast("bigint")).cast("int")) == 1

        is_set = F.coalesce(reduce(lambda a, b: a & b, map(bit, _places(F.col(tag)))), F.lit(False))
        joined = df.join(F.broadcast(self.maps), F.pmod(F.col(tag), F.lit(self.blocks)) == F.col("__block"), "left")
        return joined.withColumn(name, is_set).drop("__block", "__map")


def bloom_filter(hashes: DataFrame, tag: str, count: int, share: float, limit: int) -> Bloom | None:
    """A filter of ``count`` hashes; None where it would take more than ``limit`` bytes."""
    blocks = blocks_for(count, share)
    if blocks * _BITMAP_BITS // 8 > limit:
        return None
    bits = hashes.select(
        F.pmod(F.col(tag), F.lit(blocks)).alias("__block"), F.explode(F.array(*_places(F.col(tag)))).alias("__bit"))
    maps = bits.groupBy("__block").agg(F.bitmap_construct_agg("__bit").alias("__map"))
    return Bloom(blocks, stored_scratch(maps.select("__block", _words("__map").alias("__map")), "bloom"))
