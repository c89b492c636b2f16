"""Documents packed into sequences of a fixed number of tokens.

Only lengths matter for the packing, and there are at most ``capacity`` of them.  Lengths are
counted over all documents; the plan is made from the counts, a table of bounded size:

1. *Martello-Toth reduction.*  For a length, a small set of documents with it is fixed for
   good when it provably dominates every other set it could be in: an exact fit; the largest
   partner where no two others fit; the largest pair where no three others fit and each
   other pair goes into it piece by piece.  It is repeated until nothing changes.
2. *Best fit decreasing* of the rest, by counts: equal documents go into equally full
   sequences together, with the same result as one by one.

A plan is a list of patterns with how often each is used.  Documents are ranked within their
length by salted parts, so a length that a third of all documents share is spread over tasks,
and each finds its sequence and place from its rank.

Only documents longer than a sequence are cut, into full pieces; the first piece has what is
left over.  Null text is empty: one end token.  Rows that repeat stay apart, and get places of
their own.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import salted_ranks, short_batches, shuffle_parts, stored, table, tidy
from jobtide.llm.tokens import default_tokenizer, encoder

CAPACITY, END_ID = 2048, 0
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

# A pattern: (length, how many of it) in the order they stand in the sequence.
Pattern = tuple[tuple[int, int], ...]


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their lengths and checksums."""

    @partial(tidy, uses="encoder")
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names: list[int | None] = []
            rows: list[tuple[int, int, int, int]] = []
            found = encoder(tokenizer).encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), found):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    names.append(doc_id)
                    rows.append((piece, start, length, zlib.crc32(ids[start:start + length].tobytes())))
            columns = list(zip(*rows)) or [[], [], [], []]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    short_batches(docs.sparkSession)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(pieces, PIECE_SCHEMA)


class _Counts:
    """How many documents of each length are left."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()

    def largest(self, limit: int, *taken: int) -> int:
        """The largest length up to ``limit`` that is there besides those taken; 0 for none."""
        for size in np.flatnonzero(self.left[:max(limit, 0) + 1])[::-1].tolist():
            if self.left[size] > taken.count(size):
                return size
        return 0

    def smallest_sum(self, how_many: int, *taken: int) -> float:
        """The sum of the smallest lengths besides those taken."""
        total, need = 0, how_many
        for size in np.flatnonzero(self.left).tolist():
            here = min(need, int(self.left[size]) - taken.count(size))
            if here > 0:
                total, need = total + here * size, need - here
            if not need:
                return total
        return float("inf")

    def fix(self, sizes: tuple[int, ...]) -> tuple[Pattern, int]:
        """Take the set as often as its documents allow."""
        need = {s: sizes.count(s) for s in sizes}
        times = min(int(self.left[s]) // n for s, n in need.items())
        for s, n in need.items():
            self.left[s] -= times * n
        return tuple(need.items()), times


def _pair_dominates(counts: _Counts, w: int, a: int, b: int, room: int) -> bool:
    """Whether every pair that fits beside ``w`` goes into the pair (a, b): both into a, or one into each."""
    sizes = np.flatnonzero(counts.left[:room + 1])
    for y in sizes[(sizes > b) & (sizes <= room // 2)].tolist():
        x = counts.largest(room - y, w, y)
        if x >= y and x + y > a:
            return False
    return True


def dominant_set(counts: _Counts, w: int, capacity: int) -> tuple[int, ...] | None:
    """A set with ``w`` that dominates all others with it, if one can be proved."""
    room = capacity - w
    best = counts.largest(room, w)
    if not best:
        return (w,)
    if best == room or counts.smallest_sum(2, w) > room:
        return (w, best)
    if counts.smallest_sum(3, w) > room:
        second = counts.largest(room - best, w, best)
        if second and _pair_dominates(counts, w, best, second, room):
            return (w, best, second)
    return None


def reduce_counts(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[list[tuple[Pattern, int]], np.ndarray]:
    """Fixed patterns, and the counts that are left."""
    state, fixed, changed = _Counts(counts), [], True
    while changed:
        changed = False
        for w in np.flatnonzero(state.left)[::-1].tolist():
            while state.left[w] and (sizes := dominant_set(state, w, capacity)):
                pattern, times = state.fix(sizes)
                if not times:
                    break
                fixed.append((pattern, times))
                changed = True
    return fixed, state.left


def best_fit(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Best fit decreasing on counts."""
    open_: list[list[tuple[Pattern, int]]] = [[] for _ in range(capacity + 1)]
    for w in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[w])
        while left:
            room = next((r for r in range(w, capacity + 1) if open_[r]), None)
            if room is None:
                room = capacity
                open_[room].append(((), -(-left // (capacity // w))))
            pattern, times = open_[room].pop()
            each = room // w
            full = min(times, left // each)
            if full:
                open_[room - each * w].append((pattern + ((w, each),), full))
                left -= full * each
            rest = times - full
            if rest and left:
                open_[room - left * w].append((pattern + ((w, left),), 1))
                left, rest = 0, rest - 1
            if rest:
                open_[room].append((pattern, rest))
    return [entry for group in open_ for entry in group if entry[0]]


class Places:
    """Sequence and offset of a document from its length and its rank among equal lengths."""

    def __init__(self, plan: list[tuple[Pattern, int]]):
        taken: dict[int, int] = {}
        rows, base = [], 0
        for pattern, times in plan:
            offset = 0
            for size, each in pattern:
                start = taken.get(size, 0)
                rows.append((size, start, base, each, offset))
                taken[size] = start + each * times
                offset += size * each
            base += times
        rows.sort()
        self._rows = np.array(rows, np.int64).reshape(-1, 5)
        self._keys = self._rows[:, 0] << 50 | self._rows[:, 1]

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self._keys, length << 50 | rank, "right") - 1
        size, start, base, each, offset = self._rows[at].T
        return base + (rank - start) // each, offset + (rank - start) % each * size


def plan_sequences(lengths: DataFrame, capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """The plan for a table with a ``length`` column of 1 to ``capacity``."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in lengths.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    fixed, left = reduce_counts(counts, capacity)
    return fixed + best_fit(left, capacity)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces."""
    places = Places(plan_sequences(pieces, capacity))
    ranked = salted_ranks(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], shuffle_parts(pieces.sparkSession))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places.of(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.withColumn("_place", placed("length", "rank")).select(*pieces.columns, "_place.sequence_id", "_place.offset")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(stored(token_pieces(docs, default_tokenizer()), "pieces"))
