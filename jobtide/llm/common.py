"""Small helpers shared by the text operators: reading, scratch tables, native expressions."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.sources.tables import stored_scratch

# A-Z only, as the word rules ask; other letters stay as they are.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Sides of a join up to this many bytes are broadcast; larger ones are shuffled.
BROADCAST_BYTES = 64 << 20
# Rows of a narrow table that a task writes and a file holds.
ROWS_A_FILE = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write to the shared scratch folder and read back, so that no lineage is left.

    The folder is deleted when the driver ends.  ``files`` is the most there are to be: a table of
    few rows in as many files as there are shuffle partitions is slow to write and to read, and where
    the folder is a local one, Hadoop forks the executor several times a file to set its permissions.
    """
    return stored_scratch(df.coalesce(files) if files else df, name)


def files_for(rows: int, rows_a_file: int = ROWS_A_FILE) -> int:
    """Files for a table of some dozens of bytes a row."""
    return 1 + rows // rows_a_file


def short_batches(spark: SparkSession) -> None:
    """Let tasks hand texts to Python in short batches, for the rest of the session.

    A batch is held several times over (in the JVM, on its way, in Python), and ten thousand
    rows, Spark's default, are a lot when each is a text.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))


# What this process keeps from one task for later ones, by name, with a call that lets go of it.
_kept: dict[str, Callable[[], None]] = {}


def keep_between_tasks(name: str, let_go: Callable[[], None]) -> None:
    _kept[name] = let_go


def tidy(task: Callable[[Iterator], Iterator], uses: str | None = None) -> Callable[[Iterator], Iterator]:
    """A task that gives freed memory back at its end, as its process lives on beside other tasks.

    Of what the process keeps only what the task ``uses`` is left, so a step does not carry the memos of
    the steps before it.
    """

    @functools.wraps(task)
    def run(batches: Iterator) -> Iterator:
        for name, let_go in _kept.items():
            if name != uses:
                let_go()
        try:
            yield from task(batches)
        finally:
            # What a task was sent refers to itself in circles.
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


def unused(df: DataFrame, name: str) -> str:
    """A column name near ``name`` that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    Plain columns are substituted into every place that names them, lambda bodies included.
    """
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_enough(rows: int, bytes_per_row: int, limit: int = BROADCAST_BYTES) -> bool:
    return rows * bytes_per_row <= limit


def maybe_broadcast(df: DataFrame, rows: int, bytes_per_row: int) -> DataFrame:
    """Broadcast a side whose counted size is below the limit, else leave it to a shuffle."""
    return F.broadcast(df) if small_enough(rows, bytes_per_row) else df


def running_sums(values: Column, block: int = 64) -> Column:
    """Inclusive running sums of an array in two levels, near linear for long arrays."""

    def add(acc, x):
        return acc + x

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def sums(v: Column) -> Column:
        n_blocks = F.ceil(F.size(v) / F.lit(block)).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), n_blocks - 1), lambda b: total(F.slice(v, b * block + 1, F.lit(block)))
        )
        return let(
            blocks,
            lambda bs: let(
                F.transform(bs, lambda _, b: F.when(b == 0, F.lit(0).cast("bigint")).otherwise(
                    total(F.slice(bs, F.lit(1), b)))),
                lambda before: F.transform(
                    v,
                    lambda _, k: before[F.floor(k / F.lit(block)).cast("int")]
                    + total(F.slice(v, F.floor(k / F.lit(block)).cast("int") * block + 1, k % block + 1)),
                ),
            ),
        )

    empty = F.array().cast("array<bigint>")
    return let(values.cast("array<bigint>"), lambda v: F.when(F.size(v) > 0, sums(v)).otherwise(empty))


def salted_ranks(df: DataFrame, keys: Sequence[str], order: Sequence[str], salts: int, name: str = "rank") -> DataFrame:
    """Gapless rank from 0 within ``keys`` without bringing a key's rows together.

    Rows of a key are spread over ``salts`` parts by the hash of the order columns; ranks
    are counted inside the parts and shifted by the sizes of the parts before.  ``df`` has
    to be a stored table, as it is read twice.
    """
    keyed = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    sizes = keyed.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    over = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    before = F.sum("_n").over(over.orderBy("_salt").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_n")
    shifts = sizes.select(
        *[F.col(c).alias(f"_own_{c}") for c in keys], F.col("_salt").alias("_own_salt"), before.alias("_before"))
    inside = F.row_number().over(W.partitionBy(*keys, "_salt").orderBy(*order)) - 1
    on = [F.col(c).eqNullSafe(F.col(f"_own_{c}")) for c in keys] + [F.col("_salt") == F.col("_own_salt")]
    joined = keyed.withColumn("_inside", inside).join(shifts, on, "inner")
    return joined.select(*df.columns, (F.col("_inside") + F.col("_before")).cast("bigint").alias(name))


def salted_offsets(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], salts: int, name: str) -> DataFrame:
    """Sum of ``value`` over the rows before each one within ``keys``, in salted parts as in
    :func:`salted_ranks`.  ``df`` has to be a stored table."""
    keyed = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    sizes = keyed.groupBy(*keys, "_salt").agg(F.sum(value).alias("_n"))
    over = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    rows = (W.unboundedPreceding, W.currentRow)
    before = F.sum("_n").over(over.orderBy("_salt").rowsBetween(*rows)) - F.col("_n")
    shifts = sizes.select(
        *[F.col(c).alias(f"_own_{c}") for c in keys], F.col("_salt").alias("_own_salt"), before.alias("_before"))
    inside = F.sum(value).over(W.partitionBy(*keys, "_salt").orderBy(*order).rowsBetween(*rows)) - F.col(value)
    on = [F.col(c).eqNullSafe(F.col(f"_own_{c}")) for c in keys] + [F.col("_salt") == F.col("_own_salt")]
    joined = keyed.withColumn("_inside", inside).join(shifts, on, "inner")
    return joined.select(*df.columns, (F.col("_inside") + F.col("_before")).cast("bigint").alias(name))
