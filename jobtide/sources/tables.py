"""Parquet tables by path: scan, append, full refresh, scratch tables.

A table that is refreshed has its rows in ``version-<id>`` folders.  Small numbered files under
``_pointers`` list the folders that make up the table, after a mark of what it was made from; the
greatest number is the current one.  A refresh writes a folder, then one pointer, whose
appearance is the only step that readers see.

A table that is appended to can be bucketed on a key: rows with equal keys are in files of
the same bucket, so that grouping on the key and more needs no exchange.  Spark keeps such a
layout in its catalog; the number of buckets is kept beside the rows, and every session
registers the folder under a name of its own when it first meets it.
"""

from __future__ import annotations

import atexit
import hashlib
import json
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.functions.text import has_substring
from jobtide.operators.project import align_to
from jobtide.schema import SEARCH_TITLES

_POINTERS, _VERSION, _BUCKETS = "_pointers", "version-", "_buckets"
# A table of more folders than this is written as one when the next is added.
MOST_FOLDERS = 32
_local_scratch: dict[str, str] = {}
# Settings belong to the session, which batches taken side by side share.
_settings = threading.RLock()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_scratch:
        folder = tempfile.mkdtemp(prefix="jobtide-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_scratch[context.applicationId] = folder
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the scratch folder, deleted when the driver ends."""
    path = scratch_path(spark, name)
    fs, target = _filesystem(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return path


def stored_scratch(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the scratch folder and read back; deleted when the driver ends."""
    path = f"{scratch_folder(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _filesystem(spark, path)
    fs.delete(target, True)


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    fs, source = _filesystem(spark, path)
    target = _filesystem(spark, to)[1]
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"cannot move {path} to {to}")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none where there is no folder."""
    fs, target = _filesystem(spark, path)
    names = (f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else ()
    return sorted(name for name in names if not name.startswith("."))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside its place and moved there; an existing one is replaced."""
    beside = f"{path}__{uuid.uuid4().hex}"
    fs, target = _filesystem(spark, beside)
    out = fs.create(target)
    out.write(bytearray(text.encode()))
    out.close()
    delete_path(spark, path)
    rename_path(spark, beside, path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _filesystem(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@dataclass(frozen=True)
class Version:
    """The folders of a table, and a number for what they were made from."""

    number: int
    upto: int
    folders: tuple[str, ...]


def _pointers(spark: SparkSession, path: str) -> list[str]:
    return [name for name in list_names(spark, f"{path}/{_POINTERS}") if name.isdigit()]


def current_version(spark: SparkSession, path: str) -> Version | None:
    """None for a table that was never refreshed."""
    pointers = _pointers(spark, path)
    if not pointers:
        return None
    upto, *folders = read_text(spark, f"{path}/{_POINTERS}/{pointers[-1]}").split()
    return Version(int(pointers[-1]), int(upto), tuple(folders))


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    with _settings:
        before = spark.conf.get(name, None)
        spark.conf.set(name, value)
        try:
            yield
        finally:
            spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _listing(spark: SparkSession):
    """Inside, many folders are listed by a few tasks for each core, not by one task for each folder."""
    tasks = str(max(8, 2 * spark.sparkContext.defaultParallelism))
    return _setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks)


def bucket_spec(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """(key, number of buckets) of a bucketed table."""
    if not table_exists(spark, f"{path}/{_BUCKETS}"):
        return None
    key, number, *_ = read_text(spark, f"{path}/{_BUCKETS}").split()
    return key, int(number)


def _registered(spark: SparkSession, path: str) -> str:
    """The name of a bucketed table in this session's catalog."""
    name = f"jobtide_{hashlib.md5(path.encode()).hexdigest()}"
    if not spark.catalog.tableExists(name):
        text = read_text(spark, f"{path}/{_BUCKETS}")
        head, schema = text.split("\n", 1)
        key, number, *partition_by = head.split()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(schema)).fields)
        parted = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        # The folders themselves say which partitions there are.
        with _setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false"):
            spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet {parted} "
                f"CLUSTERED BY (`{key}`) INTO {number} BUCKETS LOCATION '{path}'")
    return name


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of a table: appended to, bucketed or refreshed."""
    with _listing(spark):
        if bucket_spec(spark, path):
            name = _registered(spark, path)
            spark.catalog.refreshTable(name)
            table = spark.table(name)
            return table if schema is None else table.select(*[c for c in schema.names if c in table.columns])
        reader = spark.read.schema(schema) if schema is not None else spark.read
        version = current_version(spark, path)
        return reader.parquet(*[f"{path}/{folder}" for folder in version.folders] if version else [path])


def create_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    buckets: tuple[str, int] | None = None,
) -> None:
    """An empty table with a fixed schema; ``buckets`` is (key, number).

    Each bucket is read by one task, so their number is chosen for the size that the table will have.
    """
    if table_exists(spark, path):
        raise ValueError(f"table {path} already exists")
    if buckets:
        head = " ".join([buckets[0], str(buckets[1]), *partition_by])
        write_text(spark, f"{path}/{_BUCKETS}", f"{head}\n{schema.json()}")
        return
    _writer(spark.createDataFrame([], schema), partition_by).parquet(path)


def _writer(df: DataFrame, partition_by: Sequence[str]):
    return df.write.partitionBy(*partition_by) if partition_by else df.write


def existing_postings(df: DataFrame, phrases: list[str] = SEARCH_TITLES, column: str = "TITLE") -> DataFrame:
    """Keys of the stored postings whose title contains a searched phrase.

    Two columns leave the scan, whatever the width of the table.
    """
    return df.where(has_substring(F.col(column), phrases)).select("ID")


def append_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> None:
    """Append to an existing table after aligning columns by name; any failure raises.

    With partition columns the rows are rebalanced on them first: few files per
    partition, and a partition holding most of the batch is split over several tasks.  Rows for a
    bucketed table are dealt by its key, so that each task writes one bucket.
    """
    spark = df.sparkSession
    if not table_exists(spark, path):
        raise ValueError(f"target table {path} does not exist")
    try:
        target = read_table(spark, path, schema)
    except AnalysisException as error:
        raise ValueError(f"target table {path} cannot be read") from error
    rows = align_to(df, target)
    if buckets := bucket_spec(spark, path):
        name = _registered(spark, path)
        with _listing(spark):
            rows.select(*spark.table(name).columns).repartition(buckets[1], buckets[0]).write.insertInto(name)
        return
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    _writer(rows, partition_by).mode("append").parquet(path)


def _point(spark: SparkSession, path: str, before: Version | None, upto: int, folders: Sequence[str]) -> None:
    """Make ``folders`` the table.  Someone else's refresh that took the number first is an error."""
    number = before.number + 1 if before else 0
    waiting = f"{path}/{_POINTERS}/waiting-{uuid.uuid4().hex}"
    write_text(spark, waiting, "\n".join([str(upto), *folders]))
    try:
        rename_path(spark, waiting, f"{path}/{_POINTERS}/{number:012d}")
    except BaseException:
        delete_path(spark, waiting)
        raise


def _write_version(
    df: DataFrame, path: str, kept: Sequence[str], before: Version | None, partition_by: Sequence[str], upto: int,
) -> DataFrame:
    spark = df.sparkSession
    folder = f"{_VERSION}{uuid.uuid4().hex}"
    try:
        _writer(df.hint("rebalance", *partition_by) if partition_by else df, partition_by).parquet(f"{path}/{folder}")
        _point(spark, path, before, upto, [*kept, folder])
    except BaseException:
        delete_path(spark, f"{path}/{folder}")
        raise
    in_use = {_POINTERS, folder, *kept, *(before.folders if before else ())}
    for name in list_names(spark, path):
        if name not in in_use:
            delete_path(spark, f"{path}/{name}")
    current = _pointers(spark, path)[-1]
    for name in list_names(spark, f"{path}/{_POINTERS}"):
        if name != current:
            delete_path(spark, f"{path}/{_POINTERS}/{name}")
    spark.catalog.refreshByPath(path)
    return spark.read.schema(df.schema).parquet(*[f"{path}/{f}" for f in (*kept, folder)])


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), upto: int = 0) -> DataFrame:
    """Full refresh: write a new version, then point to it; the new table is returned.

    Whatever stops between two steps, readers find the old table or the new one.  The folders of
    the version before stay for those who are reading it; older ones, and what a stopped refresh
    left, are deleted.  ``upto`` is kept with the version.
    """
    return _write_version(df, path, (), current_version(df.sparkSession, path), partition_by, upto)


def extend_table(df: DataFrame, path: str, upto: int) -> DataFrame:
    """Add rows to a refreshed table as a version of its own: the folders there are, and one more.

    Before that more than ``MOST_FOLDERS`` folders are written as one.
    """
    spark = df.sparkSession
    before = current_version(spark, path)
    if before is None:
        raise ValueError(f"table {path} was never refreshed")
    if len(before.folders) >= MOST_FOLDERS:
        overwrite_table(read_table(spark, path, df.schema), path, upto=before.upto)
        before = current_version(spark, path)
    return _write_version(df, path, before.folders, before, (), upto)


def newest_part(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that the last refresh added."""
    return spark.read.schema(schema).parquet(f"{path}/{current_version(spark, path).folders[-1]}")


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a reused result in memory for the duration of a block."""
    held = df.persist()
    try:
        yield held
    finally:
        held.unpersist()
