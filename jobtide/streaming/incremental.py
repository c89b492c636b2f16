"""The daily incremental pull: each landed file is ingested once.

A file stream remembers which landing files it has handed out.  One call lists all files
that arrived since the last, one list for each micro-batch, then takes the batches, several of them
side by side.  New rows of a call are compared with the rows stored
before it and kept beside the table until its end, one folder for each micro-batch, so that
the rows do not depend on how the files are dealt over micro-batches.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.plans.arrivals import Arrivals
from jobtide.plans.ingest import IngestReport, Layout, take_records
from jobtide.sources.landing import FILE, dealt_lines, file_lines

# Micro-batches taken at a time.  One file is read by one task and the small jobs of a batch leave cores idle;
# each batch may hold broadcasts of its own.
SIDE_BY_SIDE = 4
_FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"


def landing_stream(
    spark: SparkSession, path: str, multi_line: bool = False, files_per_batch: int | None = None,
) -> DataFrame:
    """Landed text, as :func:`jobtide.sources.landing.landed_lines` gives it."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path, wholetext=multi_line).withColumn(FILE, F.input_file_name())


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The files under ``path`` that have landed, without their content; told apart as :func:`landing_stream` does."""
    reader = spark.readStream.schema(_FILE_COLUMNS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format("binaryFile").load(path)


def _titles(landed: DataFrame) -> list[T.StructField]:
    """The columns that folders add; without a type, where all are null, they are text."""
    added = landed.drop(*T.StructType.fromDDL(_FILE_COLUMNS).names).schema.fields
    return [T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType) for f in added]


def ingest_arrivals(spark: SparkSession, layout: Layout, files_per_batch: int | None = None) -> list[IngestReport]:
    """Ingest the files that arrived since the last call; one report per micro-batch.

    ``files_per_batch`` splits a large arrival into several batches; the stored rows, or the
    error of a broken contract, are the same for every value.  The text of fewer files than there are
    cores is dealt over all of them.  A batch that fails stops the call; the next call goes on with those not taken.
    """
    arrivals = Arrivals(spark, layout)
    cores = spark.sparkContext.defaultParallelism
    few = files_per_batch is not None and files_per_batch < cores
    landed = file_stream(spark, layout.landing, files_per_batch)
    text = T.StructType([T.StructField("value", T.StringType()), *_titles(landed)])

    def hand_out(batch: DataFrame, number: int) -> None:
        arrivals.hand_out(number, [row.path for row in batch.collect()])

    def take(number: int, files: list[str]) -> IngestReport:
        lines = file_lines(spark, files, text, layout.landing, layout.multi_line)
        taken = take_records(dealt_lines(lines, cores) if few else lines, layout, f"arrival={number}", arrivals.rows(number))
        arrivals.took(number, taken.maybe_absent, files)
        return taken.report

    query = (
        landed.select("path").writeStream.foreachBatch(hand_out)
        .option("checkpointLocation", layout.table("_arrivals"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(take), *batch) for batch in arrivals.handed_out().items()]
        try:
            reports = [batch.result() for batch in running]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise
    arrivals.store()
    return reports


def total_report(reports: list[IngestReport]) -> IngestReport:
    """The counts of all micro-batches of a call."""
    counts = {name: sum(r.counts[name] for r in reports) for name in ("landed", "rejected", "title_kept", "appended")}
    status = "loaded" if counts["appended"] else "nothing_new" if counts["title_kept"] else "no_data"
    return IngestReport(status, counts)
