"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffles from what the map side wrote and splits skewed
# join partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # HotSpot leaves methods above 8000 bytes uncompiled; past it Spark falls back to
    # smaller generated functions instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def open_session(
    app: str = "jobtide", master: str | None = None, cores: int | None = None, **extra: str
) -> SparkSession:
    """Session with :data:`SETTINGS`; ``extra`` uses ``__`` for ``.`` in names.

    ``cores`` is the number of executor cores of a cluster.  Adaptive execution merges
    small shuffle partitions but never splits a plain one, so it starts from three per core.
    """
    settings = dict(SETTINGS)
    if cores:
        settings["spark.sql.shuffle.partitions"] = str(max(200, 3 * cores))
    settings.update({name.replace("__", "."): value for name, value in extra.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
