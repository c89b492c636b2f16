"""Ingest of the whole landing folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

from jobtide.plans.arrivals import Arrivals
from jobtide.plans.ingest import IngestReport, Layout, settled_absent, take_records
from jobtide.sources.landing import landed_lines


def ingest(spark: SparkSession, layout: Layout) -> IngestReport:
    """Ingest everything under the landing directory: the backfill.  The daily run takes arrivals.

    Running it again adds nothing.
    """
    arrivals = Arrivals(spark, layout, resume=False)
    lines = landed_lines(spark, layout.landing, layout.multi_line)
    taken = take_records(lines, layout, "backfill", arrivals.rows("all"))
    arrivals.note("all", settled_absent(lines, taken.maybe_absent))
    arrivals.store(keep_broken=False)
    return taken.report
