"""The daily run: ingest, then every model in dependency order.

The first run builds all models from the cleaned table.  Later runs extend them by the rows that
arrived since: an ID is stored by one call only, so counts of distinct IDs add up, links and
conformed rows are added, and only where arrivals change the state of a city are the postings of
that city made anew.  Every model notes the last call it was made from; if they disagree, as
after a run that stopped between two of them, all are built again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.rules import standard_city
from jobtide.operators.copies import copy_filter
from jobtide.operators.lookup import lookup_join, lookup_scope, measure
from jobtide.operators.trend import wow_trend
from jobtide.plans.arrivals import Arrivals
from jobtide.plans.conformed import conformed_postings, posting_links
from jobtide.plans.dimensions import city_dimension, seniority_dimension, state_dimension, state_lookup
from jobtide.plans.ingest import IngestReport, Layout
from jobtide.plans.marts import MART_DIMS, MART_PROBE, count_marts, mart, merged_mart
from jobtide.schema import CLEANED_COLUMNS, CLEANED_SCHEMA
from jobtide.sources.tables import (
    create_table,
    current_version,
    extend_table,
    newest_part,
    overwrite_table,
    read_table,
    table_exists,
)
from jobtide.streaming.incremental import ingest_arrivals, total_report

DIMENSIONS = ["base_city", "base_state", "base_seniority"]
MARTS = [*MART_DIMS, "daily"]
MODELS = [*DIMENSIONS, "conformed", "posting_links", *MARTS]


@dataclass(frozen=True)
class RunResult:
    ingest: IngestReport
    tables: dict[str, DataFrame]


def _cleaned(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_table(spark, layout.cleaned, CLEANED_SCHEMA).select(*CLEANED_COLUMNS)


def made_from(spark: SparkSession, layout: Layout) -> int | None:
    """The last call that all models were made from; None if there is none."""
    versions = [current_version(spark, layout.table(name)) for name in MODELS]
    calls = {version.upto if version else None for version in versions}
    return calls.pop() if len(calls) == 1 else None


def _together(jobs: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Models that do not need each other, made at the same time, as most are too small to fill a cluster."""
    def run(job: Callable[[], DataFrame]) -> DataFrame:
        with lookup_scope():
            return job()

    with ThreadPoolExecutor(len(jobs)) as pool:
        return dict(zip(jobs, pool.map(run, jobs.values())))


def build_models(spark: SparkSession, layout: Layout, upto: int = 0) -> dict[str, DataFrame]:
    """Build all models but the trend from the cleaned table.

    Each is written once and read back, so a later model sees pruned columns of a
    stored table instead of recomputing the ones before it.  Postings that may have copies are
    found once for all of them.  No model is split by date: none of the reads filters on it, and
    laying the conformed table out by date would shuffle its full width a second time.
    """
    cleaned = _cleaned(spark, layout)

    def store(name: str, df: DataFrame) -> DataFrame:
        return overwrite_table(df, layout.table(name), upto=upto)

    with lookup_scope():
        again = copy_filter(cleaned, MART_PROBE)
        placed = {"in_place": True} if layout.buckets else {"again": again}
        tables = _together({
            "base_city": lambda: store("base_city", city_dimension(cleaned)),
            "base_seniority": lambda: store("base_seniority", seniority_dimension(cleaned)),
            "posting_links": lambda: store("posting_links", posting_links(cleaned, **placed)),
        })
        tables["base_state"] = store("base_state", state_dimension(tables["base_city"]))
        tables["conformed"] = store("conformed", conformed_postings(cleaned, tables["base_state"], **placed))
        counted = count_marts(tables["conformed"], again)
        tables.update(_together({name: partial(store, name, made) for name, made in counted.items()}))
    return tables


def _made_anew(
    cleaned: DataFrame, conformed: DataFrame, new: DataFrame, changed: DataFrame, states: DataFrame,
) -> DataFrame:
    """The conformed table where the state of a city has changed: its postings are made again from all their copies."""
    cities = cleaned.select("ID", standard_city(F.col("CITY")).alias("CITY"))
    touched = lookup_join(cities, changed, "CITY", "left_semi").select("ID").distinct()
    anew = lookup_join(cleaned, touched, "ID", "left_semi", null_safe=True)
    rest = lookup_join(new, touched, "ID", "left_anti", null_safe=True)
    kept = lookup_join(conformed, touched, "ID", "left_anti", null_safe=True)
    return kept.unionByName(conformed_postings(anew.unionByName(rest), states))


def extend_models(spark: SparkSession, layout: Layout, new: DataFrame, upto: int) -> dict[str, DataFrame]:
    """Extend all models but the trend by ``new``, rows of the cleaned table whose IDs no model has.

    Only the dimensions and marts, which are small beside the postings, are written again.  The
    cleaned table is read only where the state of a city has changed.
    """
    old = {name: read_table(spark, layout.table(name)) for name in MODELS}

    def store(name: str, df: DataFrame) -> DataFrame:
        return overwrite_table(df, layout.table(name), upto=upto)

    with lookup_scope():
        tables = _together({
            "base_city": lambda: store("base_city", old["base_city"].unionByName(city_dimension(new)).distinct()),
            "base_seniority": lambda: store(
                "base_seniority", old["base_seniority"].unionByName(seniority_dimension(new)).distinct()),
            "posting_links": lambda: extend_table(posting_links(new), layout.table("posting_links"), upto),
        })
        tables["base_state"] = store("base_state", state_dimension(tables["base_city"]))
        before = state_lookup(old["base_state"]).withColumnRenamed("STATE_STANDARDIZED", "before")
        moved = state_lookup(tables["base_state"]).join(before, "CITY_STANDARDIZED").where(
            ~F.col("STATE_STANDARDIZED").eqNullSafe(F.col("before")))
        changed = measure(moved.select(F.col("CITY_STANDARDIZED").alias("CITY")))
        added = conformed_postings(new, tables["base_state"])
        if changed.rows:
            whole = _made_anew(_cleaned(spark, layout), old["conformed"], new, changed.frame, tables["base_state"])
            tables["conformed"] = store("conformed", whole)
        else:
            tables["conformed"] = extend_table(added, layout.table("conformed"), upto)
            added = newest_part(spark, layout.table("conformed"), added.schema)
        merged = {name: merged_mart(old[name], counted) for name, counted in count_marts(added).items()}
        if changed.rows:
            merged["by_state"] = mart(tables["conformed"], "by_state")
        tables.update(_together({name: partial(store, name, made) for name, made in merged.items()}))
    return tables


def refresh_models(spark: SparkSession, layout: Layout, as_of: dt.date, whole: bool = False) -> dict[str, DataFrame]:
    """Bring all eleven models up to what is stored; ``whole`` builds them again in any case."""
    arrivals = Arrivals(spark, layout)
    upto = None if whole else made_from(spark, layout)
    new = {} if upto is None else arrivals.stored_after(upto)
    if upto is None:
        tables = build_models(spark, layout, arrivals.last_stored())
    elif new:
        tables = extend_models(spark, layout, reduce(DataFrame.unionByName, new.values()), max(new))
    else:
        tables = {name: read_table(spark, layout.table(name)) for name in MODELS}
    arrivals.drop(arrivals.last_stored())
    tables["wow_trend"] = overwrite_table(wow_trend(tables["daily"], as_of), layout.table("wow_trend"))
    return tables


def refresh(spark: SparkSession, layout: Layout, as_of: dt.date, whole: bool = False) -> RunResult:
    """Ingest what has landed since the last run, then bring the models up to it as of ``as_of``."""
    if not table_exists(spark, layout.cleaned):
        buckets = ("ID", layout.buckets) if layout.buckets else None
        create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by, buckets)
    report = total_report(ingest_arrivals(spark, layout))
    return RunResult(report, refresh_models(spark, layout, as_of, whole))
