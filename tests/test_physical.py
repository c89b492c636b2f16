"""What Spark makes of the plans, over stored tables."""

import datetime as dt
import re

import pytest

from checks import fixtures as X
from jobtide.operators import lookup, trend
from jobtide.operators.copies import split_copies
from jobtide.operators.filters import facet_filter
from jobtide.plans import conformed as conf
from jobtide.plans import dimensions as dims
from jobtide.plans import listings as lst
from jobtide.plans.ingest import clean_records
from jobtide.plans.marts import count_marts, mart
from jobtide.schema import CLEANED_SCHEMA
from jobtide.sources import tables
from jobtide.sources.tables import existing_postings

from conftest import SMALL


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "cleaned")
    X.postings(spark, SMALL).write.parquet(path)
    return spark.read.parquet(path)


def plan(df, capfd=None):
    return df._jdf.queryExecution().executedPlan().toString()


def full_plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def read_columns(text):
    return [set(re.findall(r"(\w+):", m)) for m in re.findall(r"ReadSchema: struct<([^\n]*)>", text)]


def test_conformed_is_map_only_without_copies(stored):
    text = plan(conf.conformed_postings(stored))
    wide = text.split("InMemoryRelation")[0]
    assert "BroadcastHashJoin" in wide
    assert "Exchange hashpartitioning" not in wide and "SortMergeJoin" not in wide
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_a_bucketed_table_is_collapsed_where_it_lies(spark, tmp_path):
    path = str(tmp_path / "bucketed")
    tables.create_table(spark, path, CLEANED_SCHEMA, buckets=("ID", 4))
    tables.append_table(X.sightings(spark, SMALL), path, schema=CLEANED_SCHEMA)
    text = plan(conf.conformed_postings(tables.read_table(spark, path, CLEANED_SCHEMA), in_place=True))
    below = text[text.index("HashAggregate(keys=[ID"):]
    # The scan, which says that it is bucketed, comes before the lookup sides and what they were made by.
    wide = below[:below.index("Bucketed: true")]
    assert "Exchange hashpartitioning" not in wide and "Sort" not in wide
    links = plan(conf.posting_links(tables.read_table(spark, path, CLEANED_SCHEMA), in_place=True))
    assert "Exchange" not in links and "Bucketed: true" in links


def test_finding_new_rows_counts_no_side_in_one_task(stored):
    text = plan(lookup.keep_new(stored, stored.select("ID")))
    assert "SinglePartition" not in text and "Limit" not in text
    lookup.release()


def test_large_dimensions_are_not_broadcast_whole(stored):
    text = plan(lookup.lookup_join(stored.select("ID", "CITY"), dims.city_lookup(dims.city_dimension(stored)), "CITY", limit=-1))
    assert "Union" in text and "CartesianProduct" not in text


def test_mart_reads_few_columns(stored, capsys):
    text = full_plan(mart(conf.conformed_postings(stored), "by_state"), capsys)
    scans = read_columns(text)
    assert {"ID", "JOB_CATEGORY", "CITY", "SENIORITY"} in scans
    assert all("LINKEDIN_ORG_DESCRIPTION" not in s for s in scans)


def test_shared_marts_shuffle_counts_only(stored):
    for name, made in count_marts(stored.drop("SENIORITY")).items():
        text = plan(made)
        assert "ID" not in "".join(re.findall(r"hashpartitioning\(([^)]*)\)", text)), name


def test_existing_postings_reads_two_columns(stored, capsys):
    assert read_columns(full_plan(existing_postings(stored), capsys)) == [{"ID", "TITLE"}]


def test_history_is_not_shuffled(stored):
    batch = stored.select("ID", "CITY").where("CITY = 'Woden'")
    text = plan(lookup.keep_new(batch, stored))
    assert "SortMergeJoin" not in text
    assert re.search(r"BroadcastHashJoin.*LeftAnti", text) and re.search(r"BroadcastHashJoin.*LeftSemi", text)


def test_details_filter_reaches_the_scan(stored, capsys):
    text = full_plan(facet_filter(lst.job_details(stored), Job_Role="Data Analyst", STATE="WA"), capsys)
    assert "EqualTo(JOB_CATEGORY,Data Analyst)" in text and "EqualTo(STATE,WA)" in text


def test_latest_trend_is_a_top_k(spark):
    daily = spark.createDataFrame([(dt.date(2025, 5, 5), "x", 1)], "date date, JOB_CATEGORY string, total_jobs bigint")
    text = plan(trend.latest_trend(trend.wow_trend(daily, mode=trend.COMPLETE)))
    assert "TakeOrderedAndProject" in text


def test_cleaning_is_map_only(spark):
    text = plan(clean_records(X.raw_postings(spark, SMALL)))
    assert "Exchange hashpartitioning" not in text and "Python" not in text


def test_newest_day_is_a_subquery_not_a_join(spark):
    daily = spark.createDataFrame([(dt.date(2025, 5, 5), "Data Analyst", 1)], "date date, JOB_CATEGORY string, total_jobs bigint")
    text = plan(lst.daily_jobs(daily))
    assert "Subquery" in text and "Join" not in text


def test_rows_alone_meet_no_shuffle_past_the_broadcast_limit(spark, stored):
    alone, repeated = split_copies(stored.union(stored.where("JOB_CATEGORY = 'Data Analyst'")), conf.COPY_PROBE, limit=-1)
    text = plan(alone)
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    assert set(re.findall(r"Exchange hashpartitioning\((\w+?)#", text)) <= {"__bucket"}
    assert alone.count() < stored.count() and alone.union(repeated).count() > stored.count()


def test_landing_files_are_not_made_in_one_task(spark, monkeypatch):
    """Files of the arrivals without a key are dealt by title; their join runs on all partitions."""
    from checks import queries as Q

    landed, land = [], Q._land
    monkeypatch.setattr(Q, "_land", lambda rows, path: landed.append(rows) or land(rows, path))
    Q.c1_arrivals_missing_key(spark, SMALL)
    plans = [rows._jdf.queryExecution().executedPlan().toString() for rows in landed]
    assert len(plans) == 2 and not any("Coalesce" in plan for plan in plans)
    assert all("hashpartitioning(job_category" in plan for plan in plans)


def test_collapse_sorts_shuffle_partitions_only(spark):
    from checks import queries as Q

    plan = Q.a7_collapse(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(ID" in plan and "partial_max" in plan
    assert plan.index("partial_max") < plan.index("hashpartitioning(ID")  # from the result down: both aggregates above the exchange


def test_links_read_stored_rows(spark):
    from checks import queries as Q

    assert not [name for name in Q.c6_posting_links(spark, SMALL).inputFiles() if "lineitem" in name]
