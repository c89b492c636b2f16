"""Orders a result promises."""

import datetime as dt

from pyspark.sql import functions as F

from jobtide.operators import order, sets
from jobtide.plans import listings as lst


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_unknown_state_comes_last(spark):
    df = spark.createDataFrame(
        [("a", "UNKNOWN", 1), ("a", "WA", 1), ("b", "NSW", 1), ("a", "NSW", 1), ("a", "ZZ", 2)],
        "JOB_CATEGORY string, STATE string, total_jobs bigint",
    )
    assert values(lst.state_listing(df), "STATE", "JOB_CATEGORY") == [
        ("NSW", "a"), ("NSW", "b"), ("WA", "a"), ("ZZ", "a"), ("UNKNOWN", "a"),
    ]


def test_null_sorts_as_greatest(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "n int")
    assert values(order.in_order(df, "n"), "n") == [(1,), (2,), (None,)]
    assert values(order.in_order(df, "-n"), "n") == [(None,), (2,), (1,)]


def test_read_orders(spark):
    df = spark.createDataFrame(
        [("b", "x", 1), ("a", "y", 5), ("a", "x", 3), ("a", "x", 4)], "JOB_CATEGORY string, CITY string, total_jobs int"
    )
    assert values(order.read_order(df, "by_city"), "JOB_CATEGORY", "CITY", "total_jobs") == [
        ("a", "x", 4), ("a", "x", 3), ("a", "y", 5), ("b", "x", 1),
    ]
    assert values(lst.city_listing(df), "CITY", "JOB_CATEGORY")[-1] == ("y", "a")
    assert [t for _, _, t in values(order.by_total_descending(df), "CITY", "JOB_CATEGORY", "total_jobs")] == [5, 4, 3, 1]
    assert values(lst.role_listing(df, "a"), "total_jobs") == [(5,), (4,), (3,)]


def test_first_and_last_rows(spark):
    df = spark.range(10)
    assert values(order.first_rows(df, 2, "id"), "id") == [(0,), (1,)]
    assert values(order.last_rows(df, 2, "id"), "id") == [(9,), (8,)]


def test_details_newest_first_and_split_over_tasks(spark):
    n = F.col("id")
    names = {c: F.lit("x") for c in lst.DETAIL_NAMES}
    names |= {"JOB_DATE": F.lit(dt.date(2025, 5, 1)), "URL": F.concat(F.lit("u"), n)}
    hot_day = spark.range(4000).select(*[v.alias(c) for c, v in names.items()])
    names |= {"JOB_DATE": F.date_add(F.lit(dt.date(2025, 5, 1)), (n + 1).cast("int"))}
    details = lst.job_details(hot_day.union(spark.range(5).select(*[v.alias(c) for c, v in names.items()])))
    days = values(details, "Post_Date")
    assert days == sorted(days, reverse=True) and len(days) == 4005
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = details.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in spread) < 2500


def test_link_column_keeps_its_place(spark):
    df = spark.createDataFrame([("r", "link", "t")], "Job_Role string, LinkedIn_Post_Link string, TITLE string")
    assert lst.link_table(df).columns == ["Job_Role", "Job Link", "TITLE"]


def test_choices(spark):
    a = spark.createDataFrame([("b", "WA"), (None, "VIC"), ("a", None), ("b", "WA")], "JOB_CATEGORY string, STATE string")
    b = spark.createDataFrame([("c", "x")], "JOB_CATEGORY string, STATE string")
    assert values(sets.distinct_union([a, b, a], "JOB_CATEGORY"), "JOB_CATEGORY") == [("a",), ("b",), ("c",)]
    assert values(sets.facet_values(a, ["STATE", "JOB_CATEGORY"]), "facet", "value") == [
        ("JOB_CATEGORY", "a"), ("JOB_CATEGORY", "b"), ("STATE", "VIC"), ("STATE", "WA"),
    ]


def test_salary_reads(spark):
    df = spark.createDataFrame(
        [("e", "WA", 1.0, 3.0, 2.0), ("e", "VIC", 3.0, 5.0, 4.0), ("a", "WA", 1.0, 1.0, 1.0)],
        "JOB_TITLE string, STATES string, SALARY_RANGE_LOW double, SALARY_RANGE_HIGH double, AVERAGE_SALARY double",
    )
    assert values(lst.salary_by_title(df), "JOB_TITLE", "SALARY_LOW", "SALARY_HIGH") == [("a", 1, 1), ("e", 2, 4)]
    assert values(lst.salary_states_of(df, "e"), "STATES", "AVG_SALARY") == [("VIC", 4), ("WA", 2)]


def test_top_skills_keeps_all_columns(spark):
    df = spark.createDataFrame([("b", 1, "x"), ("a", 2, "y")], "Job_Title string, rank int, skill string")
    assert values(lst.top_skills(df), "Job_Title", "rank", "skill") == [("a", 2, "y"), ("b", 1, "x")]
