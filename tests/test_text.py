"""Hand-worked cases of the cleaning expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobtide.functions import calendar as cal
from jobtide.functions import text
from jobtide.functions.salary import band_columns, exact_mean
from jobtide.operators import filters, project
from jobtide.schema import CLEANED_COLUMNS, EXPECTED_COLUMNS, KEPT_COLUMNS, RAW_SCHEMA, SEARCH_TITLES


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", fn(F.col("v"))).orderBy("i").collect()]


def test_title_filters(spark):
    titles = [
        "Sr DATA ENGINEER/x", "Metadata Engineering", None, "data analysts", "Lead,Data Scientist",
        "Data  Engineer", "éData Engineer", "",
    ]
    df = spark.createDataFrame([(t,) for t in titles], "TITLE string")
    whole = {r[0] for r in filters.title_phrase_filter(df).collect()}
    assert whole == {"Sr DATA ENGINEER/x", "Lead,Data Scientist"}
    part = {r[0] for r in filters.title_contains_filter(df).collect()}
    assert part == whole | {"Metadata Engineering", "data analysts", "éData Engineer"}
    assert SEARCH_TITLES == ["Data Engineer", "Data Scientist", "Data Analyst"]


def test_written_date_keeps_the_day(spark):
    texts = ["2025-05-18T23:30:00-05:00", "2025-05-18T00:10:00+11:00", "2025-05-18 23:30:00", "2025-05-18", None]
    assert apply(spark, text.written_date, texts) == [dt.date(2025, 5, 18)] * 4 + [None]


def test_bad_date_is_told_from_a_missing_one(spark):
    df = spark.createDataFrame([("soon",), ("2025-05-18T10:00:00",), (None,), (" ",)], "d string")
    got = df.select(text.written_date(F.col("d")).cast("string"), F.coalesce(text.is_bad_date(F.col("d")), F.lit(False))).collect()
    assert [tuple(r) for r in got] == [(None, True), ("2025-05-18", False), (None, False), (None, False)]


def places(*pairs):
    return [((city, state, None),) for city, state in pairs]


LOCATIONS = [
    places(("Sydney", "NSW")),
    places((None, "VIC"), ("Perth", None)),
    places(("O'Connor", " 'WA'\t")),
    None,
    [],
    places(("Sidney CBD", "NSW"), ("Perth", "WA")),
    places(("悉尼", None)),
    places(("SÍDNEY", "")),
    [None],
]


def test_city_and_state_of_locations(spark):
    kind = RAW_SCHEMA["locations_raw"].dataType.simpleString()
    assert apply(spark, text.posting_city, LOCATIONS, kind) == [
        "Sydney", "Perth", "O'Connor", None, None, "Sydney", "Sydney", "Sydney", None,
    ]
    assert apply(spark, text.posting_state, LOCATIONS, kind) == [
        "NSW", "VIC", "WA", None, None, "NSW", None, "", None,
    ]


def test_list_and_size_text(spark):
    lists = [["FULL_TIME", "PART_TIME"], ["CONTRACTOR"], [], None, ["[x]", "y "]]
    assert apply(spark, text.list_to_text, lists, "array<string>") == [
        "FULL_TIME, PART_TIME", "CONTRACTOR", "", None, "x, y",
    ]
    sizes = ["51-200 employees", "1 employee", None, "\t10,001+ employees ", "Employees"]
    assert apply(spark, text.employee_range, sizes) == ["51-200", "1 employee", None, "10,001+", "Employees"]


def test_blank_to_null_only_for_empty_text(spark):
    df = spark.createDataFrame([("", " ", 0), ("a", None, 1)], "a string, b string, n int")
    assert [tuple(r) for r in project.blank_to_null(df).collect()] == [(None, " ", 0), ("a", None, 1)]


def test_week_and_day_of_week(spark):
    days = [dt.date(2025, 5, 18), dt.date(2025, 5, 19), dt.date(2025, 1, 1), None]
    assert apply(spark, cal.day_of_week, days, "date") == [0, 1, 3, None]
    assert apply(spark, cal.week_start, days, "date") == [
        dt.date(2025, 5, 12), dt.date(2025, 5, 19), dt.date(2024, 12, 30), None,
    ]
    assert apply(spark, lambda c: cal.week_start(c, "sunday"), days, "date") == [
        dt.date(2025, 5, 18), dt.date(2025, 5, 18), dt.date(2024, 12, 29), None,
    ]
    with pytest.raises(ValueError):
        cal.week_start(F.lit(None), "friday")


def test_safe_ratio(spark):
    df = spark.createDataFrame([(5, 0), (5, None), (5, 2), (None, 2)], "a bigint, b bigint")
    assert [r[0] for r in df.select(cal.safe_ratio(F.col("a"), F.col("b"))).collect()] == [None, None, 2.5, None]


def test_trend_label_matches_python_rounding(spark):
    ratios = [0.005, 0.015, 0.025, -0.004, -0.005, 0.0, 1.0, -1.0, 0.124999, 3.337, 0.995]
    got = apply(spark, cal.percent_text, ratios, "double")
    assert got == [f"{r * 100:.0f}%" for r in ratios]
    assert apply(spark, cal.trend_direction, [0.1, 0.0, -0.1, None], "double") == ["up", "flat", "down", "down"]
    assert apply(spark, cal.percent_text, [None], "double") == [None]


def test_salary_band(spark):
    df = spark.createDataFrame([(90999.0, 120000.0)], "lo double, hi double")
    row = df.select(*[c.alias(n) for n, c in band_columns(F.col("lo"), F.col("hi")).items()]).first().asDict()
    assert row == {
        "LOWER_BOUND": 90999 - 29001 / 2, "UPPER_BOUND": 120000 + 29001 / 2, "LEAD_WIDTH": 29001 / 2,
        "BAND_WIDTH": 29001.0, "TAIL_WIDTH": 29001 / 2, "BAND_TEXT": "$90K-$120K",
    }


def test_exact_mean(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", None), ("b", None)], "k string, v double")
    got = dict(df.groupBy("k").agg(exact_mean(F.col("v"))).collect())
    assert got == {"a": 0.15, "b": None}


def test_contract(spark):
    assert len(EXPECTED_COLUMNS) == 44 and len(CLEANED_COLUMNS) == 31 and len(KEPT_COLUMNS) == 28
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert project.project_contract(df, ["a", "b"]).columns == ["a", "b"]
    with pytest.raises(ValueError, match="'z'"):
        project.project_contract(df, ["a", "z"])
    filled = project.project_contract(df, ["a", "LOCATIONS_RAW"], on_missing="null")
    assert filled.schema["LOCATIONS_RAW"].dataType == RAW_SCHEMA["locations_raw"].dataType
    assert project.upper_names(df).columns == ["B", "A"]


def test_facet_filter_all_means_no_filter(spark, rows):
    df = spark.createDataFrame([("x", "1"), ("x", "2"), ("y", "1"), (None, "1")], "a string, b string")
    assert len(rows(filters.facet_filter(df, a="All", b="All"))) == 4
    assert rows(filters.facet_filter(df, a="x", b="All")) == [("x", "1"), ("x", "2")]
    assert rows(filters.facet_filter(df, a="x", b="2")) == [("x", "2")]
