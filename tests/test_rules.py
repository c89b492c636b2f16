"""Hand-worked standardisation results and the order of the rules."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobtide.functions import rules

CITY = {
    "Launceston Tasmania": "Hobart", "Victoria": "Melbourne", "Greater Sydney Area": "Sydney",
    "no regrets": "Unknown", "Geelong": "Geelong", None: None, "NEW SOUTH WALES": "Sydney",
    "new south wales north": "new south wales north", "barzbin": "Brisbane", "Hobart, Tasmania": "Hobart",
    "Perth": "Perth", "North Perth": "Perth", "Queensland": "Brisbane", "": "",
}
SENIORITY = {
    "Mid-Senior level": "Senior", "average seniority level": "Senior",
    "medium-upper level manager": "Intermediate", "medium-high": "Intermediate",
    "middle head manager": "Manager/Executive", "Middle": "Intermediate",
    "Middle level seniors": "Senior", "full-senior": "Senior", "medium-level": "Intermediate",
    "Association": "Not Applicable", "Associate": "Entry Level", "Assistant manager": "Entry Level",
    "  Entry level ": "Entry Level", "Internship": "No Experience", "First job": "No Experience",
    "Director": "Manager/Executive", "SENIOR EXECUTIVE": "Manager/Executive", "NA": "Not Applicable",
    "": "Not Applicable", None: "Not Applicable", "Junior": "Entry Level", "Cadre": "Intermediate",
    "unprecedented": "Not Applicable", "Without experience": "No Experience", "Base": "Entry Level",
    "It does not correspond": "Not Applicable", "Trainee": "No Experience", "minimum": "Entry Level",
}
STATE = {
    ("Perth", "of"): "WA", ("Woden", "NA"): "ACT", ("Geelong", "NA"): "UNKNOWN", ("Geelong", "of"): "of",
    ("Perth", "VIC"): "VIC", ("Sydney", "Australia"): "NSW", ("Darwin", "ON"): "NT", ("Geelong", None): None,
    (None, "na"): "UNKNOWN", ("Hobart", "na"): "TAS", ("Brisbane", "On"): "QLD", ("Melbourne", "of"): "VIC",
    ("Canberra", "na"): "ACT", ("Adelaide", "na"): "SA", ("perth", "of"): "of",
}


def test_city(spark):
    df = spark.createDataFrame([(c,) for c in CITY], "c string")
    got = df.select("c", rules.standard_city(F.col("c"))).collect()
    assert {r[0]: r[1] for r in got} == CITY


def test_seniority(spark):
    df = spark.createDataFrame([(c,) for c in SENIORITY], "c string")
    got = df.select("c", rules.standard_seniority(F.col("c"))).collect()
    assert {r[0]: r[1] for r in got} == SENIORITY


def test_state(spark):
    df = spark.createDataFrame(list(STATE), "c string, s string")
    got = df.select("c", "s", rules.standard_state(F.col("s"), F.col("c"))).collect()
    assert {(r[0], r[1]): r[2] for r in got} == STATE


def test_table_sizes():
    assert len(rules.CITY_RULES) == 20
    assert sum(how == rules.IS for how, _, _ in rules.CITY_RULES) == 11
    assert len(rules.SENIORITY_RULES) == 35
    assert len(rules.CITY_STATES) == 9


@pytest.mark.parametrize("text", ["medium-upper level manager", "senior assistant", "middle level seniors"])
def test_order_of_seniority_rules_matters(spark, text):
    row = spark.range(1).select(F.lit(text).alias("t"))
    kept = rules.standard_seniority(F.col("t"))
    turned = rules.first_match(F.lower("t"), rules.SENIORITY_RULES[::-1], F.lit("Not Applicable"))
    kept, turned = row.select(kept, turned).first()
    assert kept != turned


words = st.sampled_from([k for _, k, _ in rules.SENIORITY_RULES + rules.CITY_RULES] + ["x", "lead", " "])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(words, min_size=1, max_size=3).map(" ".join), min_size=20, max_size=60))
def test_first_rule_wins_on_random_texts(spark, texts):
    def brute(table, text, default):
        low = text.lower()
        return next((v for how, k, v in table if (low == k if how == "is" else k in low)), default)

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, city, seniority in df.select(
        "t", rules.standard_city(F.col("t")), rules.standard_seniority(F.col("t"))
    ).collect():
        assert city == brute(rules.CITY_RULES, t, t)
        assert seniority == brute(rules.SENIORITY_RULES, t.strip(" "), "Not Applicable")
