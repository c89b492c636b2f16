"""Trend semantics against a plain-Python account of the calendar."""

import datetime as dt

import pytest

from jobtide.operators import trend
from jobtide.operators.filters import before_newest, to_date_days, with_report_params
from jobtide.plans import listings as lst

DAILY = "date date, month int, Year int, JOB_CATEGORY string, total_jobs bigint"


def daily_of(spark, counts):
    data = [(d, d.month, d.year, c, n) for (d, c), n in counts.items()]
    return spark.createDataFrame(data, DAILY)


def expected(counts, as_of=None):
    """Trend rows by the letter of the definition; Sunday is 0."""
    sunday0 = lambda d: (d.weekday() + 1) % 7
    weeks = {}
    for (day, cat), n in counts.items():
        if as_of and not (sunday0(day) <= sunday0(as_of) and day <= as_of - dt.timedelta(1)):
            continue
        start = day - dt.timedelta(day.weekday())
        weeks[cat, start] = weeks.get((cat, start), 0) + n
    out, last = set(), {}
    for cat, start in sorted(weeks):
        this, prev = weeks[cat, start], last.get(cat)
        last[cat] = this
        diff = None if prev is None else this - prev
        out.add((cat, start, this, prev, diff, diff / prev if prev else None))
    return out


def counts_over(first, days, skip_weeks=()):
    out = {}
    for i in range(days):
        day = first + dt.timedelta(i)
        if (i // 7) not in skip_weeks:
            out[day, "Data Engineer"] = 1 + i * 7 % 5
            if i % 3:
                out[day, "Data Analyst"] = i % 4
    return out


@pytest.mark.parametrize("weekday", range(7))
def test_to_date_on_each_weekday(spark, weekday):
    counts = counts_over(dt.date(2024, 12, 9), 45, skip_weeks=(2,))
    as_of = dt.date(2025, 1, 6) + dt.timedelta(weekday)
    got = {tuple(r) for r in trend.wow_trend(daily_of(spark, counts), as_of).collect()}
    assert got == expected(counts, as_of)


def test_complete_weeks_skip_absent_ones(spark):
    counts = counts_over(dt.date(2024, 12, 9), 45, skip_weeks=(1, 2))
    got = {tuple(r) for r in trend.wow_trend(daily_of(spark, counts), mode=trend.COMPLETE).collect()}
    assert got == expected(counts)
    third = next(r for r in got if r[0] == "Data Engineer" and r[1] == dt.date(2024, 12, 30))
    first = next(r for r in got if r[0] == "Data Engineer" and r[1] == dt.date(2024, 12, 9))
    assert third[3] == first[2]


def test_zero_previous_week(spark):
    counts = {(dt.date(2025, 5, 5), "Data Analyst"): 0, (dt.date(2025, 5, 12), "Data Analyst"): 5}
    got = {tuple(r) for r in trend.wow_trend(daily_of(spark, counts), mode=trend.COMPLETE).collect()}
    assert ("Data Analyst", dt.date(2025, 5, 12), 5, 0, 5, None) in got


def test_kept_days_of_a_monday(spark):
    days = {(dt.date(2025, 5, 5) + dt.timedelta(i), "x"): 1 for i in range(20)}
    kept = {r["date"] for r in to_date_days(daily_of(spark, days), dt.date(2025, 5, 19)).collect()}
    assert kept == {dt.date(2025, 5, 5), dt.date(2025, 5, 11), dt.date(2025, 5, 12), dt.date(2025, 5, 18)}


def test_params_and_modes(spark):
    daily = daily_of(spark, {(dt.date(2025, 5, 5), "x"): 1})
    row = with_report_params(daily, dt.date(2025, 5, 18)).first()
    assert (row["report_date"], row["report_dow"]) == (dt.date(2025, 5, 17), 0)
    with pytest.raises(ValueError):
        trend.wow_trend(daily)
    with pytest.raises(ValueError):
        trend.wow_trend(daily, mode="monthly")


def test_latest_rows_break_ties_by_category(spark):
    counts = {(dt.date(2025, 5, 5 + 7 * w), c): 1 + w for w in range(2) for c in ("d", "b", "a", "c")}
    newest = trend.latest_trend(trend.wow_trend(daily_of(spark, counts), mode=trend.COMPLETE))
    assert [(r["week_start"].day, r["JOB_CATEGORY"]) for r in newest.collect()] == [(12, "a"), (12, "b"), (12, "c")]
    cards = lst.trend_cards(trend.wow_trend(daily_of(spark, counts), mode=trend.COMPLETE)).collect()
    assert [c["WOW_TEXT"] for c in cards] == ["100%"] * 3 and {c["DIRECTION"] for c in cards} == {"up"}


def test_newest_day_is_dropped(spark):
    counts = {(dt.date(2025, 5, d), c): d for d in (1, 2, 3) for c in ("Data Analyst", "Florist")}
    daily = daily_of(spark, counts)
    assert {r["date"].day for r in before_newest(daily).collect()} == {1, 2}
    got = [tuple(r) for r in lst.daily_jobs(daily).collect()]
    assert got == [(dt.date(2025, 5, 1), "Data Analyst", 1), (dt.date(2025, 5, 2), "Data Analyst", 2)]
    assert before_newest(daily.limit(0)).count() == 0


def test_newest_day_of_the_whole_mart_counts(spark):
    counts = {(dt.date(2025, 5, 1), "Data Analyst"): 1, (dt.date(2025, 5, 2), "Florist"): 1}
    assert lst.daily_jobs(daily_of(spark, counts)).count() == 1
