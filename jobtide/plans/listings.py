"""The reads of the dashboard, each a function from stored tables to one result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.functions.salary import band_columns, exact_mean
from jobtide.operators.aggregate import bounds, count_distinct_mart, distinct_rows, sum_by
from jobtide.operators.copies import distinct_split
from jobtide.operators.filters import ALL, before_newest, facet_filter, title_contains_filter
from jobtide.operators.order import by_total_descending, in_order, sort_keys, unknown_last
from jobtide.operators.project import display_names
from jobtide.operators.sets import distinct_union, facet_values
from jobtide.operators.trend import latest_trend, with_trend_label

# Columns of the detail listing and the names they are shown under.
DETAIL_NAMES = {
    "JOB_CATEGORY": "Job_Role",
    "TITLE": "TITLE",
    "JOB_DATE": "Post_Date",
    "EMPLOYMENT_TYPE": "EMPLOYMENT_TYPE",
    "SENIORITY": "SENIORITY",
    "CITY": "CITY",
    "STATE": "STATE",
    "ORGANIZATION": "ORGANIZATION",
    "URL": "LinkedIn_Post_Link",
    "LINKEDIN_ORG_URL": "LINKEDIN_ORG_URL",
    "LINKEDIN_ORG_INDUSTRY": "LINKEDIN_ORG_INDUSTRY",
    "REMOTE_DERIVED": "IS_REMOTE",
    "LINKEDIN_ORG_RECRUITMENT_AGENCY_DERIVED": "Job_By_Agency",
    "DIRECTAPPLY": "DIRECTAPPLY",
}
DETAIL_FACETS = ["Job_Role", "STATE", "CITY", "ORGANIZATION"]


def reported_period(daily: DataFrame) -> DataFrame:
    """First day, newest day, and the last full day shown in the heading."""
    return bounds(daily).withColumn("LAST_FULL_DAY", F.date_sub("MAX_DATE", 1))


def job_totals(cleaned: DataFrame) -> DataFrame:
    """Distinct postings per category, on the cleaned (not the conformed) table."""
    totals = count_distinct_mart(title_contains_filter(cleaned), ["JOB_CATEGORY"], name="Total_Jobs")
    return in_order(totals.withColumnRenamed("JOB_CATEGORY", "Title"), "Title")


def trend_cards(trend: DataFrame, rows: int = 3) -> DataFrame:
    """The newest trend rows with their percent text and direction."""
    newest = with_trend_label(latest_trend(trend, rows))
    return newest.select(
        F.col("week_start").alias("WEEK_START"),
        "JOB_CATEGORY",
        F.col("this_week_jobs").alias("THIS_WEEK"),
        F.col("last_week_jobs").alias("LAST_WEEK"),
        F.col("wow_diff_pct").alias("WOW_DIFF_PCT"),
        F.col("wow_text").alias("WOW_TEXT"),
        F.col("direction").alias("DIRECTION"),
    )


def daily_jobs(daily: DataFrame) -> DataFrame:
    """Daily totals per role without the newest, still filling day."""
    roles = title_contains_filter(daily, "JOB_CATEGORY")
    kept = before_newest(roles, "date", newest_of=daily)
    summed = sum_by(kept, [F.col("JOB_CATEGORY").alias("TITLE"), F.col("date").alias("DATE")], "total_jobs", "TOTAL_JOBS")
    return in_order(summed.select("DATE", "TITLE", "TOTAL_JOBS"), "TITLE", "DATE")


def salary_by_title(salary: DataFrame) -> DataFrame:
    means = salary.groupBy("JOB_TITLE").agg(
        exact_mean(F.col("SALARY_RANGE_LOW")).alias("SALARY_LOW"),
        exact_mean(F.col("SALARY_RANGE_HIGH")).alias("SALARY_HIGH"),
    )
    return in_order(means, "JOB_TITLE")


def salary_bands(salary: DataFrame) -> DataFrame:
    """Mean band per title with the figures its chart is drawn from."""
    return salary_by_title(salary).withColumns(band_columns(F.col("SALARY_LOW"), F.col("SALARY_HIGH")))


def salary_by_state(salary: DataFrame) -> DataFrame:
    means = salary.groupBy("JOB_TITLE", "STATES").agg(exact_mean(F.col("AVERAGE_SALARY")).alias("AVG_SALARY"))
    return in_order(means, "JOB_TITLE", "-AVG_SALARY")


def salary_states_of(salary: DataFrame, title: str) -> DataFrame:
    """The expander below one title: its states and their mean salary."""
    return in_order(
        salary_by_state(salary).where(F.col("JOB_TITLE") == title).select("STATES", "AVG_SALARY"), "-AVG_SALARY"
    )


def top_skills(skills: DataFrame) -> DataFrame:
    """Every column of the skills table in title order."""
    ties = [c for c in skills.columns if c != "Job_Title"]
    return in_order(skills, "Job_Title", *ties)


def state_listing(by_state: DataFrame) -> DataFrame:
    return by_state.orderBy(*unknown_last("STATE"), *sort_keys("JOB_CATEGORY"))


def city_listing(by_city: DataFrame) -> DataFrame:
    return in_order(by_city, "CITY", "JOB_CATEGORY")


def org_listing(by_org: DataFrame) -> DataFrame:
    return in_order(by_org.select("JOB_CATEGORY", "ORGANIZATION", "total_jobs"), "ORGANIZATION", "JOB_CATEGORY")


def role_choices(marts: list[DataFrame]) -> DataFrame:
    return distinct_union(marts, "JOB_CATEGORY")


def role_listing(listing: DataFrame, role: str = ALL) -> DataFrame:
    """One of the three listings for one role, largest total first."""
    return by_total_descending(facet_filter(listing, JOB_CATEGORY=role))


def job_details(conformed: DataFrame) -> DataFrame:
    """Distinct detail rows, newest first, then by role.

    Link and title break ties, so a day with most of the postings is still sorted by
    several tasks.  Only rows that share link and role with another one are compared.
    """
    shown = display_names(conformed, DETAIL_NAMES)
    shown = distinct_split(shown, shown.columns, ["LinkedIn_Post_Link", "Job_Role"])
    return in_order(shown, "-Post_Date", "Job_Role", "LinkedIn_Post_Link", "TITLE")


def filter_details(
    details: DataFrame, role: str = ALL, state: str = ALL, city: str = ALL, organization: str = ALL
) -> DataFrame:
    return facet_filter(details, Job_Role=role, STATE=state, CITY=city, ORGANIZATION=organization)


def detail_choices(conformed: DataFrame) -> DataFrame:
    """What each of the four selectors offers.

    Read from the conformed table: the listing's DISTINCT and order change none of it.
    """
    return facet_values(display_names(conformed, DETAIL_NAMES), DETAIL_FACETS)


def link_table(details: DataFrame) -> DataFrame:
    """Detail rows with the link column renamed for display, in its old place."""
    return display_names(details, {c: "Job Link" if c == "LinkedIn_Post_Link" else c for c in details.columns})
