"""Posting-shaped views over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import values as V
from jobtide.schema import CLEANED_COLUMNS, RAW_SCHEMA


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value).lower() if isinstance(value, bool) else f'"{value}"'


def pick(index: str, texts: list) -> str:
    """SQL text choosing one of ``texts`` by position.

    Not ``array[index]``: the optimizer takes that for cheap and repeats it wherever the
    column is used.
    """
    chosen = f"CAST({index} AS INT)"
    if isinstance(texts[0], bool):
        return f"CASE {chosen} " + " ".join(f"WHEN {i} THEN {literal(t)}" for i, t in enumerate(texts)) + " END"
    return f"elt({chosen} + 1, {', '.join(map(literal, texts))})"


def _orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customers, orders.o_custkey == customers.c_custkey)


def _cleaned(df: DataFrame, city: str, state: str, seniority: str) -> DataFrame:
    columns = {
        "ID": "concat('job-', o_orderkey)",
        "TITLE": pick("o_orderkey % 5", V.TITLES),
        "JOB_CATEGORY": pick("o_orderkey % 3", V.CATEGORIES),
        "JOB_DATE": "CAST(o_orderdate AS DATE)",
        "CITY": pick(city, V.CITIES),
        "STATE": pick(state, V.STATES),
        "EMPLOYMENT_TYPE": pick("o_orderkey % 4", V.EMPLOYMENT),
        "ORGANIZATION": "c_name",
        "ORGANIZATION_URL": "concat('https://example.org/org/', c_custkey)",
        "URL": "concat('https://example.org/job/', o_orderkey)",
        "SOURCE_TYPE": pick("o_orderkey % 2", V.SOURCE_TYPES),
        "SOURCE": "lower(c_mktsegment)",
        "SOURCE_DOMAIN": "concat(lower(c_mktsegment), '.example.org')",
        "ORGANIZATION_LOGO": "concat('https://example.org/logo/', c_nationkey)",
        "REMOTE_DERIVED": "o_orderkey % 3 = 0",
        "RECRUITER_NAME": pick("o_orderkey % 7", V.RECRUITERS),
        "RECRUITER_TITLE": "o_orderpriority",
        "RECRUITER_URL": "concat('https://example.org/recruiter/', o_orderkey % 7)",
        "LINKEDIN_ORG_URL": "concat('https://example.org/page/', c_custkey)",
        "ORG_SIZE": pick("c_custkey % 4", V.SIZES),
        "LINKEDIN_ORG_INDUSTRY": "c_mktsegment",
        "LINKEDIN_ORG_HEADQUARTERS": "concat('Nation ', c_nationkey)",
        "LINKEDIN_ORG_TYPE": "o_orderstatus",
        "LINKEDIN_ORG_FOUNDEDDATE": "CAST(1900 + c_custkey % 120 AS STRING)",
        "LINKEDIN_ORG_SPECIALTIES": "array(o_orderpriority, lower(c_mktsegment))",
        "LINKEDIN_ORG_LOCATIONS": "array(concat('Nation ', c_nationkey))",
        "LINKEDIN_ORG_DESCRIPTION": "concat(c_name, ' in ', c_mktsegment)",
        "LINKEDIN_ORG_RECRUITMENT_AGENCY_DERIVED": pick("c_custkey % 3", V.AGENCY),
        "SENIORITY": pick(seniority, V.SENIORITIES),
        "DIRECTAPPLY": "o_orderkey % 2 = 1",
        "LINKEDIN_ORG_SLUG": "concat('org-', c_custkey)",
    }
    assert list(columns) == CLEANED_COLUMNS
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table: one posting per order."""
    return _cleaned(
        _orders_customers(spark, sf_dir),
        "c_custkey % 26", "(c_custkey + o_orderkey % 2) % 13", "o_orderkey % 40",
    )


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table with copies: an order is stored once per line, and the copies
    disagree on city, state and seniority."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    df = _orders_customers(spark, sf_dir).join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return _cleaned(
        df,
        "(c_custkey + l_linenumber % 2) % 26",
        "(c_custkey + l_linenumber % 2) % 13",
        "(o_orderkey + l_linenumber) % 40",
    )


def _place(locality: str, region: str) -> str:
    return (
        f"struct(struct({locality} AS addressLocality, {region} AS addressRegion, "
        "CAST(NULL AS STRING) AS streetAddress) AS address)"
    )


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed records: one per order, with nested locations and list-valued columns."""
    df = _orders_customers(spark, sf_dir).selectExpr(
        "*",
        f"{pick('c_custkey % 29', V.RAW_CITIES)} AS locality",
        f"{pick('(c_custkey + o_orderkey % 2) % 13', V.STATES)} AS state",
    ).selectExpr("*", """CASE WHEN o_orderkey % 2 = 0 THEN state ELSE concat(" '", state, "' ") END AS region""")
    none = "CAST(NULL AS STRING)"
    columns = {
        "id": "concat('job-', o_orderkey)",
        "title": pick("o_orderkey % 7", V.RAW_TITLES),
        "job_category": pick("o_orderkey % 3", V.CATEGORIES),
        "date_created": "concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T23:30:00-05:00')",
        "locations_raw": f"""CASE o_orderkey % 3 WHEN 0 THEN array({_place('locality', 'region')})
            WHEN 1 THEN array({_place(none, 'region')}, {_place('locality', none)})
            ELSE array({_place('locality', none)}, {_place('"Elsewhere"', 'region')}) END""",
        "employment_type": f"split({pick('o_orderkey % 4', V.RAW_EMPLOYMENT)}, '[|]')",
        "organization": "CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END",
        "url": "concat('https://example.org/job/', o_orderkey)",
        "linkedin_org_size": pick("c_custkey % 4", V.RAW_SIZES),
        "linkedin_org_industry": "c_mktsegment",
        "remote_derived": "o_orderkey % 3 = 0",
        "recruiter_name": pick("o_orderkey % 7", V.RECRUITERS),
        "linkedin_org_specialties": "array(o_orderpriority, lower(c_mktsegment))",
        "seniority": pick("o_orderkey % 40", V.SENIORITIES),
        "directapply": "o_orderkey % 2 = 1",
    }
    return df.selectExpr(
        *[
            f"{columns.get(f.name, f'CAST(NULL AS {f.dataType.simpleString()})')} AS {f.name}"
            for f in RAW_SCHEMA.fields
        ],
        "o_orderstatus",
    )


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translations for the organisations of one market segment and for their cities."""
    known = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    organisations = known.selectExpr("c_name AS value", "concat('Org ', c_custkey) AS translated")
    cities = known.selectExpr(f"{pick('c_custkey % 26', V.CITIES)} AS value").where("value IS NOT NULL").distinct()
    return organisations.union(cities.selectExpr("value", "upper(value) AS translated"))


def salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(18,2)")
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("JOB_TITLE"),
        F.col("p_brand").alias("STATES"),
        price.alias("SALARY_RANGE_LOW"),
        (price * F.lit(1.5).cast("decimal(4,2)")).alias("SALARY_RANGE_HIGH"),
        (price * F.lit(1.25).cast("decimal(4,2)")).alias("AVERAGE_SALARY"),
    )


def skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("Job_Title"), F.col("p_name").alias("skill")
    ).distinct()
