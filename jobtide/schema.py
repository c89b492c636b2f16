"""Column contracts and declared types of the raw, cleaned and mart layers."""

from __future__ import annotations

from pyspark.sql import types as T

# The 44 columns a landed posting must have, in contract order.
EXPECTED_COLUMNS = [
    "ID", "DATE_POSTED", "DATE_CREATED", "TITLE", "JOB_CATEGORY",
    "ORGANIZATION", "ORGANIZATION_URL", "DATE_VALIDTHROUGH", "LOCATIONS_RAW",
    "LOCATION_TYPE", "LOCATION_REQUIREMENTS_RAW", "EMPLOYMENT_TYPE", "URL",
    "SOURCE_TYPE", "SOURCE", "SOURCE_DOMAIN", "ORGANIZATION_LOGO",
    "CITIES_DERIVED", "REGIONS_DERIVED", "COUNTRIES_DERIVED",
    "LOCATIONS_DERIVED", "TIMEZONES_DERIVED", "LATS_DERIVED", "LNGS_DERIVED",
    "REMOTE_DERIVED", "RECRUITER_NAME", "RECRUITER_TITLE", "RECRUITER_URL",
    "LINKEDIN_ORG_EMPLOYEES", "LINKEDIN_ORG_URL", "LINKEDIN_ORG_SIZE",
    "LINKEDIN_ORG_SLOGAN", "LINKEDIN_ORG_INDUSTRY", "LINKEDIN_ORG_FOLLOWERS",
    "LINKEDIN_ORG_HEADQUARTERS", "LINKEDIN_ORG_TYPE", "LINKEDIN_ORG_FOUNDEDDATE",
    "LINKEDIN_ORG_SPECIALTIES", "LINKEDIN_ORG_LOCATIONS",
    "LINKEDIN_ORG_DESCRIPTION", "LINKEDIN_ORG_RECRUITMENT_AGENCY_DERIVED",
    "SENIORITY", "DIRECTAPPLY", "LINKEDIN_ORG_SLUG",
]

# The 31 columns of the cleaned table, in table order.
CLEANED_COLUMNS = [
    "ID", "TITLE", "JOB_CATEGORY", "JOB_DATE", "CITY", "STATE",
    "EMPLOYMENT_TYPE", "ORGANIZATION", "ORGANIZATION_URL", "URL",
    "SOURCE_TYPE", "SOURCE", "SOURCE_DOMAIN", "ORGANIZATION_LOGO",
    "REMOTE_DERIVED", "RECRUITER_NAME", "RECRUITER_TITLE", "RECRUITER_URL",
    "LINKEDIN_ORG_URL", "ORG_SIZE", "LINKEDIN_ORG_INDUSTRY",
    "LINKEDIN_ORG_HEADQUARTERS", "LINKEDIN_ORG_TYPE", "LINKEDIN_ORG_FOUNDEDDATE",
    "LINKEDIN_ORG_SPECIALTIES", "LINKEDIN_ORG_LOCATIONS",
    "LINKEDIN_ORG_DESCRIPTION", "LINKEDIN_ORG_RECRUITMENT_AGENCY_DERIVED",
    "SENIORITY", "DIRECTAPPLY", "LINKEDIN_ORG_SLUG",
]

# The three columns replaced by standardised text, and the 28 that stay as keys.
STANDARDISED_COLUMNS = ["CITY", "STATE", "SENIORITY"]
KEPT_COLUMNS = [c for c in CLEANED_COLUMNS if c not in STANDARDISED_COLUMNS]

# Searched titles, translated columns, and the text for "missing".
SEARCH_TITLES = ["Data Engineer", "Data Scientist", "Data Analyst"]
TRANSLATED_COLUMNS = ["CITY", "STATE", "ORGANIZATION", "SENIORITY"]
MISSING_TEXT = "NA"

LOCATION = T.StructType([
    T.StructField("address", T.StructType([
        T.StructField("addressLocality", T.StringType()),
        T.StructField("addressRegion", T.StringType()),
        T.StructField("streetAddress", T.StringType()),
    ])),
])

_TYPES = {
    "LOCATIONS_RAW": T.ArrayType(LOCATION),
    "JOB_DATE": T.DateType(),
    "LINKEDIN_ORG_EMPLOYEES": T.LongType(),
    "LINKEDIN_ORG_FOLLOWERS": T.LongType(),
    **{c: T.ArrayType(T.StringType()) for c in (
        "LOCATION_REQUIREMENTS_RAW", "CITIES_DERIVED", "REGIONS_DERIVED",
        "COUNTRIES_DERIVED", "LOCATIONS_DERIVED", "TIMEZONES_DERIVED",
        "LINKEDIN_ORG_SPECIALTIES", "LINKEDIN_ORG_LOCATIONS")},
    **{c: T.ArrayType(T.DoubleType()) for c in ("LATS_DERIVED", "LNGS_DERIVED")},
    **{c: T.BooleanType() for c in (
        "REMOTE_DERIVED", "DIRECTAPPLY", "LINKEDIN_ORG_RECRUITMENT_AGENCY_DERIVED")},
}


def _struct(names: list[str], overrides: dict[str, T.DataType] | None = None) -> T.StructType:
    types = {**_TYPES, **(overrides or {})}
    return T.StructType([T.StructField(n, types.get(n.upper(), T.StringType())) for n in names])


RAW_SCHEMA = _struct(
    [c.lower() for c in EXPECTED_COLUMNS],
    {"EMPLOYMENT_TYPE": T.ArrayType(T.StringType())},
)
CLEANED_SCHEMA = _struct(CLEANED_COLUMNS)

# Landed rows that cannot be cleaned, with where they came from.
REJECTED_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("file", "job_category", "reason", "text")])
