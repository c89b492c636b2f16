"""Rule values and column names the SQL side is written with.

Fixed values, stated here a second time on purpose: a wrong value on the Spark side must not be
right on both.
"""

# City rules in order (whole text or part of it, lower case; standard name).
CITY_RULES = [
    ("is", "new south wales", "Sydney"),
    ("is", "capital australia", "Canberra"),
    ("is", "barzbin", "Brisbane"),
    ("is", "queensland", "Brisbane"),
    ("is", "south australia", "Adelaide"),
    ("is", "australian capital territory", "Canberra"),
    ("is", "victoria", "Melbourne"),
    ("is", "northern territory", "Darwin"),
    ("is", "west australia", "Perth"),
    ("has", "tasmania", "Hobart"),
    ("is", "no regrets", "Unknown"),
    ("is", "other side of the moon", "Unknown"),
    ("has", "sydney", "Sydney"),
    ("has", "melbourne", "Melbourne"),
    ("has", "brisbane", "Brisbane"),
    ("has", "canberra", "Canberra"),
    ("has", "perth", "Perth"),
    ("has", "adelaide", "Adelaide"),
    ("has", "darwin", "Darwin"),
    ("has", "hobart", "Hobart"),
]

# Seniority rules in order (part of the lower-case text; standard name).
SENIORITY_RULES = [
    ("medium-high", "Intermediate"),
    ("medium", "Intermediate"),
    ("intermediate", "Intermediate"),
    ("it does not correspond", "Not Applicable"),
    ("executive", "Manager/Executive"),
    ("not valid", "Not Applicable"),
    ("senior", "Senior"),
    ("minimum", "Entry Level"),
    ("management", "Manager/Executive"),
    ("without experience", "No Experience"),
    ("middle head manager", "Manager/Executive"),
    ("assistant", "Entry Level"),
    ("entry level", "Entry Level"),
    ("senior employee", "Senior"),
    ("mid-senior level", "Senior"),
    ("middle level seniors", "Senior"),
    ("middle", "Intermediate"),
    ("associate", "Entry Level"),
    ("not applicable", "Not Applicable"),
    ("manager", "Manager/Executive"),
    ("full-senior", "Senior"),
    ("medium-upper level manager", "Manager/Executive"),
    ("association", "Not Applicable"),
    ("base", "Entry Level"),
    ("some responsibility", "Intermediate"),
    ("unprecedented", "Not Applicable"),
    ("beginner", "Entry Level"),
    ("trainee", "No Experience"),
    ("medium-level", "Intermediate"),
    ("average seniority level", "Intermediate"),
    ("cadre", "Intermediate"),
    ("internship", "No Experience"),
    ("junior", "Entry Level"),
    ("first job", "No Experience"),
    ("director", "Manager/Executive"),
]
SENIORITY_DEFAULT = "Not Applicable"

# The state of each city, and texts that name no state.
CITY_STATES = [
    ("Perth", "WA"),
    ("Brisbane", "QLD"),
    ("Sydney", "NSW"),
    ("Melbourne", "VIC"),
    ("Canberra", "ACT"),
    ("Adelaide", "SA"),
    ("Hobart", "TAS"),
    ("Darwin", "NT"),
    ("Woden", "ACT"),
]
VAGUE_STATES = ["of", "on", "australia", "na"]

# The columns of the cleaned table in order, and those replaced by standard text.
CLEANED_COLUMNS = """
    ID TITLE JOB_CATEGORY JOB_DATE CITY
    STATE EMPLOYMENT_TYPE ORGANIZATION ORGANIZATION_URL URL
    SOURCE_TYPE SOURCE SOURCE_DOMAIN ORGANIZATION_LOGO REMOTE_DERIVED
    RECRUITER_NAME RECRUITER_TITLE RECRUITER_URL LINKEDIN_ORG_URL ORG_SIZE
    LINKEDIN_ORG_INDUSTRY LINKEDIN_ORG_HEADQUARTERS LINKEDIN_ORG_TYPE LINKEDIN_ORG_FOUNDEDDATE LINKEDIN_ORG_SPECIALTIES
    LINKEDIN_ORG_LOCATIONS LINKEDIN_ORG_DESCRIPTION LINKEDIN_ORG_RECRUITMENT_AGENCY_DERIVED SENIORITY DIRECTAPPLY
    LINKEDIN_ORG_SLUG
""".split()
STANDARDISED_COLUMNS = ["CITY", "STATE", "SENIORITY"]
KEPT_COLUMNS = [c for c in CLEANED_COLUMNS if c not in STANDARDISED_COLUMNS]
