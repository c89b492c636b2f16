"""Text values the fixtures pick from, shared by the Spark fixture and the SQL one.

Every city, state and seniority rule is hit at least once; null, empty and unlisted
texts are included.
"""

TITLES = [
    "Senior Data Engineer",
    "data analyst - graduate",
    "Data Scientist (ML)",
    "Metadata Engineering Lead",
    "Software Developer",
]
RAW_TITLES = [*TITLES, None, "Sr DATA ENGINEER/x"]

CATEGORIES = ["Data Engineer", "Data Scientist", "Data Analyst"]

CITIES = [
    "New South Wales", "capital australia", "Barzbin", "Queensland", "south australia",
    "Australian Capital Territory", "VICTORIA", "northern territory", "West Australia",
    "Launceston Tasmania", "no regrets", "Other Side Of The Moon", "Greater Sydney Area",
    "Melbourne CBD", "Brisbane", "canberra region", "East Perth", "Adelaide Hills",
    "Darwin", "Hobart", "Woden", "Geelong", "Wagga Wagga", "NA", None, "Perth",
]
RAW_CITIES = [*CITIES, "Sidney CBD", "悉尼", "O'Connor"]

STATES = [
    "of", "NSW", "on", "VIC", "Australia", "Queensland", "NA", "WA", "OF", "SA", "na",
    None, "On",
]

SENIORITIES = [
    "Medium-High", "medium", "Intermediate", "It does not correspond", "Executive",
    "not valid", " Senior ", "minimum", "Management", "Without experience",
    "middle head manager", "Assistant", "Entry level", "senior employee",
    "Mid-Senior level", "Middle level seniors", "Middle", "Associate", "Not Applicable",
    "manager", "full-senior", "medium-upper level manager", "Association", "Base",
    "some responsibility", "unprecedented", "Beginner", "Trainee", "medium-level",
    "average seniority level", "Cadre", "Internship", "Junior", "First job", "Director",
    "NA", None, "Graduate programme", "", "SENIOR EXECUTIVE",
]

EMPLOYMENT = ["FULL_TIME", "PART_TIME, CONTRACTOR", None, "CONTRACTOR"]
RAW_EMPLOYMENT = ["FULL_TIME", "PART_TIME|CONTRACTOR", None, ""]
SIZES = ["51-200", "1 employee", None, "10,001+"]
RAW_SIZES = ["51-200 employees", "1 employee", None, "10,001+ employees "]
SOURCE_TYPES = ["ats", "jobboard"]
RECRUITERS = [None, "Ana Li", "Pat O'Hara", None, "Sam", "", "Kim"]
AGENCY = [True, False, None]
