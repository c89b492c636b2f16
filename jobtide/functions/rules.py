"""Ordered rule tables for city, state and seniority, and their folding into CASE.

Order decides: the first rule that holds gives the value.  Do not sort the tables
or drop entries that an earlier one shadows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

IS, HAS = "is", "has"

# City rules on the lower-cased text; no rule keeps the text.
CITY_RULES = [
    (IS, "new south wales", "Sydney"),
    (IS, "capital australia", "Canberra"),
    (IS, "barzbin", "Brisbane"),
    (IS, "queensland", "Brisbane"),
    (IS, "south australia", "Adelaide"),
    (IS, "australian capital territory", "Canberra"),
    (IS, "victoria", "Melbourne"),
    (IS, "northern territory", "Darwin"),
    (IS, "west australia", "Perth"),
    (HAS, "tasmania", "Hobart"),
    (IS, "no regrets", "Unknown"),
    (IS, "other side of the moon", "Unknown"),
    (HAS, "sydney", "Sydney"),
    (HAS, "melbourne", "Melbourne"),
    (HAS, "brisbane", "Brisbane"),
    (HAS, "canberra", "Canberra"),
    (HAS, "perth", "Perth"),
    (HAS, "adelaide", "Adelaide"),
    (HAS, "darwin", "Darwin"),
    (HAS, "hobart", "Hobart"),
]

# Seniority rules on the lower-cased, trimmed text.
SENIORITY_RULES = [
    (HAS, "medium-high", "Intermediate"),
    (HAS, "medium", "Intermediate"),
    (HAS, "intermediate", "Intermediate"),
    (HAS, "it does not correspond", "Not Applicable"),
    (HAS, "executive", "Manager/Executive"),
    (HAS, "not valid", "Not Applicable"),
    (HAS, "senior", "Senior"),
    (HAS, "minimum", "Entry Level"),
    (HAS, "management", "Manager/Executive"),
    (HAS, "without experience", "No Experience"),
    (HAS, "middle head manager", "Manager/Executive"),
    (HAS, "assistant", "Entry Level"),
    (HAS, "entry level", "Entry Level"),
    (HAS, "senior employee", "Senior"),
    (HAS, "mid-senior level", "Senior"),
    (HAS, "middle level seniors", "Senior"),
    (HAS, "middle", "Intermediate"),
    (HAS, "associate", "Entry Level"),
    (HAS, "not applicable", "Not Applicable"),
    (HAS, "manager", "Manager/Executive"),
    (HAS, "full-senior", "Senior"),
    (HAS, "medium-upper level manager", "Manager/Executive"),
    (HAS, "association", "Not Applicable"),
    (HAS, "base", "Entry Level"),
    (HAS, "some responsibility", "Intermediate"),
    (HAS, "unprecedented", "Not Applicable"),
    (HAS, "beginner", "Entry Level"),
    (HAS, "trainee", "No Experience"),
    (HAS, "medium-level", "Intermediate"),
    (HAS, "average seniority level", "Intermediate"),
    (HAS, "cadre", "Intermediate"),
    (HAS, "internship", "No Experience"),
    (HAS, "junior", "Entry Level"),
    (HAS, "first job", "No Experience"),
    (HAS, "director", "Manager/Executive"),
]
SENIORITY_DEFAULT = "Not Applicable"
# Every standardised seniority, in the order of the texts.
SENIORITY_NAMES = sorted({value for *_, value in SENIORITY_RULES} | {SENIORITY_DEFAULT})

# State texts that say nothing, and the state of nine cities.
VAGUE_STATES = ["of", "on", "australia", "na"]
CITY_STATES = {
    "Perth": "WA",
    "Brisbane": "QLD",
    "Sydney": "NSW",
    "Melbourne": "VIC",
    "Canberra": "ACT",
    "Adelaide": "SA",
    "Hobart": "TAS",
    "Darwin": "NT",
    "Woden": "ACT",
}
UNKNOWN_STATE = "UNKNOWN"


def first_match(subject: Column, rules: Iterable[tuple[str, str, str]], default: Column) -> Column:
    """One CASE over ``rules``; ``subject`` must already be lower-cased."""
    chain = F
    for how, key, value in rules:
        holds = subject == key if how == IS else subject.contains(key)
        chain = chain.when(holds, F.lit(value))
    return chain.otherwise(default)


def standard_city(city: Column) -> Column:
    return first_match(F.lower(city), CITY_RULES, city)


def standard_seniority(seniority: Column) -> Column:
    """Null and unknown texts become the default."""
    return first_match(F.lower(F.trim(seniority)), SENIORITY_RULES, F.lit(SENIORITY_DEFAULT))


def standard_state(state: Column, standardised_city: Column) -> Column:
    """Fill a vague state from the city; ``na`` elsewhere is unknown, the rest stays."""
    low = F.lower(state)
    vague = low.isin(VAGUE_STATES)
    chain = F
    for city, code in CITY_STATES.items():
        chain = chain.when(vague & (standardised_city == city), F.lit(code))
    return chain.when(low == "na", F.lit(UNKNOWN_STATE)).otherwise(state)
