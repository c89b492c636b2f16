"""Text and nested-value expressions used while cleaning a posting."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Misspellings of one city, and the name they become.
SYDNEY_SPELLINGS = ["sidney", "sídney", "悉尼"]
SYDNEY = "Sydney"

# Unicode white space plus the four ASCII separators a Python strip also removes.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def has_phrase(c: Column, phrases: list[str]) -> Column:
    """True when ``c`` holds one of ``phrases`` as whole words, in any case."""
    body = "|".join(re.escape(p).replace(r"\ ", " ") for p in phrases)
    return c.rlike(rf"(?iU)\b(?:{body})\b")


def has_substring(c: Column, phrases: list[str]) -> Column:
    """True when the lower-cased text contains one of ``phrases`` anywhere."""
    low = F.lower(c)
    return reduce(or_, [low.contains(p.lower()) for p in phrases])


def written_date(c: Column) -> Column:
    """Date part of an ISO text exactly as written: no shift to the session zone.

    Text that is no date becomes null; :func:`is_bad_date` tells it from a missing one.
    """
    return c.try_cast("date")


def is_bad_date(c: Column) -> Column:
    return (F.trim(c) != "") & c.try_cast("date").isNull()


def first_in_locations(locations: Column, field: str) -> Column:
    """First non-null ``address.<field>`` over an array of locations."""
    values = F.transform(locations, lambda x: x["address"][field])
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))


def fix_city_spelling(c: Column) -> Column:
    low = F.lower(c)
    misspelt = reduce(or_, [low.contains(s) for s in SYDNEY_SPELLINGS])
    return F.when(misspelt, F.lit(SYDNEY)).otherwise(c)


def posting_city(locations: Column) -> Column:
    return fix_city_spelling(first_in_locations(locations, "addressLocality"))


def posting_state(locations: Column) -> Column:
    """First region.  City and state may come from different entries of the list."""
    return strip(F.replace(first_in_locations(locations, "addressRegion"), F.lit("'"), F.lit("")))


def list_to_text(c: Column) -> Column:
    """``[a, b]`` to ``a, b``; a missing list stays null."""
    return strip(F.regexp_replace(F.array_join(c, ", "), r"[\[\]']", ""))


def employee_range(c: Column) -> Column:
    """``51-200 employees`` to ``51-200`` (the word is matched as written)."""
    return strip(F.replace(c, F.lit("employees"), F.lit("")))
