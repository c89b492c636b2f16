"""Standardisation dimensions, each worked out once per distinct input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.functions.rules import standard_city, standard_seniority, standard_state
from jobtide.operators.aggregate import distinct_rows


def city_dimension(cleaned: DataFrame) -> DataFrame:
    """One row per raw (CITY, STATE) with the standardised city."""
    pairs = distinct_rows(cleaned, ["CITY", "STATE"])
    return pairs.select("CITY", standard_city(F.col("CITY")).alias("CITY_STANDARDIZED"), "STATE")


def state_dimension(cities: DataFrame) -> DataFrame:
    """Distinct (standardised city, standardised state); a city may have several states."""
    filled = cities.select(
        "CITY_STANDARDIZED",
        standard_state(F.col("STATE"), F.col("CITY_STANDARDIZED")).alias("STATE_STANDARDIZED"),
    )
    return filled.distinct()


def seniority_dimension(cleaned: DataFrame) -> DataFrame:
    """One row per distinct raw seniority, null included."""
    texts = distinct_rows(cleaned, ["SENIORITY"])
    return texts.select("SENIORITY", standard_seniority(F.col("SENIORITY")).alias("SENIORITY_STANDARDIZED"))


def city_lookup(cities: DataFrame) -> DataFrame:
    """The city dimension cut to one row per raw CITY."""
    return cities.select("CITY", "CITY_STANDARDIZED").distinct()


def state_lookup(states: DataFrame) -> DataFrame:
    """The state dimension cut to one row per city: its greatest state text.

    The state therefore belongs to the city, not to the posting: one stray state
    relabels every posting of the city.
    """
    return states.groupBy("CITY_STANDARDIZED").agg(F.max("STATE_STANDARDIZED").alias("STATE_STANDARDIZED"))
