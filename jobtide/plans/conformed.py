"""The conformed postings table and the posting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.functions.rules import SENIORITY_NAMES, standard_city, standard_seniority
from jobtide.operators.aggregate import collapse
from jobtide.operators.copies import CopyFilter, copy_filter, distinct_split
from jobtide.operators.lookup import BROADCAST_LIMIT, Measured, join_measured, keep, lookup_join, measure
from jobtide.plans.dimensions import (
    city_dimension,
    city_lookup,
    state_dimension,
    state_lookup,
)
from jobtide.schema import CLEANED_COLUMNS, KEPT_COLUMNS, STANDARDISED_COLUMNS

# Narrow columns that any two copies of a posting share.
COPY_PROBE = ["ID", "JOB_CATEGORY", "JOB_DATE"]
LINK_COLUMNS = ["ID", "TITLE", "JOB_CATEGORY", "URL"]


def join_city(df: DataFrame, cities: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Adds CITY_STANDARDIZED; rows whose CITY is null or unknown to the dimension go."""
    return lookup_join(df, city_lookup(cities), "CITY", limit=limit)


def join_state(df: DataFrame, states: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Adds the one STATE_STANDARDIZED of the standardised city; no row is multiplied."""
    return lookup_join(df, state_lookup(states), "CITY_STANDARDIZED", limit=limit)


def join_seniority(df: DataFrame, seniorities: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Adds SENIORITY_STANDARDIZED; rows whose SENIORITY is null go."""
    return lookup_join(df, seniorities.distinct(), "SENIORITY", limit=limit)


def numbered_states(state_of: Measured) -> Measured:
    """The one state of each city, with the places of city and state in the order of their texts.

    The greatest text is the one with the greatest number, and whole numbers can be aggregated by hash.
    Only for a side that fits a broadcast, as the order is made in one task.
    """
    by = lambda column: F.dense_rank().over(W.orderBy(F.col(column).asc_nulls_first())).cast("int")
    frame = state_of.frame.select(
        "*", by("CITY_STANDARDIZED").alias("_CITY"),
        F.when(F.col("STATE_STANDARDIZED").isNotNull(), by("STATE_STANDARDIZED")).alias("_STATE"))
    return state_of._replace(frame=keep(frame))


def collapse_numbered(located: DataFrame, places: DataFrame) -> DataFrame:
    """:func:`collapse` of rows that carry ``_CITY``, ``_STATE`` and ``_SENIORITY`` as numbers.

    MAX over texts makes Spark sort the rows at full width; over numbers it hashes them.
    """
    greatest = collapse(located, KEPT_COLUMNS, ["_CITY", "_STATE", "_SENIORITY"])
    cities = places.select("_CITY", F.col("CITY_STANDARDIZED").alias("CITY"))
    states = places.where("_STATE IS NOT NULL").select("_STATE", F.col("STATE_STANDARDIZED").alias("STATE")).distinct()
    named = greatest.join(F.broadcast(cities), "_CITY").join(F.broadcast(states), "_STATE", "left")
    return named.withColumn("SENIORITY", F.element_at(F.array(*map(F.lit, SENIORITY_NAMES)), F.col("_SENIORITY")))


def conformed_postings(
    cleaned: DataFrame,
    states: DataFrame | None = None,
    limit: int = BROADCAST_LIMIT,
    again: CopyFilter | None = None,
    in_place: bool = False,
) -> DataFrame:
    """Cleaned postings with standardised city, state and seniority, one row per posting.

    Written as the rewrite of "join three dimensions, then group and take MAX":

    * city and seniority dimensions hold every value of the table they are built from,
      so their inner joins are a null filter plus the rule expression itself;
    * MAX over the states of a city does not depend on the posting, so the state
      dimension is reduced to one row per city before its join and nothing fans out;
    * grouping by the 28 kept columns also removes exact duplicates, so no DISTINCT runs;
    * rows equal in all kept columns are equal in ID, category and day, so only rows that
      repeat in those three are grouped at all;
    * the three maxima are taken over the places of the texts in their order, by hash.

    What is left without copies is a map-only pass at full width with one measured broadcast,
    after two narrow passes (city with state; the three probe columns).  With copies the full
    width is read once more, for the rows that repeat, and only those are shuffled.
    ``states`` may be the stored state dimension of the same cleaned table, ``again`` the filter of
    its copies.  ``in_place`` says that rows with equal IDs are already in one partition, as in a
    table bucketed on it: then all rows are grouped where they lie, without exchange or sort.
    """
    if states is None:
        states = state_dimension(city_dimension(cleaned))
    state_of = measure(state_lookup(states), limit)
    if state_of.fits:
        state_of = numbered_states(state_of)

    def place(rows: DataFrame) -> DataFrame:
        seniority = standard_seniority(F.col("SENIORITY"))
        located = rows.select(
            *KEPT_COLUMNS, standard_city(F.col("CITY")).alias("CITY"), seniority.alias("SENIORITY"),
            F.array_position(F.array(*map(F.lit, SENIORITY_NAMES)), seniority).cast("int").alias("_SENIORITY"))
        return join_measured(located, state_of, "CITY", "CITY_STANDARDIZED").withColumnRenamed(
            "STATE_STANDARDIZED", "STATE"
        )

    def collapsed(rows: DataFrame) -> DataFrame:
        if state_of.fits:
            return collapse_numbered(place(rows), state_of.frame).select(*CLEANED_COLUMNS)
        return collapse(place(rows), KEPT_COLUMNS, STANDARDISED_COLUMNS).select(*CLEANED_COLUMNS)

    placeable = cleaned.where(F.col("CITY").isNotNull() & F.col("SENIORITY").isNotNull())
    if in_place:
        return collapsed(placeable)
    alone, repeated = (again or copy_filter(placeable, COPY_PROBE, limit)).split(placeable)
    if alone is None:
        return collapsed(repeated)
    single = place(alone).select(*CLEANED_COLUMNS)
    return single if repeated is None else single.unionByName(collapsed(repeated))


def posting_links(
    cleaned: DataFrame, limit: int = BROADCAST_LIMIT, again: CopyFilter | None = None, in_place: bool = False,
) -> DataFrame:
    """Distinct links; their order is applied when they are read.  Options as for the conformed table."""
    if in_place:
        return cleaned.select(*LINK_COLUMNS).distinct()
    return distinct_split(cleaned, LINK_COLUMNS, ["ID", "JOB_CATEGORY"], limit, again)
