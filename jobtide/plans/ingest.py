"""Ingest: landed records to new rows for the cleaned table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.text import (
    employee_range,
    has_phrase,
    is_bad_date,
    list_to_text,
    posting_city,
    posting_state,
    written_date,
)
from jobtide.operators.filters import title_phrase_filter
from jobtide.operators.lookup import keep_new, lookup_scope, normalise_via_dictionary
from jobtide.operators.project import blank_to_null, project_contract, relevant_columns, upper_names
from jobtide.schema import (
    CLEANED_COLUMNS,
    CLEANED_SCHEMA,
    EXPECTED_COLUMNS,
    RAW_SCHEMA,
    REJECTED_SCHEMA,
    SEARCH_TITLES,
    TRANSLATED_COLUMNS,
)
from jobtide.sources.landing import CORRUPT, FILE, absent_keys, conform, is_rejected, names_of, parse_landed, unread_keys
from jobtide.sources.tables import delete_path, read_table, scratch_path, table_exists

RECORD = "_record"
# The contract columns that are keys of the records; the title comes from the folder.
LANDED_KEYS = [c.lower() for c in EXPECTED_COLUMNS if c != "JOB_CATEGORY"]
ALL_KEYS = (1 << len(LANDED_KEYS)) - 1
# Records of a task whose keys are listed in any case.
FIRST_RECORDS = 1000
_PLACE = "_place"


@dataclass(frozen=True)
class Layout:
    """Where the tables live.  All paths must be visible to every executor."""

    root: str
    landing: str
    dictionary: str
    partition_by: Sequence[str] = ("JOB_DATE",)
    # Buckets of the cleaned table by ID; 0 for none.  Each is read by one task when postings are collapsed.
    buckets: int = 0
    multi_line: bool = False
    # "error": a contract column that no landed record has fails the ingest; "null" fills it.
    on_missing: str = "error"

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def cleaned(self) -> str:
        return self.table("cleaned_postings")

    @property
    def rejected(self) -> str:
        return self.table("rejected")


@dataclass(frozen=True)
class IngestReport:
    """Exact row counts of one ingest; ``status`` is loaded, no_data or nothing_new.

    landed = rejected + title_dropped + known + appended.
    """

    status: str
    counts: dict[str, int] = field(default_factory=dict)

    @property
    def title_dropped(self) -> int:
        return self.counts["landed"] - self.counts["rejected"] - self.counts["title_kept"]

    @property
    def known(self) -> int:
        return self.counts["title_kept"] - self.counts["appended"]


def _derived(contract: DataFrame) -> DataFrame:
    return contract.withColumns({
        "JOB_DATE": written_date(F.col("DATE_CREATED")),
        "CITY": posting_city(F.col("LOCATIONS_RAW")),
        "STATE": posting_state(F.col("LOCATIONS_RAW")),
        "EMPLOYMENT_TYPE": list_to_text(F.col("EMPLOYMENT_TYPE")),
        "ORG_SIZE": employee_range(F.col("LINKEDIN_ORG_SIZE")),
    })


def clean_records(good: DataFrame) -> DataFrame:
    """Parsed records to the 31 cleaned columns; map-side work only."""
    return relevant_columns(_derived(project_contract(upper_names(title_phrase_filter(good, "title")))))


def _staged(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a scratch table and read it back.

    Later steps read the columns they need, and a lost executor costs no second parse.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def absent_of_all(absent: Sequence[int | None]) -> int:
    """The contract keys that are absent from every batch; ``absent`` has those of each, None where it has no records."""
    masks = [mask for mask in absent if mask is not None]
    return reduce(and_, masks) if masks else 0


def check_contract(layout: Layout, absent: Sequence[int | None]) -> None:
    """Raise when a contract column is a key of no landed record.

    ``absent`` has the keys that no record of a batch has, see :func:`absent_keys`; None where a
    batch has no records.
    """
    nowhere = absent_of_all(absent)
    if nowhere and layout.on_missing == "error":
        missing = [name.upper() for name in names_of(nowhere, LANDED_KEYS)]
        raise ValueError(f"expected columns missing in source data: {missing}")


def maybe_absent(landed: DataFrame) -> tuple[DataFrame, Column]:
    """The records with a mark, and by it the contract keys that each may lack; null for what is no object.

    The keys of the first records of a task are listed, which settles keys that are null everywhere.
    Of the others a key may be absent if it has no value.
    """
    first = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1)) < FIRST_RECORDS
    record = F.col(RECORD)
    mask = F.when(first, absent_keys(record, LANDED_KEYS)).otherwise(unread_keys(record, LANDED_KEYS))
    return landed.withColumn(_PLACE, F.monotonically_increasing_id()), F.when(~is_rejected(CORRUPT), mask)


def absent_everywhere(landed: DataFrame, maybe: int | None) -> int | None:
    """The contract keys that no landed record has, see :func:`absent_keys`; None without records.

    ``maybe`` has the keys that every record may lack, see :func:`maybe_absent`; only if it leaves one
    open is the text read again, and the keys of all records are listed.
    """
    if maybe == 0:
        return 0
    good = landed.where(~is_rejected(CORRUPT))
    return good.agg(F.bit_and(absent_keys(F.col(RECORD), LANDED_KEYS))).first()[0]


def rejected_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    """The rejected records with file, title, reason and text, each once."""
    if not table_exists(spark, layout.rejected):
        return spark.createDataFrame([], REJECTED_SCHEMA)
    rows = spark.read.schema(REJECTED_SCHEMA).option("recursiveFileLookup", True).parquet(layout.rejected)
    return rows.distinct()


@dataclass(frozen=True)
class Taken:
    """What a batch left: its report, and the contract keys that each of its records may lack.

    None stands for no records; a key that is not among them is a key of some record.
    """

    report: IngestReport
    maybe_absent: int | None


def settled_absent(lines: DataFrame, maybe: int | None) -> int | None:
    """The contract keys that no record of landed text has, of those that :class:`Taken` leaves open."""
    return maybe if not maybe else absent_everywhere(parse_landed(lines, record=RECORD), maybe)


def take_records(lines: DataFrame, layout: Layout, name: str, into: str) -> Taken:
    """Take one batch of landed text (as :func:`landed_lines` gives it).

    The text is read and parsed once, by a map-only job that also counts the rows and notes which
    contract keys may be absent (a task that is run again counts once, as nothing is shuffled
    there); :func:`settled_absent` reads it again where that is not enough.  Records that are no JSON or have a date that is none go to the folder ``name`` of
    the rejected rows with their file, text and reason, so that a batch taken again writes its own
    folder anew; every other record is kept.  The rows not loaded before are counted by their IDs,
    then translated and written to ``into`` in one pass over the scratch table.
    """
    spark = lines.sparkSession
    landed = parse_landed(lines, record=RECORD, keep=[FILE])
    wanted = ~is_rejected(CORRUPT) & has_phrase(F.col("title"), SEARCH_TITLES)
    reason = F.when(is_rejected(CORRUPT), "not JSON").when(wanted & is_bad_date(F.col("date_created")), "bad date")
    seen = Observation()
    marked, lacking = maybe_absent(landed)
    counted = marked.observe(
        seen,
        F.count(F.lit(1)).alias("landed"),
        F.count(reason).alias("rejected"),
        F.count_if(wanted & reason.isNull()).alias("title_kept"),
        F.count_if(~is_rejected(CORRUPT)).alias("parsed"),
        F.bit_and(lacking).alias("maybe_absent"),
    )
    noted = counted.where(wanted | reason.isNotNull()).withColumns({
        "_reason": reason,
        "_file": F.col(FILE),
        "_text": F.when(reason.isNotNull(), F.col(RECORD)),
    })
    cleaned = _derived(upper_names(conform(noted.drop(RECORD, FILE, _PLACE)).drop(CORRUPT)))
    scratch = scratch_path(spark, "ingest")
    try:
        with lookup_scope():
            staged = _staged(cleaned.select(*CLEANED_COLUMNS, "_REASON", "_FILE", "_TEXT"), f"{scratch}/batch")
            batch = staged.where("_REASON IS NULL").select(*CLEANED_COLUMNS)
            counts = {name: seen.get.get(name) or 0 for name in ("landed", "rejected", "title_kept")}
            counts["appended"] = 0
            maybe = seen.get.get("maybe_absent")
            absent = None if not seen.get.get("parsed") else ALL_KEYS if maybe is None else maybe
            rejects = f"{layout.rejected}/{name}"
            if counts["rejected"]:
                staged.where("_REASON IS NOT NULL").select(
                    F.col("_FILE").alias("file"), F.col("JOB_CATEGORY").alias("job_category"),
                    F.col("_REASON").alias("reason"), F.col("_TEXT").alias("text"),
                ).write.mode("overwrite").parquet(rejects)
            elif table_exists(spark, rejects):
                delete_path(spark, rejects)
            if not counts["title_kept"]:
                return Taken(IngestReport("no_data", counts), absent)
            history = read_table(spark, layout.cleaned, CLEANED_SCHEMA)
            new = keep_new(batch, history)
            counts["appended"] = new.select("ID").count()
            if not counts["appended"]:
                return Taken(IngestReport("nothing_new", counts), absent)
            translated = normalise_via_dictionary(blank_to_null(new), TRANSLATED_COLUMNS, read_table(spark, layout.dictionary))
            translated.write.mode("overwrite").parquet(into)
            return Taken(IngestReport("loaded", counts), absent)
    finally:
        delete_path(spark, scratch)
