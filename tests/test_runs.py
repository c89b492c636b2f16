"""Whole runs: ingest twice, arrivals, refresh, and properties of the conformed table."""

import dataclasses
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from checks import fixtures as X
from jobtide.operators.aggregate import collapse, daily_mart
from jobtide.plans import conformed as conf
from jobtide.plans import dimensions as dims
from jobtide.plans import ingest as ingest_plan
from jobtide.plans import refresh as runs
from jobtide.plans.arrivals import Arrivals
from jobtide.plans.backfill import ingest
from jobtide.plans.ingest import Layout, rejected_rows
from jobtide.plans.marts import all_marts, count_marts, mart
from jobtide.plans.refresh import refresh
from jobtide.schema import CLEANED_COLUMNS, CLEANED_SCHEMA, EXPECTED_COLUMNS, KEPT_COLUMNS, STANDARDISED_COLUMNS
from jobtide.sources import tables
from jobtide.sources.landing import absent_keys, is_rejected, landed_lines, names_of, parse_landed
from jobtide.streaming.incremental import ingest_arrivals

from conftest import SMALL


def record(n, title="Data Engineer", **more):
    place = {"address": {"addressLocality": "Sidney", "addressRegion": "NSW", "streetAddress": None}}
    return {
        **{c.lower(): None for c in EXPECTED_COLUMNS if c != "JOB_CATEGORY"}, "id": None if n is None else f"{n}", "title": title, "date_created": "2025-05-18T10:00:00", "locations_raw": [place],
        "employment_type": ["FULL_TIME"], "organization": "Acme", "seniority": "", **more,
    }


@pytest.fixture
def layout(spark, tmp_path):
    made = Layout(str(tmp_path / "tables"), str(tmp_path / "landing"), str(tmp_path / "dictionary"))
    words = [("Acme", "Acme Ltd"), ("NSW", "New South Wales")]
    spark.createDataFrame(words, "value string, translated string").write.parquet(made.dictionary)
    return made


def land(layout, category, name, records):
    from pathlib import Path

    folder = Path(layout.landing) / f"job_category={category}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


def cleaned(spark, layout):
    return tables.read_table(spark, layout.cleaned, CLEANED_SCHEMA).select(*CLEANED_COLUMNS)


def test_ingest_counts_and_is_idempotent(spark, layout):
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    land(layout, "Data Engineer", "a", [record(1), record(2, "Florist"), record(3, None), "{broken", record(None)])
    land(layout, "Data Analyst", "a", [record(1)])
    report = ingest(spark, layout)
    assert report.status == "loaded"
    assert report.counts == {"landed": 6, "rejected": 1, "title_kept": 3, "appended": 3}
    rows = cleaned(spark, layout).orderBy("JOB_CATEGORY", "ID").collect()
    assert [(r.ID, r.JOB_CATEGORY) for r in rows] == [("1", "Data Analyst"), (None, "Data Engineer"), ("1", "Data Engineer")]
    assert {(r.CITY, r.STATE, r.ORGANIZATION, r.SENIORITY) for r in rows} == {("Sydney", "New South Wales", "Acme Ltd", "NA")}
    assert {(r.JOB_DATE, r.EMPLOYMENT_TYPE, r.ORG_SIZE) for r in rows} == {(dt.date(2025, 5, 18), "FULL_TIME", None)}
    again = ingest(spark, layout)
    assert again.status == "nothing_new" and again.counts["appended"] == 0
    assert cleaned(spark, layout).count() == 3


def test_ingest_without_data(spark, layout):
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA)
    land(layout, "Data Engineer", "a", [record(1, "Florist"), "not json"])
    report = ingest(spark, layout)
    assert report.status == "no_data" and report.counts["rejected"] == 1
    assert cleaned(spark, layout).count() == 0


def test_keys_with_a_value_are_not_listed(spark, layout, monkeypatch):
    """Listing the keys of every record is a second parse; a value that was read already proves its key."""
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    keys = [c.lower() for c in EXPECTED_COLUMNS if c != "JOB_CATEGORY"]
    full = {**{k: "x" for k in keys}, **{k: v for k, v in record(1).items() if v is not None}}
    halves = [{k: v if (place + half) % 2 else None for place, (k, v) in enumerate(full.items())} for half in (0, 1)]
    land(layout, "Data Engineer", "a", [*({**h, "title": "Data Engineer", "id": f"{n}"} for n, h in enumerate(halves)), "{broken"])
    monkeypatch.setattr(ingest_plan, "FIRST_RECORDS", 0)
    monkeypatch.setattr(ingest_plan, "absent_keys", lambda *_: F.raise_error(F.lit("keys are listed")).cast("bigint"))
    assert ingest(spark, layout).counts == {"landed": 3, "rejected": 1, "title_kept": 2, "appended": 2}


@pytest.mark.parametrize("first", [0, 1, 1000])
def test_absent_keys_are_those_of_no_record(spark, layout, monkeypatch, first):
    """A key that is null everywhere is there, wherever its record is; one that no record has is not."""
    monkeypatch.setattr(ingest_plan, "FIRST_RECORDS", first)
    names = ingest_plan.LANDED_KEYS
    lacking = {k: v for k, v in record(1).items() if k not in ("source", "url")}
    cases = {
        "null_value": ([lacking, lacking, {**lacking, "source": None}], ["url"]),
        "all_there": ([lacking, {**lacking, "source": None}, {**lacking, "url": None}], []),
        "of_a_list": ([[lacking, {**lacking, "url": "x"}]], ["source"]),
        "nested_list": ([lacking, [[{**lacking, "url": "x", "source": "x"}]]], ["source", "url"]),
        "broken": (["{broken", {}], names),
        "no_object": (["{broken", "7"], None),
    }
    for case, (records, missing) in cases.items():
        land(layout, "Data Engineer", case, [r if isinstance(r, str) else json.dumps(r) for r in records])
        path = f"{layout.landing}/job_category=Data Engineer/{case}.json"
        landed = parse_landed(landed_lines(spark, path), record=ingest_plan.RECORD)
        good = landed.where(~is_rejected())
        marked, lacking = ingest_plan.maybe_absent(landed)
        got = ingest_plan.absent_everywhere(landed, marked.agg(F.bit_and(lacking)).first()[0])
        assert (None if got is None else sorted(names_of(got, names))) == (None if missing is None else sorted(missing)), case
        assert got == good.agg(F.bit_and(absent_keys(F.col(ingest_plan.RECORD), names))).first()[0], case


def test_missing_target_raises(spark, layout):
    land(layout, "Data Engineer", "a", [record(1)])
    with pytest.raises(Exception, match="(?i)not exist|PATH_NOT_FOUND"):
        ingest(spark, layout)


def test_arrivals_take_each_file_once(spark, layout):
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    land(layout, "Data Engineer", "a", [record(1), record(2)])
    assert sum(r.counts["appended"] for r in ingest_arrivals(spark, layout)) == 2
    land(layout, "Data Analyst", "b", [record(2), record(3)])
    second = ingest_arrivals(spark, layout)
    assert [(r.counts["landed"], r.counts["appended"]) for r in second] == [(2, 1)]
    assert ingest_arrivals(spark, layout) == []
    for n in (4, 5, 6):
        land(layout, "Data Engineer", f"c{n}", [record(n), record(3)])
    split = ingest_arrivals(spark, layout, files_per_batch=1)
    assert [r.counts["appended"] for r in split] == [1, 1, 1]
    assert {r.ID for r in cleaned(spark, layout).collect()} == {"1", "2", "3", "4", "5", "6"}


@pytest.mark.parametrize("files_per_batch", [None, 1, 2])
def test_rows_do_not_depend_on_the_micro_batches(spark, layout, rows, files_per_batch):
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    land(layout, "Data Engineer", "a", [record(1), record(2)])
    land(layout, "Data Analyst", "b", [record(1)])
    land(layout, "Data Scientist", "c", [record(1), record(3)])
    ingest_arrivals(spark, layout, files_per_batch)
    assert rows(cleaned(spark, layout).select("ID", "JOB_CATEGORY")) == [
        ("1", "Data Analyst"), ("1", "Data Engineer"), ("1", "Data Scientist"), ("2", "Data Engineer"), ("3", "Data Scientist")]
    land(layout, "Data Analyst", "d", [record(2), record(4)])
    assert [r.counts["appended"] for r in ingest_arrivals(spark, layout, files_per_batch)] == [1]


def test_a_field_of_another_type_costs_no_record(spark, layout):
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    place = record(0)["locations_raw"][0]
    drifting = [
        record(1, employment_type="FULL_TIME"), record(2, linkedin_org_specialties="data"), record(3, remote_derived="yes"),
        record(4, locations_raw=place), record(5, lats_derived="north", id=5), record(6, linkedin_org_employees="many"), record(7),
    ]
    bad = [record(8, date_created="next week"), "{broken"]
    land(layout, "Data Engineer", "a", [*drifting, *bad, record(9, "Florist", date_created="never")])
    report = ingest(spark, layout)
    assert report.counts == {"landed": 10, "rejected": 2, "title_kept": 7, "appended": 7}
    assert report.counts["landed"] == report.counts["appended"] + report.known + report.title_dropped + report.counts["rejected"]
    got = {r.ID: r for r in cleaned(spark, layout).collect()}
    assert set(got) == {str(n) for n in range(1, 8)}
    assert got["1"].EMPLOYMENT_TYPE == "FULL_TIME" and got["2"].LINKEDIN_ORG_SPECIALTIES == ["data"]
    assert got["3"].REMOTE_DERIVED is True and got["4"].CITY == "Sydney"
    for _ in range(2):
        kept = rejected_rows(spark, layout).collect()
        assert {(r.reason, r.job_category) for r in kept} == {("not JSON", "Data Engineer"), ("bad date", "Data Engineer")}
        assert len(kept) == 2 and all(r.file.endswith("a.json") for r in kept)
        assert any("next week" in r.text for r in kept) and any(r.text == "{broken" for r in kept)
        assert ingest(spark, layout).status == "nothing_new"


def test_a_missing_contract_column_fails_before_the_append(spark, layout):
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    lacking = {k: v for k, v in record(1).items() if k not in ("url", "linkedin_org_slug")}
    land(layout, "Data Engineer", "a", [lacking])
    with pytest.raises(ValueError, match="'URL', 'LINKEDIN_ORG_SLUG'"):
        ingest(spark, layout)
    assert cleaned(spark, layout).count() == 0
    filling = dataclasses.replace(layout, on_missing="null")
    assert ingest(spark, filling).counts["appended"] == 1


def lacking(n, *names, **more):
    return {k: v for k, v in record(n, **more).items() if k not in names}


@pytest.mark.parametrize("files_per_batch", [None, 1, 2])
def test_a_column_that_some_file_has_is_there(spark, layout, files_per_batch):
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    land(layout, "Data Engineer", "a", [lacking(1, "linkedin_org_slug")])
    land(layout, "Data Engineer", "b", [record(2), lacking(3, "url")])
    assert sum(r.counts["appended"] for r in ingest_arrivals(spark, layout, files_per_batch)) == 3
    assert sorted(r.ID for r in cleaned(spark, layout).collect()) == ["1", "2", "3"]


@pytest.mark.parametrize("files_per_batch", [None, 1, 2])
@pytest.mark.parametrize("mended_by", ["file", "layout"])
def test_a_column_that_no_file_has_stops_the_call_and_the_next_goes_on(spark, layout, files_per_batch, mended_by):
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    land(layout, "Data Engineer", "a", [lacking(1, "linkedin_org_slug")])
    land(layout, "Data Engineer", "b", [lacking(2, "linkedin_org_slug"), lacking(3, "linkedin_org_slug", "url")])
    for _ in range(2):
        with pytest.raises(ValueError, match=r"\['LINKEDIN_ORG_SLUG'\]"):
            ingest_arrivals(spark, layout, files_per_batch)
        assert cleaned(spark, layout).count() == 0
    if mended_by == "file":
        land(layout, "Data Engineer", "c", [record(1), record(4)])
        ingest_arrivals(spark, layout, files_per_batch)
        assert sorted(r.ID for r in cleaned(spark, layout).collect()) == ["1", "2", "3", "4"]
    else:
        ingest_arrivals(spark, dataclasses.replace(layout, on_missing="null"), files_per_batch)
        assert sorted(r.ID for r in cleaned(spark, layout).collect()) == ["1", "2", "3"]
    land(layout, "Data Engineer", "d", [record(2), record(5)])
    assert [r.counts["appended"] for r in ingest_arrivals(spark, layout, files_per_batch)] == [1]


@pytest.mark.parametrize("step", ["append_table", "rename_path", "_mark"])
def test_a_call_that_stops_is_gone_on_with(spark, layout, monkeypatch, step):
    from jobtide.plans import arrivals

    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    land(layout, "Data Engineer", "a", [record(1), record(2)])
    stops = [True]

    def stopping(real, after):
        def run(*args, **kwargs):
            if after:
                real(*args, **kwargs)
            if stops.pop() if stops else False:
                raise RuntimeError("stopped")
            if not after:
                real(*args, **kwargs)
        return run

    owner = Arrivals if step == "_mark" else arrivals
    monkeypatch.setattr(owner, step, stopping(getattr(owner, step), after=step != "rename_path"))
    with pytest.raises(RuntimeError, match="stopped"):
        ingest_arrivals(spark, layout)
    land(layout, "Data Engineer", "b", [record(2), record(3)])
    ingest_arrivals(spark, layout)
    assert sorted(r.ID for r in cleaned(spark, layout).collect()) == (["1", "2", "2", "3"] if step == "rename_path" else ["1", "2", "3"])


def test_landed_text_is_read_once(spark, layout):
    """Of the rows that the stream reports as read, each is counted as often as it is scanned."""
    from jobtide.plans.ingest import take_records
    from jobtide.streaming.incremental import landing_stream

    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    land(layout, "Data Engineer", "a", [record(n) for n in range(20)] + ["{broken", record(99, date_created="x")])
    query = landing_stream(spark, layout.landing).writeStream.foreachBatch(
        lambda batch, number: take_records(batch, layout, f"arrival={number}", layout.table(f"rows-{number}")) and None
    ).option("checkpointLocation", layout.table("_once")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 22
    assert rejected_rows(spark, layout).count() == 2


def test_arrays_blank_lines_and_scalars(spark, layout):
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    page = json.dumps([record(1), record(2)])
    land(layout, "Data Engineer", "a", [page, "", "   ", record(3), "[]", "[{", "5"])
    report = ingest(spark, layout)
    assert report.counts == {"landed": 5, "rejected": 2, "title_kept": 3, "appended": 3}
    assert sorted(r.text for r in rejected_rows(spark, layout).collect()) == ["5", "[{"]
    whole = dataclasses.replace(layout, root=layout.root + "2", landing=layout.landing + "2", multi_line=True)
    tables.create_table(spark, whole.cleaned, CLEANED_SCHEMA, whole.partition_by)
    land(whole, "Data Engineer", "a", [page])
    land(whole, "Data Engineer", "b", ["[{", "]"])
    assert ingest(spark, whole).counts == {"landed": 3, "rejected": 1, "title_kept": 2, "appended": 2}


def states(n, state, city="Elsewhere"):
    place = {"address": {"addressLocality": city, "addressRegion": state, "streetAddress": None}}
    return record(n, locations_raw=[place], organization=f"Org {n}")


@pytest.mark.parametrize("options", [{"partition_by": ()}, {"buckets": 2}])
def test_extended_models_equal_rebuilt_ones(spark, layout, rows, options):
    layout = dataclasses.replace(layout, **options)
    days = dt.date(2025, 5, 21)
    parts = [
        [states(1, "NSW"), states(1, "VIC", "Other"), states(2, "QLD"), record(None)],
        [states(3, "ACT"), states(3, "ACT", "Third"), record(4), record(None), states(1, "WA")],
        [states(5, "WA"), record(6, seniority=None), states(7, None, None)],  # the state of a known city changes
        [record(8, "Florist")],
        [states(9, "TAS", "Third"), states(9, "TAS", "Third"), states(9, "NT")],
    ]
    for number, part in enumerate(parts):
        land(layout, "Data Engineer" if number % 2 else "Data Analyst", f"part{number}", part)
        extended = refresh(spark, layout, days).tables
        got = {name: rows(df) for name, df in extended.items()}
        rebuilt = runs.refresh_models(spark, layout, days, whole=True) if number in (2, 4) else None
        if rebuilt:
            assert got == {name: rows(df) for name, df in rebuilt.items()}
    assert len(got["conformed"]) == 9


def test_extending_reads_no_cleaned_table(spark, layout, monkeypatch):
    land(layout, "Data Engineer", "a", [record(n) for n in range(1, 6)])
    refresh(spark, layout, dt.date(2025, 5, 21))
    land(layout, "Data Engineer", "b", [record(n) for n in range(5, 8)])
    ingest_arrivals(spark, layout)
    monkeypatch.setattr(runs, "_cleaned", lambda *_: pytest.fail("the cleaned table is read"))
    made = runs.refresh_models(spark, layout, dt.date(2025, 5, 21))
    assert made["conformed"].count() == 7 and made["by_type"].first()["total_jobs"] == 7


def test_a_refresh_that_stopped_between_models_builds_them_again(spark, layout, monkeypatch, rows):
    days = dt.date(2025, 5, 21)
    land(layout, "Data Engineer", "a", [record(n) for n in range(1, 6)])
    refresh(spark, layout, days)
    land(layout, "Data Engineer", "b", [record(n) for n in range(5, 8)])
    monkeypatch.setattr(runs, "posting_links", lambda *_, **__: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh(spark, layout, days)
    assert runs.made_from(spark, layout) is None
    monkeypatch.undo()
    made = refresh(spark, layout, days).tables
    assert rows(made["by_type"]) == [("Data Engineer", 7)] and made["conformed"].count() == made["posting_links"].count() == 7
    assert refresh(spark, layout, days).tables["conformed"].count() == 7


def test_refresh_reads_new_files_only(spark, layout):
    land(layout, "Data Engineer", "a", [record(n) for n in range(1, 6)])
    assert refresh(spark, layout, dt.date(2025, 5, 21)).ingest.counts["landed"] == 5
    land(layout, "Data Engineer", "b", [record(n) for n in range(4, 8)])
    second = refresh(spark, layout, dt.date(2025, 5, 21)).ingest
    assert second.counts["landed"] == 4 and second.counts["appended"] == 2 and second.known == 2


def test_refresh_runs_twice(spark, layout, rows):
    land(layout, "Data Engineer", "a", [record(n) for n in range(1, 6)])
    first = refresh(spark, layout, dt.date(2025, 5, 21))
    assert first.ingest.counts["appended"] == 5
    assert rows(first.tables["by_city"]) == [("Data Engineer", "Sydney", 5)]
    land(layout, "Data Analyst", "b", [record(n) for n in range(6, 9)])
    second = refresh(spark, layout, dt.date(2025, 5, 21))
    assert second.ingest.counts["appended"] == 3
    assert rows(second.tables["by_type"]) == [("Data Analyst", 3), ("Data Engineer", 5)]
    assert set(second.tables) == {
        "base_city", "base_state", "base_seniority", "conformed", "posting_links", "by_city", "by_org",
        "by_state", "by_type", "daily", "wow_trend",
    }
    assert rows(second.tables["conformed"].select("STATE", "SENIORITY").distinct()) == [("New South Wales", "Not Applicable")]


def mixed(spark):
    """Postings, some of them stored again with another city, state and seniority."""
    again = X.sightings(spark, SMALL).where("LINKEDIN_ORG_INDUSTRY = 'BUILDING'")
    return X.postings(spark, SMALL).union(again)


def test_conformed_equals_fan_out_form(spark, rows):
    df = mixed(spark).cache()
    cities = dims.city_dimension(df)
    fanned = (
        df.withColumnRenamed("STATE", "s").join(cities.select("CITY", "CITY_STANDARDIZED").distinct(), "CITY")
        .join(dims.state_dimension(cities), "CITY_STANDARDIZED").join(dims.seniority_dimension(df), "SENIORITY")
        .select(
            *KEPT_COLUMNS, F.col("CITY_STANDARDIZED").alias("CITY"), F.col("STATE_STANDARDIZED").alias("STATE"),
            F.col("SENIORITY_STANDARDIZED").alias("SENIORITY"),
        )
    )
    want = rows(collapse(fanned, KEPT_COLUMNS, STANDARDISED_COLUMNS).select(*CLEANED_COLUMNS))
    assert rows(conf.conformed_postings(df)) == want
    assert rows(conf.conformed_postings(df, limit=-1)) == want
    assert rows(conf.conformed_postings(df, dims.state_dimension(cities))) == want
    df.unpersist()


def test_links_are_distinct(spark, rows):
    df = mixed(spark)
    want = rows(df.select("ID", "TITLE", "JOB_CATEGORY", "URL").distinct())
    assert rows(conf.posting_links(df)) == want
    assert rows(conf.posting_links(df, limit=-1)) == want


def test_state_belongs_to_the_city(spark):
    df = X.postings(spark, SMALL)
    per_city = conf.conformed_postings(df).groupBy("CITY").agg(F.countDistinct("STATE").alias("n"))
    assert per_city.where("n > 1").count() == 0


def test_daily_total_is_the_distinct_count(spark):
    fact = conf.conformed_postings(mixed(spark)).cache()
    total = daily_mart(fact).agg(F.sum("total_jobs")).first()[0]
    assert total == fact.select("ID", "JOB_CATEGORY", "JOB_DATE").distinct().count()
    fact.unpersist()


def test_shared_counting_equals_single_marts(spark, rows):
    fact = conf.conformed_postings(mixed(spark)).cache()
    doubled = fact.union(fact.where("STATE = 'WA'").withColumn("CITY", F.lit("Elsewhere"))).cache()
    for df in (fact, doubled):
        shared = count_marts(df)
        for name in ("by_city", "by_org", "by_state", "by_type"):
            assert rows(shared[name]) == rows(mart(df, name))
        assert rows(shared["daily"]) == rows(daily_mart(df))
    assert set(all_marts(fact, dt.date(2001, 8, 1))) == {"by_city", "by_org", "by_state", "by_type", "daily", "wow_trend"}
    fact.unpersist()
    doubled.unpersist()


def test_lines_of_few_files_are_dealt_over_all_tasks(spark, tmp_path):
    """Compressed files, one a batch; equal lines are spread, too, and each keeps the name of its file."""
    from jobtide.sources.landing import FILE, dealt_lines, landed_lines

    rows = spark.range(400).selectExpr("if(id < 300, 'same', concat('line ', id)) AS value").coalesce(1)
    rows.write.option("compression", "gzip").text(str(tmp_path / "landing"))
    lines = landed_lines(spark, str(tmp_path / "landing"))
    dealt = dealt_lines(lines, 4).withColumn("task", F.spark_partition_id())
    counts = [r.n for r in dealt.groupBy("task").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(counts) == 4 and sum(counts) == 400 and max(counts) < 150
    assert sorted(r.value for r in dealt.collect()) == sorted(r.value for r in lines.collect())
    files = {r[FILE] for r in dealt.collect()}
    assert len(files) == 1 and files.pop().endswith(".txt.gz")


def test_an_ingest_writes_new_rows_once_beside_the_parsed_batch(spark, tmp_path, monkeypatch):
    """Records that are all stored already are counted by ID and written nowhere; landing files are compressed."""
    from checks import queries as Q
    from jobtide.plans import ingest as I

    written, staged = [], I._staged
    monkeypatch.setattr(I, "_staged", lambda df, path: written.append(path) or staged(df, path))
    layout = Q._landed(spark, SMALL)
    files = [name for title in tables.list_names(spark, layout.landing) if title.startswith("job_category")
             for name in tables.list_names(spark, f"{layout.landing}/{title}")]
    assert files and all(name.endswith(".json.gz") for name in files)
    tables.create_table(spark, layout.cleaned, I.CLEANED_SCHEMA)
    first, again = ingest(spark, layout), ingest(spark, layout)
    assert first.counts["appended"] == again.known > 0 and again.status == "nothing_new"
    assert [path.rsplit("/", 1)[1] for path in written] == ["batch", "batch"]


def test_a_key_of_some_batch_is_settled_without_a_second_read(spark, layout, monkeypatch):
    """Batches whose records all lack a column are read again only where no other batch has it."""
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    for n in range(1, 4):
        land(layout, "Data Engineer", f"a{n}", [lacking(n, "linkedin_org_slug")])
    land(layout, "Data Engineer", "b", [record(4)])
    with monkeypatch.context() as patch:
        patch.setattr(ingest_plan, "absent_everywhere", lambda *_: pytest.fail("the text is read again"))
        assert sum(r.counts["appended"] for r in ingest_arrivals(spark, layout, 1)) == 4
    land(layout, "Data Engineer", "c", [lacking(5, "url")])
    land(layout, "Data Engineer", "d", [lacking(6, "url", "source")])
    read, real = [], ingest_plan.absent_everywhere
    monkeypatch.setattr(ingest_plan, "absent_everywhere", lambda *a: read.append(1) or real(*a))
    with pytest.raises(ValueError, match=r"\['URL'\]"):
        ingest_arrivals(spark, layout, 1)
    assert read == [1]


def test_batches_are_taken_side_by_side(spark, layout, monkeypatch):
    """Both batches wait for each other before they end."""
    import threading

    from jobtide.streaming import incremental

    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    land(layout, "Data Engineer", "a", [record(1)])
    land(layout, "Data Analyst", "b", [record(1), record(2)])
    both, take = threading.Barrier(2), incremental.take_records
    monkeypatch.setattr(incremental, "take_records", lambda *a: both.wait(60) is None or take(*a))
    assert sorted(r.counts["appended"] for r in ingest_arrivals(spark, layout, 1)) == [1, 2]


def test_batches_that_a_failed_call_listed_are_taken_by_the_next(spark, layout, monkeypatch, rows):
    from jobtide.streaming import incremental

    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    for n in range(1, 8):
        land(layout, "Data [Engineer]" if n % 2 else "01", f"f {n}", [record(n), "{broken"])
    take = incremental.take_records
    monkeypatch.setattr(incremental, "take_records", lambda lines, layout, name, into: 1 / 0 if name == "arrival=2" else take(lines, layout, name, into))
    with pytest.raises(ZeroDivisionError):
        ingest_arrivals(spark, layout, 1)
    assert cleaned(spark, layout).count() == 0
    monkeypatch.undo()
    land(layout, "01", "g", [record(8)])
    ingest_arrivals(spark, layout, 1)
    assert rows(cleaned(spark, layout).select("ID", "JOB_CATEGORY")) == [
        (str(n), "Data [Engineer]" if n % 2 else "01") for n in range(1, 9)]
    assert rejected_rows(spark, layout).count() == 7 and ingest_arrivals(spark, layout, 1) == []


def test_files_of_an_earlier_text_stream_are_not_taken_again(spark, layout):
    from jobtide.streaming.incremental import landing_stream

    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    land(layout, "Data Engineer", "a", [record(1)])
    earlier = landing_stream(spark, layout.landing).writeStream.foreachBatch(lambda *_: None)
    earlier.option("checkpointLocation", layout.table("_arrivals")).trigger(availableNow=True).start().awaitTermination()
    land(layout, "Data Engineer", "b", [record(2)])
    assert [r.counts["appended"] for r in ingest_arrivals(spark, layout)] == [1]
    assert [r.ID for r in cleaned(spark, layout).collect()] == ["2"]


def test_a_large_landing_is_written_by_more_tasks_than_titles(spark, monkeypatch):
    """Slices of a title; the number of rows is made up."""
    from checks import queries as Q

    landed, stored = [], tables.stored_scratch

    def large(df, name):
        held = stored(df, name)
        held.count = lambda: 12_000_000
        return held

    monkeypatch.setattr(Q.tables, "stored_scratch", large)
    monkeypatch.setattr(Q, "_land", lambda rows, path: landed.append(rows))
    monkeypatch.setattr(Q, "ingest_arrivals", lambda *_, **__: [])
    Q.c1_arrivals_missing_key(spark, SMALL)
    with tables._setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        for rows in landed:
            tasks = rows.select("job_category").withColumn("task", F.spark_partition_id()).distinct()
            assert tasks.count() > tasks.select("job_category").distinct().count() == 3


def test_arrivals_without_any_title_and_empty_files(spark, layout):
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA, layout.partition_by)
    land(layout, "__HIVE_DEFAULT_PARTITION__", "a", [record(1)])
    land(layout, "__HIVE_DEFAULT_PARTITION__", "b", [])
    assert sorted((r.status, r.counts["appended"]) for r in ingest_arrivals(spark, layout, 1)) == [("loaded", 1), ("no_data", 0)]
    assert [(r.ID, r.JOB_CATEGORY) for r in cleaned(spark, layout).collect()] == [("1", None)]
