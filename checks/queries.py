"""One registered query per operator, over whole driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures as X
from checks import values as V
from jobtide.functions import calendar as cal
from jobtide.functions import rules, text
from jobtide.functions.salary import exact_mean
from jobtide.operators import aggregate as agg
from jobtide.operators import copies, filters, lookup, order, project, sets, trend
from jobtide.operators.collapse import collapse_by_place
from jobtide.plans import conformed as conf
from jobtide.plans import dimensions as dims
from jobtide.plans import listings as lst
from jobtide.plans import marts
from jobtide.plans.backfill import ingest
from jobtide.plans.ingest import Layout, clean_records, rejected_rows
from jobtide.plans.refresh import refresh
from jobtide.schema import CLEANED_COLUMNS, CLEANED_SCHEMA, KEPT_COLUMNS, STANDARDISED_COLUMNS
from jobtide.sources import landing, tables
from jobtide.streaming.incremental import ingest_arrivals

AS_OF = dt.date(2001, 8, 1)
PROPS = T.StructType([T.StructField("k", T.LongType())])

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def flat(df: DataFrame) -> DataFrame:
    """Array columns as text, so that any client can compare rows."""
    return df.select(*[
        F.array_join(f.name, "|").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields
    ])


def conformed(spark, sf_dir) -> DataFrame:
    return conf.conformed_postings(X.postings(spark, sf_dir))


def stored_conformed(spark, sf_dir) -> DataFrame:
    """The conformed table as a run stores it, for reads that need it more than once."""
    return tables.stored_scratch(conformed(spark, sf_dir), "conformed")


def stored_sightings(spark, sf_dir) -> DataFrame:
    """The cleaned table with copies as a run stores it, bucketed by ID."""
    path = tables.scratch_folder(spark, "sightings") + "/rows"
    tables.create_table(spark, path, CLEANED_SCHEMA, buckets=("ID", int(spark.conf.get("spark.sql.shuffle.partitions"))))
    tables.append_table(X.sightings(spark, sf_dir), path, schema=CLEANED_SCHEMA)
    return tables.read_table(spark, path, CLEANED_SCHEMA)


def daily(spark, sf_dir) -> DataFrame:
    return agg.daily_mart(conformed(spark, sf_dir))


def stored_daily(spark, sf_dir) -> DataFrame:
    return tables.stored_scratch(daily(spark, sf_dir), "daily")


def wow(spark, sf_dir) -> DataFrame:
    return trend.wow_trend(daily(spark, sf_dir), AS_OF)


def city_mart(spark, sf_dir):
    return marts.mart(conformed(spark, sf_dir), "by_city")


# --- sources and sinks -----------------------------------------------------------


@query
def s1_read_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = landing.parse_json_text(X.table(spark, sf_dir, "events"), "props", PROPS, "p")
    return parsed.select("event_id", F.col("p.k").alias("k"))


@query
def s1_landing_round_trip(spark, sf_dir):
    path = tables.scratch_folder(spark, "landing") + "/rows"
    X.raw_postings(spark, sf_dir).drop("o_orderstatus").write.partitionBy("job_category").json(path)
    raw = landing.read_raw(spark, path)
    return raw.select("id", "title", "job_category", "date_created", "organization", F.size("locations_raw").alias("places"))


@query
def s2_flatten_structs(spark, sf_dir):
    customers, nations = X.table(spark, sf_dir, "customer"), X.table(spark, sf_dir, "nation")
    nested = customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        F.col("c_custkey").alias("id"),
        F.struct(
            F.col("c_name").alias("name"),
            F.struct(F.col("n_name").alias("nation"), F.col("n_regionkey").alias("region")).alias("place"),
        ).alias("org"),
    )
    return landing.flatten_structs(nested, sep="_")


@query
def s3_tag_pages(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    titles = dict(zip(["F", "O", "P"], V.CATEGORIES))
    return landing.union_pages([
        landing.tag_title(orders.where(F.col("o_orderstatus") == status), title) for status, title in titles.items()
    ])


@query
def s4_union_pages(spark, sf_dir):
    customers = X.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = X.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("supplier")
    )
    return landing.union_pages([customers, suppliers])


@query
def s5_reject_split(spark, sf_dir):
    events = X.table(spark, sf_dir, "events").withColumn(
        "props",
        F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{broken"), "props")).otherwise(F.col("props")),
    )
    parsed = landing.parse_json_text(events, "props", PROPS, "p").withColumn("bad", F.col("p._corrupt_record"))
    good, rejected = landing.split_rejects(parsed, "bad")
    return landing.union_pages([
        good.select("event_id", F.lit("good").alias("outcome"), F.col("p.k").alias("k")),
        rejected.select("event_id", F.lit("rejected").alias("outcome")),
    ])


@query
def s6_existing_ids(spark, sf_dir):
    return tables.existing_postings(X.postings(spark, sf_dir))


@query
def s7_append(spark, sf_dir):
    path = tables.scratch_folder(spark, "cleaned") + "/rows"
    cleaned = X.postings(spark, sf_dir)
    tables.create_table(spark, path, CLEANED_SCHEMA)
    tables.append_table(cleaned, path, schema=CLEANED_SCHEMA)
    again = cleaned.withColumn("ID", F.concat(F.lit("again-"), "ID")).select(*reversed(CLEANED_COLUMNS))
    tables.append_table(again, path)
    return tables.read_table(spark, path).select("ID", "TITLE", "JOB_DATE", "CITY", "REMOTE_DERIVED")


@query
def s7_append_by_day(spark, sf_dir):
    """The default layout of the cleaned table, a folder for each day."""
    days = Layout("", "", "").partition_by
    path = tables.scratch_folder(spark, "cleaned") + "/rows"
    cleaned = X.postings(spark, sf_dir)
    tables.create_table(spark, path, CLEANED_SCHEMA, days)
    tables.append_table(cleaned, path, days, CLEANED_SCHEMA)
    return tables.read_table(spark, path, CLEANED_SCHEMA).select("ID", "TITLE", "JOB_DATE", "CITY", "REMOTE_DERIVED")


@query
def s8_full_refresh(spark, sf_dir):
    path = tables.scratch_folder(spark, "by_type") + "/rows"
    cleaned = X.postings(spark, sf_dir)
    tables.overwrite_table(cleaned.select("JOB_CATEGORY", "TITLE"), path)
    return tables.overwrite_table(agg.count_distinct_mart(cleaned, ["JOB_CATEGORY"]), path)


@query
def s8_extended_table(spark, sf_dir):
    """A refreshed table with two later parts, each a version of its own."""
    path = tables.scratch_folder(spark, "links") + "/rows"
    links = X.postings(spark, sf_dir).select("ID", "TITLE", "JOB_CATEGORY", "URL")
    part = F.crc32(F.col("ID").cast("binary")) % 3
    tables.overwrite_table(links, path)
    tables.overwrite_table(links.where(part == 0), path)
    for upto in (1, 2):
        tables.extend_table(links.where(part == upto), path, upto)
    return tables.read_table(spark, path)


@query
def s9_mart_read(spark, sf_dir):
    path = tables.scratch_folder(spark, "by_city") + "/rows"
    tables.overwrite_table(city_mart(spark, sf_dir), path)
    return lst.city_listing(tables.read_table(spark, path))


@query
def s10_cached_result(spark, sf_dir):
    """Cities beside the greatest total of their category, from one evaluation of the mart."""
    with tables.cached(city_mart(spark, sf_dir)) as held:
        most = held.groupBy("JOB_CATEGORY").agg(F.max("total_jobs").alias("most"))
        return tables.stored_scratch(held.join(most, "JOB_CATEGORY"), "cached")


# --- projections, filters, predicates ----------------------------------------------


@query
def p1_upper_names(spark, sf_dir):
    return project.upper_names(X.table(spark, sf_dir, "part"))


@query
def p2_contract(spark, sf_dir):
    return project.project_contract(
        X.table(spark, sf_dir, "part"), ["p_partkey", "p_type", "p_brand", "p_origin"], on_missing="null"
    )


@query
def p3_relevant_columns(spark, sf_dir):
    wide = X.postings(spark, sf_dir).withColumns({"LOCATION_TYPE": F.lit("x"), "DATE_POSTED": F.col("JOB_DATE")})
    return flat(project.relevant_columns(wide))


@query
def p4_title_phrase(spark, sf_dir):
    return filters.title_phrase_filter(X.postings(spark, sf_dir).select("ID", "TITLE"))


@query
def p5_title_contains(spark, sf_dir):
    return filters.title_contains_filter(X.postings(spark, sf_dir).select("ID", "TITLE"))


@query
def p6_blank_to_null(spark, sf_dir):
    return project.blank_to_null(X.postings(spark, sf_dir).select("ID", "SENIORITY", "RECRUITER_NAME", "DIRECTAPPLY"))


@query
def p7_display_names(spark, sf_dir):
    details = project.display_names(X.postings(spark, sf_dir), lst.DETAIL_NAMES)
    return lst.link_table(details).withColumnRenamed("Job Link", "Job_Link")


@query
def p8_facet_filter(spark, sf_dir):
    chosen = lst.filter_details(
        lst.job_details(conformed(spark, sf_dir)), role="Data Engineer", state="WA", city="All", organization="All"
    )
    return chosen


@query
def p9_before_newest(spark, sf_dir):
    return filters.before_newest(stored_daily(spark, sf_dir))


@query
def p10_to_date_days(spark, sf_dir):
    return filters.to_date_days(daily(spark, sf_dir), AS_OF)


@query
def p11_report_params(spark, sf_dir):
    return filters.with_report_params(daily(spark, sf_dir), AS_OF)


@query
def p12_same_layout(spark, sf_dir):
    cleaned = X.postings(spark, sf_dir)
    shuffled = cleaned.select(*sorted(CLEANED_COLUMNS))
    aligned = project.align_to(shuffled, cleaned)
    return aligned.select(
        "ID", "CITY",
        F.lit(project.same_layout(shuffled, cleaned)).alias("same_before"),
        F.lit(project.same_layout(aligned, cleaned)).alias("same_after"),
    )


# --- joins -----------------------------------------------------------------------------


@query
def j1_new_documents(spark, sf_dir):
    return lookup.keep_new(
        X.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"),
        X.table(spark, sf_dir, "labels"),
        on="doc_id",
    )


@query
def j1_new_postings(spark, sf_dir):
    cleaned = X.postings(spark, sf_dir).select("ID", "CITY", "ORGANIZATION", "LINKEDIN_ORG_TYPE")
    return lookup.keep_new(cleaned, cleaned.where(F.col("LINKEDIN_ORG_TYPE") == "F"))


@query
def j2_city_join(spark, sf_dir):
    cleaned = X.postings(spark, sf_dir).select("ID", "CITY", "STATE")
    return conf.join_city(cleaned, dims.city_dimension(cleaned))


@query
def j3_state_join(spark, sf_dir):
    cleaned = X.postings(spark, sf_dir).select("ID", "CITY", "STATE")
    cities = dims.city_dimension(cleaned)
    return conf.join_state(conf.join_city(cleaned, cities), dims.state_dimension(cities))


@query
def j4_seniority_join(spark, sf_dir):
    cleaned = X.postings(spark, sf_dir).select("ID", "SENIORITY")
    return conf.join_seniority(cleaned, dims.seniority_dimension(cleaned))


@query
def j5_with_params(spark, sf_dir):
    days = filters.with_report_params(daily(spark, sf_dir), AS_OF)
    return days.where(
        (cal.day_of_week(F.col("date")) <= F.col("report_dow")) & (F.col("date") <= F.col("report_date"))
    ).select("JOB_CATEGORY", cal.week_start(F.col("date")).alias("week_start"), "total_jobs", "report_date", "report_dow")


@query
def j6_value_map(spark, sf_dir):
    return lookup.map_values(
        X.postings(spark, sf_dir).select("ID", "CITY", "ORGANIZATION"), ["CITY"], X.dictionary(spark, sf_dir)
    )


# --- aggregations ------------------------------------------------------------------------


@query
def a1_jobs_by_city(spark, sf_dir):
    return city_mart(spark, sf_dir)


@query
def a2_jobs_by_org(spark, sf_dir):
    return marts.mart(conformed(spark, sf_dir), "by_org")


@query
def a3_jobs_by_state(spark, sf_dir):
    return marts.mart(conformed(spark, sf_dir), "by_state")


@query
def a4_jobs_by_type(spark, sf_dir):
    return marts.mart(conformed(spark, sf_dir), "by_type")


@query
def a5_jobs_daily(spark, sf_dir):
    return daily(spark, sf_dir)


@query
def a6_weekly_sums(spark, sf_dir):
    return trend.weekly_sums(daily(spark, sf_dir))


@query
def a7_collapse(spark, sf_dir):
    keys = ["ID", "TITLE", "JOB_CATEGORY", "RECRUITER_NAME", "EMPLOYMENT_TYPE"]
    # Dealt by ID first, so that a task sorts one shuffle partition and not a whole split of the scan.
    rows = X.sightings(spark, sf_dir).select(*keys, *STANDARDISED_COLUMNS).repartition("ID")
    return agg.collapse(rows, keys, STANDARDISED_COLUMNS)


@query
def a7_collapse_all_keys(spark, sf_dir):
    rows = tables.stored_scratch(X.sightings(spark, sf_dir), "sightings")
    return flat(collapse_by_place(rows, KEPT_COLUMNS, STANDARDISED_COLUMNS))


@query
def a8_date_bounds(spark, sf_dir):
    return agg.bounds(daily(spark, sf_dir))


@query
def a9_job_totals(spark, sf_dir):
    return lst.job_totals(X.postings(spark, sf_dir))


@query
def a10_daily_jobs(spark, sf_dir):
    return lst.daily_jobs(stored_daily(spark, sf_dir))


@query
def a11_salary_by_title(spark, sf_dir):
    return lst.salary_by_title(X.salary(spark, sf_dir))


@query
def a12_salary_by_state(spark, sf_dir):
    return lst.salary_by_state(X.salary(spark, sf_dir))


@query
def a13_distinct_links(spark, sf_dir):
    return agg.distinct_rows(X.sightings(spark, sf_dir), ["ID", "TITLE", "JOB_CATEGORY", "URL"])


@query
def a14_distinct_values(spark, sf_dir):
    return agg.distinct_values(X.postings(spark, sf_dir), "CITY")


@query
def a15_stage_counts(spark, sf_dir):
    """The counts of a real ingest over a table that holds some of the postings."""
    layout = _landed(spark, sf_dir)
    _with_history(spark, sf_dir, layout)
    report = ingest(spark, layout)
    stages = {"landed": report.counts["landed"], "title_kept": report.counts["title_kept"],
              "known": report.known, "fresh": report.counts["appended"]}
    return spark.createDataFrame(list(stages.items()), "stage string, rows bigint")


# --- windows -------------------------------------------------------------------------------


@query
def w1_previous_week(spark, sf_dir):
    return trend.with_previous_week(trend.weekly_sums(daily(spark, sf_dir)))


@query
def w2_wow_to_date(spark, sf_dir):
    return wow(spark, sf_dir)


@query
def w3_wow_complete(spark, sf_dir):
    return trend.wow_trend(daily(spark, sf_dir), mode=trend.COMPLETE)


# --- sort, limit, top-k ---------------------------------------------------------------------


@query
def o1_org_mart_order(spark, sf_dir):
    return order.read_order(marts.mart(conformed(spark, sf_dir), "by_org"), "by_org")


@query
def o2_unknown_last(spark, sf_dir):
    flag, _ = order.unknown_last()
    return lst.state_listing(marts.mart(conformed(spark, sf_dir), "by_state")).withColumn("unknown_rank", flag)


@query
def o3_latest_trend(spark, sf_dir):
    return trend.latest_trend(wow(spark, sf_dir))


@query
def o4_detail_order(spark, sf_dir):
    return lst.job_details(X.postings(spark, sf_dir)).select("Post_Date", "Job_Role", "LinkedIn_Post_Link")


@query
def o5_total_descending(spark, sf_dir):
    return order.by_total_descending(marts.mart(conformed(spark, sf_dir), "by_org"))


@query
def o6_salary_order(spark, sf_dir):
    ranked = X.salary(spark, sf_dir).groupBy("JOB_TITLE", "STATES").agg(
        exact_mean(F.col("SALARY_RANGE_HIGH")).alias("AVG_SALARY")
    )
    return order.in_order(ranked, "JOB_TITLE", "-AVG_SALARY")


@query
def o7_preview(spark, sf_dir):
    links = X.postings(spark, sf_dir).select("JOB_DATE", "ID", "TITLE")
    first = order.first_rows(links, 5, "JOB_DATE", "ID").withColumn("side", F.lit("first"))
    return first.union(order.last_rows(links, 5, "JOB_DATE", "ID").withColumn("side", F.lit("last")))


# --- set operations ----------------------------------------------------------------------------


@query
def u1_role_choices(spark, sf_dir):
    fact = stored_conformed(spark, sf_dir)
    return lst.role_choices([marts.mart(fact, name) for name in ("by_state", "by_city", "by_org")])


@query
def u2_facet_values(spark, sf_dir):
    return lst.detail_choices(conformed(spark, sf_dir))


# --- scalar functions -----------------------------------------------------------------------------


@query
def f1_written_date(spark, sf_dir):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00"))
    events = X.table(spark, sf_dir, "events")
    return events.select("event_id", text.written_date(iso).alias("job_date"))


@query
def f2_city_of_locations(spark, sf_dir):
    raw = X.raw_postings(spark, sf_dir)
    return raw.select("id", text.first_in_locations(F.col("locations_raw"), "addressLocality").alias("city"))


@query
def f3_state_of_locations(spark, sf_dir):
    return X.raw_postings(spark, sf_dir).select("id", text.posting_state(F.col("locations_raw")).alias("state"))


@query
def f4_city_spelling(spark, sf_dir):
    return X.raw_postings(spark, sf_dir).select("id", text.posting_city(F.col("locations_raw")).alias("city"))


@query
def f5_employment_text(spark, sf_dir):
    return X.raw_postings(spark, sf_dir).select("id", text.list_to_text(F.col("employment_type")).alias("employment"))


@query
def f6_employee_range(spark, sf_dir):
    return X.raw_postings(spark, sf_dir).select("id", text.employee_range(F.col("linkedin_org_size")).alias("org_size"))


@query
def f7_translate(spark, sf_dir):
    cleaned = project.blank_to_null(X.postings(spark, sf_dir).select("ID", "CITY", "STATE", "ORGANIZATION", "SENIORITY"))
    return lookup.normalise_via_dictionary(
        cleaned, ["CITY", "STATE", "ORGANIZATION", "SENIORITY"], X.dictionary(spark, sf_dir)
    )


@query
def f8_city_rules(spark, sf_dir):
    return X.postings(spark, sf_dir).select("ID", "CITY", rules.standard_city(F.col("CITY")).alias("city_standardized"))


@query
def f9_seniority_rules(spark, sf_dir):
    return X.postings(spark, sf_dir).select(
        "ID", "SENIORITY", rules.standard_seniority(F.col("SENIORITY")).alias("seniority_standardized")
    )


@query
def f10_state_fill(spark, sf_dir):
    city = rules.standard_city(F.col("CITY"))
    return X.postings(spark, sf_dir).select(
        "ID", "CITY", "STATE", rules.standard_state(F.col("STATE"), city).alias("state_standardized")
    )


@query
def f11_date_parts(spark, sf_dir):
    day = F.col("job_day")
    return X.postings(spark, sf_dir).select("ID", F.col("JOB_DATE").alias("job_day")).select(
        "ID", "job_day",
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        cal.day_of_week(day).alias("dow"),
        cal.week_start(day).alias("week_monday"),
        cal.week_start(day, "sunday").alias("week_sunday"),
        F.date_sub(day, 1).alias("day_before"),
    )


@query
def f12_safe_ratio(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey", cal.safe_ratio(F.col("o_custkey"), F.col("o_orderkey") % 4).alias("ratio")
    )


@query
def f13_trend_label(spark, sf_dir):
    return trend.with_trend_label(wow(spark, sf_dir))


@query
def f14_salary_bands(spark, sf_dir):
    return lst.salary_bands(X.salary(spark, sf_dir))


@query
def f15_reported_period(spark, sf_dir):
    return lst.reported_period(daily(spark, sf_dir))


# --- composed --------------------------------------------------------------------------------------


def _land(rows: DataFrame, path: str) -> None:
    """Landing files as they are sent: compressed, one record per line, of a bounded length."""
    writer = rows.write.mode("append").partitionBy("job_category").option("ignoreNullFields", False)
    writer.option("compression", "gzip").option("maxRecordsPerFile", 1_000_000).json(path)


def _landed(spark, sf_dir, partition_by=()) -> Layout:
    """Raw records and the dictionary of the driver tables, written as a run would find them."""
    root = tables.scratch_folder(spark, "run")
    layout = Layout(f"{root}/tables", f"{root}/landing", f"{root}/dictionary", partition_by)
    raw = X.raw_postings(spark, sf_dir).drop("o_orderstatus")
    _land(raw, layout.landing)
    X.dictionary(spark, sf_dir).write.parquet(layout.dictionary)
    return layout


def _with_history(spark, sf_dir, layout: Layout) -> None:
    history = X.postings(spark, sf_dir).where(F.col("LINKEDIN_ORG_TYPE") == "F")
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA)
    tables.append_table(history, layout.cleaned, schema=CLEANED_SCHEMA)


def _ingested(spark, layout: Layout) -> DataFrame:
    return flat(tables.read_table(spark, layout.cleaned, CLEANED_SCHEMA).select(*CLEANED_COLUMNS))


@query
def c1_ingest(spark, sf_dir):
    layout = _landed(spark, sf_dir)
    _with_history(spark, sf_dir, layout)
    for _ in range(2):
        ingest(spark, layout)
    return _ingested(spark, layout)


@query
def c1_clean_records(spark, sf_dir):
    return flat(clean_records(X.raw_postings(spark, sf_dir)))


@query
def c1_arrivals(spark, sf_dir):
    layout = _landed(spark, sf_dir)
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA)
    ingest_arrivals(spark, layout)
    ingest_arrivals(spark, layout)
    return _ingested(spark, layout)


@query
def c1_arrivals_split(spark, sf_dir):
    """Arrivals taken a few files at a time."""
    layout = _landed(spark, sf_dir)
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA)
    ingest_arrivals(spark, layout, files_per_batch=2)
    return _ingested(spark, layout)


@query
def c1_arrivals_missing_key(spark, sf_dir):
    """Arrivals one file at a time, some of them without a contract column: the call as a whole has it."""
    root = tables.scratch_folder(spark, "lacking")
    layout = Layout(f"{root}/tables", f"{root}/landing", f"{root}/dictionary", ())
    X.dictionary(spark, sf_dir).write.parquet(layout.dictionary)
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA)
    raw = tables.stored_scratch(X.raw_postings(spark, sf_dir).drop("o_orderstatus"), "raw")
    early = F.crc32(F.col("id").cast("binary")) % 2 == 0
    slices = 1 + raw.count() // 5_000_000  # of a title, so that a large landing is written by more tasks than there are titles
    for rows in (raw.where(early).drop("linkedin_org_slug"), raw.where(~early)):
        _land(rows.repartition("job_category", F.monotonically_increasing_id() % slices), layout.landing)
    ingest_arrivals(spark, layout, files_per_batch=1)
    return _ingested(spark, layout)


def _drifted(spark, sf_dir) -> Layout:
    """Landed records that differ in field types, some with bad dates, and broken lines beside them."""
    root = tables.scratch_folder(spark, "drift")
    layout = Layout(f"{root}/tables", f"{root}/landing", f"{root}/dictionary", ())
    X.dictionary(spark, sf_dir).write.parquet(layout.dictionary)
    tables.create_table(spark, layout.cleaned, CLEANED_SCHEMA)
    raw = tables.stored_scratch(X.raw_postings(spark, sf_dir).drop("o_orderstatus"), "raw")
    key = F.replace("id", F.lit("job-"), F.lit("")).cast("bigint")
    dated = raw.withColumn("date_created", F.when(key % 97 == 0, F.lit("next week")).otherwise(F.col("date_created")))
    other = {
        1: ("employment_type", F.array_join("employment_type", ", ")),
        2: ("linkedin_org_specialties", F.get("linkedin_org_specialties", F.lit(0))),
        3: ("remote_derived", F.when(F.col("remote_derived"), "yes").otherwise("no")),
        4: ("locations_raw", F.get("locations_raw", F.lit(0))),
    }
    for part in range(5):
        name, value = other.get(part, ("id", F.col("id")))
        _land(dated.where(key % 5 == part).withColumn(name, value), layout.landing)
    broken = raw.where(key % 89 == 0).select(F.concat(F.lit("{broken "), "id").alias("value"), "job_category")
    broken.write.mode("append").partitionBy("job_category").text(layout.landing)
    return layout


@query
def c1_drifting_types(spark, sf_dir):
    layout = _drifted(spark, sf_dir)
    ingest(spark, layout)
    return _ingested(spark, layout)


@query
def c1_rejected(spark, sf_dir):
    layout = _drifted(spark, sf_dir)
    for _ in range(2):
        ingest(spark, layout)
    kept = rejected_rows(spark, layout)
    return kept.select("reason", "job_category", F.coalesce(F.get_json_object("text", "$.id"), "text").alias("id"))


@query
def c2_city_dimension(spark, sf_dir):
    return dims.city_dimension(X.postings(spark, sf_dir))


@query
def c3_state_dimension(spark, sf_dir):
    return dims.state_dimension(dims.city_dimension(X.postings(spark, sf_dir)))


@query
def c4_seniority_dimension(spark, sf_dir):
    return dims.seniority_dimension(X.postings(spark, sf_dir))


@query
def c5_conformed(spark, sf_dir):
    return flat(conformed(spark, sf_dir))


@query
def c5_conformed_copies(spark, sf_dir):
    return flat(conf.conformed_postings(stored_sightings(spark, sf_dir), in_place=True))


@query
def c5_conformed_split(spark, sf_dir):
    """Copies in rows that are not dealt by ID, told by a Bloom filter."""
    rows = tables.stored_scratch(X.sightings(spark, sf_dir), "sightings")
    return flat(conf.conformed_postings(rows, again=copies.copy_filter(rows, marts.MART_PROBE, limit=-1)))


@query
def c6_posting_links(spark, sf_dir):
    rows = tables.stored_scratch(X.sightings(spark, sf_dir).select(*conf.LINK_COLUMNS), "sightings")
    return order.read_order(conf.posting_links(rows), "posting_links")


@query
def c6_posting_links_in_place(spark, sf_dir):
    return conf.posting_links(stored_sightings(spark, sf_dir), in_place=True)


@query
def c7_all_marts(spark, sf_dir):
    return _long_form(marts.all_marts(stored_conformed(spark, sf_dir), AS_OF))


def _long_form(made: dict[str, DataFrame]) -> DataFrame:
    """All six marts as (mart, role, item, total)."""
    item = {
        "by_city": F.col("CITY"), "by_org": F.col("ORGANIZATION"), "by_state": F.col("STATE"),
        "by_type": F.lit(None).cast("string"), "daily": F.col("date").cast("string"),
        "wow_trend": F.col("week_start").cast("string"),
    }
    return landing.union_pages([
        made[name].select(
            F.lit(name).alias("mart"), F.col("JOB_CATEGORY").alias("role"), column.alias("item"),
            F.col("this_week_jobs" if name == "wow_trend" else "total_jobs").alias("total"),
        )
        for name, column in item.items()
    ])


@query
def c8_job_details(spark, sf_dir):
    return lst.job_details(conformed(spark, sf_dir))


@query
def c9_state_listing(spark, sf_dir):
    return lst.role_listing(lst.state_listing(marts.mart(conformed(spark, sf_dir), "by_state")), "Data Analyst")


@query
def c9_city_listing(spark, sf_dir):
    return lst.role_listing(lst.city_listing(city_mart(spark, sf_dir)))


@query
def c9_org_listing(spark, sf_dir):
    return lst.role_listing(lst.org_listing(marts.mart(conformed(spark, sf_dir), "by_org")), "Data Engineer")


@query
def c10_skills_listing(spark, sf_dir):
    return lst.top_skills(X.skills(spark, sf_dir))


def _refreshed(spark, sf_dir, whole: bool = False, **layout_options) -> dict[str, DataFrame]:
    """The models after two runs, each with one part of the landing.

    The second extends the models of the first, or builds all of them again.
    """
    root = tables.scratch_folder(spark, "run")
    layout = Layout(f"{root}/tables", f"{root}/landing", f"{root}/dictionary", **layout_options)
    X.dictionary(spark, sf_dir).write.parquet(layout.dictionary)
    raw = tables.stored_scratch(X.raw_postings(spark, sf_dir).drop("o_orderstatus"), "raw")
    early = F.crc32(F.col("id").cast("binary")) % 2 == 0
    for part in (early, ~early):
        _land(raw.where(part), layout.landing)
        result = refresh(spark, layout, AS_OF, whole)
    return result.tables


@query
def c11_refresh_run(spark, sf_dir):
    return _long_form(_refreshed(spark, sf_dir, partition_by=()))


@query
def c11_refresh_rebuilt(spark, sf_dir):
    """All models built again from a table bucketed by ID."""
    return _long_form(_refreshed(spark, sf_dir, whole=True, partition_by=(), buckets=4))


@query
def c11_refresh_by_day(spark, sf_dir):
    """With the default layout of the cleaned table, a folder for each day."""
    return _long_form(_refreshed(spark, sf_dir))


@query
def c11_refresh_conformed(spark, sf_dir):
    return flat(_refreshed(spark, sf_dir, partition_by=())["conformed"].select(*CLEANED_COLUMNS))


@query
def c11_refresh_dimensions(spark, sf_dir):
    """The other four models as (model, a, b, c, d)."""
    made = _refreshed(spark, sf_dir, partition_by=())
    none = F.lit(None).cast("string")
    columns = {
        "base_city": ["CITY", "CITY_STANDARDIZED", "STATE"], "base_state": ["CITY_STANDARDIZED", "STATE_STANDARDIZED"],
        "base_seniority": ["SENIORITY", "SENIORITY_STANDARDIZED"], "posting_links": ["ID", "TITLE", "JOB_CATEGORY", "URL"],
    }
    return landing.union_pages([
        made[model].select(F.lit(model).alias("model"), *[
            (F.col(names[i]) if i < len(names) else none).alias(letter) for i, letter in enumerate("abcd")])
        for model, names in columns.items()
    ])


@query
def d1_trend_cards(spark, sf_dir):
    return lst.trend_cards(wow(spark, sf_dir))


@query
def d2_salary_states(spark, sf_dir):
    return lst.salary_states_of(X.salary(spark, sf_dir), "ECONOMY")
