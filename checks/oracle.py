"""SQL oracles, written against the naive form of each operator.

Nothing here uses the Spark code: dimensions fan out and are collapsed by GROUP BY,
rules are joined as a relation and the lowest rule number wins.
"""

from __future__ import annotations

from checks import values as V
from checks.rule_values import (
    CITY_RULES,
    CITY_STATES,
    CLEANED_COLUMNS,
    KEPT_COLUMNS,
    SENIORITY_DEFAULT,
    SENIORITY_RULES,
    VAGUE_STATES,
)

ORACLE: dict[str, str] = {}


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    return "'" + v.replace("'", "''") + "'"


def pick(index: str, texts: list) -> str:
    return f"([{', '.join(map(lit, texts))}])[CAST({index} AS INTEGER) + 1]"


ARRAYS = {"LINKEDIN_ORG_SPECIALTIES", "LINKEDIN_ORG_LOCATIONS"}


def flat(names: list[str]) -> str:
    return ", ".join(f"array_to_string({n}, '|') AS {n}" if n in ARRAYS else n for n in names)


def cleaned_select(city: str, state: str, seniority: str, source: str) -> str:
    return f"""SELECT concat('job-', o_orderkey) AS ID, {pick('o_orderkey % 5', V.TITLES)} AS TITLE,
      {pick('o_orderkey % 3', V.CATEGORIES)} AS JOB_CATEGORY, CAST(o_orderdate AS DATE) AS JOB_DATE,
      {pick(city, V.CITIES)} AS CITY, {pick(state, V.STATES)} AS STATE,
      {pick('o_orderkey % 4', V.EMPLOYMENT)} AS EMPLOYMENT_TYPE, c_name AS ORGANIZATION,
      concat('https://example.org/org/', c_custkey) AS ORGANIZATION_URL,
      concat('https://example.org/job/', o_orderkey) AS URL,
      {pick('o_orderkey % 2', V.SOURCE_TYPES)} AS SOURCE_TYPE, lower(c_mktsegment) AS SOURCE,
      concat(lower(c_mktsegment), '.example.org') AS SOURCE_DOMAIN,
      concat('https://example.org/logo/', c_nationkey) AS ORGANIZATION_LOGO,
      o_orderkey % 3 = 0 AS REMOTE_DERIVED, {pick('o_orderkey % 7', V.RECRUITERS)} AS RECRUITER_NAME,
      o_orderpriority AS RECRUITER_TITLE,
      concat('https://example.org/recruiter/', o_orderkey % 7) AS RECRUITER_URL,
      concat('https://example.org/page/', c_custkey) AS LINKEDIN_ORG_URL,
      {pick('c_custkey % 4', V.SIZES)} AS ORG_SIZE, c_mktsegment AS LINKEDIN_ORG_INDUSTRY,
      concat('Nation ', c_nationkey) AS LINKEDIN_ORG_HEADQUARTERS, o_orderstatus AS LINKEDIN_ORG_TYPE,
      CAST(1900 + c_custkey % 120 AS VARCHAR) AS LINKEDIN_ORG_FOUNDEDDATE,
      [o_orderpriority, lower(c_mktsegment)] AS LINKEDIN_ORG_SPECIALTIES,
      [concat('Nation ', c_nationkey)] AS LINKEDIN_ORG_LOCATIONS,
      concat(c_name, ' in ', c_mktsegment) AS LINKEDIN_ORG_DESCRIPTION,
      {pick('c_custkey % 3', V.AGENCY)} AS LINKEDIN_ORG_RECRUITMENT_AGENCY_DERIVED,
      {pick(seniority, V.SENIORITIES)} AS SENIORITY, o_orderkey % 2 = 1 AS DIRECTAPPLY,
      concat('org-', c_custkey) AS LINKEDIN_ORG_SLUG
    FROM {source}"""


OC = "orders JOIN customer ON o_custkey = c_custkey"
POSTINGS = cleaned_select("c_custkey % 26", "(c_custkey + o_orderkey % 2) % 13", "o_orderkey % 40", OC)
SIGHTINGS = cleaned_select(
    "(c_custkey + l_linenumber % 2) % 26",
    "(c_custkey + l_linenumber % 2) % 13",
    "(o_orderkey + l_linenumber) % 40",
    f"{OC} JOIN lineitem ON o_orderkey = l_orderkey",
)

# Landed records as (id, title, category, day, city, state, ...) after parsing.
_LOCALITY = pick("c_custkey % 29", V.RAW_CITIES)
RAW = f"""SELECT o_orderkey, o_orderstatus, o_orderpriority, c_mktsegment, concat('job-', o_orderkey) AS id,
      {pick('o_orderkey % 7', V.RAW_TITLES)} AS title, {pick('o_orderkey % 3', V.CATEGORIES)} AS job_category,
      CAST(o_orderdate AS DATE) AS job_date,
      CASE WHEN o_orderkey % 3 = 2 THEN coalesce({_LOCALITY}, 'Elsewhere') ELSE {_LOCALITY} END AS locality,
      {pick('(c_custkey + o_orderkey % 2) % 13', V.STATES)} AS state,
      {pick('o_orderkey % 4', V.EMPLOYMENT[:3] + [''])} AS employment,
      {pick('c_custkey % 4', V.SIZES)} AS org_size,
      CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END AS organization,
      concat('https://example.org/job/', o_orderkey) AS url, o_orderkey % 3 = 0 AS remote,
      {pick('o_orderkey % 7', V.RECRUITERS)} AS recruiter, {pick('o_orderkey % 40', V.SENIORITIES)} AS seniority,
      o_orderkey % 2 = 1 AS directapply
    FROM {OC}"""

_SPELT = "CASE WHEN regexp_matches(lower(locality), 'sidney|sídney|悉尼') THEN 'Sydney' ELSE locality END"
_PHRASE = r"regexp_matches({c}, '(?i)\b(data engineer|data scientist|data analyst)\b')"
_CONTAINS = "(lower({c}) LIKE '%data engineer%' OR lower({c}) LIKE '%data scientist%' OR lower({c}) LIKE '%data analyst%')"

_RAW_VALUES = {
    "ID": "id", "TITLE": "title", "JOB_CATEGORY": "job_category", "JOB_DATE": "job_date", "CITY": _SPELT,
    "STATE": "state", "EMPLOYMENT_TYPE": "employment", "ORGANIZATION": "organization", "URL": "url",
    "REMOTE_DERIVED": "remote", "RECRUITER_NAME": "recruiter", "ORG_SIZE": "org_size",
    "LINKEDIN_ORG_INDUSTRY": "c_mktsegment", "SENIORITY": "seniority", "DIRECTAPPLY": "directapply",
    "LINKEDIN_ORG_SPECIALTIES": "[o_orderpriority, lower(c_mktsegment)]",
}
RAW_CLEANED = "SELECT " + ", ".join(
    f"{_RAW_VALUES.get(n, 'CAST(NULL AS ' + ('VARCHAR[]' if n in ARRAYS else 'BOOLEAN' if n.endswith('AGENCY_DERIVED') else 'VARCHAR') + ')')} AS {n}"
    for n in CLEANED_COLUMNS
) + f", o_orderstatus FROM raw WHERE {_PHRASE.format(c='title')}"

DICTIONARY = f"""SELECT value, max(translated) AS translated FROM (
      SELECT c_name AS value, concat('Org ', c_custkey) AS translated FROM customer WHERE c_mktsegment = 'BUILDING'
      UNION ALL
      SELECT {pick('c_custkey % 26', V.CITIES)}, upper({pick('c_custkey % 26', V.CITIES)}) FROM customer
      WHERE c_mktsegment = 'BUILDING') WHERE value IS NOT NULL GROUP BY value"""

_TRANSLATED = {"CITY", "STATE", "ORGANIZATION", "SENIORITY"}
_TEXT = [n for n in CLEANED_COLUMNS if n not in ARRAYS | {
    "JOB_DATE", "REMOTE_DERIVED", "DIRECTAPPLY", "LINKEDIN_ORG_RECRUITMENT_AGENCY_DERIVED"}]


def _lookup(column: str) -> str:
    return f"(SELECT translated FROM dictionary d WHERE d.value = x.{column})"


def ingested(where: str = "true") -> str:
    columns = []
    for n in CLEANED_COLUMNS:
        if n in _TRANSLATED:
            e = f"coalesce({_lookup(n)}, nullif({n}, ''), 'NA')"
        elif n in _TEXT:
            e = f"nullif({n}, '')"
        else:
            e = n
        columns.append(f"{e} AS {n}")
    return f"SELECT {', '.join(columns)} FROM raw_cleaned x WHERE {where}"


def values(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else lit(x) for x in r) + ")" for r in rows)


CITY_RULE = f"SELECT * FROM (VALUES {values((i, h, k, v) for i, (h, k, v) in enumerate(CITY_RULES))}) r(n, how, pat, val)"
SEN_RULE = f"SELECT * FROM (VALUES {values((i, k, v) for i, (k, v) in enumerate(SENIORITY_RULES))}) r(n, pat, val)"
STATE_RULE = f"SELECT * FROM (VALUES {values(CITY_STATES)}) r(city, code)"
_VAGUE = "(" + ", ".join(map(lit, VAGUE_STATES)) + ")"

CITY_MAP = """SELECT c.CITY, coalesce(arg_min(r.val, r.n), c.CITY) AS CITY_STANDARDIZED
    FROM (SELECT DISTINCT CITY FROM postings) c LEFT JOIN city_rule r
      ON (r.how = 'is' AND lower(c.CITY) = r.pat) OR (r.how = 'has' AND lower(c.CITY) LIKE '%' || r.pat || '%')
    GROUP BY c.CITY"""
CITY_DIM = """SELECT p.CITY, m.CITY_STANDARDIZED, p.STATE FROM (SELECT DISTINCT CITY, STATE FROM postings) p
    JOIN city_map m ON p.CITY IS NOT DISTINCT FROM m.CITY"""
STATE_DIM = f"""SELECT DISTINCT c.CITY_STANDARDIZED,
      CASE WHEN lower(c.STATE) IN {_VAGUE} AND s.code IS NOT NULL THEN s.code
           WHEN lower(c.STATE) = 'na' THEN 'UNKNOWN' ELSE c.STATE END AS STATE_STANDARDIZED
    FROM city_dim c LEFT JOIN state_rule s ON s.city = c.CITY_STANDARDIZED"""
SEN_DIM = f"""SELECT s.SENIORITY, coalesce(arg_min(r.val, r.n), {lit(SENIORITY_DEFAULT)}) AS SENIORITY_STANDARDIZED
    FROM (SELECT DISTINCT SENIORITY FROM postings) s
    LEFT JOIN sen_rule r ON lower(trim(s.SENIORITY)) LIKE '%' || r.pat || '%' GROUP BY s.SENIORITY"""
_KEYS = ", ".join(f"p.{n}" for n in KEPT_COLUMNS)
CONFORMED = f"""SELECT {_KEYS}, max(c.CITY_STANDARDIZED) AS CITY, max(s.STATE_STANDARDIZED) AS STATE,
      max(e.SENIORITY_STANDARDIZED) AS SENIORITY
    FROM (SELECT DISTINCT * FROM postings) p JOIN city_dim c ON p.CITY = c.CITY
    JOIN state_dim s ON c.CITY_STANDARDIZED = s.CITY_STANDARDIZED
    JOIN sen_dim e ON p.SENIORITY = e.SENIORITY GROUP BY {_KEYS}"""
DAILY = """SELECT JOB_DATE AS date, CAST(month(JOB_DATE) AS INTEGER) AS month, CAST(year(JOB_DATE) AS INTEGER) AS "Year",
      JOB_CATEGORY, count(DISTINCT ID) AS total_jobs FROM conformed GROUP BY JOB_DATE, JOB_CATEGORY"""
PARAMS = """SELECT DATE '2001-08-01' - INTERVAL 1 DAY AS report_date, dayofweek(DATE '2001-08-01') AS report_dow"""
WEEKLY = """SELECT JOB_CATEGORY, CAST(date_trunc('week', date) AS DATE) AS week_start,
      CAST(sum(total_jobs) AS BIGINT) AS jobs_sum FROM {days} GROUP BY 1, 2"""
FILTERED = """SELECT d.* FROM daily d, params p WHERE dayofweek(d.date) <= p.report_dow AND d.date <= p.report_date"""
TREND = """SELECT JOB_CATEGORY, week_start, jobs_sum AS this_week_jobs, prev AS last_week_jobs,
      jobs_sum - prev AS wow_diff, CAST(jobs_sum - prev AS DOUBLE) / nullif(prev, 0) AS wow_diff_pct
    FROM (SELECT w.*, lag(jobs_sum) OVER (PARTITION BY JOB_CATEGORY ORDER BY week_start) AS prev FROM weekly w)"""
SALARY = """SELECT p_type AS JOB_TITLE, p_brand AS STATES, CAST(p_retailprice AS DECIMAL(18,2)) AS low,
      CAST(p_retailprice AS DECIMAL(18,2)) * 1.5 AS high, CAST(p_retailprice AS DECIMAL(18,2)) * 1.25 AS mean FROM part"""

PARTS = {
    "postings": POSTINGS, "raw": RAW, "raw_cleaned": RAW_CLEANED, "dictionary": DICTIONARY,
    "city_rule": CITY_RULE, "sen_rule": SEN_RULE, "state_rule": STATE_RULE, "city_map": CITY_MAP,
    "city_dim": CITY_DIM, "state_dim": STATE_DIM, "sen_dim": SEN_DIM, "conformed": CONFORMED,
    "daily": DAILY, "params": PARAMS, "filtered": FILTERED, "weekly": WEEKLY.format(days="filtered"),
    "trend": TREND, "salary": SALARY,
}
CONFORM = ["postings", "city_rule", "sen_rule", "state_rule", "city_map", "city_dim", "state_dim", "sen_dim", "conformed"]
DAYS = [*CONFORM, "daily"]
TRENDS = [*DAYS, "params", "filtered", "weekly", "trend"]


def ask(name: str, parts: list[str], body: str, **other: str) -> None:
    made = {p: other.pop(p, PARTS.get(p)) for p in parts}
    made.update(other)
    ORACLE[name] = (
        "WITH " + ",\n".join(f"{p} AS ({sql})" for p, sql in made.items()) + "\n" + body if made else body
    )


P = ["postings"]
RULED = ["postings", "city_rule", "sen_rule", "state_rule", "city_map", "city_dim", "state_dim", "sen_dim"]
R = ["raw"]
S = ["salary"]

ask("s1_read_json", [], "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
ask("s1_landing_round_trip", R, """SELECT id, title, job_category, concat(CAST(job_date AS VARCHAR), 'T23:30:00-05:00')
    AS date_created, organization, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS INTEGER) AS places FROM raw""")
ask("s2_flatten_structs", [], """SELECT c_custkey AS id, c_name AS org_name, n_name AS org_place_nation,
    n_regionkey AS org_place_region FROM customer JOIN nation ON c_nationkey = n_nationkey""")
ask("s3_tag_pages", [], """SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'Data Engineer'
    WHEN 'O' THEN 'Data Scientist' WHEN 'P' THEN 'Data Analyst' END AS job_category FROM orders""")
ask("s4_union_pages", [], """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
    CAST(NULL AS BIGINT) AS supplier FROM customer UNION ALL SELECT s_name, s_acctbal, NULL, s_suppkey FROM supplier""")
ask("s5_reject_split", [], """SELECT event_id, CASE WHEN json_valid(t) THEN 'good' ELSE 'rejected' END AS outcome,
    CASE WHEN json_valid(t) THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM
    (SELECT event_id, props, CASE WHEN event_id % 10 = 0 THEN concat('{broken', props) ELSE props END AS t FROM events)""")
ask("s6_existing_ids", P, f"SELECT ID FROM postings WHERE {_CONTAINS.format(c='TITLE')}")
ask("s7_append", P, """SELECT ID, TITLE, JOB_DATE, CITY, REMOTE_DERIVED FROM postings UNION ALL
    SELECT concat('again-', ID), TITLE, JOB_DATE, CITY, REMOTE_DERIVED FROM postings""")
ask("s7_append_by_day", P, "SELECT ID, TITLE, JOB_DATE, CITY, REMOTE_DERIVED FROM postings")
ask("s8_extended_table", P, "SELECT ID, TITLE, JOB_CATEGORY, URL FROM postings")
ask("s8_full_refresh", P, "SELECT JOB_CATEGORY, count(DISTINCT ID) AS total_jobs FROM postings GROUP BY 1")

BY = {
    "by_city": "SELECT JOB_CATEGORY, CITY, count(DISTINCT ID) AS total_jobs FROM conformed GROUP BY 1, 2",
    "by_org": "SELECT ORGANIZATION, JOB_CATEGORY, count(DISTINCT ID) AS total_jobs FROM conformed GROUP BY 1, 2",
    "by_state": "SELECT JOB_CATEGORY, STATE, count(DISTINCT ID) AS total_jobs FROM conformed GROUP BY 1, 2",
    "by_type": "SELECT JOB_CATEGORY, count(DISTINCT ID) AS total_jobs FROM conformed GROUP BY 1",
}
ask("s9_mart_read", CONFORM, BY["by_city"])

ask("s10_cached_result", [*CONFORM, "by_city"], """SELECT m.JOB_CATEGORY, m.CITY, m.total_jobs, t.most FROM by_city m
    JOIN (SELECT JOB_CATEGORY, max(total_jobs) AS most FROM by_city GROUP BY 1) t ON m.JOB_CATEGORY = t.JOB_CATEGORY""",
    by_city=BY["by_city"])

ask("p1_upper_names", [], """SELECT p_partkey AS P_PARTKEY, p_name AS P_NAME, p_brand AS P_BRAND, p_type AS P_TYPE,
    p_size AS P_SIZE, p_retailprice AS P_RETAILPRICE FROM part""")
ask("p2_contract", [], "SELECT p_partkey, p_type, p_brand, CAST(NULL AS VARCHAR) AS p_origin FROM part")
ask("p3_relevant_columns", P, f"SELECT {flat(CLEANED_COLUMNS)} FROM postings")
ask("p4_title_phrase", P, f"SELECT ID, TITLE FROM postings WHERE {_PHRASE.format(c='TITLE')}")
ask("p5_title_contains", P, f"SELECT ID, TITLE FROM postings WHERE {_CONTAINS.format(c='TITLE')}")
ask("p6_blank_to_null", P, """SELECT ID, CASE WHEN SENIORITY <> '' THEN SENIORITY END AS SENIORITY,
    CASE WHEN RECRUITER_NAME <> '' THEN RECRUITER_NAME END AS RECRUITER_NAME, DIRECTAPPLY FROM postings""")

# The columns of the detail listing and the names they are shown under.
_DETAIL = """JOB_CATEGORY AS Job_Role, TITLE, JOB_DATE AS Post_Date, EMPLOYMENT_TYPE, SENIORITY, CITY, STATE,
    ORGANIZATION, URL AS {link}, LINKEDIN_ORG_URL, LINKEDIN_ORG_INDUSTRY, REMOTE_DERIVED AS IS_REMOTE,
    LINKEDIN_ORG_RECRUITMENT_AGENCY_DERIVED AS Job_By_Agency, DIRECTAPPLY"""
DETAIL = _DETAIL.format(link="LinkedIn_Post_Link")
ask("p7_display_names", P, f"SELECT {_DETAIL.format(link='Job_Link')} FROM postings")
ask("p8_facet_filter", CONFORM, f"SELECT DISTINCT {DETAIL} FROM conformed WHERE JOB_CATEGORY = 'Data Engineer' AND STATE = 'WA'")
ask("p9_before_newest", DAYS, "SELECT * FROM daily WHERE date < (SELECT max(date) FROM daily)")
ask("p10_to_date_days", [*DAYS, "params", "filtered"], "SELECT * FROM filtered")
ask("p11_report_params", [*DAYS, "params"], """SELECT d.*, CAST(p.report_date AS DATE) AS report_date,
    CAST(p.report_dow AS INTEGER) AS report_dow FROM daily d, params p""")
ask("p12_same_layout", P, "SELECT ID, CITY, FALSE AS same_before, TRUE AS same_after FROM postings")

ask("j1_new_documents", [], """SELECT doc_id, lang, source, n_chars FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
ask("j1_new_postings", P, """SELECT ID, CITY, ORGANIZATION, LINKEDIN_ORG_TYPE FROM postings p WHERE NOT EXISTS
    (SELECT 1 FROM postings o WHERE o.ID = p.ID AND o.LINKEDIN_ORG_TYPE = 'F')""")
ask("j2_city_join", RULED, """SELECT p.ID, p.CITY, p.STATE, c.CITY_STANDARDIZED FROM postings p
    JOIN (SELECT DISTINCT CITY, CITY_STANDARDIZED FROM city_dim) c ON p.CITY = c.CITY""")
ask("j3_state_join", RULED, """SELECT p.ID, p.CITY, p.STATE, c.CITY_STANDARDIZED, max(s.STATE_STANDARDIZED) AS STATE_STANDARDIZED
    FROM postings p JOIN city_dim c ON p.CITY = c.CITY JOIN state_dim s ON s.CITY_STANDARDIZED = c.CITY_STANDARDIZED
    GROUP BY 1, 2, 3, 4""")
ask("j4_seniority_join", RULED, "SELECT p.ID, p.SENIORITY, s.SENIORITY_STANDARDIZED FROM postings p JOIN sen_dim s ON p.SENIORITY = s.SENIORITY")
ask("j5_with_params", [*DAYS, "params"], """SELECT d.JOB_CATEGORY, CAST(date_trunc('week', d.date) AS DATE) AS week_start,
    d.total_jobs, CAST(p.report_date AS DATE) AS report_date, CAST(p.report_dow AS INTEGER) AS report_dow
    FROM daily d CROSS JOIN params p WHERE dayofweek(d.date) <= p.report_dow AND d.date <= p.report_date""")
ask("j6_value_map", ["postings", "dictionary"], """SELECT p.ID, coalesce(d.translated, p.CITY) AS CITY, p.ORGANIZATION
    FROM postings p LEFT JOIN dictionary d ON d.value = p.CITY""")

ask("a1_jobs_by_city", CONFORM, BY["by_city"])
ask("a2_jobs_by_org", CONFORM, BY["by_org"])
ask("a3_jobs_by_state", CONFORM, BY["by_state"])
ask("a4_jobs_by_type", CONFORM, BY["by_type"])
ask("a5_jobs_daily", DAYS, "SELECT * FROM daily")
ask("a6_weekly_sums", [*DAYS, "weekly"], "SELECT * FROM weekly", weekly=WEEKLY.format(days="daily"))
ask("a7_collapse", P, """SELECT ID, TITLE, JOB_CATEGORY, RECRUITER_NAME, EMPLOYMENT_TYPE, max(CITY) AS CITY,
    max(STATE) AS STATE, max(SENIORITY) AS SENIORITY FROM postings GROUP BY 1, 2, 3, 4, 5""", postings=SIGHTINGS)
ask("a7_collapse_all_keys", P, f"""SELECT {', '.join(f"array_to_string({n}, '|') AS {n}" if n in ARRAYS else n for n in KEPT_COLUMNS)},
    max(CITY) AS CITY, max(STATE) AS STATE, max(SENIORITY) AS SENIORITY FROM postings GROUP BY ALL""", postings=SIGHTINGS)
ask("a8_date_bounds", DAYS, "SELECT min(date) AS MIN_DATE, max(date) AS MAX_DATE FROM daily")
ask("a9_job_totals", P, f"""SELECT JOB_CATEGORY AS Title, count(DISTINCT ID) AS Total_Jobs FROM postings
    WHERE {_CONTAINS.format(c='postings.TITLE')} GROUP BY 1""")
ask("a10_daily_jobs", DAYS, f"""SELECT date AS DATE, JOB_CATEGORY AS TITLE, CAST(sum(total_jobs) AS BIGINT) AS TOTAL_JOBS
    FROM daily WHERE {_CONTAINS.format(c='JOB_CATEGORY')} GROUP BY 1, 2 HAVING date < (SELECT max(date) FROM daily)""")
_MEAN = "CAST(sum({c}) AS DOUBLE) / count({c})"
ask("a11_salary_by_title", S, f"""SELECT JOB_TITLE, {_MEAN.format(c='low')} AS SALARY_LOW,
    {_MEAN.format(c='high')} AS SALARY_HIGH FROM salary GROUP BY 1""")
ask("a12_salary_by_state", S, f"SELECT JOB_TITLE, STATES, {_MEAN.format(c='mean')} AS AVG_SALARY FROM salary GROUP BY 1, 2")
ask("a13_distinct_links", P, "SELECT DISTINCT ID, TITLE, JOB_CATEGORY, URL FROM postings", postings=SIGHTINGS)
ask("a14_distinct_values", P, "SELECT CITY FROM postings WHERE CITY IS NOT NULL GROUP BY CITY")
ask("a15_stage_counts", R, f"""SELECT 'landed' AS stage, count(*) AS rows FROM raw
    UNION ALL SELECT 'title_kept', count(*) FROM raw WHERE {_PHRASE.format(c='title')}
    UNION ALL SELECT 'known', count(*) FROM raw WHERE {_PHRASE.format(c='title')} AND o_orderstatus = 'F'
    UNION ALL SELECT 'fresh', count(*) FROM raw WHERE {_PHRASE.format(c='title')} AND o_orderstatus <> 'F'""")

ask("w1_previous_week", [*DAYS, "weekly"], """SELECT w.*, lag(jobs_sum) OVER (PARTITION BY JOB_CATEGORY ORDER BY week_start)
    AS lastweek_jobs_sum FROM weekly w""", weekly=WEEKLY.format(days="daily"))
ask("w2_wow_to_date", TRENDS, "SELECT * FROM trend")
ask("w3_wow_complete", [*DAYS, "weekly", "trend"], "SELECT * FROM trend", weekly=WEEKLY.format(days="daily"))

ask("o1_org_mart_order", CONFORM, BY["by_org"] + " ORDER BY 1, 2, 3 DESC")
ask("o2_unknown_last", CONFORM, """SELECT JOB_CATEGORY, STATE, count(DISTINCT ID) AS total_jobs,
    CAST(CASE WHEN STATE = 'UNKNOWN' THEN 1 ELSE 0 END AS INTEGER) AS unknown_rank FROM conformed GROUP BY 1, 2, 4
    ORDER BY 4, 2, 1""")
ask("o3_latest_trend", TRENDS, "SELECT * FROM trend ORDER BY week_start DESC, JOB_CATEGORY LIMIT 3")
ask("o4_detail_order", P, """SELECT JOB_DATE AS Post_Date, JOB_CATEGORY AS Job_Role, URL AS LinkedIn_Post_Link
    FROM postings ORDER BY 1 DESC, 2, 3""")
ask("o5_total_descending", CONFORM, BY["by_org"] + " ORDER BY 3 DESC")
ask("o6_salary_order", S, f"SELECT JOB_TITLE, STATES, {_MEAN.format(c='high')} AS AVG_SALARY FROM salary GROUP BY 1, 2 ORDER BY 1, 3 DESC")
ask("o7_preview", P, """(SELECT JOB_DATE, ID, TITLE, 'first' AS side FROM postings ORDER BY JOB_DATE, ID LIMIT 5) UNION ALL
    (SELECT JOB_DATE, ID, TITLE, 'last' FROM postings ORDER BY JOB_DATE DESC, ID DESC LIMIT 5)""")

ask("u1_role_choices", CONFORM, "SELECT DISTINCT JOB_CATEGORY FROM conformed WHERE JOB_CATEGORY IS NOT NULL")
ask("u2_facet_values", CONFORM, """SELECT 'Job_Role' AS facet, JOB_CATEGORY AS value FROM conformed WHERE JOB_CATEGORY IS NOT NULL
    UNION SELECT 'STATE', STATE FROM conformed WHERE STATE IS NOT NULL
    UNION SELECT 'CITY', CITY FROM conformed WHERE CITY IS NOT NULL
    UNION SELECT 'ORGANIZATION', ORGANIZATION FROM conformed WHERE ORGANIZATION IS NOT NULL""")

ask("f1_written_date", [], "SELECT event_id, CAST(substr(strftime(ts, '%Y-%m-%dT%H:%M:%S-05:00'), 1, 10) AS DATE) AS job_date FROM events")
ask("f2_city_of_locations", R, "SELECT id, locality AS city FROM raw")
ask("f3_state_of_locations", R, "SELECT id, state FROM raw")
ask("f4_city_spelling", R, f"SELECT id, {_SPELT} AS city FROM raw")
ask("f5_employment_text", R, "SELECT id, employment FROM raw")
ask("f6_employee_range", R, "SELECT id, org_size FROM raw")
ask("f7_translate", ["postings", "dictionary"], "SELECT ID, " + ", ".join(
    f"coalesce({_lookup(c)}, nullif({c}, ''), 'NA') AS {c}" for c in ("CITY", "STATE", "ORGANIZATION", "SENIORITY")
) + " FROM postings x")
ask("f8_city_rules", RULED, """SELECT p.ID, p.CITY, m.CITY_STANDARDIZED AS city_standardized FROM postings p
    JOIN city_map m ON p.CITY IS NOT DISTINCT FROM m.CITY""")
ask("f9_seniority_rules", RULED, """SELECT p.ID, p.SENIORITY, s.SENIORITY_STANDARDIZED AS seniority_standardized
    FROM postings p JOIN sen_dim s ON p.SENIORITY IS NOT DISTINCT FROM s.SENIORITY""")
ask("f10_state_fill", RULED, f"""SELECT p.ID, p.CITY, p.STATE, CASE WHEN lower(p.STATE) IN {_VAGUE} AND r.code IS NOT NULL
    THEN r.code WHEN lower(p.STATE) = 'na' THEN 'UNKNOWN' ELSE p.STATE END AS state_standardized
    FROM postings p JOIN city_map m ON p.CITY IS NOT DISTINCT FROM m.CITY
    LEFT JOIN state_rule r ON r.city = m.CITY_STANDARDIZED""")
ask("f11_date_parts", P, """SELECT ID, JOB_DATE AS job_day, CAST(month(JOB_DATE) AS INTEGER) AS month,
    CAST(year(JOB_DATE) AS INTEGER) AS year, CAST(dayofweek(JOB_DATE) AS INTEGER) AS dow,
    CAST(JOB_DATE - CAST(isodow(JOB_DATE) - 1 AS INTEGER) AS DATE) AS week_monday,
    CAST(JOB_DATE - CAST(dayofweek(JOB_DATE) AS INTEGER) AS DATE) AS week_sunday,
    CAST(JOB_DATE - 1 AS DATE) AS day_before FROM postings""")
ask("f12_safe_ratio", [], """SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey AS DOUBLE) / (o_orderkey % 4) END
    AS ratio FROM orders""")
_LABEL = """concat(CASE WHEN wow_diff_pct < 0 AND round_even(wow_diff_pct * 100, 0) = 0 THEN '-' ELSE '' END,
    CAST(CAST(round_even(wow_diff_pct * 100, 0) AS BIGINT) AS VARCHAR), '%')"""
_LABELS = f"""CASE WHEN wow_diff_pct IS NOT NULL THEN {_LABEL} END AS {{text}},
    CASE WHEN wow_diff_pct > 0 THEN 'up' WHEN wow_diff_pct = 0 THEN 'flat' ELSE 'down' END AS {{direction}}"""
ask("f13_trend_label", TRENDS, f"SELECT *, {_LABELS.format(text='wow_text', direction='direction')} FROM trend")
ask("f14_salary_bands", [*S, "m"], """SELECT JOB_TITLE, lo AS SALARY_LOW, hi AS SALARY_HIGH, lo - (hi - lo) / 2 AS LOWER_BOUND,
    hi + (hi - lo) / 2 AS UPPER_BOUND, lo - (lo - (hi - lo) / 2) AS LEAD_WIDTH, hi - lo AS BAND_WIDTH,
    hi + (hi - lo) / 2 - hi AS TAIL_WIDTH,
    concat('$', CAST(trunc(lo / 1000) AS BIGINT), 'K-$', CAST(trunc(hi / 1000) AS BIGINT), 'K') AS BAND_TEXT FROM m""",
    m=f"SELECT JOB_TITLE, {_MEAN.format(c='low')} AS lo, {_MEAN.format(c='high')} AS hi FROM salary GROUP BY 1")
ask("f15_reported_period", DAYS, """SELECT min(date) AS MIN_DATE, max(date) AS MAX_DATE,
    CAST(max(date) - 1 AS DATE) AS LAST_FULL_DAY FROM daily""")

INGEST = ["raw", "raw_cleaned", "dictionary"]
ask("c1_ingest", [*P, *INGEST, "fresh"], f"""SELECT {flat(CLEANED_COLUMNS)} FROM postings WHERE LINKEDIN_ORG_TYPE = 'F'
    UNION ALL SELECT {flat(CLEANED_COLUMNS)} FROM fresh""", fresh=ingested("o_orderstatus <> 'F'"))
ask("c1_clean_records", ["raw", "raw_cleaned"], f"SELECT {flat(CLEANED_COLUMNS)} FROM raw_cleaned")
# Records whose fields drift in type by order: plain text for a list, an object for a list of them.
DRIFT_RAW = RAW.replace(
    "CASE WHEN o_orderkey % 3 = 2 THEN coalesce(",
    f"CASE WHEN o_orderkey % 5 = 4 THEN CASE WHEN o_orderkey % 3 <> 1 THEN {_LOCALITY} END WHEN o_orderkey % 3 = 2 THEN coalesce(",
).replace(" AS state,", " AS all_states, CASE WHEN o_orderkey % 15 <> 14 THEN all_states END AS state,")
DRIFT_CLEANED = RAW_CLEANED.replace(
    "[o_orderpriority, lower(c_mktsegment)]",
    "CASE WHEN o_orderkey % 5 = 2 THEN [o_orderpriority] ELSE [o_orderpriority, lower(c_mktsegment)] END",
) + " AND o_orderkey % 97 <> 0"
ask("c1_drifting_types", [*INGEST, "fresh"], f"SELECT {flat(CLEANED_COLUMNS)} FROM fresh",
    raw=DRIFT_RAW, raw_cleaned=DRIFT_CLEANED, fresh=ingested())
ask("c1_rejected", R, f"""SELECT 'bad date' AS reason, job_category, id FROM raw
    WHERE {_PHRASE.format(c='title')} AND o_orderkey % 97 = 0
    UNION ALL SELECT 'not JSON', job_category, concat('{{broken ', id) FROM raw WHERE o_orderkey % 89 = 0""")
ask("c1_arrivals_split", [*INGEST, "fresh"], f"SELECT {flat(CLEANED_COLUMNS)} FROM fresh", fresh=ingested())
ask("c1_arrivals_missing_key", [*INGEST, "fresh"], f"SELECT {flat(CLEANED_COLUMNS)} FROM fresh", fresh=ingested())
ask("c1_arrivals", [*INGEST, "fresh"], f"SELECT {flat(CLEANED_COLUMNS)} FROM fresh", fresh=ingested())
ask("c2_city_dimension", RULED, "SELECT * FROM city_dim")
ask("c3_state_dimension", RULED, "SELECT * FROM state_dim")
ask("c4_seniority_dimension", RULED, "SELECT * FROM sen_dim")
ask("c5_conformed", CONFORM, f"SELECT {flat(CLEANED_COLUMNS)} FROM conformed")
ask("c5_conformed_copies", CONFORM, f"SELECT {flat(CLEANED_COLUMNS)} FROM conformed", postings=SIGHTINGS)
ask("c5_conformed_split", CONFORM, f"SELECT {flat(CLEANED_COLUMNS)} FROM conformed", postings=SIGHTINGS)
ask("c6_posting_links", P, "SELECT DISTINCT ID, TITLE, JOB_CATEGORY, URL FROM postings ORDER BY JOB_CATEGORY, ID, TITLE", postings=SIGHTINGS)
ask("c6_posting_links_in_place", P, "SELECT DISTINCT ID, TITLE, JOB_CATEGORY, URL FROM postings ORDER BY JOB_CATEGORY, ID, TITLE", postings=SIGHTINGS)

_LONG = f"""SELECT 'by_city' AS mart, JOB_CATEGORY AS role, CITY AS item, total_jobs AS total FROM ({BY['by_city']})
    UNION ALL SELECT 'by_org', JOB_CATEGORY, ORGANIZATION, total_jobs FROM ({BY['by_org']})
    UNION ALL SELECT 'by_state', JOB_CATEGORY, STATE, total_jobs FROM ({BY['by_state']})
    UNION ALL SELECT 'by_type', JOB_CATEGORY, NULL, total_jobs FROM ({BY['by_type']})
    UNION ALL SELECT 'daily', JOB_CATEGORY, CAST(date AS VARCHAR), total_jobs FROM daily
    UNION ALL SELECT 'wow_trend', JOB_CATEGORY, CAST(week_start AS VARCHAR), this_week_jobs FROM trend"""
ask("c7_all_marts", TRENDS, _LONG)
ask("c8_job_details", CONFORM, f"SELECT DISTINCT {DETAIL} FROM conformed ORDER BY Post_Date DESC, Job_Role")
ask("c9_state_listing", CONFORM, f"SELECT * FROM ({BY['by_state']}) WHERE JOB_CATEGORY = 'Data Analyst' ORDER BY total_jobs DESC")
ask("c9_city_listing", CONFORM, f"SELECT * FROM ({BY['by_city']}) ORDER BY total_jobs DESC")
ask("c9_org_listing", CONFORM, f"SELECT * FROM ({BY['by_org']}) WHERE JOB_CATEGORY = 'Data Engineer' ORDER BY total_jobs DESC")
ask("c10_skills_listing", [], "SELECT DISTINCT p_type AS Job_Title, p_name AS skill FROM part ORDER BY 1")
ask("c11_refresh_by_day", [*INGEST, *TRENDS], _LONG, postings=ingested())
ask("c11_refresh_rebuilt", [*INGEST, *TRENDS], _LONG, postings=ingested())
ask("c11_refresh_conformed", [*INGEST, *CONFORM], f"SELECT {flat(CLEANED_COLUMNS)} FROM conformed", postings=ingested())
ask("c11_refresh_dimensions", [*INGEST, *RULED], """SELECT 'base_city' AS model, CITY AS a, CITY_STANDARDIZED AS b, STATE AS c,
    NULL AS d FROM city_dim UNION ALL SELECT 'base_state', CITY_STANDARDIZED, STATE_STANDARDIZED, NULL, NULL FROM state_dim
    UNION ALL SELECT 'base_seniority', SENIORITY, SENIORITY_STANDARDIZED, NULL, NULL FROM sen_dim
    UNION ALL SELECT DISTINCT 'posting_links', ID, TITLE, JOB_CATEGORY, URL FROM postings""", postings=ingested())
ask("c11_refresh_run", [*INGEST, *TRENDS], _LONG, postings=ingested())

ask("d1_trend_cards", TRENDS, f"""SELECT week_start AS WEEK_START, JOB_CATEGORY, this_week_jobs AS THIS_WEEK,
    last_week_jobs AS LAST_WEEK, wow_diff_pct AS WOW_DIFF_PCT, {_LABELS.format(text='WOW_TEXT', direction='DIRECTION')}
    FROM (SELECT * FROM trend ORDER BY week_start DESC, JOB_CATEGORY LIMIT 3)""")
ask("d2_salary_states", S, f"SELECT STATES, {_MEAN.format(c='mean')} AS AVG_SALARY FROM salary WHERE JOB_TITLE = 'ECONOMY' GROUP BY 1")
