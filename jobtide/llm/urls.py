"""URL verdicts from rules and, where none fits, from a tree of path templates per host.

DataFrame functions only.  A url is split into host and path; the longest rule that fits
decides.  The urls that rules decide are the labels for the rest:

1. *Shapes.*  A path segment with a digit becomes ``*`` (its extension stays).  Pages are
   counted by (host, shape) first, so a host with most pages is a few rows from there on.
2. *Variable segments.*  The host's tree is walked from the top.  Where a node has at least
   ``MIN_CHILDREN`` child values with fewer than ``ROWS_PER_CHILD`` rows each on average, the child
   becomes ``*``, and what follows is counted below that one node.  Segments past ``MOST_DEPTH``
   count as one.
3. *Merged branches.*  Siblings that differ in their last literal segment are pooled unless
   a branch's block rate is more than ``Z`` standard errors from the pooled rate.
4. *Purity.*  Block share of a template, smoothed towards the share of the same template on
   all hosts, and that one towards the share of all labelled urls.  ``REJECT`` or more blocks.

Null urls and urls without ``://`` have an empty host and path and are judged as that
template.  Repeated rows each get a row; an empty table gives none; other columns are not
read.  Without any labelled url the share is 0, so all are allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import stored, table

# Fixed values: (verdict, host with its subdomains, start of the path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
MIN_CHILDREN, ROWS_PER_CHILD, Z, WEIGHT, REJECT = 20, 3, 2.0, 5.0, 0.5
MOST_DEPTH = 12


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``."""
    at = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(F.col(url), F.lit(""))
    host = F.translate(F.regexp_extract(whole, at, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return df.withColumns({"host": host, "path": F.regexp_extract(whole, at, 2)})


def apply_rules(df: DataFrame, rules=RULES) -> DataFrame:
    """Add ``rule`` (the longest that fits, else null) and ``rule_verdict``."""

    def fits(host: str, path: str) -> Column:
        return ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))

    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, host, path in reversed(longest_first):
        rule = F.when(fits(host, path), F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits(host, path), F.lit(word)).otherwise(verdict)
    return df.withColumns({"rule": rule, "rule_verdict": verdict})


def with_shape(df: DataFrame) -> DataFrame:
    return df.withColumn("shape", F.rtrim(F.regexp_replace("path", r"[^/.]*[0-9][^/.]*", "*"), F.lit("/")))


def shape_counts(df: DataFrame) -> DataFrame:
    """Pages, labelled pages and blocked pages of each (host, shape)."""
    return df.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("rule_verdict").alias("n_labelled"),
        F.count(F.when(F.col("rule_verdict") == "block", 1)).alias("n_blocked"),
    )


def segments_of(shape: Column, most: int = MOST_DEPTH) -> Column:
    """The segments of a shape, those past ``most`` as one."""
    each = F.split(shape, "/")
    rest = F.array_join(F.slice(each, F.lit(most), F.size(each)), "/")
    return F.when(F.size(each) <= most, each).otherwise(F.concat(F.slice(each, 1, most - 1), F.array(rest)))


def generalise(
    shapes: DataFrame, min_children: int = MIN_CHILDREN, rows_per_child: int = ROWS_PER_CHILD, most_depth: int = MOST_DEPTH,
) -> DataFrame:
    """Add ``template`` to (host, shape) rows: variable nodes of the host's tree become ``*``.

    One round for each level; a round counts the children of the nodes that the rounds before have made.
    """
    walked = stored(shapes.withColumns({
        "segments": segments_of(F.col("shape"), most_depth), "template": F.lit("")}), "level")
    depth = walked.agg(F.max(F.size("segments"))).first()[0] or 0
    for d in range(depth):
        node = walked.where(F.size("segments") > d).groupBy("host", "template", F.col("segments")[d].alias("child")).agg(F.sum("n").alias("n"))
        variable = node.groupBy("host", "template").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("all")).where(
            (F.col("kinds") >= min_children) & (F.col("all") < rows_per_child * F.col("kinds"))).select(
            F.col("host").alias("_host"), F.col("template").alias("_template"), F.lit(True).alias("varies"))
        here = (F.col("host") == F.col("_host")) & (F.col("template") == F.col("_template")) & (F.size("segments") > d)
        segment = F.when(F.col("varies"), "*").otherwise(F.col("segments")[d])
        longer = F.concat("template", F.lit("/" if d else ""), segment)
        walked = stored(
            walked.join(variable, here, "left").withColumn("template", F.when(F.size("segments") > d, longer).otherwise(F.col("template")))
            .drop("_host", "_template", "varies"), "level")
    return walked.drop("segments")


def template_purity(shapes: DataFrame, weight: float = WEIGHT, z: float = Z) -> DataFrame:
    """Smoothed block share of every (host, shape), by its template and merged branch."""
    totals = shapes.agg(F.sum("n_blocked").alias("b"), F.sum("n_labelled").alias("n")).first()
    overall = totals["b"] / totals["n"] if totals["n"] else 0.0
    branch = F.regexp_replace("template", r"/[^/*][^/]*((?:/\*[^/]*)*)$", "/+$1")
    sums = [F.sum("n_labelled").alias("n_labelled"), F.sum("n_blocked").alias("n_blocked")]
    own = shapes.groupBy("host", "template").agg(*sums).withColumn("branch", branch)
    pooled = own.groupBy("host", "branch").agg(F.sum("n_labelled").alias("all_labelled"), F.sum("n_blocked").alias("all_blocked"))
    everywhere = own.groupBy("template").agg(
        ((F.sum("n_blocked") + weight * overall) / (F.sum("n_labelled") + weight)).alias("share"))
    rate = F.col("all_blocked") / F.greatest("all_labelled", F.lit(1))
    gap = F.abs(F.col("n_blocked") / F.greatest("n_labelled", F.lit(1)) - rate)
    like = (F.col("n_labelled") == 0) | (gap <= z * F.sqrt(rate * (1 - rate) / F.greatest("n_labelled", F.lit(1))))
    blocked = F.when(like, F.col("all_blocked")).otherwise(F.col("n_blocked"))
    labelled = F.when(like, F.col("all_labelled")).otherwise(F.col("n_labelled"))
    judged = own.join(pooled, ["host", "branch"]).join(everywhere, "template").select(
        "host", "template", ((blocked + weight * F.col("share")) / (labelled + weight)).alias("purity"))
    return shapes.select("host", "shape", "template").join(judged, ["host", "template"])


def judge_urls(df: DataFrame, url: str = "url", rules=RULES, reject: float = REJECT) -> DataFrame:
    """Add host, path, rule, verdict, template and purity (the template's block share).

    Columns of these names are replaced.
    """
    added = ("host", "path", "rule", "verdict", "template", "purity")
    kept = [c for c in df.columns if c.lower() not in (*added, "shape", "rule_verdict")]
    pages = with_shape(apply_rules(split_url(df.select(kept), url), rules))
    shapes = generalise(shape_counts(pages))
    purity = template_purity(shapes)
    verdict = F.coalesce("rule_verdict", F.when(F.col("purity") >= reject, "block").otherwise("allow"))
    return pages.join(purity, ["host", "shape"], "left").withColumn("verdict", verdict).select(
        *kept, *added)


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for the url of every page."""
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


_RULE_CASE = "\n".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
    for _, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
)
_VERDICT_CASE = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for v, h, p in RULES)

def _level(d: int) -> str:
    """CTEs of one level of the tree, in the way of the round of the same number."""
    child = f"segs[{d + 1}]"
    return f"""c{d} AS MATERIALIZED (SELECT host, template FROM l{d} WHERE len(segs) > {d} GROUP BY host, template
  HAVING count(DISTINCT {child}) >= {MIN_CHILDREN} AND sum(n) < {ROWS_PER_CHILD} * count(DISTINCT {child})),
l{d + 1} AS MATERIALIZED (SELECT l.host, shape, n, segs, l.template || CASE WHEN len(segs) <= {d} THEN ''
    ELSE '{"/" if d else ""}' || CASE WHEN c.host IS NULL THEN {child} ELSE '*' END END AS template
  FROM l{d} l LEFT JOIN c{d} c ON l.host = c.host AND l.template = c.template AND len(segs) > {d})"""


_LEVELS = f"""parted AS (SELECT host, shape, n, string_split(shape, '/') AS s FROM shapes),
l0 AS MATERIALIZED (SELECT host, shape, n, CASE WHEN len(s) <= {MOST_DEPTH} THEN s
  ELSE s[1:{MOST_DEPTH - 1}] || [array_to_string(s[{MOST_DEPTH}:len(s)], '/')] END AS segs, '' AS template FROM parted),
""" + ",\n".join(_level(d) for d in range(MOST_DEPTH))

SQL = rf"""
WITH cut AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
ruled AS (SELECT *, CASE {_RULE_CASE} END AS rule,
  rtrim(regexp_replace(path, '[^/.]*[0-9][^/.]*', '*', 'g'), '/') AS shape FROM cut),
voted AS (SELECT *, CASE {_VERDICT_CASE} END AS rule_verdict FROM ruled),
shapes AS (SELECT host, shape, count(*) AS n, count(rule_verdict) AS n_labelled,
  count(CASE WHEN rule_verdict = 'block' THEN 1 END) AS n_blocked FROM voted GROUP BY host, shape),
{_LEVELS},
templates AS (SELECT host, shape, template FROM l{MOST_DEPTH}),
own AS (SELECT t.host, t.template, sum(n_labelled) AS n_labelled, sum(n_blocked) AS n_blocked,
    regexp_replace(t.template, '/[^/*][^/]*((?:/\*[^/]*)*)$', '/+\1') AS branch
  FROM templates t JOIN shapes s ON t.host = s.host AND t.shape = s.shape GROUP BY t.host, t.template),
overall AS (SELECT CASE WHEN sum(n_labelled) > 0 THEN sum(n_blocked)::DOUBLE / sum(n_labelled) ELSE 0 END AS g FROM shapes),
pooled AS (SELECT host, branch, sum(n_labelled) AS all_labelled, sum(n_blocked) AS all_blocked FROM own GROUP BY host, branch),
everywhere AS (SELECT template, (sum(n_blocked) + {WEIGHT}::DOUBLE * any_value(g)) / (sum(n_labelled) + {WEIGHT}::DOUBLE) AS share
  FROM own, overall GROUP BY template),
rates AS (SELECT o.host, o.template, n_labelled, n_blocked, all_labelled, all_blocked, share,
    all_blocked::DOUBLE / greatest(all_labelled, 1) AS rate
  FROM own o JOIN pooled p ON o.host = p.host AND o.branch = p.branch JOIN everywhere e ON o.template = e.template),
alike AS (SELECT *, n_labelled = 0 OR abs(n_blocked::DOUBLE / greatest(n_labelled, 1) - rate)
    <= {Z}::DOUBLE * sqrt(rate * (1 - rate) / greatest(n_labelled, 1)) AS same FROM rates),
purity AS (SELECT host, template, (CASE WHEN same THEN all_blocked ELSE n_blocked END + {WEIGHT}::DOUBLE * share)
    / (CASE WHEN same THEN all_labelled ELSE n_labelled END + {WEIGHT}::DOUBLE) AS purity FROM alike)
SELECT page_id, v.host, path, rule,
  coalesce(rule_verdict, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict, t.template, purity
FROM voted v JOIN templates t ON v.host = t.host AND v.shape = t.shape
JOIN purity u ON t.host = u.host AND t.template = u.template
"""
