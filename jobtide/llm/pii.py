"""Personal data in text, DataFrame functions only.

Regular expressions propose spans, validators confirm them (Luhn for card numbers, mod-97
for account numbers, value ranges for addresses), and context words before and after a span
raise its score.  Offsets are code points, the end exclusive.

Base spans (email, ip, card, phone) always stay.  The method adds

* ``card`` and ``phone`` spans inside a run of digits whose whole match failed, found by
  stricter forms, where no base span of the kind overlaps them;
* ``iban`` spans that pass mod-97;
* ``ssn`` spans of a valid number with a context word beside them.

Null text is empty text and has no spans.  Rows are never joined or merged, so repeated rows,
ties and empty tables give as many rows as they have.  Other columns pass through.

The expressions are equivalent to the plain base patterns: a match can only start where a run
of its first class starts, or where the match before ended (``\\G``), and possessive runs end
where greedy ones do.  They take linear time on long runs, and no group recursion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import let, running_sums, table, unused

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]

PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
STRICT = {
    "card": r"(?<![0-9])[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])",
    "phone": r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])",
}
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "address|host|server|login",
    "card": "card|visa|pay|credit",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|bank|account|konto|cuenta|compte",
    "ssn": "ssn|social security|tax id",
}
# (score of the form, added when the validator passes); a context word adds CONTEXT_SCORE.
SCORES = {"email": (0.8, 0.1), "ip": (0.4, 0.3), "card": (0.3, 0.5), "phone": (0.4, 0.3), "iban": (0.3, 0.6), "ssn": (0.2, 0.2)}
CONTEXT_SCORE, KEEP_SCORE, CONTEXT_CHARS = 0.3, 0.6, 40

SPAN = "struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""

    def weighed(d: Column, i: Column) -> Column:
        v = d.substr(i, F.lit(1)).cast("int")
        return F.when((F.length(d) - i) % 2 == 0, v).when(v > 4, v * 2 - 9).otherwise(v * 2)

    def total(d: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda a, i: a + weighed(d, i))

    return let(digits, lambda d: F.when(F.length(d) > 0, total(d) % 10 == 0).otherwise(F.lit(False)))


def mod97(account: Column) -> Column:
    """Whether an account number of letters and digits leaves 1 when divided by 97."""
    moved = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), acc * 10 + F.ascii(c) - 48).otherwise(acc * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(r"^(0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(\.|$)){4}$")
    if kind == "card":
        return let(_digits(m), lambda d: F.length(d).between(13, 19) & luhn(d))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return let(F.replace(m, F.lit(" "), F.lit("")), lambda a: F.length(a).between(15, 34) & mod97(a))
    if kind == "ssn":
        return ~m.rlike(r"^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def _needed(kind: str, text: Column) -> Column:
    """A cheap test that every text with a match passes, and that text without one mostly fails."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    if kind == "card":
        # A separator may stand between any two digits.
        return text.rlike(r"[0-9][\x20-]?[0-9]")
    return text.rlike("[0-9]{2}") if kind in ("ssn", "iban") else text.rlike(r"[0-9]\.[0-9]")


def spans_of(kind: str, text: Column, pattern: str, base: bool) -> Column:
    """Array of the confirmed spans of one pattern, by start."""
    none = F.array().cast(f"array<{SPAN}>")
    form, confirmed = SCORES[kind]

    def placed(matches: Column) -> Column:
        return let(F.split(text, pattern, -1), lambda gaps: located(matches, gaps))

    def located(matches: Column, gaps: Column) -> Column:
        steps = F.transform(
            matches,
            lambda _, i: F.char_length(gaps[i]) + F.when(i > 0, F.char_length(matches[i - 1])).otherwise(F.lit(0)),
        )
        return let(running_sums(steps), lambda starts: F.transform(matches, lambda m, i: span(m, i, gaps, starts)))

    def span(m: Column, i: Column, gaps: Column, starts: Column) -> Column:
        around = F.lower(F.concat_ws(" ", F.right(gaps[i], F.lit(CONTEXT_CHARS)), F.left(gaps[i + 1], F.lit(CONTEXT_CHARS))))
        near = F.when(around.rlike(CONTEXT[kind]), F.lit(CONTEXT_SCORE)).otherwise(F.lit(0.0))
        score = F.when(valid(kind, m), F.least(F.lit(1.0), F.lit(form + confirmed) + near)).otherwise(F.lit(0.0))
        return F.struct(
            F.lit(kind).alias("kind"), starts[i].alias("start"), (starts[i] + F.char_length(m)).alias("end"),
            score.alias("score"), F.lit(base).alias("base"),
        )

    found = F.when(_needed(kind, text), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(
        F.array().cast("array<string>"))
    all_spans = let(found, lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(none))
    least = 1e-9 if base else KEEP_SCORE
    return F.filter(all_spans.cast(f"array<{SPAN}>"), lambda s: s["score"] >= least)


def _apart(more: Column, have: Column) -> Column:
    """The spans that overlap none of those at hand."""
    return F.filter(more, lambda s: ~F.exists(have, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def find_pii(df: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """Add the array of spans of each text: by kind in the order of ``KINDS``, then start.

    A column of that name is replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    column = {k: unused(df, f"_{into}_{k}") for k in KINDS}
    out = df.select("*", *[spans_of(k, body, PATTERNS[k], k in BASE).alias(n) for k, n in column.items()])
    for kind, pattern in STRICT.items():
        have = F.col(column[kind])
        # Only text whose whole match failed can hold more: as many matches as spans end it.
        tried = F.regexp_count(body, F.lit(PATTERNS[kind])) > F.size(have)
        worth = body.rlike(r"[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}") if kind == "card" else F.contains(body, F.lit("+"))
        more = F.when(worth & tried, spans_of(kind, body, pattern, False)).otherwise(F.array().cast(f"array<{SPAN}>"))
        fresh = _apart(more, have)
        out = out.withColumn(column[kind], F.array_sort(
            F.concat(have, fresh), lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0)))
    return out.withColumn(into, F.concat(*[F.col(n) for n in column.values()])).drop(*column.values())


def redact(df: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """Replace every span by its kind in angle brackets; overlapping spans become one.

    Of overlapping spans the kind of the first one names the replacement.  Text without spans,
    and null text, stays as it is.  Each kept part is cut out once, so the work is the length
    of a text times its number of spans.
    """
    body = F.col(text)
    by_start = F.array_sort(F.col(spans), lambda a, b: F.when(a["start"] < b["start"], -1).when(
        a["start"] > b["start"], 1).when(a["end"] > b["end"], -1).when(a["end"] < b["end"], 1).otherwise(0))

    def rebuilt(ss: Column) -> Column:
        # The reach of the spans before each one; spans inside it add nothing of their own.
        reach = F.transform(ss, lambda _, i: F.when(i == 0, F.lit(0).cast("bigint")).otherwise(
            F.array_max(F.transform(F.slice(ss, F.lit(1), i), lambda s: s["end"]))))
        return let(reach, lambda r: F.concat(
            F.array_join(F.transform(ss, lambda s, i: F.concat(
                body.substr((r[i] + 1).cast("int"), F.greatest(s["start"] - r[i], F.lit(0)).cast("int")),
                F.when((i > 0) & (s["start"] < r[i]), F.lit("")).otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">"))))), ""),
            body.substr((F.array_max(F.transform(ss, lambda s: s["end"])) + 1).cast("int"), F.char_length(body)),
        ))

    return df.withColumn(text, F.when(F.size(spans) > 0, let(by_start, rebuilt)).otherwise(body))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and offsets of personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[F.size(_of_kind(base, k)).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("pii")).alias("spans"),
        F.coalesce(F.array_max(F.transform("pii", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )
