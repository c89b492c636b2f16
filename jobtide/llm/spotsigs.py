"""Document fingerprints from spot signatures, DataFrame functions only.

A common word (anchor) and the next ``CHAIN`` content words after it within ``REACH`` words
form a signature; so do the first content words of a text, which stand after its start.  Where
``REACH`` words pass without a common word, as in lists of names, every word is an anchor.  The
signature set of a text ignores case, punctuation and the common words between.  A text whose
words give no signature has one of its own, made of the whole text.

The fingerprint is the set's size, a digest of the sorted set and its 16 smallest members:
equal sets have equal fingerprints, and different sets differ.  Likeness is Jaccard.

:func:`near_sets` finds all pairs of different sets that are alike.  Sets are partitioned by length:
two sets can only reach a likeness of ``least`` if their classes are equal or neighbours.  Within
these they meet on rare signatures first: of a set's signatures in order of their frequency
only as many are posted as it takes for two alike sets to share one.  Of the pairs that meet,
those whose lengths, or whose places of the first shared signature, rule the likeness out are
pruned, and the others are compared.  The query compares fixed pairs, a text with its edited
form and with the next one, and wants each exact value, so that there nothing can be pruned.

Null text is empty text; two empty texts are equal.  Rows are kept as they are: repeated rows
give repeated results, ties in doc_id stand in the order of their text's hash, null ids last.
An empty table gives no rows; a single document is its own next one.  Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from jobtide.llm.common import let, maybe_broadcast, stored, table

# Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in is was for that with as at by be this from are it he on or a an "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine auch es "
    "de la le et les en un du une que est pour qui dans par plus pas au sur ne se "
    "el y los del las por con no su para al lo como"
).split()
CHAIN, REACH, SKETCH = 2, 8, 16
NOT_WORD = r"[^\p{L}\p{N}]+"
CLASS_RATIO = 0.8


def _is_anchor(word: Column) -> Column:
    return word.isin(*ANCHORS)


def signatures(text: Column) -> Column:
    """Sorted distinct signatures of a text, 16 hex digits each."""
    body = F.coalesce(text, F.lit(""))
    spoken = F.filter(F.split(F.lower(body), NOT_WORD), lambda w: w != "")
    none, nowhere = F.array().cast("array<string>"), F.array().cast("array<int>")

    def chain(content: Column, after: Column) -> Column:
        return F.array_join(F.slice(F.array_remove(F.slice(content, after, F.lit(REACH)), ""), 1, CHAIN), " ")

    def bare(anchors: Column, n: Column) -> Column:
        # Between neighbouring anchors, and before the first, the words after REACH ones without any.
        ends = F.concat(anchors, F.array(n))
        gaps = F.zip_with(F.concat(F.array(F.lit(-1)), anchors), ends, lambda p, q: F.when(
            p + REACH + 1 < q, F.sequence(p + REACH + 1, q - 1)).otherwise(nowhere))
        return F.flatten(gaps)

    def spots(words: Column) -> Column:
        def of(content: Column) -> Column:
            anchors = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: content[i] == "")
            places = let(anchors, lambda at: F.concat(at, bare(at, F.size(words))))
            after = F.transform(places, lambda i: F.concat(words[i], F.lit(" "), chain(content, i + 2)))
            return F.concat(F.array(F.concat(F.lit("^ "), chain(content, F.lit(1)))), after)

        # Common words are blanked once, so that a chain only has to leave out blanks.
        return let(F.transform(words, lambda w: F.when(_is_anchor(w), "").otherwise(w)), of)

    def complete(chains: Column) -> Column:
        # An anchor without a content word after it says nothing.
        return F.filter(chains, lambda s: ~F.endswith(s, F.lit(" ")))

    found = let(spoken, lambda w: F.when(F.size(w) > 0, complete(spots(w))).otherwise(none))
    hashed = let(found, lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(F.concat(F.lit("= "), body))))
    return F.sort_array(F.array_distinct(F.transform(hashed, lambda s: F.substring(F.md5(s.cast("binary")), 1, 16))))


def fingerprint(sigs: Column) -> Column:
    return F.concat_ws(
        ":", F.size(sigs).cast("string"), F.md5(F.array_join(sigs, "").cast("binary")),
        F.array_join(F.slice(sigs, 1, SKETCH), ""))


def length_class(sigs: Column) -> Column:
    """Sets whose classes lie more than one apart have a likeness below ``CLASS_RATIO``."""
    return F.floor(F.ln(F.size(sigs)) / F.lit(-math.log(CLASS_RATIO))).cast("int")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard of two signature sets; 0 without a look at them where lengths rule ``least`` out."""
    possible = F.least(F.size(a), F.size(b)) >= F.lit(least) * F.greatest(F.size(a), F.size(b))
    shared = let(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n))
    return F.when(possible, shared).otherwise(F.lit(0.0))


def set_classes(sets: DataFrame) -> DataFrame:
    """(class, id, sigs) of the different sets among (id, sigs) rows; the class is a digest, the id the smallest."""
    keyed = sets.select(F.md5(F.array_join("sigs", ",").cast("binary")).alias("class"), "id", "sigs")
    return keyed.groupBy("class").agg(F.min("id").alias("id"), F.first("sigs").alias("sigs"))


def near_sets(classes: DataFrame, least: float = CLASS_RATIO) -> DataFrame:
    """(a, b, likeness) of all pairs of different sets that are at least so alike, each pair once.

    ``classes`` has (class, sigs) rows with sorted, distinct signatures, see :func:`set_classes`; it has to
    be a stored table.  A pair of one length class is found there, one of neighbouring classes in the
    larger set's.  Empty sets are like nothing.
    """
    step = -math.log(least)
    sized = classes.where(F.size("sigs") > 0).withColumn("n", F.size("sigs"))
    each = sized.select("class", "n", F.explode("sigs").alias("sig"))
    common = stored(each.groupBy("sig").agg(F.count(F.lit(1)).alias("often")).where("often > 1"), "common-signatures")
    # Signatures of one set alone come first of all and lead to nobody.
    shared = each.join(maybe_broadcast(common, common.count(), 64), "sig").groupBy("class", "n").agg(
        F.array_sort(F.collect_list(F.struct("often", "sig"))).alias("ranked"))
    alone = F.col("n") - F.size("ranked")
    reach = F.greatest(F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9).cast("int") + 1 - alone, F.lit(0))
    posted = stored(
        shared.select("class", "n", alone.alias("alone"), F.slice("ranked", F.lit(1), reach).alias("prefix"))
        .select("class", "n", F.floor(F.ln("n") / F.lit(step) + 1e-9).cast("int").alias("length"),
                F.posexplode("prefix").alias("place", "p"), "alone")
        .select("class", "length", F.col("p.sig").alias("sig"), F.struct("class", "n", (F.col("n") - F.col("alone") - F.col("place")).alias("rest")).alias("e")),
        "postings")
    # A set is looked for by those of its own class that come after it, and by all of the next class.
    left = posted.select("sig", "length", F.col("e").alias("x"), F.lit(0).alias("up"))
    left = left.unionByName(left.select("sig", (F.col("length") + 1).alias("length"), "x", F.lit(1).alias("up")))
    right = posted.select("sig", "length", F.col("e").alias("y"))
    met = left.join(right, ["sig", "length"]).where((F.col("up") == 1) | (F.col("x.class") < F.col("y.class")))
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    within = small >= F.lit(least - 1e-12) * large
    # The first signature that two sets share leaves most of both behind it.
    most = met.where(within).groupBy(F.col("x.class").alias("a"), F.col("y.class").alias("b")).agg(
        F.max(F.least("x.rest", "y.rest")).alias("most"), F.first(small + large).alias("both"))
    kept = most.where(F.col("most") >= F.lit(least - 1e-12) * (F.col("both") - F.col("most"))).select("a", "b")
    one = classes.select(F.col("class").alias("a"), F.col("sigs").alias("a_sigs"))
    two = classes.select(F.col("class").alias("b"), F.col("sigs").alias("b_sigs"))
    like = likeness(F.col("a_sigs"), F.col("b_sigs"), least)
    return kept.join(one, "a").join(two, "b").select("a", "b", like.alias("likeness")).where(F.col("likeness") >= least)


def in_ranges(docs: DataFrame) -> DataFrame:
    """Documents dealt over ranges (``part``) of descending doc_id.

    Ids are dealt over ranges from percentiles of all ids.  The first document of a range is
    also the last neighbour of the range before, so each range is ordered by itself; the only
    rows brought to the driver are one id per range.
    """
    spark = docs.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    marks = docs.select(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10000).alias("m")).first()["m"]
    cuts = F.array(*[F.lit(m).cast("bigint") for m in sorted(set(marks or []))]).cast("array<bigint>")
    # Rows without an id come last; the hash that orders them also deals them over ranges of their own.
    by_hash = F.floor((F.shiftright(F.xxhash64(F.coalesce("text", F.lit(""))), 32) + (1 << 31)) * F.lit(parts) / F.lit(1 << 32)).cast("int")
    part = F.when(F.col("doc_id").isNull(), -1 - by_hash).otherwise(
        F.size(F.filter(cuts, lambda m: m <= F.col("doc_id"))))
    ranged = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), part.alias("part")).withColumn(
        "hash", F.xxhash64("text"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("down"), "hash")).alias("first")
    heads = sorted(ranged.groupBy("part").agg(first).collect(), key=lambda r: -r["part"])
    before = [
        (r["part"], None if r["first"]["none"] else -r["first"]["down"], r["first"]["hash"], heads[i - 1]["part"])
        for i, r in enumerate(heads)]
    ends = F.broadcast(spark.createDataFrame(before, "part int, head bigint, head_hash bigint, before int"))
    copies = F.when(
        F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("hash") == F.col("head_hash")),
        F.array(F.struct(F.col("part").alias("part"), F.lit(0).alias("copy")), F.struct(F.col("before").alias("part"), F.lit(1).alias("copy"))),
    ).otherwise(F.array(F.struct(F.col("part").alias("part"), F.lit(0).alias("copy"))))
    return ranged.join(ends, "part").select("doc_id", "text", "hash", F.inline(copies))


def following(column: str) -> Column:
    """The value of the next document, among the rows of a range and the copy that ends it."""
    return F.lead(column).over(W.partitionBy("part").orderBy("copy", F.col("doc_id").desc_nulls_last(), "hash"))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, sigs, next_text, next_sigs): the document after each one by descending doc_id, round the end.

    Each document's signatures are made once, where the ranges are in order, and handed to the one before.
    """
    dealt = in_ranges(docs).withColumn("next_text", following("text")).withColumn("sigs", signatures(F.col("text")))
    return dealt.withColumn("next_sigs", following("sigs")).where("copy = 0").select(
        "doc_id", "text", "sigs", "next_text", "next_sigs")


def with_edit(pairs: DataFrame) -> DataFrame:
    """Add the text whose last half is replaced by the start of the next document."""
    half = F.floor(F.char_length("text") / 2).cast("int")
    kept = F.left("text", F.char_length("text") - half)
    return pairs.withColumn("edited", F.concat(kept, F.left("next_text", half)))


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    edited = with_edit(with_next(table(spark, sf_dir, "documents").select("doc_id", "text")))
    sets = edited.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.col("sigs").alias("own"), signatures(F.col("edited")).alias("other"), "next_sigs")
    return sets.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_sigs")).alias("near_next"),
        length_class(F.col("own")).alias("length_class"))


_ANCHOR_LIST = "[" + ", ".join(f"'{w}'" for w in sorted(set(ANCHORS))) + "]"


def _sql_signatures(texts: str, column: str, name: str) -> str:
    """CTEs from (id, text) rows of ``texts`` to ``name``(id, sigs)."""
    return rf"""
{name}_w AS (SELECT doc_id, {column} AS body, list_filter(regexp_split_to_array(lower({column}), '[^\p{{L}}\p{{N}}]+'),
  lambda x: x <> '') AS w FROM {texts}),
{name}_p AS (SELECT doc_id, w, unnest(range(0, len(w) + 1)) AS i FROM {name}_w WHERE len(w) > 0),
{name}_c AS (SELECT doc_id, CASE WHEN i = 0 THEN '^' ELSE w[i] END || ' ' ||
  array_to_string(list_slice(list_filter(list_slice(w, i + 1, i + {REACH}), lambda x: NOT list_contains({_ANCHOR_LIST}, x)), 1, {CHAIN}), ' ') AS s
  FROM {name}_p WHERE i = 0 OR list_contains({_ANCHOR_LIST}, w[i]) OR (i > {REACH}
    AND len(list_filter(list_slice(w, i - {REACH}, i - 1), lambda x: list_contains({_ANCHOR_LIST}, x))) = 0)),
{name}_u AS (SELECT DISTINCT doc_id, substr(md5(s), 1, 16) AS h FROM {name}_c WHERE NOT ends_with(s, ' ')),
{name}_g AS (SELECT doc_id, list(h ORDER BY h) AS sigs FROM {name}_u GROUP BY doc_id),
{name} AS (SELECT t.doc_id, coalesce(g.sigs, [substr(md5('= ' || body), 1, 16)]) AS sigs
  FROM {name}_w t LEFT JOIN {name}_g g ON t.doc_id = g.doc_id)"""


def _sql_print(sigs: str) -> str:
    return f"len({sigs})::VARCHAR || ':' || md5(array_to_string({sigs}, '')) || ':' || array_to_string(list_slice({sigs}, 1, {SKETCH}), '')"


def _sql_like(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"{both}::DOUBLE / (len({a}) + len({b}) - {both})"


SQL = f"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text,
    coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC), first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS following
  FROM documents),
cut AS (SELECT *, substr(text, 1, length(text) - length(text) // 2) || substr(following, 1, length(text) // 2) AS edited FROM base),
{_sql_signatures("cut", "text", "own")},
{_sql_signatures("cut", "edited", "other")},
{_sql_signatures("cut", "following", "after")}
SELECT c.doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, {_sql_print("o.sigs")} AS fingerprint,
  {_sql_print("e.sigs")} AS edited_fingerprint, {_sql_like("o.sigs", "e.sigs")} AS near_edited, {_sql_like("o.sigs", "a.sigs")} AS near_next,
  floor(ln(len(o.sigs)) / {-math.log(CLASS_RATIO)!r})::INTEGER AS length_class
FROM cut c JOIN own o ON c.doc_id = o.doc_id JOIN other e ON c.doc_id = e.doc_id JOIN after a ON c.doc_id = a.doc_id
"""
