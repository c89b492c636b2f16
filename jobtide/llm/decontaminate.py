"""Documents that hold passages of a benchmark, DataFrame functions only.

Text is A-Z lower-cased and cut into words of digits, letters and all non-ASCII characters.
Every run of ``window`` words of an item (a shorter item is one window) is searched in every
document by a prefix-filtered join.  A window can only occur where all of its tokens do, so
one token is a sufficient prefix: its rarest, counted over all documents.  Positions of the
documents that hold a prefix token are joined to the windows, those where the window would
reach over an end of the document are dropped (length and position bounds), and the rest is
compared word by word.

The windows are broadcast only when their counted size is below the limit.  Past that a Bloom
filter of the prefix tokens is broadcast, sized by their number, and each position that may hold one is
shuffled on its token with 128 bits of hash for every window that reaches over it, no words; adaptive
execution splits a token that is still frequent.  Item ids are not carried by occurrences:
windows of the same items share a number, and a document's distinct numbers are looked up last.

Null or empty text has no words and is in the result with zeros.  Items without words match
nothing; an item with null id marks words but is not listed.  Rows that repeat each get a row.  With an
empty benchmark nothing is hit.  Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from jobtide.llm.common import ascii_lower, let, small_enough, stored, table, unused
from jobtide.operators.bloom import bloom_filter

WINDOW = 10
# The share of other tokens that a filter may let pass, and the most memory it may take.
FALSE_SHARE, FILTER_BYTES = 0.01, 256 << 20
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Ends every document's word list; no word can hold it.
END = "\u0000"


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows with the ids of the items that hold them."""
    listed = items.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    each = listed.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("words", s, length))).alias("window"))
    return each.groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def token_counts(docs: DataFrame, vocabulary: DataFrame, limit: int) -> DataFrame:
    """How often the benchmark's tokens occur in all documents.

    Past the broadcast limit tokens of other texts are sorted out by a Bloom filter and the rest is
    counted in each task before it is shuffled.
    """
    rows = vocabulary.count()
    tokens = docs.select(F.explode(words(F.col("text"))).alias("token"))
    if small_enough(rows, 64, limit):
        return tokens.join(F.broadcast(vocabulary), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    near = _maybe(tokens, vocabulary, rows)
    return near.groupBy("token").agg(F.count(F.lit(1)).alias("n")).join(vocabulary, "token")


def _maybe(tokens: DataFrame, sought: DataFrame, count: int) -> DataFrame:
    """Rows whose token may be one of the sought ones: all of them where a filter would be too large."""
    tag, found = unused(tokens, "_tag"), unused(tokens, "_found")
    bloom = bloom_filter(sought.select(F.xxhash64("token").alias(tag)), tag, count, FALSE_SHARE, FILTER_BYTES)
    if bloom is None:
        return tokens
    return bloom.flagged(tokens.withColumn(tag, F.xxhash64("token")), tag, found).where(found).drop(tag, found)


def prefixed_windows(docs: DataFrame, windows: DataFrame, limit: int) -> DataFrame:
    """Windows with their rarest token over all documents and its place in the window."""
    places = windows.select("window", F.posexplode("window").alias("offset", "token"))
    vocabulary = stored(places.select("token").distinct(), "vocabulary")
    counts = token_counts(docs, vocabulary, limit)
    ranked = places.join(counts, "token", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("rarest"))
    # A window with a token that no document holds occurs nowhere.
    kept = ranked.where(F.col("rarest.n") > 0)
    return kept.join(windows, "window").select(
        F.col("rarest.token").alias("token"), F.col("rarest.offset").alias("offset"),
        F.size("window").alias("length"), "window", "owners")


def _listed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("key"), words(F.col("text")).alias("words"))


def _by_broadcast(docs: DataFrame, found: DataFrame) -> DataFrame:
    end_row = docs.sparkSession.range(1).select(
        F.lit(END).alias("token"), F.lit(0).alias("offset"), F.lit(0).alias("length"),
        F.array().cast("array<string>").alias("window"), F.lit(None).cast("bigint").alias("owners"))
    listed = _listed(docs).withColumn("words", F.concat("words", F.array(F.lit(END))))
    placed = listed.select("doc_id", "key", "words", F.posexplode("words").alias("pos", "token"))
    start = F.col("pos") - F.col("offset")
    fits = (start >= 0) & (start + F.col("length") < F.size("words"))
    same = F.slice("words", start + 1, F.col("length")) == F.col("window")
    is_end = F.col("token") == END
    hits = placed.join(F.broadcast(found.unionByName(end_row)), "token").where(is_end | (fits & same))
    return hits.select(
        "doc_id", "key", start.alias("start"), (start + F.col("length")).alias("end"), "owners", is_end.alias("is_end"))


def _digest(window: Column) -> Column:
    """128 bits of the words of a window, which hold no blank."""
    return let(F.array_join(window, " "), lambda text: F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(END), text).alias("b")))


def _by_shuffle(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The same rows for windows of any number, those of one length after the other."""
    read = _listed(docs)
    parts = [read.select(
        "doc_id", "key", F.size("words").alias("start"), F.size("words").alias("end"),
        F.lit(None).cast("bigint").alias("owners"), F.lit(True).alias("is_end"))]
    for row in found.groupBy("length").agg(F.count_distinct("token").alias("tokens")).collect():
        length = row["length"]
        of_length = found.where(F.col("length") == length)
        placed = read.where(F.size("words") >= length).select("doc_id", "key", "words", F.posexplode("words").alias("pos", "token"))
        near = _maybe(placed, of_length.select("token").distinct(), row["tokens"])
        begin = lambda o: F.col("pos") - o
        over = F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda o: F.when(
            (begin(o) >= 0) & (begin(o) + length <= F.size("words")), _digest(F.slice("words", begin(o) + 1, F.lit(length)))))
        narrow = near.select("doc_id", "key", "pos", F.xxhash64("token").alias("tag"), over.alias("over"))
        sought = of_length.select(F.xxhash64("token").alias("tag"), "offset", _digest(F.col("window")).alias("digest"), "owners")
        hits = narrow.join(sought, "tag").where(F.element_at("over", F.col("offset") + 1) == F.col("digest"))
        start = F.col("pos") - F.col("offset")
        parts.append(hits.select(
            "doc_id", "key", start.alias("start"), (start + length).alias("end"), "owners", F.lit(False).alias("is_end")))
    return reduce(DataFrame.unionByName, parts)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, limit: int = 64 << 20) -> DataFrame:
    """Per document its words, hit words, and the items with windows in it.

    Hit words are counted as the length of the union of the windows: in order of start, each
    adds what reaches beyond the ends before.
    """
    read = docs.select("doc_id", "text")
    windows = stored(item_windows(items, window), "item-windows")
    # A number for each set of items that windows have in common.
    owners = stored(windows.select("items").distinct().select(F.monotonically_increasing_id().alias("owners"), "items"), "owners")
    numbered = windows.join(owners, "items").select("window", "owners")
    found = stored(prefixed_windows(read, numbered, limit), "windows")
    broadcast = small_enough(found.count(), 120 + 24 * window, limit)
    hits = _by_broadcast(read, found) if broadcast else _by_shuffle(read, found)
    order = W.partitionBy("doc_id", "key").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    reach = F.coalesce(F.max("end").over(order), F.lit(0))
    adds = F.greatest(F.col("end") - F.greatest(F.col("start"), F.col("reach")), F.lit(0))
    summed = stored(hits.withColumn("reach", reach).groupBy("doc_id", "key").agg(
        F.max(F.when(F.col("is_end"), F.col("start"))).cast("bigint").alias("n_words"),
        F.sum(F.when(F.col("is_end"), 0).otherwise(adds)).cast("bigint").alias("n_hit"),
        F.count_if("is_end").cast("int").alias("rows"), F.collect_set("owners").alias("owners")), "hit-documents")
    hit = summed.where("n_hit > 0").select("doc_id", "key", F.explode("owners").alias("owners"))
    listing = owners.select(F.col("owners").alias("_owners"), F.explode("items").alias("item"))
    size = listing.count()
    side = F.broadcast(listing) if small_enough(size, 48, limit) else listing
    ids = hit.join(side, F.col("owners") == F.col("_owners")).groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")).select(
        F.col("doc_id").alias("_doc_id"), F.col("key").alias("_key"), "items")
    clean = summed.where("n_hit = 0").withColumn("items", F.array().cast("array<string>"))
    marked = summed.where("n_hit > 0").join(
        ids, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("key") == F.col("_key")), "left").withColumn(
        "items", F.coalesce("items", F.array().cast("array<string>")))
    both = clean.select("doc_id", "key", "n_words", "n_hit", "items", "rows").unionByName(
        marked.select("doc_id", "key", "n_words", "n_hit", "items", "rows"))
    each = both.withColumn("rows", F.explode(F.sequence(F.lit(1), "rows")))
    return each.select(
        "doc_id", "key", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items",
        (F.col("n_hit") > 0).alias("contaminated"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    marked = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return marked.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
spans AS (SELECT item_id, w, least(len(w), {WINDOW}) AS size FROM items WHERE len(w) > 0),
sought AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, place, place + size - 1), ' ') AS run
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS place FROM spans)),
sizes AS (SELECT DISTINCT size FROM sought),
runs AS (SELECT doc_id, size, place, array_to_string(list_slice(w, place, place + size - 1), ' ') AS run
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS place FROM docs, sizes WHERE len(w) >= size)),
hits AS (SELECT r.doc_id, r.place, r.size, s.item_id FROM runs r JOIN sought s ON r.size = s.size AND r.run = s.run),
hit_words AS (SELECT doc_id, count(*) AS n_hit FROM
  (SELECT DISTINCT doc_id, unnest(range(place, place + size)) AS word FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words h ON d.doc_id = h.doc_id LEFT JOIN hit_items i ON d.doc_id = i.doc_id
"""
