"""Draw the documents that look most like a target, with noise: importance resampling.

An untrained Split of the tokenizers library cuts A-Z lower-cased text into words with their
offsets.  A feature is a window of 1 to ``longest`` neighbouring words, a pair of offsets; its
bucket is the CRC-32 of its words, joined by one blank, modulo ``buckets``.  Buckets are counted over all
documents and over the whole target.  A bucket's gain is the logarithm of how much likelier the
target has it, smoothed by one; a document's weight is the sum over its features.  Its score adds
Gumbel noise made from its id, and the highest scores of the documents with enough words are drawn.

Texts are cut once: their buckets, two bytes a feature, go to a scratch table, from which the
counts and then the weights are made.  Only counts of buckets and narrow rows are shuffled.  Ranks
come from a sort by ranges of (score, doc_id, place in the scratch table), so equal keys are split
too, and the counts of its partitions.

Null and empty texts have no features, weight 0, and are not drawn for want of words.  Null doc_id
makes noise as no digits do and loses ties; rows with the same score and doc_id are ranked by their
weight, then their place.  Rows that repeat each count and each can be drawn.  An empty target has counts
of 0, empty documents give no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm.common import LOWER, UPPER, short_batches, shuffle_parts, stored, table, tidy

BUCKETS, LONGEST = 10000, 1
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Characters handed to the library at once; a longer text is cut at a gap.
CHARS_AT_ONCE = 1 << 20

_LOWER = str.maketrans(UPPER, LOWER)


class Cutter:
    """Words of a text with their offsets, and the buckets of their windows."""

    def __init__(self, buckets: int = BUCKETS, longest: int = LONGEST):
        from tokenizers import Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(GAP), "removed").pre_tokenize_str
        self.buckets, self.longest = buckets, longest

    def words(self, text: str) -> Iterator[tuple[str, tuple[int, int]]]:
        start = 0
        while start < len(text):
            end = start + CHARS_AT_ONCE
            while end < len(text) and text[end] != " ":
                end += 1
            for word, (a, b) in self.split(text[start:end]):
                yield word, (start + a, start + b)
            start = end

    def cut(self, text: str | None) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of each window, by its first word and its length."""
        lowered = (text or "").translate(_LOWER)
        offsets = [place for _, place in self.words(lowered)]
        found = []
        for first, (start, end) in enumerate(offsets):
            code = crc32(lowered[start:end].encode("utf-8", "replace"))
            found.append(code % self.buckets)
            for start, end in offsets[first + 1:first + self.longest]:
                code = crc32(f" {lowered[start:end]}".encode("utf-8", "replace"), code)
                found.append(code % self.buckets)
        return len(offsets), np.array(found, np.uint32)


def bucketed(docs: DataFrame, key: str, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(key, n_words, n_features, codes): the buckets of every text as 16-bit numbers, 32-bit past 65536."""
    short_batches(docs.sparkSession)
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(buckets, longest)
        for batch in batches:
            rows = [cutter.cut(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array([n for n, _ in rows], pa.int64()), pa.array([len(c) for _, c in rows], pa.int64()),
                 pa.array([c.astype(kind).tobytes() for _, c in rows], pa.binary())],
                names=[key, "n_words", "n_features", "codes"])

    fields = [docs.schema[key], *(T.StructField(n, T.LongType()) for n in ("n_words", "n_features")), T.StructField("codes", T.BinaryType())]
    return docs.select(key, "text").mapInArrow(cut, T.StructType(fields))


def bucket_counts(coded: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of each bucket over all texts; at most ``buckets`` rows come from each task."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    @tidy
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for codes in batch.column(0).to_pylist():
                sums += np.bincount(np.frombuffer(codes, kind), minlength=buckets)
        used = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(used), pa.array(sums[used])], names=["bucket", "n"])

    partial = coded.select("codes").mapInArrow(counted, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in thousandths, rounded down."""
    n = len(source)
    all_source, all_target = float(source.sum()), float(target.sum())
    return np.array([
        floor(1000 * log((t + 1.0) * (all_source + n) / ((s + 1.0) * (all_target + n))))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of an id, in thousandths, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296))).cast("bigint")


def weighted(coded: DataFrame, gain: np.ndarray) -> DataFrame:
    """``codes`` replaced by the weight of the text."""
    kind = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")

    @F.pandas_udf("bigint")
    def weight(codes):
        return codes.map(lambda c: int(gain[np.frombuffer(c, kind)].sum()))

    return coded.withColumn("weight", weight("codes")).drop("codes")


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Gapless rank from 1 in a total order, without bringing the rows together.

    Rows are dealt by ranges and sorted; a row's place in its partition is stored with it and
    shifted by the sizes of the partitions before, of which there are as many as partitions.
    """
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
    placed = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before, shifts = 0, []
    for row in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        shifts.append((row["part"], before))
        before += row["n"]
    sides = spark.createDataFrame(shifts, "_part bigint, _before bigint")
    joined = placed.withColumn("_part", part).join(F.broadcast(sides), "_part")
    return joined.withColumn(name, inside + F.col("_before") + 1).drop("_at", "_part", "_before")


def resample(
    docs: DataFrame, target: DataFrame, target_key: str, buckets: int = BUCKETS, longest: int = LONGEST,
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank); rank is null where a document isn't drawn."""
    coded = stored(bucketed(docs, "doc_id", buckets, longest), "buckets")
    gain = gains(bucket_counts(coded, buckets), bucket_counts(bucketed(target, target_key, buckets, longest), buckets))
    scored = stored(
        weighted(coded, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
        .withColumn("place", F.monotonically_increasing_id()), "scores")
    enough = F.col("n_words") >= least_words
    draw = percent * scored.where(enough).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.asc("place")]
    first = ranked(scored.where(enough), order)
    drawn = first.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("bigint"))
    return drawn.unionByName(rest).drop("place")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn for their likeness to the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    target = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return resample(docs, target, "item_id").drop("n_words")


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS place, doc_id, {_WORDS} AS w FROM documents),
words AS (SELECT place, word, count(*) AS n FROM (SELECT place, unnest(w) AS word FROM docs) GROUP BY place, word),
sought AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
bytes AS (SELECT list(list_reduce([i] || range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc FROM range(256) r(i)),
codes AS (SELECT word, xor(list_reduce([4294967295] || list_transform(range(octet_length(encode(word))),
    lambda k: ('0x' || substr(hex(encode(word)), 2 * k + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT word FROM words UNION SELECT word FROM sought), bytes),
source AS (SELECT bucket, sum(n) AS s FROM words JOIN codes USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM sought JOIN codes USING (word) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln(
    (coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM source) + {BUCKETS})::DOUBLE
    / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM target), 0) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM source LEFT JOIN target USING (bucket)),
weights AS (SELECT place, sum(n * gain)::BIGINT AS weight FROM words JOIN codes USING (word) JOIN gain USING (bucket) GROUP BY place),
scores AS (SELECT place, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((
      ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (place)),
drawn AS (SELECT place, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, weight DESC, place) AS rank,
    {PERCENT} * count(*) OVER () // 100 AS most FROM scores WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= most THEN rank END AS rank FROM scores LEFT JOIN drawn USING (place)
"""
