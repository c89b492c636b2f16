"""Corpus cleaning in five stages, each of them one operator over all its predecessor kept.

1. ``language``: documents without a letter, or whose text no language's kernel fits, go.
2. ``near_duplicates``: of documents that share at least 0.8 of their five-word shingles, or
   are linked by such documents, the one with the smallest doc_id stays.
3. ``benchmark``: documents with a window of a benchmark item go.
4. ``personal_data``: every confirmed span is replaced by its kind.
5. ``packing``: what is left is packed into sequences of 2048 tokens.

Stages 1 to 4 return the columns of ``documents``, extra ones included, in their order; texts that a
stage changes have a new n_chars.  The language model is learned from documents with a
language outside the held-out third, as in the operator's own query.

Rows with null text have no letter and go in stage 1.  Rows that repeat a document whole count
as near duplicates: one stays.  Rows with null doc_id have no id to be kept or dropped by and pass
stage 2.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import files_for, maybe_broadcast, stored, table, unused
from jobtide.llm.decontaminate import decontaminate
from jobtide.llm.language import UNKNOWN, learn, predict
from jobtide.llm.near import near_duplicates
from jobtide.llm.packing import pack, token_pieces
from jobtide.llm.pii import find_pii, redact
from jobtide.llm.tokens import default_tokenizer

# The least score of a kept text.
LEAST_SCORE = 0.05
SHINGLE, PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language the model can tell."""
    own = unused(docs, "_language")
    scored = docs.withColumn(own, predict(learn(docs))("text"))
    kept = (F.col(f"{own}.lang_pred") != UNKNOWN) & (F.col(f"{own}.score") >= LEAST_SCORE)
    return scored.where(kept).drop(own)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies.

    Only ids that go are joined.  A doc_id that stands on several rows is first cut down to one
    row for each text.
    """
    own = unused(docs, "_id")
    same = F.col("doc_id") == F.col(own)
    files = files_for(docs.count())
    groups = stored(near_duplicates(docs, SHINGLE, PERCENT), "groups", files)
    repeated = stored(
        groups.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(own)).agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1").select(own), "repeated", files)
    single = docs
    if not repeated.isEmpty():
        ids = maybe_broadcast(repeated, repeated.count(), 64)
        several = docs.join(ids, same, "left_semi").dropDuplicates(["doc_id", "text"])
        single = docs.join(ids, same, "left_anti").unionByName(several)
    goes = stored(groups.where("doc_id != component_id").select(F.col("doc_id").alias(own)).distinct(), "goes", files)
    return single.join(maybe_broadcast(goes, goes.count(), 64), same, "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    own, key = unused(docs, "_id"), unused(docs, "_key")
    goes = stored(
        decontaminate(docs, items).where("contaminated").select(F.col("doc_id").alias(own), F.col("key").alias(key)), "goes")
    same = F.col("doc_id").eqNullSafe(F.col(own)) & (F.xxhash64("text") == F.col(key))
    return docs.join(maybe_broadcast(goes, goes.count(), 64), same, "left_anti")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind."""
    own = unused(docs, "_pii")
    clean = redact(find_pii(docs, into=own), spans=own)
    changed = F.when(F.size(own) > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents; one row per piece."""
    return pack(stored(token_pieces(docs.select("doc_id", "text"), default_tokenizer()), "pieces"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", keep_one),
    ("benchmark", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packing),
]

# Kernels and tokenizers are no SQL; the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
