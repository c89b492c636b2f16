"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobtide.llm import resampling
from jobtide.llm.common import table
from jobtide.llm.queries import QUERIES
from llm import data

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    words = WORD.findall((text or "").translate(str.maketrans(resampling.UPPER, resampling.LOWER)))
    return len(words), [" ".join(words[i:i + n]) for i in range(len(words)) for n in range(1, longest + 1) if i + n <= len(words)]


def plain(docs, items, buckets=10000, longest=1, percent=10, least=20, seed=2024):
    coded = [(i, n, [zlib.crc32(f.encode()) % buckets for f in found]) for i, t in docs for n, found in [features(t, longest)]]
    s = Counter(b for *_, found in coded for b in found)
    t = Counter(zlib.crc32(f.encode()) % buckets for text in items for f in features(text, longest)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in s}
    rows = []
    for i, n, found in coded:
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    enough = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[3]))
    for rank, row in enumerate(enough[:percent * len(enough) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, rows), key=repr)


def inputs(folder):
    docs = data.read(folder, "documents")
    return [(None if i != i else int(i), t) for i, t in zip(docs.doc_id, docs.text)], list(data.read(folder, "benchmark").text)


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 70000, "percent": 50, "least_words": 2}, {"buckets": 7, "percent": 100, "least_words": 0}])
def test_resample_equals_plain(spark, odd, options):
    got = resampling.resample(table(spark, odd, "documents"), table(spark, odd, "benchmark"), "item_id", **options)
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    docs, items = inputs(odd)
    wanted = plain(docs, items, **{"least" if k == "least_words" else k: v for k, v in options.items()})
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == wanted


def test_op12_equals_plain(spark):
    got = sorted(map(tuple, QUERIES["op12_resampling"](spark, data.SMALL).select(
        "doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)
    wanted = sorted(((r[0], *r[2:]) for r in plain(*inputs(data.SMALL))), key=repr)
    assert got == wanted and sum(r[4] is not None for r in got) > 0


def test_long_texts_are_cut_at_gaps(monkeypatch):
    text = "Alpha, béta  gamma9 " * 200
    whole = resampling.Cutter(longest=2).cut(text)
    monkeypatch.setattr(resampling, "CHARS_AT_ONCE", 7)
    parts = resampling.Cutter(longest=2).cut(text)
    assert whole[0] == parts[0] == 600 and whole[1].tolist() == parts[1].tolist()


def test_offsets_are_those_of_the_words():
    text = "Añb, c\u0000\U0001F600 é1"
    for word, (start, end) in resampling.Cutter().words(text.translate(resampling._LOWER)):
        assert text.translate(resampling._LOWER)[start:end] == word


def test_ranks_of_equal_keys_are_gapless(spark):
    rows = spark.range(5000).select(F.lit(7).alias("score"), F.col("id").alias("place")).repartition(9)
    got = resampling.ranked(rows, [F.desc("score"), F.asc("place")]).orderBy("rank").collect()
    assert [(r["rank"], r["place"]) for r in got] == [(k + 1, k) for k in range(5000)]


def test_empty_target(spark, odd):
    docs = table(spark, odd, "documents")
    got = resampling.resample(docs, spark.createDataFrame([], "item_id long, text string"), "item_id")
    assert got.count() == docs.count()
