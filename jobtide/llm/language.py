"""Language of a text by a string kernel.

The kernel of two texts is the number of character n-grams (1 to 3 letters, with word ends)
that both hold, divided by the root of the product of their numbers: a blended spectrum of
presence features.  N-grams are hashed into 2**20 features.  Nyström landmarks are a bounded
sample of labelled texts, and one ridge regression per language is fitted on their kernel
values.  Scoring takes the presence matrix of a few dozen texts at a time, multiplies it by
the landmarks' matrix and the result by the coefficients.  The landmarks are kept as postings (the
landmarks that have a feature); where their dense matrix would be large, it is made and
multiplied a block of features at a time, in the fit as in the scoring.

Only the sample is bounded, chosen by the hash of the ids: ``LANDMARKS`` and ``FIT_ROWS`` texts per
language, and where there are many languages ``ALL_LANDMARKS`` and ``ALL_ROWS`` shared between them, one of
each at least.  There is no bound on their number.  Every text is scored whole, in pieces of any length.

Null texts and texts without a letter are ``und`` with score 0.  Without any labelled text
all are ``und``.  Equal scores go to the first language by name.  Repeated rows each get a row; rows
with null ``lang`` are scored, not learned from.  Columns besides doc_id, text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from jobtide.llm.common import maybe_broadcast, short_batches, stored, table, tidy

FEATURE_BITS, ORDERS = 20, 3
LANDMARKS, FIT_ROWS, RIDGE = 40, 250, 1e-3
ALL_LANDMARKS, ALL_ROWS = 4096, 25_000
UNKNOWN = "und"
# Texts of one presence matrix, letters hashed at once, and numbers of a dense matrix.
ROWS_AT_ONCE, CHARS_AT_ONCE, CELLS_AT_ONCE = 64, 1 << 18, 1 << 24

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    """Lower-case letters as numbers, every run of anything else as one 0."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[points], points, 0)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


def _features(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, features) of each order; word ends are part of an n-gram, other words not."""
    wide = codes.astype(np.uint64) + np.uint64(1)
    for n in range(1, ORDERS + 1):
        if len(codes) < n:
            return
        size = len(codes) - n + 1
        inner = np.ones(size, bool)
        for k in range(1, n - 1):
            inner &= codes[k:size + k] != 0
        if n < 3:
            inner &= (codes[:size] != 0) & (codes[n - 1:] != 0)
        mixed = np.full(size, n, np.uint64)
        for k in range(n):
            mixed = (mixed ^ wide[k:size + k]) * _MULTIPLIERS[k]
            mixed ^= mixed >> np.uint64(29)
        at = np.flatnonzero(inner)
        yield at, ((mixed[at] * _MULTIPLIERS[0]) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def text_features(text: str | None) -> np.ndarray:
    """Sorted distinct features of one text."""
    seen = np.zeros(1 << FEATURE_BITS, bool)
    for piece in _pieces(text or ""):
        for _, feature in _features(_codes(piece)):
            seen[feature] = True
    return np.flatnonzero(seen).astype(np.int32)


def _pieces(text: str) -> Iterator[str]:
    """Parts of a long text that share two characters, so that no n-gram is lost."""
    step = CHARS_AT_ONCE
    if len(text) <= step:
        yield f" {text} "
        return
    for start in range(0, len(text), step):
        yield (" " if start == 0 else "") + text[max(0, start - 2):start + step] + (" " if start + step >= len(text) else "")


@dataclass(frozen=True)
class Landmarks:
    """The features of the landmark texts as postings: of the k-th feature that any has, the landmarks
    ``owners[ends[k]:ends[k + 1]]`` have it."""

    column_of: np.ndarray  # feature -> number of the feature, -1 for none
    ends: np.ndarray
    owners: np.ndarray
    scale: np.ndarray  # 1 divided by the root of a landmark's size

    def __getstate__(self) -> dict:
        """Tasks make the dense matrix themselves."""
        return {k: v for k, v in self.__dict__.items() if k != "_whole"}

    @property
    def width(self) -> int:
        return len(self.ends) - 1

    def _dense(self, start: int, end: int) -> np.ndarray:
        out = np.zeros((end - start, len(self.scale)), np.float32)
        a, b = self.ends[start], self.ends[end]
        rows = np.repeat(np.arange(end - start), np.diff(self.ends[start:end + 1]))
        out[rows, self.owners[a:b]] = self.scale[self.owners[a:b]]
        return out

    @cached_property
    def _whole(self) -> np.ndarray:
        return self._dense(0, self.width)

    def times(self, presence: np.ndarray) -> np.ndarray:
        """The product of presence rows and the scaled landmark matrix."""
        step = max(1, CELLS_AT_ONCE // max(1, len(self.scale)))
        if self.width <= step:
            return presence @ self._whole
        out = np.zeros((len(presence), len(self.scale)), np.float32)
        for start in range(0, self.width, step):
            end = min(start + step, self.width)
            out += presence[:, start:end] @ self._dense(start, end)
        return out

    def rows_at_once(self) -> int:
        return max(1, min(ROWS_AT_ONCE, CELLS_AT_ONCE // max(1, self.width)))


def landmarks_of(features: list[np.ndarray]) -> Landmarks:
    owner = np.repeat(np.arange(len(features), dtype=np.int32), [len(f) for f in features])
    feature = np.concatenate([np.zeros(0, np.int32), *features])
    order = np.argsort(feature, kind="stable")
    used, first = np.unique(feature[order], return_index=True)
    column_of = np.full(1 << FEATURE_BITS, -1, np.int32)
    column_of[used] = np.arange(len(used))
    scale = 1 / np.sqrt(np.maximum([len(f) for f in features], 1))
    return Landmarks(column_of, np.append(first, len(feature)).astype(np.int64), owner[order], np.asarray(scale, np.float32))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    landmarks: Landmarks
    weights: np.ndarray  # landmarks x languages


def _presence(texts: list[str | None], column_of: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Presence matrix over the landmarks' features; the number of all distinct features of a text,
    those of no landmark included; whether a text has a letter."""
    rows = np.zeros((len(texts), width + 1), np.float32)
    lettered = np.zeros(len(texts), bool)
    waiting: list[tuple[int, np.ndarray]] = []
    size = 0
    # Distinct (row, feature) of features that no landmark has, as one number each.
    others = np.zeros(0, np.int64)

    def flush() -> None:
        nonlocal waiting, size, others
        if not waiting:
            return
        codes = np.concatenate([c for _, c in waiting])
        owner = np.repeat([r for r, _ in waiting], [len(c) for _, c in waiting])
        found = [others]
        for at, feature in _features(codes):
            column = column_of[feature]
            rows[owner[at], column] = 1
            apart = column < 0
            found.append(np.unique(owner[at[apart]] << FEATURE_BITS | feature[apart]))
        others = np.unique(np.concatenate(found))
        waiting, size = [], 0

    for row, text in enumerate(texts):
        if len(text or "") > CHARS_AT_ONCE:
            flush()
        for piece in _pieces(text or ""):
            codes = _codes(piece)
            lettered[row] |= bool(codes.any())
            waiting.append((row, codes))
            size += len(codes)
            # Whole texts end in 0, so no n-gram reaches from one into the next; parts do not.
            if size >= CHARS_AT_ONCE or len(text or "") > CHARS_AT_ONCE:
                flush()
    flush()
    known = rows[:, :width]
    return known, known.sum(axis=1) + np.bincount(others >> FEATURE_BITS, minlength=len(texts)), lettered


def _kernel(presence: np.ndarray, landmarks: Landmarks, sizes: np.ndarray) -> np.ndarray:
    return landmarks.times(presence) / np.sqrt(np.maximum(sizes, 1)).astype(np.float32)[:, None]


def fit(texts: list[tuple[str, np.ndarray]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """A model from (language, features) of sampled texts; the first of a language are its landmarks."""
    languages = sorted({lang for lang, _ in texts})
    number = {lang: k for k, lang in enumerate(languages)}
    by_language: list[list[np.ndarray]] = [[] for _ in languages]
    for lang, features in texts:
        if len(features) and len(by_language[number[lang]]) < landmarks:
            by_language[number[lang]].append(np.asarray(features, np.int32))
    chosen = [f for own in by_language for f in own]
    marks = landmarks_of(chosen)

    def kernels(rows: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """(first row, kernel values) of some rows after the others."""
        step = marks.rows_at_once()
        for start in range(0, len(rows), step):
            part = rows[start:start + step]
            presence = np.zeros((len(part), marks.width), np.float32)
            for row, features in enumerate(part):
                at = marks.column_of[features]
                presence[row, at[at >= 0]] = 1
            yield start, _kernel(presence, marks, np.array([len(f) for f in part])).astype(np.float64)

    between = np.concatenate([np.zeros((0, len(chosen))), *[known for _, known in kernels(chosen)]])
    system = ridge * len(texts) * between + 1e-6 * np.eye(len(chosen))
    sums = np.zeros((len(chosen), len(languages)))
    for start, known in kernels([np.asarray(f, np.int32) for _, f in texts]):
        system += known.T @ known
        for row, (lang, _) in enumerate(texts[start:start + len(known)]):
            sums[:, number[lang]] += known[row]
    weights = np.linalg.solve(system, sums) if chosen else np.zeros((0, len(languages)))
    return Model(languages, marks, weights.astype(np.float32))


def shares(languages: int) -> tuple[int, int]:
    """(landmarks, texts) of the sample for each of so many languages."""
    each = max(1, languages)
    return max(1, min(LANDMARKS, ALL_LANDMARKS // each)), max(1, min(FIT_ROWS, ALL_ROWS // each))


def sample_texts(labelled: DataFrame) -> tuple[list[tuple[str, np.ndarray]], int]:
    """(language, features) of some texts of each language, by the hash of their ids, and the landmarks of each.

    A threshold on the hash is set from the counts first, so that only about as many rows as
    are wanted meet in the ranking, however many rows a language has.
    """
    counts = stored(labelled.groupBy("lang").count().withColumnRenamed("count", "_n"), "languages")
    languages = counts.count()
    landmarks, wanted = shares(languages)
    place = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    near = labelled.join(maybe_broadcast(counts, languages, 64), "lang").withColumn("_at", place).where(
        F.col("_at") * F.col("_n") <= 2 * wanted + 20)
    ranked = near.withColumn("_rank", F.row_number().over(W.partitionBy("lang").orderBy("_at", "doc_id", "text")))

    @F.udf("binary")
    def features(text):
        return text_features(text).tobytes()

    rows = ranked.where(F.col("_rank") <= wanted).select("lang", "_rank", features("text").alias("f")).collect()
    ordered = sorted(rows, key=lambda r: (r["lang"], r["_rank"]))
    return [(r["lang"], np.frombuffer(r["f"], np.int32)) for r in ordered], landmarks


def predict(model: Model):
    """A function from a text column to struct<lang_pred, score>."""

    @F.pandas_udf("lang_pred string, score double")
    @tidy
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        marks, step = model.landmarks, model.landmarks.rows_at_once()
        for texts in batches:
            names, scores = [], []
            for start in range(0, len(texts), step):
                part = [t if isinstance(t, str) else None for t in texts.iloc[start:start + step]]
                presence, sizes, lettered = _presence(part, marks.column_of, marks.width)
                if not model.languages:
                    lettered[:] = False
                values = _kernel(presence, marks, sizes) @ model.weights if model.languages else np.zeros((len(part), 1))
                best = values.argmax(axis=1)
                names += [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
                scores += [float(min(1.0, max(0.0, v))) if ok else 0.0 for v, ok in zip(values.max(axis=1), lettered)]
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return scored


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def learn(docs: DataFrame) -> Model:
    """Fit on labelled documents outside the held-out third."""
    short_batches(docs.sparkSession)
    usable = docs.select("doc_id", "text", "lang").where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return fit(*sample_texts(usable))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = predict(learn(docs))
    return docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), scored("text").alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score")
