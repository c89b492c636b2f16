"""Toxic texts by a noisy channel: disguised words are restored, then the restored text is scored.

A writer's word passes a channel that puts signs for letters (``1d10t``, ``st*pid``), repeats letters
(``idiooot``) and spaces letters out (``i d i o t``, ``i.d.i.o.t``).  A disguised stretch becomes a
lattice: every sign may stand for its letters or for a word's end, a mask for any vowel, a run of one
letter for one or two of it, a separator for nothing or for a word's end, each at a fixed cost.  Viterbi decoding finds
the path whose cost and whose probability under a character model of the corpus are best together.
The model is of four characters with back-off; its counts are over the letters of all texts, and none
is left out.  While the counted runs fit a broadcast every task gets all of them; past that each batch of
texts is sent those that its own lattices ask for, which decodes it the same.  A word
of letters alone without a run of three has a single path and is not decoded.

Restored words are scored by logistic regression on the presence of words and word beginnings, each
at several numbers of occurrences.  Their document counts by label are over all labelled rows; the
``MOST_FEATURES`` that tell labels apart best are kept.  Only the regression is fitted on a bounded
sample: ``FIT_ROWS`` rows of each label, by the hash of their ids.

Null, empty and blank texts have no words and get the score of a text without any kept feature.
Without labelled rows of both kinds every score is the share of label 1 (0 without any label).  Rows
with null doc_id are scored, not learned from; a doc_id with several labels has the greatest.  Rows
that repeat each get a row.  Whole texts are read, of any length: a decoded stretch takes time and
memory in proportion to its length.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import BROADCAST_BYTES, maybe_broadcast, short_batches, small_enough, stored, table, tidy

# Letters that a sign is written for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
# Signs that hide any vowel, at most so many in a row, and signs that set letters apart.
MASKS, MOST_MASKS, VOWELS = "*#", 3, "aeiou"
SEPARATORS = " .-_*~"
# Costs of the channel, in nats: a sign for a letter, a sign for none, a repetition, a letter set apart.
SIGN_COST, END_COST, REPEAT_COST, APART_COST = 1.0, 4.0, 0.5, 0.2

ORDER, BACK_OFF = 4, log(0.4)
FLOOR = log(1e-7)
GRAMS_AT_ONCE, PAIRS_AT_ONCE, WORDS_KEPT, STEPS_KEPT = 1 << 22, 1 << 18, 1 << 16, 1 << 17

BEGINNINGS, TIMES = range(3, 9), (1, 2, 4)
MOST_FEATURES, LEAST_DOCS, LEAST_EVIDENCE = 1000, 3, 8.0
FIT_ROWS, RIDGE, STEPS = 5000, 0.1, 30
TOXIC = 0.7

_SPACED = re.compile(
    rf"(?<![^\s{re.escape(SEPARATORS)}])[^\W_]([{re.escape(SEPARATORS)}])(?:[^\W_]\1)+[^\W_](?![^\s{re.escape(SEPARATORS)}.,;:!?])")
_RUN = re.compile(r"([^\W\d_])\1\1")
_SIGN = re.compile(r"[^\W\d_][0-9@$€£]|[0-9@$€£][^\W\d_]|[^\W\d_](?:[!|+(]|[*#]{1,3})[^\W\d_]")
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"\S+")
# Signs at the ends of a token that are no part of it.
_ENDS = "!?.,;:|+()[]{}\"'#%&*"


# --- the character model ----------------------------------------------------------------------


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x10000)), bool, 0x10000)


def _grams(texts: list[str]) -> np.ndarray:
    """All runs of four characters, packed; whatever is no letter is one word end, written 0."""
    points = np.frombuffer(f" {' '.join(texts)} ".lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    low = np.where(points < 0x10000, points, 0)
    codes = np.where(_letters()[low], low, 0).astype(np.uint64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    codes = codes[keep]
    size = max(0, len(codes) - ORDER + 1)
    packed = np.zeros(size, np.uint64)
    for k in range(ORDER):
        packed = packed << np.uint64(16) | codes[k:size + k]
    return packed


class Runs:
    """Values of packed runs, as sorted arrays: a dictionary takes some ten times their memory."""

    def __init__(self, runs: np.ndarray, values: np.ndarray):
        self.runs, self.values = runs, values

    def get(self, run: int) -> float | None:
        place = int(self.runs.searchsorted(np.uint64(run)))
        return float(self.values[place]) if place < len(self.runs) and int(self.runs[place]) == run else None

    def __contains__(self, run: int) -> bool:
        return self.get(run) is not None


class Steps:
    """Costs of characters after others, from tables of runs."""

    _tables: list[Runs]  # log(count of the run / count of the run without its end), for runs of 1 to 4

    @cached_property
    def _kept(self) -> dict[tuple[int, int, int], float]:
        return {}

    def step(self, context: int, known: int, code: int) -> float:
        """log probability of a character after the last ``known`` ones, packed in ``context``."""
        value = self._kept.get((context, known, code))
        if value is None:
            if len(self._kept) >= STEPS_KEPT:
                self._kept.clear()
            value = self._kept[context, known, code] = self._step(context, known, code)
        return value

    def _step(self, context: int, known: int, code: int) -> float:
        lost = 0.0
        for n in range(known, -1, -1):
            value = self._tables[n].get(_run(context, n, code))
            if value is not None:
                return value + lost
            lost += BACK_OFF
        return FLOOR + lost


def _run(context: int, n: int, code: int) -> int:
    """A character behind the last ``n`` of its context, packed."""
    return (context & ((1 << 16 * n) - 1)) << 16 | code


@dataclass(frozen=True)
class CharModel(Steps):
    grams: np.ndarray  # packed runs of four characters
    counts: np.ndarray

    @cached_property
    def _tables(self) -> list[Runs]:
        grams, counts = self.grams.astype(np.uint64), self.counts.astype(np.float64)
        out = []
        for n in range(1, ORDER + 1):
            mask = np.uint64((1 << 16 * n) - 1)
            runs, inverse = np.unique(grams & mask, return_inverse=True)
            sums = np.bincount(inverse, counts, len(runs))
            before, of = np.unique(runs >> np.uint64(16), return_inverse=True)
            total = np.bincount(of, sums, len(before))
            out.append(Runs(runs, np.log(sums / total[of])))
        return out


class Asked:
    """Stands for a model and notes the runs that decoding asks it for.

    Decoding follows every state of a lattice whatever it costs, so it asks any model for the same.
    """

    def __init__(self) -> None:
        self.steps: set[tuple[int, int, int]] = set()

    def step(self, context: int, known: int, code: int) -> float:
        self.steps.add((context, known, code))
        return 0.0

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Their lengths, and the runs packed; with those that are backed off to."""
        found = sorted({(n + 1, _run(context, n, code)) for context, known, code in self.steps for n in range(known + 1)})
        return np.array([n for n, _ in found], np.int32), np.array([run for _, run in found], np.uint64)


class Slice(Steps):
    """A model of the runs that some texts ask for, which are all they need."""

    def __init__(self, lengths: np.ndarray, runs: np.ndarray, counts: np.ndarray, totals: np.ndarray):
        order = np.argsort(runs)
        lengths, runs, values = lengths[order], runs[order], np.log(counts[order] / totals[order])
        self._tables = [Runs(runs[lengths == n], values[lengths == n]) for n in range(1, ORDER + 1)]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(gram, n) of all runs of four over the letters of all texts, stored."""

    @tidy
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def flush() -> pa.RecordBatch:
            grams, counts = np.unique(_grams(waiting), return_counts=True)
            return pa.record_batch([pa.array(grams.view(np.int64)), pa.array(counts.astype(np.int64))], names=["gram", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                # Parts of a long text share three characters, so that no run is lost; the words cut by
                # them are counted a second time as ends at most.
                for start in range(0, len(text or ""), GRAMS_AT_ONCE):
                    waiting.append(text[max(0, start - ORDER + 1):start + GRAMS_AT_ONCE])
                    size += len(waiting[-1])
                    if size >= GRAMS_AT_ONCE:
                        yield flush()
                        waiting, size = [], 0
        if waiting:
            yield flush()

    partial = docs.select("text").mapInArrow(counted, "gram bigint, n bigint")
    return stored(partial.groupBy("gram").agg(F.sum("n").alias("n")), "grams")


def _collected(counts: DataFrame) -> CharModel:
    rows = counts.toPandas().sort_values("gram")
    return CharModel(rows["gram"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64))


def char_model(docs: DataFrame, most: int | None = None) -> CharModel:
    """Counts over the letters of all texts, on the driver.

    With ``most`` no more runs than that: those above a power of two that leaves no more.  Nothing
    here asks for it; texts with more runs than a broadcast may have go to :func:`legible`.
    """
    summed = gram_counts(docs)
    if most is None:
        return _collected(summed)
    power = F.floor(F.log2(F.col("n"))).cast("int")
    sizes = {r["p"]: r["n"] for r in summed.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, room = max(sizes, default=0) + 1, most
    for p in sorted(sizes, reverse=True):
        room -= sizes[p]
        if room < 0:
            break
        least = p
    return _collected(summed.where(F.col("n") >= F.lit(1 << least)))


def run_counts(counts: DataFrame) -> DataFrame:
    """(length, run, n, total) of the runs of one to four, stored; ``total`` is of the run without its end."""
    lengths = []
    for n in range(1, ORDER + 1):
        mask = F.lit(-1 if n == ORDER else (1 << 16 * n) - 1).cast("bigint")
        lengths.append(counts.select(F.lit(n).alias("length"), F.col("gram").bitwiseAND(mask).alias("run"), "n"))
    every = lengths[0].union(lengths[1]).union(lengths[2]).union(lengths[3])
    summed = stored(every.groupBy("length", "run").agg(F.sum("n").alias("n")), "runs")
    before = F.shiftrightunsigned("run", 16)
    totals = summed.groupBy(F.col("length").alias("_length"), before.alias("_before")).agg(F.sum("n").alias("total"))
    on = (F.col("length") == F.col("_length")) & (before == F.col("_before"))
    return stored(summed.join(totals, on).select("length", "run", "n", "total"), "steps")


# --- decoding ---------------------------------------------------------------------------------


def lattice(stretch: str) -> list[list[tuple[str, float]]]:
    """Per place of a lower-cased stretch what may have been meant, with its cost."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(stretch):
        char = stretch[i]
        end = i + 1
        while end < len(stretch) and stretch[end] == char:
            end += 1
        run = end - i
        if char.isalpha():
            arcs = [(char, 0.0)] if run == 1 else [(char * 2, 0.0 if run == 2 else REPEAT_COST), (char, REPEAT_COST)]
        elif char in SIGNS:
            arcs = [(letter, SIGN_COST + (REPEAT_COST if run > 1 else 0)) for letter in SIGNS[char]]
            if run > 1:
                arcs += [(letter * 2, 2 * SIGN_COST + (REPEAT_COST if run > 2 else 0)) for letter in SIGNS[char]]
            arcs.append((" ", END_COST))
        elif char in MASKS and run <= MOST_MASKS:
            arcs = [*((letter, SIGN_COST) for letter in VOWELS), *([("", APART_COST)] if char in SEPARATORS else []), (" ", 0.0)]
            end = i + 1
        elif char in SEPARATORS:
            arcs = [("", APART_COST), (" ", 0.0)]
        else:
            arcs = [(" ", 0.0)]
        out.append(arcs)
        i = end
    return out


def _code(char: str) -> int:
    return ord(char) if char.isalpha() and ord(char) < 0x10000 else 0


def path_cost(model: CharModel, text: str, context: int = 0, known: int = 1) -> tuple[float, int, int]:
    """Cost of written characters after a context, and the context after them."""
    cost = 0.0
    for char in text:
        code = _code(char)
        if code or context & 0xFFFF:  # word ends do not repeat
            cost -= model.step(context, known, code)
            context, known = (context << 16 | code) & ((1 << 16 * (ORDER - 1)) - 1), min(known + 1, ORDER - 1)
    return cost, context, known


def decode(stretch: str, model: CharModel) -> str:
    """The best path: a state is the last three characters, so the search is exact."""
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 1): (0.0, None)}
    for arcs in [*lattice(stretch), [(" ", 0.0)]]:
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (context, known), (cost, way) in best.items():
            for text, paid in arcs:
                more, *state = path_cost(model, text, context, known)
                total, key = cost + paid + more, tuple(state)
                if key not in after or total < after[key][0]:
                    after[key] = (total, (way, text) if text else way)
        best = after
    _, way = min(best.values(), key=lambda v: v[0])
    parts = []
    while way:
        way, text = way
        parts.append(text)
    return " ".join("".join(reversed(parts)).split())


def _repeats(text: str) -> bool:
    """Whether a letter stands three times in a row."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return bool(((points[2:] == points[1:-1]) & (points[1:-1] == points[:-2])).any()) and bool(_RUN.search(text))


class Restorer:
    """Restores texts; decoded tokens are kept up to ``WORDS_KEPT``."""

    def __init__(self, model: Steps | Asked):
        self.model, self.kept = model, {}

    def token(self, token: str) -> str:
        """A lower-cased run without white space."""
        if not (_RUN.search(token) or _SIGN.search(token)):
            return token
        done = self.kept.get(token)
        if done is None:
            # Signs behind a token end it, as those before it do; other signs are part of the lattice.
            core = token.strip(_ENDS)
            done = token.replace(core, decode(core, self.model), 1) if core else token
            if len(token) <= 64:
                if len(self.kept) >= WORDS_KEPT:
                    self.kept.clear()
                self.kept[token] = done
        return done

    def _spaced(self, match: re.Match) -> str:
        stretch = match[0]
        return stretch if len(set(stretch)) <= 2 else decode(stretch, self.model)

    def joined(self, text: str | None) -> str:
        """Lower-cased, with letters that are set apart brought together."""
        return _SPACED.sub(self._spaced, (text or "").lower())

    def tokens(self, joined: str) -> str:
        return _TOKEN.sub(lambda m: self.token(m[0]), joined)

    def text(self, text: str | None) -> str:
        return self.tokens(self.joined(text))

    def words(self, text: str | None, heads: frozenset[str] | None = None) -> dict[str, int]:
        """How often each word stands in the restored text; with ``heads`` only words that begin like one of them."""
        joined, short = self.joined(text), BEGINNINGS[0]
        repeats = _repeats(joined)
        out: dict[str, int] = defaultdict(int)
        for token, n in Counter(joined.split()).items():
            core = token if token.isalpha() else token.strip(_ENDS)
            if core.isalpha() and not (repeats and _RUN.search(core)):
                if heads is None or core[:short] in heads:
                    out[core] += n
            else:
                for word in _WORD.findall(self.token(token)):
                    if heads is None or word[:short] in heads:
                        out[word] += n
        return out


class Restored:
    """In place of a :class:`Restorer` for texts that are restored."""

    def words(self, text: str | None, heads: frozenset[str] | None = None) -> dict[str, int]:
        short = BEGINNINGS[0]
        return Counter(w for w in _WORD.findall(text or "") if heads is None or w[:short] in heads)


def reader(chars: CharModel | None) -> Restorer | Restored:
    return Restored() if chars is None else Restorer(chars)


def _answered(docs: DataFrame, steps: DataFrame, rewrite: Callable[[Restorer, str], str]) -> DataFrame:
    """``docs`` with texts rewritten: each batch of them asks for runs and is decoded with the answers."""
    schema = docs.schema
    place = schema.names.index("text")

    def texts(restorer: Restorer, batch: pa.RecordBatch) -> list[str | None]:
        return [None if t is None else rewrite(restorer, t) for t in batch.column(place).to_pylist()]

    @tidy
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches, TaskContext.get().partitionId() << 32):
            asked = Asked()
            texts(Restorer(asked), batch)
            lengths, runs = asked.runs()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as stream:
                stream.write_batch(batch)
            yield pa.record_batch(
                [pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                 pa.array([lengths], pa.list_(pa.int32())), pa.array([runs.view(np.int64)], pa.list_(pa.int64()))],
                names=["batch", "body", "length", "run"])

    @tidy
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for body, *answers in zip(*(rows.column(c) for c in ("body", "length", "run", "n", "total"))):
                lengths, runs, counts, totals = (np.array(a.as_py() or [], np.int64) for a in answers)
                restorer = Restorer(Slice(lengths, runs.view(np.uint64), counts, totals))
                for batch in pa.ipc.open_stream(body.as_buffer()):
                    done = pa.array(texts(restorer, batch), batch.schema.field(place).type)
                    yield batch.set_column(place, batch.schema.field(place), done)

    sent = stored(docs.mapInArrow(ask, "batch bigint, body binary, length array<int>, run array<bigint>"), "asked")
    asked = sent.select("batch", F.explode(F.arrays_zip("length", "run")).alias("of")).select("batch", "of.length", "of.run")
    answers = asked.join(steps, ["length", "run"]).groupBy("batch").agg(
        F.collect_list(F.struct("length", "run", "n", "total")).alias("answer"))
    found = answers.select("batch", "answer.length", "answer.run", "answer.n", "answer.total")
    return sent.select("batch", "body").join(found, "batch", "left").mapInArrow(apply, schema)


def legible(docs: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, CharModel | None]:
    """``docs`` with the model that restores them, or already restored, stored, and no model.

    The latter where the counted runs are more than a broadcast may have.  Both ways each text has the same words.
    """
    short_batches(docs.sparkSession)
    counts = gram_counts(docs)
    if small_enough(counts.count(), 16, limit):
        return docs, _collected(counts)
    steps = run_counts(counts)
    # Letters set apart come first, as the tokens to decode depend on what they are brought together to.
    for rewrite in (Restorer.joined, Restorer.tokens):
        docs = _answered(docs, steps, rewrite)
    return stored(docs, "restored"), None


def restore(docs: DataFrame, model: CharModel, into: str = "restored") -> DataFrame:
    """Adds the restored text, lower-cased; null stays null."""
    short_batches(docs.sparkSession)

    @F.pandas_udf("string")
    @tidy
    def restored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restorer = Restorer(model)
        for texts in batches:
            yield pd.Series([restorer.text(t) if isinstance(t, str) else None for t in texts], dtype=object)

    return docs.withColumn(into, restored("text"))


# --- scoring ----------------------------------------------------------------------------------


def _occurrences(words: dict[str, int]) -> dict[str, int]:
    """How often a text has each feature: its words, closed by a blank, and their beginnings."""
    out: dict[str, int] = defaultdict(int)
    for word, n in words.items():
        out[f"{word} "] += n
        for k in BEGINNINGS:
            if k > len(word):
                break
            out[word[:k]] += n
    return out


@dataclass(frozen=True)
class Scorer:
    chars: CharModel | None  # none for restored texts
    features: list[tuple[str, int]]  # feature, least number of occurrences
    weights: np.ndarray  # one for each feature, the last for every text

    @cached_property
    def _columns(self) -> dict[str, list[tuple[int, int]]]:
        out = defaultdict(list)
        for column, (feature, times) in enumerate(self.features):
            out[feature].append((times, column))
        return dict(out)

    @cached_property
    def heads(self) -> frozenset[str]:
        """How the words begin that can have a feature."""
        return frozenset(f[:BEGINNINGS[0]].rstrip() for f, _ in self.features)

    def columns(self, words: dict[str, int]) -> list[int]:
        """Sorted columns of the features that a text has."""
        found = self._columns
        return sorted(c for f, n in _occurrences(words).items() for times, c in found.get(f, ()) if n >= times)

    def score(self, words: dict[str, int]) -> float:
        """From the words of a text, or those of them that begin like one of ``heads``."""
        z = float(self.weights[-1] + self.weights[self.columns(words)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def feature_counts(labelled: DataFrame, chars: CharModel | None) -> DataFrame:
    """(feature, times, n1, n0): labelled texts of either kind that have a feature so many times.

    The row with an empty feature counts the texts.
    """

    @tidy
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = reader(chars)
        sums: dict[tuple[int, int], Counter] = defaultdict(Counter)  # by number of times and label

        def flush() -> Iterator[pa.RecordBatch]:
            for (times, toxic), found in sums.items():
                n, none = pa.array(found.values(), pa.int64()), pa.array(np.zeros(len(found), np.int64))
                yield pa.record_batch(
                    [pa.array(found.keys(), pa.string()), pa.array(np.full(len(found), times, np.int32)), *((n, none) if toxic else (none, n))],
                    names=["feature", "times", "n1", "n0"])
            sums.clear()

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                has = _occurrences(restorer.words(text))
                sums[0, toxic][""] += 1
                sums[1, toxic].update(has.keys())
                for times in TIMES[1:]:
                    sums[times, toxic].update([feature for feature, n in has.items() if n >= times])
                if sum(map(len, sums.values())) >= PAIRS_AT_ONCE:
                    yield from flush()
        yield from flush()

    partial = labelled.select("text", "toxic").mapInArrow(counted, "feature string, times int, n1 bigint, n0 bigint")
    return partial.groupBy("feature", "times").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def evidence(n1: Column, n0: Column, all1: int, all0: int) -> Column:
    """Log-likelihood ratio of a feature's presence in both kinds against one share for all."""
    share = (n1 + n0) / F.lit(float(all1 + all0))
    parts = [(n1, all1 * share), (n0, all0 * share), (all1 - n1, all1 * (1 - share)), (all0 - n0, all0 * (1 - share))]
    return sum((F.when(seen > 0, 2 * seen * F.log(seen / meant)).otherwise(0.0) for seen, meant in parts), F.lit(0.0))


def fit(rows: Iterable[tuple[list[int], int]], width: int, share: float, ridge: float = RIDGE) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the sample is weighted to ``share`` of ones."""
    rows = list(rows)
    y = np.array([toxic for _, toxic in rows], float)
    ones = y.sum()
    if not 0 < ones < len(rows):
        weights = np.zeros(width + 1)
        weights[-1] = log(max(share, 1e-12) / max(1 - share, 1e-12))
        return weights
    x = np.zeros((len(rows), width + 1), np.float32)
    x[:, -1] = 1
    for row, (columns, _) in enumerate(rows):
        x[row, columns] = 1
    parts = np.where(y == 1, share * len(rows) / ones, (1 - share) * len(rows) / (len(rows) - ones))
    weights, penalty = np.zeros(width + 1), np.full(width + 1, ridge)
    penalty[-1] = 1e-3
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (parts * (p - y)) + penalty * weights
        curve = np.diag(penalty)
        for start in range(0, len(rows), 1024):
            part = x[start:start + 1024]
            curve += (part * (parts * p * (1 - p))[start:start + 1024, None].astype(np.float32)).T @ part
        move = np.linalg.solve(curve, slope)
        weights -= move
        if np.abs(move).max() < 1e-4:
            break
    return weights


def sample(labelled: DataFrame, sizes: dict[int, int], fit_rows: int) -> DataFrame:
    """About ``fit_rows`` rows of each label, by the hash of their ids."""
    place = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    size = F.when(F.col("toxic") == 1, F.lit(sizes[1])).otherwise(F.lit(sizes[0]))
    return labelled.where(place * size < fit_rows)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, most: int = MOST_FEATURES) -> Scorer:
    """Learn from rows that have a label, outside the held-out third."""
    short_batches(docs.sparkSession)
    return learn_from(docs, labels, char_model(docs), fit_rows, most)


def learn_from(
    docs: DataFrame, labels: DataFrame, chars: CharModel | None, fit_rows: int = FIT_ROWS, most: int = MOST_FEATURES,
) -> Scorer:
    """:func:`learn` from what :func:`legible` gave."""
    read = docs.select("doc_id", "text")
    known = stored(
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "toxic-labels")
    labelled = read.join(maybe_broadcast(known, known.count(), 64), "doc_id")
    counts = stored(feature_counts(labelled, chars), "toxic-counts")
    sizes = counts.where("feature = ''").first()
    n1, n0 = (sizes["n1"], sizes["n0"]) if sizes else (0, 0)
    features: list[tuple[str, int]] = []
    if n1 and n0:
        found = counts.where((F.col("feature") != "") & (F.col("n1") >= LEAST_DOCS) & (F.col("n1") * n0 > F.col("n0") * n1))
        told = found.withColumn("told", evidence(F.col("n1"), F.col("n0"), n1, n0)).where(F.col("told") >= LEAST_EVIDENCE)
        rows = told.orderBy(F.desc("told"), "feature", "times").limit(most).collect()
        features = [(r["feature"], r["times"]) for r in rows]
    blank = Scorer(chars, features, np.zeros(len(features) + 1))

    @F.pandas_udf("array<int>")
    @tidy
    def columns(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restorer = reader(blank.chars)
        for texts in batches:
            yield pd.Series([np.array(blank.columns(restorer.words(t, blank.heads)), np.int32) for t in texts], dtype=object)

    share = n1 / (n1 + n0) if n1 + n0 else 0.0
    rows = []
    if features:
        rows = sample(labelled, {0: n0, 1: n1}, fit_rows).select(columns("text").alias("c"), "toxic").collect()
    return Scorer(chars, features, fit(sorted((list(r["c"]), r["toxic"]) for r in rows), len(features), share))


def score(scorer: Scorer):
    """A function from a text column to its score, 0 to 1."""

    @F.pandas_udf("double")
    @tidy
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restorer = reader(scorer.chars)
        for texts in batches:
            yield pd.Series([scorer.score(restorer.words(t if isinstance(t, str) else None, scorer.heads)) for t in texts], dtype=float)

    return scored


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs, chars = legible(table(spark, sf_dir, "documents").select("doc_id", "text"))
    scorer = learn_from(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), chars)
    scored = docs.select("doc_id", held_out().alias("held_out"), score(scorer)("text").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= TOXIC, 1).otherwise(0))
