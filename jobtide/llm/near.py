"""Documents whose shingle sets have a Jaccard of at least a threshold, and their groups.

1. *Rarity.*  The 64-bit shingles of all documents are counted.  A task sends those of some thousand
   documents (a batch) sorted, as gaps, dealt over ranges; a range adds up its shingles, a slice at
   a time, and answers each batch with the counts of those that any other document has, too.  A
   shingle that is frequent inside a batch is sent once with its count, so no range gathers a
   frequent one.  The number of ranges grows with the text.
2. *Prefixes.*  Two sets above the threshold share one of their first
   ``n - ceil(t n) + 1`` shingles, rare ones first.  Shingles of one document alone come first of
   all and are shared with nobody, so only what reaches beyond them is kept; most documents
   have nothing left and no partner.  Equal sets are one class, from here on one row.
3. *Clusters.*  Classes that share a prefix shingle fall into one cluster, by links from the
   smallest class that has the shingle.  No pair is formed.
4. *Blocks.*  A cluster is dealt over chunks of about ``CHUNK`` classes and ``CHUNK_SHINGLES``, and
   each pair of chunks is a block: every pair of classes meets in one block only.  The length
   filter, the positional bound of the first shared prefix shingle and the suffix filter (the
   sum of the smaller counts over 16 hash ranges bounds the overlap) drop pairs; only classes
   with a pair left are compared, a few pairs one by one, many by products of presence matrices.
   A block returns a spanning forest of its links.
5. *Components* of the links, by smallest labels with hooks and shortcuts over written tables.

Counts, links, classes and labels stay in tables; nothing of them goes through the driver.

Null text and text without words have an empty set, link with nothing and are a group of their
own.  Equal texts, repeated rows included, are in one group.  A group's id is the smallest doc_id
in it, null only where all are null.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import files_for, maybe_broadcast, short_batches, shuffle_parts, stored, table, tidy
from jobtide.llm.shingles import shingle_sets

SHINGLE, PERCENT = 3, 90
# Shingles and documents of a batch, and the count from which a shingle is frequent in it.
BATCH_TOKENS, BATCH_DOCUMENTS, OFTEN, NOBODY = 1 << 20, 60_000, 32, 0xFFFF
# Shingles that a range is meant to hold, and those it adds up at once.  There are at most as many
# ranges as leave 32 shingles of a batch for each, so past some terabytes of text the batches have to grow, too.
RANGE_SHINGLES, SLICE_SHINGLES = 1 << 22, 1 << 20
# Bytes that a task hands back to Spark at once.
SENT_BYTES = 1 << 20
CHUNK, CHUNK_SHINGLES, SUFFIX_BITS, DENSE_COLUMNS, FEW = 384, 1 << 21, 4, 1 << 13, 8


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, sorted shingles) of a batch, some hundred texts at a time."""
    names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
    for start in range(0, len(names), 256):
        yield from zip(names[start:start + 256], shingle_sets(texts.slice(start, 256).to_pylist(), size))


def _planes(values: np.ndarray) -> bytes:
    """Numbers with all first bytes, then all second bytes, as many as the greatest needs."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _packed(values: np.ndarray) -> tuple[int, bytes]:
    """Sorted shingles as the first one, signed, and the gaps."""
    return int(values[:1].view(np.int64)[0]), _planes(np.diff(values, prepend=values[:1]))


def _unpacked(first: int, gaps: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(gaps), dtype=np.uint64) + np.array([first], np.int64).view(np.uint64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _digest(tokens: np.ndarray) -> bytes:
    return blake2b(tokens.astype("<u8").tobytes(), digest_size=16).digest()


_SENT = pa.schema([
    ("range", pa.int32()), ("batch", pa.int64()), ("first", pa.int64()), ("gaps", pa.binary()), ("owners", pa.binary()),
    ("times", pa.binary()), ("ids", pa.list_(pa.int64())), ("classes", pa.binary()), ("sizes", pa.binary()),
    ("often", pa.binary()), ("often_owners", pa.binary())])
_SENT_DDL = ("range int, batch bigint, first bigint, gaps binary, owners binary, times binary, ids array<bigint>, "
             "classes binary, sizes binary, often binary, often_owners binary")


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _short(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in record batches of some ``SENT_BYTES``, or of one longer row, as each is held once more in the JVM."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) if isinstance(v, bytes) else 8 * len(v) if isinstance(v, list) else 8 for v in row)
        if size >= SENT_BYTES:
            yield _rows(held, schema)
            held, size = [], 0
    if held:
        yield _rows(held, schema)


def _send_batch(number: int, names: list, digests: list[bytes], sets: list[np.ndarray], shift: int) -> Iterator[tuple]:
    """One row for each range with shingles of the batch, and one that lists its documents."""
    sizes = np.array([len(b) for b in sets], np.int64)
    flat = np.concatenate(sets)
    del sets
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)[order]
    first = np.ones(len(flat), bool)
    first[1:] = flat[1:] != flat[:-1]
    runs = np.diff(np.flatnonzero(first), append=len(flat)).astype(np.int32)
    often = np.repeat(runs >= OFTEN, runs)
    keep = ~often | first
    times = np.where(often, np.repeat(runs, runs), np.int32(1))[keep]
    sent, owners = flat[keep], np.where(often, NOBODY, owner)[keep].astype("<u2")
    ranges = 1 << (64 - shift)
    cuts = np.append(np.searchsorted(sent, np.arange(ranges, dtype=np.uint64) << np.uint64(shift)), len(sent))
    listing = (names, b"".join(digests), sizes.astype("<u4").tobytes(), flat[often].astype("<u8").tobytes(), owner[often].astype("<u2").tobytes())
    del flat, owner, order, first, often, keep
    for r, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if b > a:
            yield r, number, *_packed(sent[a:b]), owners[a:b].tobytes(), _planes(times[a:b]), *[None] * 5
    yield number % ranges, number, None, None, None, None, *listing


def _totals(places: list[np.ndarray], times: list[np.ndarray]) -> list[np.ndarray]:
    """How often each shingle of the sorted lists stands in all of them, a slice of their values at a time."""
    out = [np.zeros(len(p), np.int64) for p in places]
    size = sum(map(len, places))
    # Hashes are spread evenly, so slices of equal width have about equal sizes.
    slices = size // SLICE_SHINGLES + 1
    low, high = min(int(p[0]) for p in places), max(int(p[-1]) for p in places)
    ends = np.array([low + (high - low) * k // slices for k in range(1, slices)], np.uint64)
    cuts = [np.concatenate([[0], np.searchsorted(p, ends), [len(p)]]) for p in places]
    for k in range(len(ends) + 1):
        parts = [slice(int(c[k]), int(c[k + 1])) for c in cuts]
        # A shingle stands several times in a batch, once for each owner.
        _, which = np.unique(np.concatenate([p[s] for p, s in zip(places, parts)]), return_inverse=True)
        if not len(which):
            continue
        total = np.bincount(which, weights=np.concatenate([t[s] for t, s in zip(times, parts)]))[which].astype(np.int64)
        for o, s, found in zip(out, parts, np.split(total, np.cumsum([s.stop - s.start for s in parts])[:-1])):
            o[s] = found
    return out


def _answer_range(rows: list[tuple]) -> Iterator[tuple]:
    """The counts of a range's shared shingles for each batch; listings go on as they are."""
    sent = [r for r in rows if r[1] is not None]
    places = [_unpacked(r[1], r[2]) for r in sent]
    counts = iter(zip(places, _totals(places, [_from_planes(r[4]) for r in sent]))) if sent else iter(())
    for number, first, _, owners, _, *listing in rows:
        if first is None:
            yield 0, number, None, None, None, None, *listing
            continue
        place, count = next(counts)
        shared = count > 1
        if shared.any():
            own = np.frombuffer(owners, "<u2")[shared]
            yield 0, number, *_packed(place[shared]), own.tobytes(), _planes(count[shared]), *[None] * 5


def _batch_prefixes(rows: list[tuple], percent: int) -> list[tuple]:
    """(doc_id, class, n, alone, prefix) of a batch's documents from all answers to it."""
    listing = next(r for r in rows if r[1] is None)
    ids, classes, sizes, often, often_owners = listing[5:]
    answers = [r for r in rows if r[1] is not None]
    token = np.concatenate([np.zeros(0, np.uint64), *[_unpacked(r[1], r[2]) for r in answers]])
    owner = np.concatenate([np.zeros(0, "<u2"), *[np.frombuffer(r[3], "<u2") for r in answers]]).astype(np.int64)
    count = np.concatenate([np.zeros(0, "<u8"), *[_from_planes(r[4]) for r in answers]]).astype(np.int64)
    common = owner == NOBODY
    known, known_count = token[common], count[common]
    order = np.argsort(known)
    held, held_owner = np.frombuffer(often, "<u8"), np.frombuffer(often_owners, "<u2").astype(np.int64)
    held_count = known_count[order][np.searchsorted(known[order], held)] if len(held) else np.zeros(0, np.int64)
    token = np.concatenate([token[~common], held])
    owner = np.concatenate([owner[~common], held_owner])
    count = np.concatenate([count[~common], held_count])
    order = np.lexsort((token, count, owner))
    token, ends = token[order].view(np.int64), np.searchsorted(owner[order], np.arange(len(ids) + 1))
    out = []
    for k, (name, n) in enumerate(zip(ids, np.frombuffer(sizes, "<u4").tolist())):
        a, b = int(ends[k]), int(ends[k + 1])
        alone = n - (b - a)
        reach = max(0, prefix_length(n, percent) - alone)
        out.append((name, classes[16 * k:16 * k + 16], n, alone, token[a:min(b, a + reach)].tolist()))
    return out


def range_bits(docs: DataFrame) -> int:
    """Bits that number the ranges: some for each partition, more for more text, at two bytes a shingle or more."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = max(shuffle_parts(docs.sparkSession) * 4, size // 2 // RANGE_SHINGLES)
    return max(4, min(wanted.bit_length(), (BATCH_TOKENS // 32).bit_length() - 1))


def document_prefixes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, class, n, alone, prefix) of all documents, stored.

    ``alone`` shingles stand before the prefix and are in no other document.
    """
    parts = shuffle_parts(docs.sparkSession)
    shift = 64 - range_bits(docs)
    result = pa.schema([("doc_id", pa.int64()), ("class", pa.binary()), ("n", pa.int64()), ("alone", pa.int64()), ("prefix", pa.list_(pa.int64()))])

    @tidy
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, 0
        names, digests, sets = [], [], []
        for batch in batches:
            for name, tokens in _sets(batch, size):
                names.append(name)
                digests.append(_digest(tokens))
                sets.append(tokens)
                held += len(tokens)
                if held >= BATCH_TOKENS or len(names) >= BATCH_DOCUMENTS:
                    rows = _send_batch(number, names, digests, sets, shift)
                    number, held = number + 1, 0
                    names, digests, sets = [], [], []
                    yield from _short(rows, _SENT)
        if names:
            rows = _send_batch(number, names, digests, sets, shift)
            del names, digests, sets
            yield from _short(rows, _SENT)

    @tidy
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, _SENT.names):
            yield from _short(_answer_range(rows), _SENT)

    @tidy
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, _SENT.names[1:]):
            yield from _short(_batch_prefixes([(None, *r) for r in rows], percent), result)

    read = docs.select(F.col("doc_id").cast("bigint"), "text")
    sent = read.mapInArrow(send, _SENT_DDL).repartition(parts, "range").sortWithinPartitions("range")
    answered = sent.mapInArrow(answer, _SENT_DDL).repartition(parts, "batch").sortWithinPartitions("batch")
    return stored(answered.mapInArrow(merge, "doc_id bigint, class binary, n bigint, alone bigint, prefix array<bigint>"), "prefixes")


def _grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[object, list[tuple]]]:
    """(value, rows of the other columns) of each run of equal values in the first column."""
    at, rows = None, []
    for batch in batches:
        for value, *row in zip(*(batch.column(c).to_pylist() for c in names)):
            if value != at:
                if at is not None:
                    yield at, rows
                at, rows = value, []
            rows.append(tuple(row))
    if at is not None:
        yield at, rows


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(node, label) for all nodes of (a, b) edges; the label is the smallest node reachable.

    Each round takes the smallest label of the neighbours, hands it to the node that the old label
    names as well, so that whole trees are hooked on, and then takes the label's own label.  Rounds
    go on until nothing moves; in chains of shuffled nodes their number grows with the logarithm.
    ``most`` is a number that the edges do not exceed, where one is known.
    """
    # One pass: the edges may be what a long task makes.
    ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("way")
    both = stored(edges.select(ways).select("way.*").distinct(), "edges", None if most is None else files_for(2 * most))
    # There are no more nodes than edges in both directions.
    files = files_for(both.count())
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels", files)
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("_a")).agg(F.min("label").alias("_near"))
        next_ = labels.join(near, F.col("node") == F.col("_a")).select(
            "node", F.col("label").alias("_old"), F.least("label", "_near").alias("_new"))
        # Of all that name a node as their label, the least new label, where it is below the node.
        hooks = next_.where(F.col("_new") < F.col("_old")).groupBy(F.col("_old").alias("_root")).agg(F.min("_new").alias("_hook"))
        hooked = next_.join(hooks, F.col("node") == F.col("_root"), "left").select(
            "node", "_old", F.least("_new", "_hook").alias("_new"))
        own = labels.select(F.col("node").alias("_of"), F.col("label").alias("_short"))
        moved = stored(
            hooked.join(own, F.col("_new") == F.col("_of")).select(
                "node", F.least("_new", "_short").alias("label"), (F.least("_new", "_short") != F.col("_old")).alias("_moved")),
            "labels", files)
        labels = moved.select("node", "label")
        if moved.where("_moved").isEmpty():
            return labels


def clusters(classes: DataFrame) -> DataFrame:
    """(class, cluster, chunk, chunks) of the classes that share a prefix shingle with another one."""
    spark = classes.sparkSession
    tokens = classes.select("class", F.explode("prefix").alias("token"))
    files = files_for(classes.agg(F.sum(F.size("prefix"))).first()[0] or 0)
    common = stored(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("token"), "common", files)
    postings = stored(tokens.join(maybe_broadcast(common, common.count(), 64), "token", "left_semi"), "postings", files)
    heads = postings.groupBy("token").agg(F.min("class").alias("a"))
    links = postings.join(heads, "token").where(F.col("class") != F.col("a")).select("a", F.col("class").alias("b")).distinct()
    found = components(links, postings.count()).join(classes.select(F.col("class").alias("node"), "n"), "node")
    wanted = F.greatest(F.count(F.lit(1)) / F.lit(CHUNK), F.sum("n") / F.lit(CHUNK_SHINGLES))
    sizes = found.groupBy("label").agg(F.ceil(wanted).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    return found.join(sizes, "label").select(
        F.col("node").alias("class"), F.col("label").alias("cluster"), chunk.alias("chunk"), "chunks")


def candidate_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(class, tokens) of the wanted (doc_id, class) rows, stored."""
    side = maybe_broadcast(wanted.select(F.col("doc_id").alias("_doc_id")).distinct(), wanted.count(), 64)
    texts = docs.select(F.col("doc_id").cast("bigint"), "text").join(
        side, F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left_semi")

    @tidy
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(_digest(t), t.astype("<u8").tobytes()) for _, t in _sets(batch, size)]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], ["class", "tokens"])

    return texts.mapInArrow(sets, "class binary, tokens binary").dropDuplicates(["class"])


def _suffix_counts(tokens: np.ndarray) -> np.ndarray:
    return np.bincount((tokens >> np.uint64(64 - SUFFIX_BITS)).astype(np.int64), minlength=1 << SUFFIX_BITS)


def _linked(shared: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (a + b - shared)


def _positional_bounds(prefixes: list[np.ndarray], rest: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The most that each pair can share, from the first prefix shingle they share; 0 where they share none.

    ``rest`` has the sizes without the shingles that one document has alone.  Both places grow along
    the common order, so the first shared shingle is the one that leaves most.
    """
    sizes = [len(p) for p in prefixes]
    token, owner = np.concatenate(prefixes), np.repeat(np.arange(len(prefixes)), sizes)
    after = rest[owner] - np.concatenate([np.arange(n) for n in sizes])
    order = np.argsort(token, kind="stable")
    token, owner, after = token[order], owner[order], after[order]
    at = np.full((2, len(prefixes)), -1)
    at[0, left], at[1, right] = np.arange(len(left)), np.arange(len(right))
    bounds = np.zeros((len(left), len(right)), np.int64)
    starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, int)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(token)]):
        if b - a > 1:
            rows, columns = at[0, owner[a:b]], at[1, owner[a:b]]
            r, c = rows >= 0, columns >= 0
            pairs = np.ix_(rows[r], columns[c])
            bounds[pairs] = np.maximum(bounds[pairs], np.minimum(after[a:b][r][:, None], after[a:b][c][None, :]))
    return bounds


def _candidates(
    sets: list[np.ndarray], prefixes: list[np.ndarray], alone: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int,
) -> np.ndarray:
    """Pairs that the length, the positional and the suffix filter leave; each pair of one side once."""
    size = np.array([len(s) for s in sets], np.int64)
    a, b = size[left][:, None], size[right][None, :]
    ok = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
    ok &= _linked(_positional_bounds(prefixes, size - alone, left, right), a, b, percent)
    if left is right:
        ok &= np.triu(ok, 1)
    if ok.any():
        counts = np.stack([_suffix_counts(s) for s in sets])
        most = np.zeros(ok.shape, np.int64)
        for k in range(1 << SUFFIX_BITS):
            most += np.minimum(counts[left, k][:, None], counts[right, k][None, :])
        ok &= _linked(most, a, b, percent)
    return ok


def _few_links(sets: list[np.ndarray], pairs: list[tuple[int, int]], percent: int) -> Iterator[tuple[int, int]]:
    for i, j in pairs:
        if _linked(len(np.intersect1d(sets[i], sets[j], assume_unique=True)), len(sets[i]), len(sets[j]), percent):
            yield i, j


def _many_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, ok: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """The candidates that link: overlaps as products of presence matrices, in slices."""
    size = np.array([len(s) for s in sets], np.int64)
    used = np.unique(np.concatenate([left, right]))
    owner = np.repeat(used, size[used])
    _, column, times = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True, return_counts=True)
    # Shingles of one class alone are in no overlap.
    rank = np.cumsum(times > 1) - 1
    use = times[column] > 1
    owner, column = owner[use], rank[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    place = np.full(len(sets), -1)
    shared = np.zeros((len(left), len(right)), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, width, DENSE_COLUMNS):
        a, b = np.searchsorted(column, [start, start + DENSE_COLUMNS])
        sides = []
        for rows in (left, right):
            place[:] = -1
            place[rows] = np.arange(len(rows))
            own = place[owner[a:b]]
            matrix = np.zeros((len(rows), min(DENSE_COLUMNS, width - start)), np.float32)
            matrix[own[own >= 0], column[a:b][own >= 0] - start] = 1
            sides.append(matrix)
        shared += sides[0] @ sides[1].T
    ok &= _linked(shared.astype(np.int64), size[left][:, None], size[right][None, :], percent)
    for i, j in zip(*(x.tolist() for x in np.nonzero(ok))):
        yield int(left[i]), int(right[j])


def links_of(
    sets: list[np.ndarray], prefixes: list[np.ndarray], alone: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int,
) -> Iterator[tuple[int, int]]:
    """All links between two sides of a block (or inside one): filters first, then exact overlaps of what they leave."""
    ok = _candidates(sets, prefixes, alone, left, right, percent)
    rows, columns = ok.any(axis=1), ok.any(axis=0)
    if ok.sum() <= FEW:
        return _few_links(sets, [(int(left[i]), int(right[j])) for i, j in zip(*np.nonzero(ok))], percent)
    return _many_links(sets, left[rows], right[columns], ok[np.ix_(rows, columns)], percent)


def block_links(blocks: DataFrame, percent: int) -> DataFrame:
    """(a, b) links inside blocks of (block, side, class, alone, prefix, tokens), a forest of each block."""

    def forest(rows: list[tuple[int, bytes, int, list[int], bytes]], same: bool) -> list[tuple[bytes, bytes]]:
        sides, names, alone, prefixes, tokens = zip(*rows)
        sets = [np.frombuffer(t, "<u8") for t in tokens]
        left = np.flatnonzero(np.array(sides) == 0)
        right = left if same else np.flatnonzero(np.array(sides) == 1)
        root = list(range(len(rows)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for i, j in links_of(sets, [np.array(p, np.int64) for p in prefixes], np.array(alone), left, right, percent):
            a, b = find(i), find(j)
            if a != b:
                root[b] = a
                out.append((names[i], names[j]))
        return out

    @tidy
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _grouped(batches, ["block", "side", "class", "alone", "prefix", "tokens"]):
            found = forest(rows, block["i"] == block["j"])
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], ["a", "b"])

    parts = shuffle_parts(blocks.sparkSession)
    dealt = blocks.repartition(parts, "block").sortWithinPartitions("block", "side")
    return dealt.mapInArrow(links, "a binary, b binary")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    short_batches(docs.sparkSession)
    members = document_prefixes(docs, size, percent)
    classes = stored(
        members.where("n > 0").groupBy("class").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("alone").alias("alone"), F.first("prefix").alias("prefix")), "classes")
    files = files_for(classes.count())
    dealt = stored(clusters(classes), "dealt", files)
    wanted = dealt.join(classes.select("class", "doc_id"), "class").select("doc_id", "class")
    sets = candidate_sets(docs, stored(wanted, "wanted", files), size)
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    filled = dealt.join(sets, "class").join(classes.select("class", "alone", "prefix"), "class")
    blocks = filled.select("*", other).select(
        F.struct("cluster", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")).alias("block"),
        F.when(F.col("chunk") <= F.col("other"), 0).otherwise(1).alias("side"), "class", "alone", "prefix", "tokens")
    # A block's forest has fewer links than the block has classes.
    most = dealt.agg(F.sum("chunks")).first()[0] or 0
    labels = components(block_links(blocks, percent), most)
    ids = labels.join(classes.select("class", "doc_id"), F.col("node") == F.col("class"))
    least = ids.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    joined = ids.join(least, "label").select("class", "component_id")
    owner = classes.select("class", "doc_id").join(joined, "class", "left").select(
        F.col("class").alias("_class"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return members.select("doc_id", "class", "n").join(owner, F.col("class") == F.col("_class"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of near copies of every document."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
