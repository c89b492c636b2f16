"""Token files of directly addressable codes.

An id is split into chunks of 8 bits.  All first chunks stand in level 0, the second chunks
of the ids that have one in level 1, and so on; a bitmap beside each level tells which ids go
on, and a rank directory holds the number of set bits before every 512.  Any id, or any run of
ids, is read by following ranks from level to level, without decoding what stands before it.

Documents are dealt over ranges of doc_id and sorted in each, and every task writes files of
about ``FILE_IDS`` ids in that order, whole documents each.  A file is a row of a Parquet
table in shared storage: the ids of its documents, where each ends, the number of ids the task
wrote before it, and the coded ids.  Offsets over the whole corpus need one number per task.

Null text is empty text: only the end id.  Rows with equal doc_ids stay apart, in the order of
their text's hash; null doc_ids come first.  An empty table gives no files and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import short_batches, stored, table, tidy
from jobtide.llm.tokens import default_tokenizer, encoder

MAGIC, BLOCK_BITS, FILE_IDS, END_ID = b"DAC1", 512, 1 << 18, 2

FILE_SCHEMA = "part int, seq long, before long, n_ids long, doc_ids array<bigint>, ends array<bigint>, payload binary"


def encode_ids(ids: np.ndarray) -> bytes:
    """The coded form of a run of unsigned 32-bit ids."""
    rest, sizes, parts = ids.astype(np.uint32), [], []
    while True:
        goes_on = rest > 0xFF
        bits = np.packbits(goes_on, bitorder="little")
        blocks = np.add.reduceat(goes_on, np.arange(0, len(rest), BLOCK_BITS), dtype=np.uint64) if len(rest) else np.zeros(0, np.uint64)
        before = np.concatenate([[0], np.cumsum(blocks)[:-1]]) if len(blocks) else blocks
        sizes.append(len(rest))
        parts += [rest.astype(np.uint8).tobytes(), bits.tobytes(), before.astype("<u8").tobytes()]
        rest = rest[goes_on] >> np.uint32(8)
        if not len(rest):
            break
    return MAGIC + np.array([len(sizes), *sizes], "<u8").tobytes() + b"".join(parts)


class CodedIds:
    """Random access to coded ids."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token file")
        levels = int(np.frombuffer(data, "<u8", 1, 4)[0])
        sizes = np.frombuffer(data, "<u8", levels, 12).astype(np.int64)
        at, self._levels = 12 + 8 * levels, []
        for n in sizes.tolist():
            n_bits, n_blocks = -(-n // 8), -(-n // BLOCK_BITS)
            chunks = np.frombuffer(data, np.uint8, n, at)
            bits = np.frombuffer(data, np.uint8, n_bits, at + n)
            ranks = np.frombuffer(data, "<u8", n_blocks, at + n + n_bits)
            self._levels.append((chunks, bits, ranks))
            at += n + n_bits + 8 * n_blocks

    def __len__(self) -> int:
        return len(self._levels[0][0])

    def __getitem__(self, i: int) -> int:
        return int(self.run(i, i + 1)[0])

    def run(self, start: int, stop: int) -> np.ndarray:
        """Ids from start to stop, read on each level from the rank of the first one."""
        return self._read(0, start, stop)

    def _read(self, level: int, start: int, stop: int) -> np.ndarray:
        chunks, bits, ranks = self._levels[level]
        out = chunks[start:stop].astype(np.uint32)
        if stop <= start:
            return out
        block = start // BLOCK_BITS
        first = block * BLOCK_BITS
        seen = np.unpackbits(bits[first // 8:-(-stop // 8)], bitorder="little")[:stop - first]
        goes_on = seen[start - first:].astype(bool)
        if goes_on.any():
            rank = int(ranks[block]) + int(seen[:start - first].sum())
            out[goes_on] |= self._read(level + 1, rank, rank + int(goes_on.sum())) << np.uint32(8)
        return out


def write_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Token files of all documents by ascending doc_id, stored."""

    @partial(tidy, uses="encoder")
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        runs: list[np.ndarray] = []
        size = 0

        def file() -> pa.RecordBatch:
            ids = np.concatenate(runs)
            ends = np.cumsum([len(r) for r in runs]).tolist()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([before], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([names], pa.list_(pa.int64())),
                 pa.array([ends], pa.list_(pa.int64())), pa.array([encode_ids(ids)], pa.binary())],
                ["part", "seq", "before", "n_ids", "doc_ids", "ends", "payload"])

        for batch in batches:
            found = encoder(tokenizer).encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), found):
                names.append(doc_id)
                runs.append(np.append(ids, np.uint32(end_id)))
                size += len(ids) + 1
                if size >= file_ids:
                    yield file()
                    seq, before = seq + 1, before + size
                    names, runs, size = [], [], 0
        if runs:
            yield file()

    short_batches(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return stored(ordered.mapInArrow(coded, FILE_SCHEMA), "token-files")


def read_documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    per_task = files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    shift, total = {}, 0
    for row in sorted(per_task, key=lambda r: r["part"]):
        shift[row["part"]] = total
        total += row["n"]

    @tidy
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                coded, base = CodedIds(file["payload"]), shift[file["part"]] + file["before"]
                ends = file["ends"]
                starts = [0, *ends[:-1]]
                # All documents of the file are wanted: one run, cut at their ends.
                ids = coded.run(0, len(coded)).astype("<u4").tobytes()
                sums = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file["doc_ids"], pa.int64()), pa.array([base + a for a in starts], pa.int64()),
                     pa.array([b - a for a, b in zip(starts, ends)], pa.int64()), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("part", "before", "doc_ids", "ends", "payload").mapInArrow(
        decoded, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of every document to token files and read them back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return read_documents(write_files(docs, default_tokenizer()))
