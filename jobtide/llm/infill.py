"""Fill-in-the-middle texts by rotating blocks in place.

A text is cut at two token bounds into prefix, middle and suffix (a token is a run of A-Z and a-z or
any other single character).  Its UTF-8 bytes are scanned for token starts; a bytearray takes them
with a mark before each segment, and neighbouring blocks change places by three reversals:
reverse both, then the whole.  ``psm`` exchanges middle and suffix, ``spm`` brings the suffix to
the front.  The same rotation the other way round restores the text exactly, from output and
form alone.

Cuts and form follow from the hash of seed and doc_id.  A text that is empty or holds a mark stays
``plain``.  Null text is empty.  A null doc_id hashes as no digits, so such rows are cut by the same
numbers.  Rows that repeat are each transformed, to the same output.  Texts of any length are
transformed whole, one at a time, in a few times their bytes.  Other columns are kept; the added
ones are named by the caller (see ``into``), so that none clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import short_batches, table, tidy

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, TRANSFORMED, SUFFIX_FIRST = 1, 90, 20
FORMS = "n long, form string, prefix_chars long, middle_chars long, output string"


def draws(seed: int, doc_id: object) -> list[int]:
    """Four numbers of 32 bits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def reverse(buffer: bytearray, start: int, end: int) -> None:
    view = np.frombuffer(buffer, np.uint8)
    half = (end - start) // 2
    left, right = view[start:start + half], view[end - half:end][::-1]
    kept = left.copy()
    left[:] = right
    right[:] = kept


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange the blocks ``start:middle`` and ``middle:end``."""
    reverse(buffer, start, middle)
    reverse(buffer, middle, end)
    reverse(buffer, start, end)


def token_starts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(byte places where a token starts, for every byte whether a character starts there)."""
    raw = np.frombuffer(data, np.uint8)
    lower = raw | 0x20
    letter = (lower >= ord("a")) & (lower <= ord("z"))
    first = (raw & 0xC0) != 0x80
    inside = np.zeros(len(raw), bool)
    inside[1:] = letter[1:] & letter[:-1]
    return np.flatnonzero(first & ~inside), first


def transform(
    text: str | None, doc_id: object, seed: int = SEED, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST,
) -> tuple[int, str, int | None, int | None, str]:
    """(tokens, form, characters of prefix and middle, output)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    starts, first = token_starts(data)
    n = len(starts)
    one, two, kind, order = draws(seed, doc_id)
    if not data or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)) or kind % 100 >= transformed:
        return n, "plain", None, None, text or ""
    bounds = np.append(starts, len(data))
    low, high = (int(bounds[k]) for k in sorted((one % (n + 1), two % (n + 1))))
    chars = int(first[:low].sum()), int(first[low:high].sum())
    buffer = bytearray(data)
    for at, mark in ((high, SUFFIX), (low, MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    middle, suffix = low + len(PREFIX), high + len(PREFIX) + len(MIDDLE)
    form = "spm" if order % 100 < suffix_first else "psm"
    rotate(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return n, form, *chars, buffer.decode("utf-8", "surrogatepass")


def restore_text(output: str | None, form: str | None) -> str:
    """The text that was transformed."""
    if form == "plain" or not output:
        return output or ""
    buffer = bytearray(output.encode("utf-8", "surrogatepass"))
    if form == "psm":
        start, cut = buffer.index(SUFFIX), buffer.index(MIDDLE)
    else:
        start, cut = 0, buffer.index(PREFIX)
    rotate(buffer, start, cut, len(buffer))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.index(mark)
        del buffer[at:at + len(mark)]
    return buffer.decode("utf-8", "surrogatepass")


def fill_in_middle(
    docs: DataFrame, into: str = "fim", seed: int = SEED, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """Adds a struct of tokens, form, characters of prefix and middle, and the output text.

    ``transformed`` of a hundred texts are cut, ``suffix_first`` of a hundred of these have the suffix first.
    """
    short_batches(docs.sparkSession)

    @F.pandas_udf(FORMS)
    @tidy
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, ids in batches:
            rows = [
                transform(t if isinstance(t, str) else None, i if isinstance(i, str) else None, seed, transformed, suffix_first)
                for t, i in zip(texts, ids)]
            out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return docs.withColumn(into, cut("text", F.col("doc_id").cast("string")))


def restored(output: Column, form: Column) -> Column:
    """The text of an output and its form."""

    @F.pandas_udf("string")
    @tidy
    def back(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for outputs, forms in batches:
            yield pd.Series([restore_text(o, f) for o, f in zip(outputs, forms)], dtype=object)

    return back(output, form)


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document transformed and restored."""
    cut = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
        F.sha2(F.col("fim.output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("fim.output"), F.col("fim.form")).cast("binary"), 256).alias("restored_sha256"))


def _draw(k: int) -> str:
    return f"('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), {8 * k + 1}, 8))::BIGINT"


SQL = rf"""
WITH cut AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
    {_draw(0)} AS h1, {_draw(1)} AS h2, {_draw(2)} AS h3, {_draw(3)} AS h4 FROM documents),
placed AS (SELECT *, len(t) AS n, least(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS low, greatest(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {TRANSFORMED}
      THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (SELECT doc_id, text, n, form, array_to_string(list_slice(t, 1, low), '') AS p,
    array_to_string(list_slice(t, low + 1, high), '') AS m, array_to_string(list_slice(t, high + 1, n), '') AS s FROM placed)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""
