"""Landed search pages: JSON files, one directory per searched title."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.schema import RAW_SCHEMA

CORRUPT = "_corrupt_record"
FILE = "_landed_file"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def text_schema(schema: T.StructType) -> T.StructType:
    """The same names, every field as the text it landed as; lists and objects stay JSON text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def _typed(c: Column, kind: T.DataType) -> Column:
    """Landed text as ``kind``; what cannot be read as it becomes null."""
    if isinstance(kind, T.StringType):
        return c
    if not isinstance(kind, T.ArrayType):
        return c.try_cast(kind)
    text = F.trim(c)
    listed = F.from_json(text, kind)
    if isinstance(kind.elementType, T.StructType):
        # A list of one may land as the object itself.
        alone = F.when(F.startswith(text, F.lit("{")), F.array(F.from_json(text, kind.elementType)))
    else:
        alone = F.when(c.isNotNull(), F.array(c.try_cast(kind.elementType)))
    return F.when(F.startswith(text, F.lit("[")), listed).otherwise(alone)


def conform(landed: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Landed text columns to the declared types, field by field.

    A field of another type than declared costs that field at most, never the record: a
    plain value where a list is declared becomes a list of one, anything unreadable null.
    """
    typed = {f.name: _typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields}
    return landed.select(*[typed.get(c, F.col(f"`{c}`")) for c in landed.columns])


def landed_lines(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The text under ``path``: a row per line, or per file with ``multi_line``.

    Directories ``job_category=<title>`` add the title; the file is told beside the text.
    """
    return spark.read.text(path, wholetext=multi_line).withColumn(FILE, F.input_file_name())


def file_lines(spark: SparkSession, files: Sequence[str], schema: T.StructType, base: str, multi_line: bool = False) -> DataFrame:
    """The text of some ``files`` under ``base``, as :func:`landed_lines` gives it.

    ``schema`` is that of the whole folder, so that a title is of one type whatever files are read.
    Names are taken as they are, not as patterns.
    """
    if not files:
        return spark.createDataFrame([], schema).withColumn(FILE, F.input_file_name())
    reader = spark.read.schema(schema).option("basePath", base).option("__globPaths__", "false")
    return reader.text(list(files), wholetext=multi_line).withColumn(FILE, F.input_file_name())


def dealt_lines(lines: DataFrame, tasks: int) -> DataFrame:
    """Landed text dealt over ``tasks`` by the place of each line, so that copies are spread, too.

    For few files: a compressed one is read by a single task, and parsing costs far more than reading.
    """
    return lines.repartition(tasks, F.monotonically_increasing_id())


def parse_landed(
    lines: DataFrame, schema: T.StructType = RAW_SCHEMA, record: str | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Lines or whole files as one row per record, every declared field as text.

    The columns are declared, never inferred.  A text that is a JSON array gives a row for each of
    its elements; blank ones give none.  A text that is no JSON becomes a row with only the
    corrupt-text column set.  ``record`` names a column that keeps the text of the record,
    ``keep`` columns of the lines that every record of theirs keeps.
    """
    tagged = "job_category" in lines.columns
    fields = text_schema(T.StructType([f for f in schema.fields if not (tagged and f.name == "job_category")]))
    listed = F.from_json("value", T.ArrayType(T.StringType()))
    each = F.when(F.startswith(F.ltrim("value"), F.lit("[")) & listed.isNotNull(), listed).otherwise(F.array("value"))
    kept = [*(["job_category"] if tagged else []), *keep]
    records = lines.select(*kept, F.explode(each).alias("_record")).where(F.trim("_record") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = records.withColumn("_parsed", F.from_json("_record", with_corrupt_column(fields), options))
    columns = {f.name: F.col(f"_parsed.`{f.name}`") for f in fields.fields}
    if tagged:
        columns["job_category"] = F.col("job_category").cast("string")
    corrupt = F.coalesce(f"_parsed.{CORRUPT}", F.when(F.col("_parsed").isNull(), F.col("_record")))
    return parsed.select(
        *[columns[f.name].alias(f.name) for f in schema.fields], corrupt.alias(CORRUPT),
        *([F.col("_record").alias(record)] if record else []), *keep)


def read_landed(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    multi_line: bool = False,
) -> DataFrame:
    """Records under ``path`` as text columns, see :func:`parse_landed`.

    One record per line keeps large files splittable; ``multi_line`` reads pages that are one
    JSON array each, a file in one task.
    """
    return parse_landed(landed_lines(spark, path, multi_line), schema)


def absent_keys(record: Column, names: list[str]) -> Column:
    """The ``names`` that are no key of a record, as bits in their order; null for what is no object.

    The bitwise AND over records has the names that none of them has.
    """
    listed = F.array(*[F.lit(n) for n in names])
    bit = lambda name: F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.array_position(listed, name) - 1).cast("int"))
    missing = F.array_except(listed, F.json_object_keys(record))
    return F.aggregate(missing, F.lit(0).cast("bigint"), lambda mask, name: mask.bitwiseOR(bit(name)))


def unread_keys(record: Column, names: list[str]) -> Column:
    """The ``names`` whose parsed columns are null in a record, as bits in their order.

    A value that was read is proof of its key, and asking for it costs no second parse of the text, as
    :func:`absent_keys` does.  A null is no proof of absence: the key may be there with a null.  Null for
    what does not begin as an object.
    """
    bits = [F.when(F.col(f"`{name}`").isNull(), F.lit(1 << place)).otherwise(F.lit(0)).cast("bigint")
            for place, name in enumerate(names)]
    return F.when(F.startswith(F.ltrim(record), F.lit("{")), reduce(Column.bitwiseOR, bits))


def names_of(mask: int, names: list[str]) -> list[str]:
    return [name for place, name in enumerate(names) if mask >> place & 1]


def read_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    multi_line: bool = False,
) -> DataFrame:
    """:func:`read_landed` with the declared types."""
    return conform(read_landed(spark, path, schema, multi_line), schema)


def parse_json_text(df: DataFrame, column: str, schema: T.StructType, into: str) -> DataFrame:
    """Parse a JSON text column into a struct that also carries the corrupt text."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.withColumn(into, F.from_json(column, with_corrupt_column(schema), options))


def is_rejected(column: str = CORRUPT) -> Column:
    return F.col(column).isNotNull()


def split_rejects(df: DataFrame, column: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)``; good rows lose the corrupt-text column when it is top level."""
    return df.where(~is_rejected(column)).drop(column), df.where(is_rejected(column))


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested objects to ``parent.child`` columns at any depth; arrays stay as they are."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        found = []
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType, here)
            else:
                source = ".".join(f"`{p}`" for p in here)
                found.append(F.col(source).alias(sep.join(here)))
        return found

    return df.select(*leaves(df.schema, ()))


def tag_title(df: DataFrame, title: str) -> DataFrame:
    return df.withColumn("job_category", F.lit(title))


def union_pages(pages: list[DataFrame]) -> DataFrame:
    """All rows of all pages (no de-duplication) over the union of their columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)
