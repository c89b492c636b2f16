"""Column naming, contracts and whole-row rewrites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.schema import CLEANED_COLUMNS, EXPECTED_COLUMNS, RAW_SCHEMA


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def missing_columns(df: DataFrame, expected: list[str] = EXPECTED_COLUMNS) -> list[str]:
    """Expected names ``df`` lacks, in contract order.  Reads the schema only."""
    have = set(df.columns)
    return [c for c in expected if c not in have]


def project_contract(
    df: DataFrame,
    expected: list[str] = EXPECTED_COLUMNS,
    on_missing: str = "error",
) -> DataFrame:
    """Keep exactly ``expected``, in that order.

    A missing column fails before any job runs; ``on_missing="null"`` fills it instead,
    with the contract's type where there is one.
    """
    missing = missing_columns(df, expected)
    if missing and on_missing == "error":
        raise ValueError(f"expected columns missing in source data: {missing}")
    types = {f.name.upper(): f.dataType for f in RAW_SCHEMA.fields}
    fill = {c: F.lit(None).cast(types.get(c, T.StringType())).alias(c) for c in missing}
    return df.select(*[fill.get(c, F.col(f"`{c}`")) for c in expected])


def relevant_columns(df: DataFrame) -> DataFrame:
    return df.select(*CLEANED_COLUMNS)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty text to null in every text column; blanks stay as they are."""
    return df.select(*[
        F.nullif(F.col(f.name), F.lit("")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def display_names(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns in the order of ``names``, renamed to its values."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def same_layout(df: DataFrame, target: DataFrame) -> bool:
    """Same column names in the same order."""
    return df.columns == target.columns


def align_to(df: DataFrame, target: DataFrame) -> DataFrame:
    """``df`` in the column order and types of ``target``; both must name the same columns."""
    if set(df.columns) != set(target.columns):
        lacking = sorted(set(target.columns) - set(df.columns))
        extra = sorted(set(df.columns) - set(target.columns))
        raise ValueError(f"batch does not match the target: lacks {lacking}, extra {extra}")
    aligned = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    assert same_layout(aligned, target)
    return aligned
