"""Run registered queries beside their SQL and compare rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def _rows(columns: list[str], rows) -> list[tuple]:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in at) for r in rows), key=repr)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), _rows(columns, cursor.fetchall())


def difference(df: DataFrame, con, sql: str) -> str | None:
    """None when equal and not empty, else what differs first."""
    (names, got), (sql_names, want) = spark_rows(df), sql_rows(con, sql)
    if not want:
        return "no rows to compare"
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if repr(g) != repr(w):
            return f"row {g} != {w}"
    return None


def main(sf_dir: str, only: list[str]) -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from jobtide.operators.lookup import release
    from jobtide.session import open_session

    spark = open_session(
        "checks", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            df = fn(spark, sf_dir)
            problem = difference(df, con, ORACLE[name]) if name in ORACLE else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        release()
        bad += problem is not None
        print(f"{name:28s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
