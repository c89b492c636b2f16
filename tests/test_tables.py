"""Landing files and tables."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.schema import CLEANED_SCHEMA
from jobtide.sources import landing, tables

PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def test_flatten_keeps_arrays_and_names_parents(spark):
    df = spark.createDataFrame(
        [((1, ("x",)), [(2,)], "t")], "o struct<n:int,`in.ner`:struct<s:string>>, l array<struct<k:int>>, t string"
    )
    flat = landing.flatten_structs(df)
    assert flat.columns == ["o.n", "o.in.ner.s", "l", "t"]
    assert tuple(flat.first())[:2] == (1, "x")


def test_pages_of_arrays_and_broken_pages(spark, tmp_path):
    for name, text in {
        "one": json.dumps([{"a": 1, "b": "x"}, {"a": 2, "other": 3}]), "two": json.dumps([{"b": "y"}]),
        "bad": "<html>error</html>", "none": "[]",
    }.items():
        folder = tmp_path / "job_category=Data Engineer"
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.json").write_text(text)
    schema = T.StructType([*PAIR.fields, T.StructField("job_category", T.StringType())])
    raw = landing.read_raw(spark, str(tmp_path), schema, multi_line=True)
    good, bad = landing.split_rejects(raw.cache())
    assert sorted(map(tuple, good.select("a", "b", "job_category").collect()), key=repr) == [
        (1, "x", "Data Engineer"), (2, None, "Data Engineer"), (None, "y", "Data Engineer"),
    ]
    assert bad.count() == 1
    raw.unpersist()


def test_union_fills_and_keeps_duplicates(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "i int, s string")
    b = spark.createDataFrame([(2, True)], "i int, f boolean")
    assert rows(landing.union_pages([a, b, landing.tag_title(b, "t").select("i")])) == [
        (1, "x", None), (1, "x", None), (2, None, None), (2, None, True),
    ]


def test_append_needs_a_matching_existing_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("x", 1)], "b string, a long")
    with pytest.raises(ValueError, match="does not exist"):
        tables.append_table(df, path)
    assert not tables.table_exists(spark, path)
    tables.create_table(spark, path, PAIR)
    with pytest.raises(ValueError, match="already exists"):
        tables.create_table(spark, path, PAIR)
    tables.append_table(df, path)
    tables.append_table(df.withColumn("a", F.lit(2)), path)
    assert rows(tables.read_table(spark, path)) == [(1, "x"), (2, "x")]
    with pytest.raises(ValueError, match="lacks"):
        tables.append_table(df.select("a"), path)
    with pytest.raises(ValueError, match="extra"):
        tables.append_table(df.withColumn("c", F.lit(1)), path)
    assert tables.read_table(spark, path).count() == 2


def test_unreadable_target(spark, tmp_path):
    with pytest.raises(ValueError, match="cannot be read"):
        tables.append_table(spark.range(1), str(tmp_path))


def test_partitioned_append_splits_a_hot_day(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("d", T.DateType())])
    tables.create_table(spark, path, schema, ["d"])
    day = F.when(F.col("id") % 10 > 0, F.lit("2025-05-01")).otherwise(F.lit("2025-05-02")).cast("date")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        tables.append_table(spark.range(0, 40000, 1, 4).select(F.col("id").alias("n"), day.alias("d")), path, ["d"], schema)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    back = tables.read_table(spark, path, schema)
    assert back.count() == back.select("n").distinct().count() == 40000
    hot = [f for f in os.listdir(f"{path}/d=2025-05-01") if f.endswith(".parquet")]
    assert len(hot) > 1
    assert {str(r[0]) for r in back.select("d").distinct().collect()} == {"2025-05-01", "2025-05-02"}


def test_refresh_replaces_whole_table_and_survives_failure(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = tables.overwrite_table(spark.range(3), path)
    kept = first.persist()
    assert kept.count() == 3
    second = tables.overwrite_table(spark.range(5).withColumn("x", F.lit("y")), path)
    assert second.count() == 5 and tables.read_table(spark, path).columns == ["id", "x"]
    assert tables.read_table(spark, path).select("id").count() == 5
    kept.unpersist()
    failing = spark.range(5).withColumn("x", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        tables.overwrite_table(failing, path)
    assert tables.read_table(spark, path).count() == 5


def test_scratch_follows_the_session_setting(spark):
    assert tables.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_cached_block(spark):
    df = spark.range(10).withColumn("x", F.lit(1))
    with tables.cached(df) as held:
        assert held.count() == 10 and held.is_cached
    assert not held.is_cached


def test_cleaned_schema_reads_back_in_order(spark, tmp_path):
    path = str(tmp_path / "cleaned")
    tables.create_table(spark, path, CLEANED_SCHEMA)
    assert tables.read_table(spark, path).schema.names == CLEANED_SCHEMA.names


@pytest.mark.parametrize("step", ["parquet", "write_text", "rename_path", "after"])
def test_readers_find_the_old_table_or_the_new_one(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(3), path)
    rows = spark.range(9)

    def stop(*_):
        raise KeyboardInterrupt

    if step == "parquet":
        rows = rows.withColumn("id", F.raise_error(F.lit("no")).cast("long"))
    elif step == "after":  # stopped when the pointer stands, before anything is tidied up
        calls = iter([tables._pointers, stop])
        monkeypatch.setattr(tables, "_pointers", lambda *a: next(calls)(*a))
    else:
        monkeypatch.setattr(tables, step, stop)
    with pytest.raises(BaseException):
        tables.overwrite_table(rows, path)
    monkeypatch.undo()
    assert tables.read_table(spark, path).count() == (9 if step == "after" else 3)
    assert tables.overwrite_table(spark.range(5), path).count() == tables.read_table(spark, path).count() == 5
    tables.overwrite_table(spark.range(6), path)
    folders = [name for name in os.listdir(path) if name.startswith("version-")]
    assert len(folders) == 2 and len(tables.list_names(spark, f"{path}/_pointers")) == 1
    assert os.listdir(tmp_path) == ["t"]


def test_two_refreshes_at_once_are_an_error(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(3), path)
    before = tables.current_version(spark, path)
    tables.overwrite_table(spark.range(4), path)
    with pytest.raises(OSError, match="cannot move"):
        tables._write_version(spark.range(5), path, (), tables.Version(before.number, 0, before.folders), (), 0)
    assert tables.read_table(spark, path).count() == 4


def test_extended_tables_are_written_as_one_folder_now_and_then(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    monkeypatch.setattr(tables, "MOST_FOLDERS", 3)
    with pytest.raises(ValueError, match="never refreshed"):
        tables.extend_table(spark.range(1), path, 1)
    tables.overwrite_table(spark.range(2), path, upto=4)
    for k in range(5):
        tables.extend_table(spark.range(10 * k, 10 * k + 2), path, 5 + k)
        version = tables.current_version(spark, path)
        assert version.upto == 5 + k and len(version.folders) <= 3
    assert tables.read_table(spark, path).count() == 12


@pytest.mark.parametrize("partition_by", [(), ("d",)])
def test_bucketed_table(spark, tmp_path, rows, partition_by):
    path, schema = str(tmp_path / "b"), T.StructType.fromDDL("k string, v array<string>, d date")
    tables.create_table(spark, path, schema, partition_by, ("k", 3))
    with pytest.raises(ValueError, match="exists"):
        tables.create_table(spark, path, schema)
    assert tables.read_table(spark, path, schema).count() == 0
    df = spark.range(60).select(
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("k"), F.col("id") % 20)).alias("k"),
        F.array(F.lit("a")).alias("v"), F.lit("2025-05-01").cast("date").alias("d"))
    for _ in range(2):
        tables.append_table(df.select("d", "v", "k"), path, schema=schema)
    spark.sql(f"DROP TABLE {tables._registered(spark, path)}")  # as in another session
    back = tables.read_table(spark, path, schema)
    assert rows(back.select("k", "v", "d")) == rows(df.union(df))
    plan = back.groupBy("k", "d").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
