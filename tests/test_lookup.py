"""Lookup joins: both ways of joining give the same rows, with hot keys and nulls."""

import pytest
from pyspark.sql import functions as F

from jobtide.operators import copies, lookup
from jobtide.operators.aggregate import collapse, count_distinct_mart
from jobtide.operators.collapse import collapse_by_place

NEVER, ALWAYS = -1, 1 << 40


@pytest.fixture
def fact(spark):
    """A third of the rows share one key, another third has none."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit("hot")).when(n % 3 == 1, None).otherwise(F.concat(F.lit("k"), n % 500))
    return spark.range(6000).select(n, key.alias("k"))


@pytest.fixture
def side(spark):
    keys = spark.range(0, 400).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    extra = spark.createDataFrame([("hot",), ("unused",), (None,)], "k string")
    return keys.union(extra).withColumn("v", F.concat(F.lit("value of "), F.coalesce("k", F.lit("null"))))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_ways_agree(rows, fact, side, how, null_safe):
    small = lookup.lookup_join(fact, side, "k", how, null_safe, limit=ALWAYS)
    large = lookup.lookup_join(fact, side, "k", how, null_safe, limit=NEVER)
    assert small.columns == large.columns
    assert rows(small) == rows(large)
    if null_safe:
        expected = fact.join(side.withColumnRenamed("k", "k2"), F.col("k").eqNullSafe(F.col("k2")), how).drop("k2")
    else:
        expected = fact.join(side, "k", how).select(*small.columns)
    assert rows(small) == rows(expected)


def test_hot_keys_are_few_and_found(fact):
    hot = {r[0] for r in lookup.hot_keys(fact, "k").collect()}
    assert {"hot", None} <= hot
    assert len(hot) <= lookup.hot_share(fact)


def test_measure(spark):
    assert lookup.measure(spark.range(0).withColumn("t", F.lit("x")), 10)[1:] == (0, True)
    df = spark.range(10).withColumn("t", F.lit("x" * 100))
    assert not lookup.measure(df, 10 * 100).fits
    assert lookup.measure(df, 10 * 200)[1:] == (10, True)


@pytest.mark.parametrize("limit", [NEVER, ALWAYS])
def test_keep_new(spark, rows, limit):
    new = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c"), (None, "d")], "ID string, x string")
    old = spark.createDataFrame([("2",), ("2",), (None,), ("9",)], "ID string")
    assert rows(lookup.keep_new(new, old, limit=limit)) == [("1", "a"), ("1", "b")]
    without_null = old.where("ID IS NOT NULL")
    assert rows(lookup.keep_new(new, without_null, limit=limit)) == [("1", "a"), ("1", "b"), (None, "d")]
    assert len(rows(lookup.keep_new(new, old.limit(0), limit=limit))) == 4


@pytest.mark.parametrize("limit", [NEVER, ALWAYS])
def test_dictionary(spark, rows, limit):
    df = spark.createDataFrame(
        [(1, None, "Foo"), (2, "hola", "Foo"), (3, "Bar", "hola"), (4, "", "Qux")], "i int, a string, b string"
    )
    words = spark.createDataFrame([("hola", "hello"), ("Qux", "B"), ("Qux", "A"), ("", "x")], "value string, translated string")
    got = lookup.normalise_via_dictionary(df, ["a", "b"], words.where("value <> ''"), limit)
    assert got.columns == ["i", "a", "b"]
    assert rows(got) == [(1, "NA", "Foo"), (2, "hello", "Foo"), (3, "Bar", "hello"), (4, "NA", "B")]


@pytest.fixture
def postings(spark):
    """Mostly single rows; one posting has 300 copies that disagree, some have two."""
    n = F.col("id")
    single = spark.range(1000).select(F.concat(F.lit("p"), n).alias("ID"), (n % 3).alias("c"), F.concat(F.lit("s"), n % 7).alias("s"))
    hot = spark.range(300).select(F.lit("p1").alias("ID"), F.lit(1).cast("long").alias("c"), F.concat(F.lit("s"), n % 11).alias("s"))
    twice = single.where("c = 2 AND ID LIKE '%7'").withColumn("s", F.lit("s9"))
    empty = spark.createDataFrame([(None, 1, "s1"), (None, 1, "s2")], "ID string, c long, s string")
    return single.union(hot).union(twice).union(empty)


@pytest.mark.parametrize("limit", [NEVER, ALWAYS])
def test_split_keeps_copies_together(rows, postings, limit):
    alone, repeated = copies.split_copies(postings, ["ID", "c"], limit)
    assert rows(alone.union(repeated)) == rows(postings)
    keys = lambda df: {tuple(r) for r in df.select("ID", "c").collect()}
    assert not keys(alone) & keys(repeated)
    whole = rows(collapse(postings, ["ID", "c"], ["s"]))
    assert whole == rows(alone.union(collapse(repeated, ["ID", "c"], ["s"])))


def test_split_without_copies_or_with_many(spark, postings):
    unique = postings.dropDuplicates(["ID", "c"])
    alone, repeated = copies.split_copies(unique, ["ID", "c"])
    assert repeated is None and alone.count() == unique.count()
    assert copies.split_copies(unique.union(unique), ["ID", "c"])[0].isEmpty()
    assert copies.split_copies(unique.limit(0), ["ID"])[1] is None


@pytest.mark.parametrize("limit", [NEVER, ALWAYS])
@pytest.mark.parametrize("dims", [["c"], ["c", "s"]])
def test_count_distinct_over_a_split(rows, postings, limit, dims):
    alone, repeated = copies.split_copies(postings, ["ID", "c"], limit)
    got = copies.count_distinct_split(alone, repeated, dims)
    assert rows(got) == rows(count_distinct_mart(postings, dims))


def test_a_filter_only_widens_the_exact_side(rows, postings):
    exact_alone, _ = copies.split_copies(postings, ["ID", "c"])
    alone, repeated = copies.split_copies(postings, ["ID", "c"], NEVER, share=0.9)
    assert rows(alone.union(repeated)) == rows(postings)
    assert set(rows(alone)) <= set(rows(exact_alone))
    assert rows(collapse(postings, ["ID", "c"], ["s"])) == rows(alone.union(collapse(repeated, ["ID", "c"], ["s"])))


@pytest.mark.parametrize("repeated", [3000, 40000])
def test_a_filter_mistakes_few_rows_however_many_hashes_it_has(spark, repeated):
    """A map of fixed size, full at 2,000 hashes, would take every row; this one is sized by their number."""
    copied = spark.range(repeated).select(F.concat(F.lit("c"), F.col("id")).alias("ID"))
    single = spark.range(50000).select(F.concat(F.lit("s"), F.col("id")).alias("ID"))
    made = copies.copy_filter(copied.union(copied).union(single), ["ID"], NEVER)
    assert made.hashes is None and made.bloom.blocks * 4096 < 2 * repeated + 4096
    alone, again = made.split(single)
    assert again.count() <= copies.FALSE_SHARE * 50000
    assert made.split(copied)[0].isEmpty() and made.split(copied)[1].count() == repeated


def test_past_the_largest_filter_all_rows_take_the_exact_path(rows, postings):
    made = copies.copy_filter(postings, ["ID", "c"], NEVER, filter_limit=0)
    alone, repeated = made.split(postings)
    assert alone is None and rows(repeated) == rows(postings)
    assert rows(copies.count_distinct_split(alone, repeated, ["c"])) == rows(count_distinct_mart(postings, ["c"]))


@pytest.mark.parametrize("limit", [NEVER, ALWAYS])
def test_collapse_by_place(spark, rows, postings, limit):
    more = postings.withColumn("t", F.when(F.col("s").isNotNull(), F.concat(F.lit("é"), F.col("s")))).withColumn("none", F.lit(None).cast("string"))
    want = rows(collapse(more, ["ID", "c"], ["s", "t", "none"]))
    got = collapse_by_place(more, ["ID", "c"], ["s", "t", "none"], limit)
    assert rows(got) == want
    above = got._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert ("SortAggregate" in above) == (limit == NEVER)
    lookup.release()


def test_one_filter_serves_rows_made_from_its_own(rows, postings):
    made = copies.copy_filter(postings, ["ID", "c"])
    part = postings.where("s IS NOT NULL")
    alone, repeated = made.split(part)
    assert rows(alone.union(repeated)) == rows(part)
    assert rows(copies.count_distinct_split(alone, repeated, ["c"])) == rows(count_distinct_mart(part, ["c"]))


def test_scopes_drop_their_own_sides_only(spark):
    outer = lookup.measure(spark.range(3), ALWAYS).frame
    with lookup.lookup_scope():
        inner = lookup.measure(spark.range(4), ALWAYS).frame
        assert inner.is_cached
        lookup.release()
        assert not inner.is_cached and outer.is_cached
    assert outer.is_cached


def test_a_large_side_is_computed_once_in_its_own_partitions(spark):
    counted = spark.sparkContext.accumulator(0)

    def note(batches):
        for batch in batches:
            counted.add(len(batch))
            yield batch

    large = spark.range(0, 1000, 1, 5).mapInPandas(note, "id long")
    side = lookup.measure(large, 100)
    assert not side.fits and side.rows == 1000
    assert side.frame.count() == 1000 and counted.value == 1000
    assert side.frame.rdd.getNumPartitions() == 5
    assert "SinglePartition" not in side.frame._jdf.queryExecution().executedPlan().toString()
    lookup.release()


def test_hot_share_follows_the_shuffle(spark, fact):
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    try:
        assert lookup.hot_share(fact) == 5000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
