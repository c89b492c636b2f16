"""Shards of equal row counts that keep linked documents together.

Documents with equal texts are linked.  Every document starts in the shard of its id's hash,
and balanced label propagation moves linked ones: in each round a group's documents move
towards the shards that hold most of the group, as few of them as have room for it, and as many
documents as the shards' quotas admit.  Documents of a group in one shard are alike, so the rounds work on cells of (group,
shard, number) and a group of any size is at most one row per shard; no pair of documents is
ever formed.  A move goes from a smaller cell to a larger one of the same group, so the sum of their squares
grows, and rounds go on until nothing moves.

Quotas are exact: shard counts differ by at most one (law ``rows``).  What the rounds have put
into a shard beyond its quota, and documents without a link, fill the room that is left in
rank order, so the overflow of a group stays in few shards.  Ranks are counted in salted
parts; a group with a third of all rows is spread over tasks.

Null text has no bytes and is linked with empty text.  Repeated rows are documents of their own
with different slots.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.llm.common import files_for, salted_offsets, salted_ranks, shuffle_parts, stored, table

SHARDS, ROW_BYTES = 24, 8


def _by_shard(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def first_cells(docs: DataFrame, shards: int) -> DataFrame:
    """(group, shard, n) of all groups with more than one document, by the hash of their ids."""
    start = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")
    cells = docs.groupBy("group", start.alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    linked = cells.groupBy("group").agg(F.sum("n").alias("_all")).where("_all > 1").select("group")
    return cells.join(linked, "group", "left_semi")


def _totals(rows: DataFrame, shards: int) -> list[int]:
    """Sum of ``n`` by shard."""
    totals = [0] * shards
    for row in rows.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        totals[row["shard"]] = row["n"]
    return totals


def propagate(cells: DataFrame, quotas: list[int], rounds: int | None = None) -> DataFrame:
    """Move cells towards the largest cells of their group, under the quotas.

    A shard has room for what its quota leaves besides the documents that want to stay: those in
    the largest cell of their group.  Where more come than others leave, the surplus is dealt with
    by :func:`within_quotas`.  ``rounds`` ends the propagation early.
    """
    shards, salts = len(quotas), shuffle_parts(cells.sparkSession)
    # There are no more cells than documents, nor more moves.
    files = files_for(sum(quotas))
    cells = stored(cells, "cells", files)
    # A group's cells in order of size; the hash settles ties differently for each group.
    by_size = W.partitionBy("group").orderBy(F.desc("n"), F.xxhash64("group", "shard"), "shard")
    before = W.partitionBy("group").orderBy("place").rowsBetween(W.unboundedPreceding, -1)

    def earlier(value: Column) -> Column:
        return F.coalesce(F.sum(value).over(before), F.lit(0))

    while rounds is None or rounds > 0:
        rounds = rounds and rounds - 1
        placed = stored(
            cells.withColumn("place", F.row_number().over(by_size))
            .withColumn("all", F.sum("n").over(W.partitionBy("group"))), "placed", files)
        free = _by_shard([max(0, q - n) for q, n in zip(quotas, _totals(placed.where("place = 1"), shards))])
        room = free[F.col("shard")]
        # The largest cells are goals until they and their room hold the whole group.
        marked = placed.withColumn("is_goal", earlier(F.col("n") + room) < F.col("all"))
        goals = marked.where("is_goal").select(
            "group", F.col("shard").alias("goal"), earlier(room).alias("from"), (earlier(room) + room).alias("to"))
        movers = marked.where("NOT is_goal").select("group", "shard", "n", earlier(F.col("n")).alias("at"))
        share = F.least(F.col("at") + F.col("n"), F.col("to")) - F.greatest("at", "from")
        moves = stored(movers.join(goals, "group").select("group", "shard", "goal", share.alias("n")).where("n > 0"), "moves", files)
        queued = salted_offsets(moves, ["goal"], "n", ["group", "shard"], salts, "ahead")
        admitted = F.greatest(F.least(free[F.col("goal")] - F.col("ahead"), F.col("n")), F.lit(0))
        taken = stored(queued.withColumn("moved", admitted).where("moved > 0"), "taken", files)
        if taken.isEmpty():
            return cells
        signed = cells.unionByName(taken.select("group", F.col("goal").alias("shard"), F.col("moved").alias("n"))).unionByName(
            taken.select("group", "shard", (-F.col("moved")).alias("n")))
        cells = stored(signed.groupBy("group", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "cells", files)
    return cells


def within_quotas(cells: DataFrame, quotas: list[int]) -> tuple[DataFrame, list[int]]:
    """Cells cut to the quotas, the overflow moved into room elsewhere; the room left after it."""
    spark, salts = cells.sparkSession, shuffle_parts(cells.sparkSession)
    quota, files = _by_shard(quotas), files_for(sum(quotas))
    cells = stored(salted_offsets(cells, ["shard"], "n", ["group"], salts, "before"), "cells", files)
    kept = F.greatest(F.least(quota[F.col("shard")] - F.col("before"), F.col("n")), F.lit(0))
    split = cells.withColumn("kept", kept)
    stay = split.where("kept > 0").select("group", "shard", F.col("kept").alias("n"))
    room = [q - used for q, used in zip(quotas, _totals(stay, len(quotas)))]
    over = stored(split.where("n > kept").select("group", "shard", (F.col("n") - F.col("kept")).alias("n")), "over", files)
    if over.isEmpty():
        return stay, room
    at = salted_offsets(over, [], "n", ["group", "shard"], salts, "at")
    ends, total = [], 0
    for r in room:
        ends.append((total, total + r))
        total += r
    spans = F.array(*[F.struct(F.lit(j).alias("shard"), F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b"))
                      for j, (a, b) in enumerate(ends)])
    parts = at.withColumn("to", F.explode(spans)).select(
        "group", F.col("to.shard").alias("shard"),
        (F.least(F.col("at") + F.col("n"), F.col("to.b")) - F.greatest("at", F.col("to.a"))).alias("n")).where("n > 0")
    cells = stored(stay.unionByName(parts).groupBy("group", "shard").agg(F.sum("n").alias("n")), "cells", files)
    return cells, [q - used for q, used in zip(quotas, _totals(cells, len(quotas)))]


def _pick(places: Column, rank: Column) -> Column:
    return F.filter(places, lambda p: (p["lo"] <= rank) & (rank < p["hi"]))[0]


def place(docs: DataFrame, cells: DataFrame, quotas: list[int], room: list[int]) -> DataFrame:
    """Add ``shard`` and ``slot`` to the stored (doc_id, ..., group) rows.

    The result is in few partitions, as whoever writes it makes a file of each.
    """
    salts, files = shuffle_parts(docs.sparkSession), files_for(sum(quotas))
    based = salted_offsets(stored(cells, "cells", files), ["shard"], "n", ["group"], salts, "base")
    spans = based.withColumn("lo", F.sum("n").over(W.partitionBy("group").orderBy("shard").rowsBetween(
        W.unboundedPreceding, W.currentRow)) - F.col("n"))
    places = spans.groupBy("group").agg(F.collect_list(F.struct(
        "shard", "lo", (F.col("lo") + F.col("n")).alias("hi"), "base")).alias("places"))
    keyed = docs.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    counts = keyed.groupBy(F.col("group").alias("_group"), F.col("salt").alias("_salt")).agg(F.count(F.lit(1)).alias("_n"))
    # At most one row per salt and group meets the group's places, however large the group is.
    before = F.sum("_n").over(W.partitionBy("_group").orderBy("_salt").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_n")
    known = counts.withColumn("_before", before).join(places.withColumnRenamed("group", "_group"), "_group", "left")
    inside = F.row_number().over(W.partitionBy("group", "salt").orderBy("doc_id")) - 1
    ranked = keyed.withColumn("_inside", inside).join(
        known, (F.col("group") == F.col("_group")) & (F.col("salt") == F.col("_salt")))
    at = stored(
        ranked.withColumn("rank", F.col("_inside") + F.col("_before"))
        .withColumn("place", _pick(F.col("places"), F.col("rank")))
        .select(*docs.columns, F.col("place.shard").alias("shard"),
                (F.col("place.base") + F.col("rank") - F.col("place.lo")).alias("slot")),
        "placed", files)
    linked = at.where(F.col("shard").isNotNull())
    loose = salted_ranks(at.where(F.col("shard").isNull()).select(*docs.columns), [], ["doc_id", "group"], salts)
    lows = [sum(room[:j]) for j in range(len(room))]
    rest = F.array(*[F.struct(
        F.lit(j).alias("shard"), F.lit(low).cast("bigint").alias("lo"), F.lit(low + r).cast("bigint").alias("hi"),
        F.lit(quotas[j] - r).cast("bigint").alias("base")) for j, (low, r) in enumerate(zip(lows, room))])
    filled = loose.withColumn("place", _pick(rest, F.col("rank"))).select(
        *docs.columns, F.col("place.shard").alias("shard"), (F.col("place.base") + F.col("rank") - F.col("place.lo")).alias("slot"))
    return linked.unionByName(filled).coalesce(files)


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, group, shard, slot) of all documents."""
    text = F.coalesce("text", F.lit(""))
    # Texts are read by as many tasks as there are; only the narrow rows are brought into few files.
    slim = stored(docs.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("group"),
    ).repartition(files_for(docs.count())), "shard-docs")
    total = slim.count()
    quotas = [total // shards + (j < total % shards) for j in range(shards)]
    cells, room = within_quotas(propagate(first_cells(slim, shards), quotas), quotas)
    return place(slim, cells, quotas, room)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, counts at most one apart."""
    placed = shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
