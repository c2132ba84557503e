"""Sharding by balanced label propagation (operator 6, DataFrame functions only). Law: ``rows``.

Documents with equal texts are linked through a group. A unit is a bounded part of a group, so that no move is larger than
``UNIT`` rows however many copies a group has. Labels begin balanced by hash. In each round a group's members count their
shards, the one with most of them is its target (one with free places, where the fullest is full), and units elsewhere want to move there; from shard to shard may go what wants to come
back and what the other's quota still has free, in the order of the groups' pull. Documents without links, and what a group
larger than a shard has outside its fullest shard, are the filling: at last they, and others only where filling is used up, move from shards above their quota to those below, which makes counts equal or one apart.

Only (group, shard) and (unit, shard) rows take part in the rounds; texts are read once for their sizes and hashes. Ranks
come from counted hash buckets, never from a task for a whole shard.

Defined cases: a null text has no bytes, size 1, and links with other nulls; an empty text likewise, apart from nulls;
repeated rows are rows of their own (ties of doc_id are broken by the row's number); an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxloom.llm.common import Scratch, key128, numbered
from voxloom.session import read_table, spread

SHARDS, UNIT, ROUNDS, BUCKET = 8, 256, 6, 20_000


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, row, size, text_crc32, g1, g2): one scan of the texts; equal (g1, g2): equal texts."""
    h1, h2 = key128(F.col("text"))
    blank = F.col("text").isNull()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.when(blank, F.lit(0)).otherwise(h1).alias("g1"), F.when(blank, F.lit(0)).otherwise(h2).alias("g2"),
    )


def accepted(wants: DataFrame, free: DataFrame, buckets: int) -> DataFrame:
    """``wants`` (g1, g2, part, shard, own, target, n, pull) that the quotas allow, strongest pull first.

    From one shard to another may go as many rows as want to come back, and a part of what the other still has ``free``. Running sums come
    in two steps: sums of counted buckets (shard, target, pull class, hash bucket), then within a bucket."""
    flows = wants.groupBy("shard", "target").agg(F.sum("n").alias("go"))
    back = flows.select(F.col("target").alias("shard"), F.col("shard").alias("target"), F.col("go").alias("come"))
    to = flows.groupBy("target").agg(F.sum("go").alias("all"))
    limits = flows.join(back, ["shard", "target"], "left").join(to, "target").join(free, "target", "left").select(
        "shard", "target",
        (F.least("go", F.coalesce("come", F.lit(0))) + F.ceil(F.greatest(F.coalesce("free", F.lit(0)), F.lit(0)) * F.col("go") / F.col("all"))).alias("most"),
    )
    keyed = wants.withColumn("b", -F.floor(F.log2(F.col("pull").cast("double"))).cast("int") * buckets + F.pmod(F.xxhash64("g1", "g2", "part"), F.lit(buckets)).cast("int"))
    sums = keyed.groupBy("shard", "target", "b").agg(F.sum("n").alias("s"))
    before = Window.partitionBy("shard", "target").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    first = sums.select("shard", "target", "b", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "target", "b").orderBy("g1", "g2", "part", "own").rowsBetween(Window.unboundedPreceding, 0)
    ranked = keyed.withColumn("upto", F.sum("n").over(inside)).join(first, ["shard", "target", "b"]).join(F.broadcast(limits), ["shard", "target"])
    return ranked.where("first + upto <= most").select("g1", "g2", "part", "own", "shard", "target")


def fullest(units: DataFrame, room: DataFrame | None = None, largest: int = 0) -> DataFrame:
    """(g1, g2, target, pull): the shard that holds most of each group, and how much.

    With ``room`` (target, free), shards with free places come first for groups of at most ``largest`` rows: a group that lies half in
    a full shard gathers elsewhere."""
    held = units.groupBy("g1", "g2", "members", "shard").agg(F.sum("n").alias("held"))
    if room is not None:
        held = held.join(F.broadcast(room.withColumnRenamed("target", "shard")), "shard", "left")
    open_ = F.lit(True) if room is None else (F.col("members") > largest) | (F.coalesce("free", F.lit(0)) > 0)
    tie = F.pmod(F.xxhash64("g1", "shard"), F.lit(1 << 20))
    best = F.max_by(F.struct("shard", "held"), F.struct(open_, "held", tie))
    return held.groupBy("g1", "g2").agg(best.alias("b")).select("g1", "g2", F.col("b.shard").alias("target"), F.col("b.held").alias("pull"))


def propagated(units: DataFrame, quotas: DataFrame, largest: int, rounds: int, buckets: int) -> DataFrame:
    """``units`` (g1, g2, part, own, shard, members, n) after the rounds; own keeps the label a unit began with.

    What a group of more than ``largest`` rows has outside its fullest shard cannot be brought together and takes no quota."""
    now, room = units, None
    for _ in range(rounds):
        told = Scratch.write(now.join(fullest(now, room, largest), ["g1", "g2"]), "told")
        settled = told.where((F.col("members") <= largest) | (F.col("shard") == F.col("target")))
        load = settled.groupBy("shard").agg(F.sum("n").alias("load"))
        room = quotas.join(load, "shard", "left").select(F.col("shard").alias("target"), (F.col("quota") - F.coalesce("load", F.lit(0))).alias("free"))
        room = Scratch.write(room, "room")
        moves = accepted(told.where("shard <> target"), room, buckets).drop("shard")
        moved = now.join(moves, ["g1", "g2", "part", "own"], "left").withColumn("shard", F.coalesce("target", "shard"))
        now = Scratch.write(moved.select("g1", "g2", "part", "own", "shard", "members", "n"), "units")
    return now


def sharded(docs: DataFrame, shards: int = SHARDS, unit: int = UNIT, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, cut) for every row; cut: whether its group lies in several shards."""
    rows = Scratch.write(described(docs), "rows")
    total = rows.count()
    buckets = max(1, -(-total // BUCKET))
    extra = (F.col("id") < total % shards).cast("long")
    quotas = docs.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"), (F.lit(total // shards).cast("long") + extra).alias("quota"))
    groups = rows.groupBy("g1", "g2").agg(F.count("*").alias("members"))
    linked = groups.where("members > 1")
    begun = rows.join(linked, ["g1", "g2"], "left").withColumn("own", F.pmod(F.xxhash64("doc_id", "row"), F.lit(shards)).cast("int"))
    parts = F.ceil(F.col("members") / F.lit(unit))
    begun = begun.withColumn("part", F.when(F.col("members").isNotNull(), F.pmod(F.xxhash64("row", "doc_id"), parts)))
    begun = Scratch.write(begun, "begun")
    units = begun.where("part IS NOT NULL").groupBy("g1", "g2", "part", "own", "members").agg(F.count("*").alias("n")).withColumn("shard", F.col("own"))
    largest = total // shards
    moved = Scratch.write(propagated(Scratch.write(units, "units"), quotas, largest, rounds, buckets), "moved")
    over = moved.where(F.col("members") > largest)
    main = fullest(over).select("g1", "g2", F.col("target").alias("main"))  # fewer groups than shards
    labelled = moved.join(F.broadcast(main), ["g1", "g2"], "left")
    labelled = labelled.select("g1", "g2", "part", "own", F.col("shard").alias("to"), F.coalesce(F.col("main") != F.col("shard"), F.lit(False)).alias("left_over"))
    placed = begun.join(labelled, ["g1", "g2", "part", "own"], "left")
    loose = F.col("to").isNull() | F.col("left_over")
    placed = placed.select("doc_id", "row", "size", "text_crc32", "g1", "g2", F.coalesce("to", "own").alias("shard"), loose.alias("loose"))
    placed = Scratch.write(placed, "placed")
    even = evened(placed, quotas, buckets)
    even = Scratch.write(even, "even")
    slots = numbered(even, "slot", ["shard"], ["doc_id", "row"], buckets)
    parted = even.join(linked, ["g1", "g2"], "left_semi").groupBy("g1", "g2").agg((F.min("shard") != F.max("shard")).alias("cut"))
    return slots.join(parted, ["g1", "g2"], "left").select(
        "doc_id", "size", "text_crc32", "shard", "slot", F.coalesce("cut", F.lit(False)).alias("cut")
    )


def evened(placed: DataFrame, quotas: DataFrame, buckets: int) -> DataFrame:
    """``placed`` with every shard at its quota: rows above it, loose ones first, go where there is room."""
    load = placed.groupBy("shard").agg(F.count("*").alias("load"), F.count_if("loose").alias("loose_load"))
    state = quotas.join(load, "shard", "left").select(
        "shard", (F.coalesce("load", F.lit(0)) - F.col("quota")).alias("over"), F.coalesce("loose_load", F.lit(0)).alias("loose_load")
    )
    told = {r["shard"]: (r["over"], r["loose_load"]) for r in state.collect()}
    lends = [(s, loose, n) for s, (over, free) in told.items() for loose, n in ((True, min(max(over, 0), free)), (False, max(over - free, 0)))]
    rows = [F.struct(F.lit(s).alias("shard"), F.lit(loose).alias("loose"), F.lit(n).cast("long").alias("lend")) for s, loose, n in lends]
    lending = quotas.sparkSession.range(1).select(F.inline(F.array(*rows)))
    ranked = numbered(placed, "rank", ["shard", "loose"], ["row", "doc_id"], buckets).join(F.broadcast(lending), ["shard", "loose"])
    lent = ranked.where("rank < lend").select("row", "doc_id", F.lit(0).alias("all"))
    order = numbered(lent, "turn", ["all"], ["row", "doc_id"], buckets)
    bounds, at = [], 0
    for s, (over, _) in sorted(told.items()):
        if over < 0:
            bounds.append((s, at, at - over))
            at -= over
    place = None
    for s, a, b in bounds:
        inside = (F.col("turn") >= a) & (F.col("turn") < b)
        place = F.when(inside, F.lit(s)) if place is None else place.when(inside, F.lit(s))
    if place is None:
        return placed.drop("loose")
    goes = order.select("row", "doc_id", place.alias("goes"))
    return placed.join(goes, ["row", "doc_id"], "left").withColumn("shard", F.coalesce("goes", "shard")).drop("goes", "loose")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query over all ``documents``, into shards 0 to 7 by the law ``rows``."""
    got = sharded(spread(read_table(spark, sf_dir, "documents")).select("doc_id", "text"))
    return got.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "cut"
    )
