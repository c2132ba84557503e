"""N-gram Jaccard join with set-relation skipping (operator 7).

A document's set is its distinct 5-word shingles (64-bit hashes); two documents link when
``100 * intersection >= 75 * union``. The join returns each document's component.

How it stays whole and bounded:

* Equal sets are one node from the start; copies are never paired.
* A global order puts shingles that are frequent among distinct sets last (a bounded list of the most frequent ones; any
  order gives the same links, a good one gives fewer candidates). Linked sets share a shingle in their prefixes.
* Prefix shingles, those in the first positions of the order, meet in an inverted index, moved as numpy blocks by hash
  range; lists of one set are dropped at once. The remaining lists are cut into blocks by set size; a block is skipped
  where sizes rule out a link, and a pair where its shared prefix and all positions behind it cannot reach the needed overlap.
* Sets of a list are first compared with one pivot a block, the smallest set id. A set that links with its pivot takes over
  the pivot's computed answer, its component. Every set close to its pivot is attached to it with the measured overlap and the few
  shingles in which it differs from the pivot.
* The smallest set id may be an outlier among near copies. Where sets of a pivot are outside its component, the most central of
  its sets, its hub, takes the pivot's place and is compared with each of them. Hubs, and sets without a pivot, are compared with
  the largest hub of each list they are in and move to it with all their sets where they overlap by half. That costs two
  comparisons a set and joins the copies that the first pivot kept apart.
* Two sets attached to one pivot are never enumerated as such: their overlap is at most the smaller overlap with the pivot plus
  the differing shingles both have, so an inverted index over differing shingles, and a comparison of sizes for pairs that have
  none in common, leave the few pairs whose answer the pivot's does not settle.
* Of a list's other pairs only those can bring news that lie in two components and have two pivots, so one of both is
  outside the component (or pivot) that most of the list's sets have: each such set meets the list's sets of a fitting size.
  Pairs that pass the overlap bound of the whole prefix are verified on full sets, as are those left by the step before, so no
  link between different components is lost.

Defined cases: a null, empty or blank text has an empty set and links with nothing; a text of fewer than five words is
one shingle; rows that repeat a doc_id give a row each, with the class of their own text; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import Scratch, components
from voxloom.llm.shingles import bounded, shingle_sets
from voxloom.session import read_table, spread

WIDTH = 5
#: The list of frequent shingles: at most so many, each in at least so many distinct sets. It shapes the order only.
MOST_FREQUENT, FREQUENT = 200_000, 64
#: Prefix shingles of an index block, about, up to so many blocks.
BLOCK, MOST_BLOCKS = 400_000, 20_000


def prefix_length(n: int) -> int:
    """How many of ``n`` ordered shingles must hold one that any linked set shares."""
    return n - (3 * n + 3) // 4 + 1


def seen_filter(sets: Iterator[np.ndarray], seen: set[int]) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(set id, shingles, whether it is new to this task)."""
    for s in sets:
        key = xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63)
        new = bool(len(s)) and key not in seen
        if new:
            seen.add(key)
        yield key, s, new


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingles, class by the logarithm of their count) of the most frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in bounded(batches, 0):
            fresh = [s for _, s, new in seen_filter(shingle_sets(batch.column(0), WIDTH), seen) if new]
            if not fresh:
                continue
            each, n = np.unique(np.concatenate(fresh), return_counts=True)
            often = n >= 3
            yield pa.RecordBatch.from_arrays([pa.array(each[often].view(np.int64)), pa.array(n[often])], ["token", "n"])

    counts = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "token").limit(MOST_FREQUENT).toArrow()
    token = top["token"].to_numpy().view(np.uint64)
    rank = np.log2(np.maximum(top["n"].to_numpy(), 1)).astype(np.int64)
    at = np.argsort(token)
    return token[at], rank[at]


SETS = "doc_id long, n long, sid long, rare binary, common binary"


def prefixes(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """For each document its set's size and id, and for sets new to a task the prefix, in order: rare and common part."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, rank = held.value
        seen: set[int] = set()
        for batch in bounded(batches, 1):
            n, sid, rare, common = [], [], [], []
            for key, s, new in seen_filter(shingle_sets(batch.column(1), WIDTH), seen):
                n.append(len(s))
                sid.append(key if len(s) else None)
                r, c = s[:0], s[:0]
                if new:
                    p = prefix_length(len(s))
                    if len(token):
                        at = np.minimum(np.searchsorted(token, s), len(token) - 1)
                        often = token[at] == s
                        r, c = s[~often], s[often]
                        c = c[np.argsort(rank[at[often]], kind="stable")]
                    else:
                        r = s
                    r, c = r[:p], c[: max(0, p - len(r))]
                rare.append(r.tobytes())
                common.append(c.tobytes())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.array(rare, pa.binary()), pa.array(common, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "sid", "rare", "common"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SETS)


#: A list has token, sids and ns; a counted pivot pair has x, xn, y, yn and c.
MET = "token long, sids array<long>, ns array<int>, x long, xn int, y long, yn int, c long"
ENTRY = np.dtype([("token", "<i8"), ("sid", "<i8"), ("n", "<i4")])


def pivot_pairs_of(rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """(x, xn, y, yn, c) for whole lists: each set with the pivots of its own and the next size block."""
    block = np.floor(np.log(rows["n"]) / np.log(4 / 3)).astype(np.int64)
    at = np.lexsort((rows["sid"], block, rows["token"]))
    rows, block = rows[at], block[at]
    head = np.ones(len(rows), bool)
    head[1:] = (rows["token"][1:] != rows["token"][:-1]) | (block[1:] != block[:-1])
    group, first = np.cumsum(head) - 1, np.flatnonzero(head)
    after = np.minimum(group + 1, len(first) - 1)
    follows = (rows["token"][first[after]] == rows["token"]) & (block[first[after]] == block + 1)
    x = np.concatenate([np.arange(len(rows)), np.flatnonzero(follows)])
    y = np.concatenate([first[group], first[after[follows]]])
    n, m = rows["n"][x].astype(np.int64), rows["n"][y].astype(np.int64)
    fits = (rows["sid"][x] != rows["sid"][y]) & (4 * np.minimum(n, m) >= 3 * np.maximum(n, m))
    x, y = x[fits], y[fits]
    order = np.lexsort((rows["sid"][y], rows["sid"][x]))
    x, y = x[order], y[order]
    new = np.ones(len(x), bool)
    new[1:] = (rows["sid"][x[1:]] != rows["sid"][x[:-1]]) | (rows["sid"][y[1:]] != rows["sid"][y[:-1]])
    edges = np.append(np.flatnonzero(new), len(x))
    x, y = x[new], y[new]
    return rows["sid"][x], rows["n"][x], rows["sid"][y], rows["n"][y], np.diff(edges)


def rare_index(sets: DataFrame, blocks: int) -> DataFrame:
    """Of the rare prefix shingles that two sets or more share: the postings, and the pivot pairs with their counts.

    Shingles are dealt into blocks by their hash; a row of the shuffle is what one batch has for one block, as bytes."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(2)]
            size = np.array([len(x) for x in parts])
            if not size.sum():
                continue
            token = np.concatenate(parts)
            block = (token >> np.uint64(32)).astype(np.int64) * blocks >> 32
            rows = np.empty(len(token), ENTRY)
            rows["token"] = token.view(np.int64)
            rows["sid"] = np.repeat(batch.column(0).to_numpy(), size)
            rows["n"] = np.repeat(batch.column(1).to_numpy(), size)
            at = np.argsort(block, kind="stable")
            rows, edges = rows[at], np.searchsorted(block[at], np.arange(blocks + 1))
            some = np.flatnonzero(np.diff(edges))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array([rows[edges[b] : edges[b + 1]].tobytes() for b in some], pa.binary())], ["block", "rows"]
            )

    def shared(got: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(got)
        rows = rows[np.lexsort((rows["sid"], rows["token"]))]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows["token"][1:] != rows["token"][:-1]) | (rows["sid"][1:] != rows["sid"][:-1])
        rows = rows[fresh]
        same = np.zeros(len(rows) + 1, bool)
        same[1:-1] = rows["token"][1:] == rows["token"][:-1]
        rows = rows[same[1:] | same[:-1]]
        if not len(rows):
            return
        k, flat = len(rows), lambda c: pa.array(np.ascontiguousarray(c))
        first = np.flatnonzero(np.append(True, rows["token"][1:] != rows["token"][:-1]))
        edges = pa.array(np.append(first, k), pa.int32())
        lists = [flat(rows["token"][first]), pa.ListArray.from_arrays(edges, flat(rows["sid"])), pa.ListArray.from_arrays(edges, flat(rows["n"]))]
        x, xn, y, yn, c = pivot_pairs_of(rows)
        pairs = [flat(x), flat(xn), flat(y), flat(yn), flat(c.astype(np.int64))]
        names, n = ["token", "sids", "ns", "x", "xn", "y", "yn", "c"], len(first)
        yield pa.RecordBatch.from_arrays([*lists, *(pa.nulls(n, t.type) for t in pairs)], names)
        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(x), t.type) for t in lists), *pairs], names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, got = None, []
        for batch in batches:
            for b, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if b != block and got:
                    yield from shared(got)
                    got = []
                block = b
                got.append(np.frombuffer(rows.as_buffer(), ENTRY))
        if got:
            yield from shared(got)

    dealt = sets.where("octet_length(rare) > 0").select("sid", "n", "rare").mapInArrow(deal, "block int, rows binary")
    # one block or few in a partition: what a task holds at once does not grow with the input
    return dealt.repartition(blocks, "block").sortWithinPartitions("block").mapInArrow(meet, MET)


def common_postings(sets: DataFrame) -> DataFrame:
    """(token, sid, n, pos) of the common part of prefixes; pos: the place in the order, from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(2)]
            size = np.array([len(x) for x in parts])
            if not size.sum():
                continue
            pos = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(batch.column(3).to_numpy(), size)
            columns = (np.concatenate(parts), np.repeat(batch.column(0).to_numpy(), size), np.repeat(batch.column(1).to_numpy(), size).astype(np.int32), pos.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "sid", "n", "pos"])

    some = sets.where("octet_length(common) > 0").select("sid", "n", "common", F.expr("octet_length(rare) div 8").alias("first"))
    return some.mapInArrow(run, "token long, sid long, n int, pos int").dropDuplicates(["token", "sid"])


def size_block(n: Column) -> Column:
    """Sizes of linked sets are in the same block or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(4 / 3))).cast("int")


def least_overlap(a: Column, b: Column) -> Column:
    """The intersection that two sets of these sizes need."""
    return F.floor((3 * (a + b) + 6) / 7)


def outside_prefix(n: Column) -> Column:
    return F.floor((3 * n + 3) / 4) - 1


def possible(pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (x, xn, y, yn, c) that ``c`` shared prefix shingles can still make a link."""
    most = F.col("c") + F.greatest(outside_prefix(F.col("xn")), outside_prefix(F.col("yn")))
    return pairs.where(most >= least_overlap(F.col("xn"), F.col("yn")))


def counted(met: DataFrame) -> DataFrame:
    """(x, xn, y, yn, c), with the counts of equal pairs added up."""
    sums = met.groupBy("x", "y").agg(F.first("xn").alias("xn"), F.first("yn").alias("yn"), F.sum("c").alias("c"))
    return sums.select("x", "xn", "y", "yn", "c")


def pivot_pairs(postings: DataFrame, hubs: DataFrame | None = None) -> DataFrame:
    """(x, xn, y, yn, c): sets of a common list's block with the pivots of their own and the next block, or with the largest of the
    ``hubs`` (sid, m) in the list's own block and both beside it; m: minus the number of a hub's sets."""
    blocked = postings.withColumn("block", size_block(F.col("n")))
    if hubs is None:
        first, beside = blocked.groupBy("token", "block").agg(F.min(F.struct("sid", "n")).alias("p")), (0, -1)
    else:
        first, beside = blocked.join(hubs, "sid").groupBy("token", "block").agg(F.min(F.struct("m", "sid", "n")).alias("p")), (0, -1, 1)
    near = first.select("token", F.explode(F.array(*(F.col("block") + k for k in beside))).alias("block"), F.col("p.sid").alias("y"), F.col("p.n").alias("yn"))
    met = blocked.join(near, ["token", "block"]).where("sid <> y AND 4L * least(n, yn) >= 3L * greatest(n, yn)")
    return counted(met.select(F.col("sid").alias("x"), F.col("n").alias("xn"), "y", "yn", F.lit(1).cast("long").alias("c")))


def leads(named: DataFrame, what: str) -> DataFrame:
    """(token, the value of ``what`` that most of the list's sets have, how many have it)."""
    each = named.groupBy("token", what).agg(F.count("*").alias("k"))
    most = each.groupBy("token").agg(F.max(F.struct("k", what)).alias("m"))
    return most.select("token", F.col(f"m.{what}").alias(f"lead_{what}"), F.col("m.k").alias(f"k_{what}"))


def cross_pairs(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """(x, y): pairs of a common list that lie in different components, have different pivots and may link by position.

    Of a pair that needs overlap o, at least one shared shingle is among the first n - o + 1 of both sets, so that a list's later
    places are skipped for this pair, whatever they hold."""
    named = postings.join(labels, "sid", "left").select("token", "sid", "n", "pos", F.coalesce("comp", "sid").alias("comp"), F.coalesce("pivot", "sid").alias("pivot"))
    named = Scratch.write(named.withColumn("block", size_block(F.col("n"))), "named")
    # one row for each of at most MOST_FREQUENT lists
    told = F.broadcast(leads(named, "comp").join(leads(named, "pivot"), "token"))
    minor = F.when(F.col("k_pivot") >= F.col("k_comp"), F.col("pivot") != F.col("lead_pivot")).otherwise(F.col("comp") != F.col("lead_comp"))
    named = named.join(told, "token").withColumn("minor", minor).drop("lead_comp", "lead_pivot", "k_comp", "k_pivot")
    left = named.where("minor").select(
        "token", F.explode(F.array(*(F.col("block") + k for k in (-1, 0, 1)))).alias("block"), F.col("sid").alias("x"), F.col("n").alias("xn"),
        F.col("pos").alias("xpos"), F.col("comp").alias("xcomp"), F.col("pivot").alias("xpivot"),
    )
    right = named.select(
        "token", "block", F.col("sid").alias("y"), F.col("n").alias("yn"), F.col("pos").alias("ypos"), F.col("comp").alias("ycomp"),
        F.col("pivot").alias("ypivot"), F.col("minor").alias("yminor"),
    )
    fits = F.expr("xcomp <> ycomp AND xpivot <> ypivot AND (NOT yminor OR x < y) AND 4L * least(xn, yn) >= 3L * greatest(xn, yn)")
    needed = least_overlap(F.col("xn"), F.col("yn"))
    early = (F.col("xpos") <= F.col("xn") - needed) & (F.col("ypos") <= F.col("yn") - needed)
    return left.join(right, ["token", "block"]).where(fits & early).select("x", "y").distinct()


def minority(of: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each entry's label is not the one that most entries of its list have, how many have that one, by list)."""
    at = np.lexsort((label, of))
    lists, labels = of[at], label[at]
    start = np.flatnonzero(np.append(True, (lists[1:] != lists[:-1]) | (labels[1:] != labels[:-1])))
    length, run = np.diff(start, append=len(at)), lists[start]
    most = np.zeros(of[-1] + 1, np.int64)
    np.maximum.at(most, run, length)
    best = np.flatnonzero(length == most[run])
    _, first = np.unique(run[best], return_index=True)
    return label != labels[start[best[first]]][of], most


#: Pairs that a task forms at once.
PAIRS_AT_ONCE = 2_000_000


def list_pairs(token: np.ndarray, sid: np.ndarray, n: np.ndarray, comp: np.ndarray, pivot: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(x, xn, y, yn, c) for the pairs of whole lists that differ in component and pivot and may link by size."""
    at = np.lexsort((sid, n, token))
    token, sid, n, comp, pivot = (c[at] for c in (token, sid, n, comp, pivot))
    of = np.cumsum(np.append(True, token[1:] != token[:-1])) - 1
    (by_comp, most_comp), (by_pivot, most_pivot) = minority(of, comp), minority(of, pivot)
    minor = np.where((most_pivot >= most_comp)[of], by_pivot, by_comp)
    some = np.flatnonzero(minor)
    place = (of << 32) | n
    low = np.searchsorted(place, (of[some] << 32) | ((3 * n[some] + 3) // 4))
    todo = np.searchsorted(place, (of[some] << 32) | (4 * n[some] // 3), side="right") - low
    part = np.cumsum(todo) // PAIRS_AT_ONCE
    for k in np.unique(part):
        a, b = np.searchsorted(part, k), np.searchsorted(part, k, side="right")
        x = np.repeat(some[a:b], todo[a:b])
        y = np.arange(len(x)) - np.repeat(np.cumsum(todo[a:b]) - todo[a:b], todo[a:b]) + np.repeat(low[a:b], todo[a:b])
        fits = (comp[x] != comp[y]) & (pivot[x] != pivot[y]) & (~minor[y] | (x < y))
        x, y = x[fits], y[fits]
        swap = sid[x] > sid[y]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        order = np.lexsort((sid[y], sid[x]))
        x, y = x[order], y[order]
        if len(x):
            new = np.append(True, (sid[x[1:]] != sid[x[:-1]]) | (sid[y[1:]] != sid[y[:-1]]))
            count = np.diff(np.append(np.flatnonzero(new), len(x)))
            x, y = x[new], y[new]
            yield sid[x], n[x].astype(np.int32), sid[y], n[y].astype(np.int32), count


PAIR_COUNTS = "x long, xn int, y long, yn int, c long"


def rare_pairs(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(x, xn, y, yn, c) for the pairs of rare lists; of lists of three sets and more only for pairs with different components and
    pivots. Labels come by shuffle at every size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for got in list_pairs(*rows):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in got], ["x", "xn", "y", "yn", "c"])

        kept = [np.empty(0, np.int64)] * 5
        for batch in batches:
            rows = [np.concatenate([k, c.to_numpy(zero_copy_only=False).astype(np.int64)]) for k, c in zip(kept, batch.columns, strict=True)]
            # the last list may go on in the next batch
            end = np.searchsorted(rows[0], rows[0][-1]) if len(rows[0]) else 0
            kept = [c[end:] for c in rows]
            if end:
                yield from told([c[:end] for c in rows])
        if len(kept[0]):
            yield from told(kept)

    two = lists.where("size(sids) = 2").selectExpr("sids[0] AS x", "ns[0] AS xn", "sids[1] AS y", "ns[1] AS yn", "1L AS c")
    two = two.where("4L * least(xn, yn) >= 3L * greatest(xn, yn)")
    each = lists.where("size(sids) > 2").select("token", F.explode(F.arrays_zip("sids", "ns")).alias("e"))
    named = each.select("token", F.col("e.sids").alias("sid"), F.col("e.ns").alias("n")).join(labels, "sid", "left")
    named = named.select("token", "sid", "n", F.coalesce("comp", "sid").alias("comp"), F.coalesce("pivot", "sid").alias("pivot"))
    more = named.repartition("token").sortWithinPartitions("token").mapInArrow(run, PAIR_COUNTS)
    return counted(two.union(more))


def unlabelled_alike(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``pairs`` (x, y) but those with one component or one pivot."""
    for side in "xy":
        pairs = pairs.join(labels.select(F.col("sid").alias(side), F.col("comp").alias(f"{side}comp"), F.col("pivot").alias(f"{side}pivot")), side, "left")
    return pairs.where("coalesce(xcomp, x) <> coalesce(ycomp, y) AND coalesce(xpivot, x) <> coalesce(ypivot, y)").select("x", "y")


#: Up to so many wanted sets, of two numbers and two flags, are sent to every task; more are joined by shuffle.
MOST_SENT = 400_000


def few_of(sets: DataFrame, sids: DataFrame, most: int) -> DataFrame:
    """Those of ``sets`` whose sid is in ``sids``, which has at most ``most`` rows."""
    sids = sids.distinct()
    return sets.join(F.broadcast(sids) if most <= MOST_SENT else sids, "sid", "left_semi")


def full_sets(docs: DataFrame, pairs: DataFrame, chosen: DataFrame) -> tuple[DataFrame, str]:
    """(sid, tokens, as_x, as_y) of the sets in ``pairs``, written, and where; as_x, as_y: on which side they are needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 1):
            got = zip(batch.column(0).to_pylist(), seen_filter(shingle_sets(batch.column(1), WIDTH), set()), strict=True)
            right = [(k, s.tobytes()) for k, (sid, (key, s, new)) in enumerate(got) if key == sid and new]
            at = pa.array([r[0] for r in right], pa.int64())
            tokens = pa.array([r[1] for r in right], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), tokens, batch.column(2).take(at), batch.column(3).take(at)], ["sid", "tokens", "as_x", "as_y"])

    sides = pairs.select(F.col("x").alias("sid"), F.lit(True).alias("as_x"), F.lit(False).alias("as_y")).union(
        pairs.select("y", F.lit(False), F.lit(True))
    )
    wanted = sides.groupBy("sid").agg(F.max("as_x").alias("as_x"), F.max("as_y").alias("as_y")).join(chosen, "sid")
    wanted = Scratch.write(wanted, "wanted")
    if wanted.count() <= MOST_SENT:
        wanted = F.broadcast(wanted)
    read = docs.select("doc_id", "text").join(wanted, "doc_id").select("sid", "text", "as_x", "as_y")
    return Scratch.write_at(read.mapInArrow(run, "sid long, tokens binary, as_x boolean, as_y boolean"), "full")


#: A set is attached to a pivot if their overlap is at least this share of the larger of both.
ATTACHED = 0.7
CHECKED = "x long, xn int, y long, yn int, both int, linked boolean, rest binary, b0 long, b1 long, b2 long, b3 long"
BITS = ("b0", "b1", "b2", "b3")


def bitmap(tokens: np.ndarray) -> list[int]:
    """256 bits, four words, with the one of each shingle's lowest byte set."""
    return np.packbits(np.bincount((tokens & np.uint64(255)).astype(np.int64), minlength=256).astype(bool)).view(np.int64).tolist()


def verified(pairs: DataFrame, one: DataFrame, two: DataFrame, hubs: bool = False) -> DataFrame:
    """``CHECKED`` for pairs (x, y) of sets in ``one`` and ``two``: both is the overlap; where y may be x's pivot (or is a hub), rest:
    the shingles of x that y lacks, and a bitmap of those of y that x lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                same = b[at] == a
                both = int(same.sum())
                close = hubs or (y < x and both >= ATTACHED * max(len(a), len(b)))
                bits = bitmap(np.delete(b, at[same])) if close else [None] * 4
                out.append((x, len(a), y, len(b), both, 7 * both >= 3 * (len(a) + len(b)), a[~same].tobytes() if close else None, *bits))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), *[pa.int64()] * 4)
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["x", "xn", "y", "yn", "both", "linked", "rest", *BITS])

    one = one.select(F.col("sid").alias("x"), F.col("tokens").alias("xs"))
    two = two.select(F.col("sid").alias("y"), F.col("tokens").alias("ys"))
    joined = pairs.select("x", "y").join(one, "x").join(two, "y").select("x", "y", "xs", "ys")
    return joined.mapInArrow(run, CHECKED)


def attachments(near: DataFrame) -> DataFrame:
    """(x, n, p, pn, both, rest, b0 to b3): every set that is close to a pivot, with the smallest such pivot p."""
    close = near.where("rest IS NOT NULL")
    first = close.groupBy("x").agg(F.min("y").alias("y"))
    return attached_to(close.join(first, ["x", "y"]).dropDuplicates(["x"]))


def attached_to(near: DataFrame) -> DataFrame:
    return near.select("x", F.col("xn").alias("n"), F.col("y").alias("p"), F.col("yn").alias("pn"), "both", "rest", *BITS)


def members(own: DataFrame, roots: DataFrame) -> DataFrame:
    """``own`` with comp and out: its component is not the pivot's."""
    a, b = roots.select(F.col("node").alias("x"), F.col("root").alias("xr")), roots.select(F.col("node").alias("p"), F.col("root").alias("pr"))
    comp, other = F.coalesce("xr", "x"), F.coalesce("pr", "p")
    named = own.join(a, "x", "left").join(b, "p", "left")
    return named.select("x", "n", "p", "pn", "both", "rest", *BITS, comp.alias("comp"), (comp != other).alias("out"))


def central(of: DataFrame) -> DataFrame:
    """(p, hub, m): for each pivot of several sets, some outside its component, the one of them that is nearest to the pivot widened
    by the shingles that at least half of them have and it lacks; m: minus their number."""
    sizes = of.groupBy("p").agg(F.count("*").alias("m"), F.max("out").alias("open")).where("open AND m > 1").drop("open")
    some = of.join(sizes, "p")
    shingles = Scratch.write(rest_shingles(some), "differing")
    counts = shingles.groupBy("p", "token").agg(F.count("*").alias("k")).join(sizes, "p")
    half = Scratch.write(counts.where("2 * k >= m").select("p", "token"), "half")
    gained = shingles.join(half, ["p", "token"], "left_semi").groupBy("x").agg(F.count("*").alias("h"))
    wide = half.groupBy("p").agg(F.count("*").alias("hn"))
    both = F.col("both") + F.coalesce("h", F.lit(0))
    near = both / (F.col("n") + F.col("pn") + F.coalesce("hn", F.lit(0)) - both)
    scored = some.select("x", "n", "p", "pn", "both", "m").join(gained, "x", "left").join(wide, "p", "left").select("p", "x", "m", near.alias("near"))
    return scored.groupBy("p").agg(F.max_by("x", F.struct("near", "x")).alias("hub"), (-F.first("m")).alias("m"))


#: A hub moves to a larger one, with all its sets, if their overlap is at least this share of the larger set.
MOVES = 0.5


def recentred(own: DataFrame, of: DataFrame, common: DataFrame, full: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(x, y) of the sets whose pivot is now the hub y (its own if x is a hub), and ``CHECKED`` for the pairs compared for that.

    ``own``: the sets' pivots, ``of``: the same as ``members``, ``full``: the sets of both."""
    hubs = Scratch.write(central(of), "hubs")
    named = hubs.select(F.col("hub").alias("sid"), "m")
    loose = common.join(own.select(F.col("x").alias("sid")).join(named, "sid", "left_anti"), "sid", "left_anti")
    meeting = Scratch.write(pivot_pairs(loose, named).select("x", "y"), "meeting")

    def compared(pairs: DataFrame) -> DataFrame:
        x, y, most = pairs.select(F.col("x").alias("sid")), pairs.select(F.col("y").alias("sid")), pairs.count()
        return verified(pairs, few_of(full, x, most), few_of(full, y, most), hubs=True)

    met = Scratch.write(compared(meeting), "met")
    fitting = met.where(F.col("both") >= MOVES * F.greatest("xn", "yn")).join(named.withColumnRenamed("sid", "y"), "y")
    larger = fitting.join(named.select(F.col("sid").alias("x"), F.col("m").alias("xm")), "x", "left").where("xm IS NULL OR struct(m, y) < struct(xm, x)")
    goal = larger.groupBy("x").agg(F.min(F.struct("m", "y")).alias("g")).select("x", F.col("g.y").alias("y"))
    # only hubs that stay take others in
    goal = Scratch.write(goal.join(goal.select(F.col("x").alias("y")), "y", "left_anti").select("x", "y"), "goal")
    sets = own.select("x", "p").join(hubs, "p").where("x <> hub").select("x", "hub")
    last = sets.join(goal.select(F.col("x").alias("hub"), "y"), "hub", "left").select("x", F.coalesce("y", "hub").alias("y")).where("x <> y")
    moves = last.join(goal.select("x"), "x", "left_anti").union(goal)
    moves = Scratch.write(moves.union(hubs.select(F.col("hub").alias("x"), F.col("hub").alias("y")).join(goal.select("x"), "x", "left_anti")), "moves")
    pairs = sets.select("x", F.col("hub").alias("y")).union(moves.where("x <> y")).distinct().join(met.select("x", "y"), ["x", "y"], "left_anti")
    return moves, Scratch.write(compared(Scratch.write(pairs, "pairs")), "by-hub").union(met)


def rest_shingles(of: DataFrame) -> DataFrame:
    """(p, token, x, n, both, comp, out) for each shingle of ``rest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(0)]
            size = np.array([len(x) for x in parts], np.int64)
            at = pa.array(np.repeat(np.arange(len(parts)), size))
            tokens = pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([tokens, *(batch.column(k).take(at) for k in range(1, 7))], ["token", "p", "x", "n", "both", "comp", "out"])

    return of.select("rest", "p", "x", "n", "both", "comp", "out").mapInArrow(run, "token long, p long, x long, n int, both int, comp long, out boolean")


#: Differing shingles that at least this share of a pivot's sets, and so many, have in common count as part of the pivot.
OFTEN_SHARE, OFTEN = 0.05, 8


def unsettled_pairs(of: DataFrame) -> DataFrame:
    """(x, y): pairs with one pivot and different components that the pivot's answers leave open.

    The pivot is widened by the shingles that many of its sets have and it lacks itself. Then for any two of its sets
    overlap(x, y) <= least(overlap with the wide pivot) + shingles outside it that both have, and it equals both overlaps together,
    less the wide pivot, more what both lack of it, more what both have outside it. Of a pair in question one set is outside the
    pivot's component."""
    stars = of.where("out").select("p").distinct()
    some = of.join(stars, "p", "left_semi")
    shingles = Scratch.write(rest_shingles(some), "differing")
    sizes = some.groupBy("p").agg(F.count("*").alias("m"))
    counts = shingles.groupBy("p", "token").agg(F.count("*").alias("k")).join(sizes, "p")
    often = Scratch.write(counts.where((F.col("k") >= OFTEN) & (F.col("k") >= OFTEN_SHARE * F.col("m"))).select("p", "token"), "often")
    gained = shingles.join(often, ["p", "token"], "left_semi").groupBy("x").agg(F.count("*").alias("h"))
    wide = often.groupBy("p").agg(F.count("*").alias("hn"))
    set_bits = F.bit_count("b0") + F.bit_count("b1") + F.bit_count("b2") + F.bit_count("b3")
    widened = some.drop("rest").join(gained, "x", "left").join(wide, "p", "left").withColumns({
        "spare": F.col("pn") - F.col("both") - set_bits,  # lacking shingles beyond one a bit
        "both": F.col("both") + F.coalesce("h", F.lit(0)),
        "pn": F.col("pn") + F.coalesce("hn", F.lit(0)),
        "hl": F.coalesce("hn", F.lit(0)) - F.coalesce("h", F.lit(0)),  # lacking shingles of the widening
    }).drop("h", "hn")
    widened = Scratch.write(widened, "widened")
    few = shingles.join(often, ["p", "token"], "left_anti").select("p", "token", "x").join(widened.select("x", "n", "both", "comp", "out"), "x")
    few = Scratch.write(few, "few")

    left = few.where("out").select("p", "token", "x", F.col("n").alias("xn"), F.col("both").alias("xb"), F.col("comp").alias("xc"))
    right = few.select("p", "token", F.col("x").alias("y"), F.col("n").alias("yn"), F.col("both").alias("yb"), F.col("comp").alias("yc"), F.col("out").alias("yout"))
    met = left.join(right, ["p", "token"]).where("xc <> yc AND (NOT yout OR x < y) AND 4L * least(xn, yn) >= 3L * greatest(xn, yn)")
    shared = met.groupBy("x", "y").agg(F.count("*").alias("a"), F.first("xn").alias("xn"), F.first("yn").alias("yn"), F.min(F.least("xb", "yb")).alias("b"))
    sharing = shared.where("7L * (a + b) >= 3L * (xn + yn)").select("x", "y")

    x_bits, y_bits = ([F.col(b).alias(f"{side}{b}") for b in BITS] for side in "xy")
    outs = widened.where("out").select(
        "p", "pn", "x", F.col("n").alias("xn"), F.col("both").alias("xb"), F.col("comp").alias("xc"), F.col("spare").alias("xs"), F.col("hl").alias("xl"), *x_bits
    )
    classes = widened.select("p", F.col("n").alias("yn")).distinct()
    open_sizes = outs.join(classes, "p").where("7L * xb >= 3L * (xn + yn) AND 4L * least(xn, yn) >= 3L * greatest(xn, yn)")
    inside = widened.select(
        "p", F.col("n").alias("yn"), F.col("x").alias("y"), F.col("both").alias("yb"), F.col("comp").alias("yc"), F.col("out").alias("yout"), F.col("hl").alias("yl"), *y_bits
    )
    # these pairs need no shingle outside the pivot; what both lack of it is at most their common bits and what x has beyond one a bit
    lacking = "+".join(f"bit_count(x{b} & y{b})" for b in BITS)
    enough = f"7L * (xb + yb - pn + {lacking} + xs + least(xl, yl)) >= 3L * (xn + yn)"
    smaller = open_sizes.join(inside, ["p", "yn"]).where(f"xc <> yc AND (NOT yout OR x < y) AND 7L * yb >= 3L * (xn + yn) AND {enough}").select("x", "y")
    return sharing.union(smaller).distinct()


def link_classes(docs: DataFrame, index_blocks: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wide, wide_at = Scratch.write_at(prefixes(docs, frequent_shingles(docs)), "prefixes")
    total = wide.agg(F.coalesce(F.sum(F.octet_length("rare")), F.lit(0))).first()[0] // 8
    met = Scratch.write(rare_index(wide, index_blocks or min(MOST_BLOCKS, max(1, -(-total // BLOCK)))), "index")
    common = Scratch.write(common_postings(wide), "common")
    sets = Scratch.write(wide.select("doc_id", "n", "sid"), "sets")
    Scratch.drop(spark, wide_at)
    Scratch.free(spark)
    chosen = Scratch.write(sets.where("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("doc_id")), "chosen")

    by_common = Scratch.write(pivot_pairs(common), "by-common")
    starred = counted(met.where("x IS NOT NULL").select("x", "xn", "y", "yn", "c").union(by_common))
    # pivots of common lists are also measured where no link is possible: sets near a large group's pivot are then attached to it
    measured = possible(starred).select("x", "y").union(by_common.where("c > 1").select("x", "y")).distinct()
    pairs = Scratch.write(measured, "pairs")
    full, full_at = full_sets(docs, pairs, chosen)
    near = Scratch.write(verified(pairs, full.where("as_x"), full.where("as_y")), "near")
    roots = Scratch.write(components(near.where("linked").select("x", "y"), "x", "y"), "roots")

    own = Scratch.write(attachments(near), "own")
    moved, by_hub = recentred(own, members(own, roots), common, full)
    Scratch.drop(spark, full_at)
    Scratch.free(spark)
    near = near.union(by_hub)
    # classes so far stand for their links
    links = roots.select(F.col("node").alias("x"), F.col("root").alias("y")).union(by_hub.where("linked").select("x", "y"))
    roots = Scratch.write(components(links, "x", "y"), "roots")
    attached = Scratch.write(members(own.join(moved, "x", "left_anti").union(attached_to(by_hub.join(moved, ["x", "y"], "left_semi"))), roots), "members")

    nodes = near.select(F.col("x").alias("sid")).union(near.select("y")).distinct()
    labels = nodes.join(roots.withColumnRenamed("node", "sid"), "sid", "left").join(attached.select(F.col("x").alias("sid"), "p"), "sid", "left")
    labels = Scratch.write(labels.select("sid", F.coalesce("root", "sid").alias("comp"), F.coalesce("p", "sid").alias("pivot")), "labels")
    Scratch.free(spark)
    # what a pair shares among common shingles is not counted but bounded by how many of them the smaller prefix part has
    held = Scratch.write(common.groupBy("sid").agg(F.count("*").alias("k")), "held")
    across = rare_pairs(met.where("token IS NOT NULL"), labels)
    for side in "xy":
        across = across.join(held.select(F.col("sid").alias(side), F.col("k").alias(f"{side}k")), side, "left")
    more = F.least(F.coalesce("xk", F.lit(0)), F.coalesce("yk", F.lit(0)))
    across = unlabelled_alike(possible(across.select("x", "xn", "y", "yn", (F.col("c") + more).alias("c"))).select("x", "y"), labels)
    # written apart: one plan of all three has dozens of exchanges, which the driver would hold and start at the same time
    found = [Scratch.write(across, "across"), Scratch.write(cross_pairs(common, labels), "cross"), Scratch.write(unsettled_pairs(attached), "unsettled")]
    left = found[0].union(found[1]).union(found[2])
    left = left.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
    done = near.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
    pairs = Scratch.write(left.join(done, ["x", "y"], "left_anti"), "pairs")
    full, full_at = full_sets(docs, pairs, chosen)
    rest = Scratch.write(verified(pairs, full.where("as_x"), full.where("as_y")), "rest")
    Scratch.drop(spark, full_at)
    Scratch.free(spark)
    links = roots.select(F.col("node").alias("x"), F.col("root").alias("y")).union(rest.where("linked").select("x", "y"))
    roots = Scratch.write(components(links, "x", "y"), "roots")

    by_set = chosen.join(roots, chosen["sid"] == roots["node"], "left").select("sid", "doc_id", F.coalesce("root", "sid").alias("root"))
    least = by_set.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = Scratch.write(by_set.join(least, "root").select("sid", "component_id"), "classes")
    return sets.select("doc_id", F.col("n").alias("n_shingles"), "sid").join(classes, "sid", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query over all ``documents``."""
    return link_classes(spread(read_table(spark, sf_dir, "documents")))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS s FROM d WHERE len(ws) > 0),
g AS MATERIALIZED (SELECT DISTINCT doc_id, hash(array_to_string(ws[s : s + 4], ' ')) AS g FROM p),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
walk(doc_id, far) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT w.doc_id, l.y FROM walk w JOIN links l ON l.x = w.far)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(w.far)::BIGINT AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN walk w USING (doc_id) GROUP BY 1, 2
"""
