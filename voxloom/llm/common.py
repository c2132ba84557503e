"""Expressions and small plans that several operators of this subpackage share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII white space, and what the contracts call a line's or word's edges.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` computed once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """Only A-Z lower-cased. Pure ASCII texts take the quicker built-in, which then does the same."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def pieces(text: Column, separator: str) -> Column:
    """The non-empty pieces of a text between runs of a separator class; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator), "")


def blank_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null gives none."""
    return pieces(text, BLANK_RUN)


def key128(value: Column) -> tuple[Column, Column]:
    """Two independently seeded 64-bit hashes of a value, together a 128-bit key."""
    return F.xxhash64(value), F.xxhash64(F.lit("voxloom"), value)


class Scratch:
    """Written tables in the folder that ``spark.checkpoint.dir`` names: they cut lineage, survive the loss of any
    executor and go when the session ends. Only where the setting is missing, as in tests, a folder is made for it."""

    _at: dict[str, str] = {}

    @classmethod
    def folder(cls, spark: SparkSession) -> str:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root is None:
            root = cls._at.get("own")
            if root is None:
                root = cls._at["own"] = tempfile.mkdtemp(prefix="voxloom-")
        app = spark.sparkContext.applicationId
        if app not in cls._at:
            cls._at[app] = f"{root.rstrip('/')}/voxloom-{app}"
            atexit.register(cls._remove, spark, cls._at[app])
        return cls._at[app]

    @staticmethod
    def _remove(spark: SparkSession, path: str) -> None:
        try:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # the session has already ended; its shared folder goes with the cluster's clean-up
            return

    @classmethod
    def write(cls, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a written table."""
        return cls.write_at(df, name)[0]

    @classmethod
    def write_at(cls, df: DataFrame, name: str) -> tuple[DataFrame, str]:
        """``df`` as a written table, and where it is."""
        spark = df.sparkSession
        path = f"{cls.folder(spark)}/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    @classmethod
    def drop(cls, spark: SparkSession, path: str) -> None:
        """Removes a written table that no later plan reads."""
        cls._remove(spark, path)

    @staticmethod
    def free(spark: SparkSession) -> None:
        """Has the driver collect its garbage, for operators of many queries: only then do broadcasts and shuffle files of ended
        queries go, and does its heap shrink again."""
        spark._jvm.System.gc()


def numbered(df: DataFrame, name: str, within: list[str], order: list[str], buckets: int) -> DataFrame:
    """``df`` with a gapless number from 0 in each group of ``within``, without a task for a whole group.

    Rows are dealt by a hash of ``order`` (which must name a unique key) into ``buckets``; only the counts by group
    and bucket, whose number is bounded by ``buckets`` times the groups, are brought together to give each bucket's
    first number. The order of numbers follows (bucket, order) and so is the same for every run."""
    bucket, first, at = f"_{name}_bucket", f"_{name}_first", f"_{name}_at"
    dealt = df.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(*within, bucket).count()
    before = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*within, bucket, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(first))
    ranked = dealt.withColumn(at, F.row_number().over(Window.partitionBy(*within, bucket).orderBy(*order)) - 1)
    joined = ranked.join(starts, [*within, bucket])
    return joined.withColumn(name, F.col(first) + F.col(at)).drop(bucket, first, at)


#: Up to so many links (16 bytes each, and about 100 in passing) are followed by one task; more take rounds over all tasks.
MOST_LINKS = 1_000_000


def reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the nodes of the links, sorted, the smallest node that each can reach)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return nodes, nodes[root]


def reached_at_once(links: DataFrame) -> DataFrame:
    """``(node, root)`` by a single task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        got += [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
        found = reached(*(np.concatenate(c) for c in zip(*got, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["node", "root"])

    return links.coalesce(1).mapInArrow(run, "node long, root long")


def components(edges: DataFrame, a: str, b: str, most_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges``; ``root`` is the smallest node it can reach.

    Few links are followed by one task: each round plans three queries, and what the driver holds follows the queries it plans.
    Beyond that it alternates the large-star and small-star steps of Kiveris et al. (2014) on DataFrames: each is one grouped
    minimum and one join. Every round is a written table, so lineage stays short. A node with very many links only
    meets others in a grouped minimum, which is pre-aggregated, and in a join that adaptive execution may split."""
    spark = edges.sparkSession
    now, path = Scratch.write_at(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"
    )
    before = now.count()
    if before <= MOST_LINKS:
        return reached_at_once(now)
    for _ in range(most_rounds):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.where("u <> v")
        small_least = low.groupBy("u").agg(F.min("v").alias("m"))
        small = low.join(small_least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small_least)
        new, new_path = Scratch.write_at(small.where("u <> v").distinct(), "links")
        size = new.count()
        changed = size != before or new.join(now, ["u", "v"], "left_anti").limit(1).count() > 0
        Scratch.drop(spark, path)
        Scratch.free(spark)
        now, path, before = new, new_path, size
        if not changed:
            break
    else:
        raise RuntimeError("components: the links did not settle")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
