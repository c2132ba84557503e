"""Ordered queries: customers are channels, orders are videos, lineitems are clips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators import ordered as O
from voxloom.operators import sampling as S
from voxloom.plans.registry import query, sql_draw
from voxloom.session import read_table
from voxloom.sources.sinks import segmented


@query("""
WITH v AS (
  SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus <> 'F' AS ok, row_number() OVER w AS n,
    coalesce(sum(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey))
SELECT o_custkey, o_orderkey, o_totalprice FROM v WHERE ok AND spent <= 300000 AND n <= 10
""")
def budget_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    videos = read_table(spark, sf_dir, "orders")
    got = O.within_budget(videos, ["o_custkey"], [F.desc("o_orderdate"), F.col("o_orderkey")], F.col("o_totalprice"), F.col("o_orderstatus") != "F", 300000.0, most=10)
    return got.select("o_custkey", "o_orderkey", "o_totalprice")


NUMBERED = "(SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS rn, count(*) OVER () AS n FROM documents)"


@query(f"SELECT doc_id, (((rn + 1) * 7 - 1) // n)::BIGINT AS shard FROM {NUMBERED}")
def range_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    total = F.lit(docs.count())
    return O.ordinal(docs, "doc_id").select("doc_id", O.range_shard(F.col("rn"), total, 7).alias("shard"))


@query(f"SELECT doc_id, (rn // 64)::BIGINT AS segment FROM {NUMBERED}")
def segment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmented(read_table(spark, sf_dir, "documents").select("doc_id"), 64, "doc_id")


@query(f"SELECT doc_id, (rn % 5 + 1)::BIGINT AS effect_index, rn % 3 = 0 AS augmented FROM {NUMBERED}")
def cyclic_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = O.ordinal(read_table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    return numbered.select("doc_id", O.cyclic(F.col("rn"), 5).alias("effect_index"), O.every(F.col("rn"), 3).alias("augmented"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)::INTEGER AS n FROM lineitem")
def file_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "lineitem")
    return O.group_ordinal(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_partkey", "n")


@query(f"SELECT doc_id FROM {NUMBERED} WHERE rn BETWEEN 100 AND 149")
def slice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.rows_between(read_table(spark, sf_dir, "documents").select("doc_id"), 100, 150, "doc_id")


@query("SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS k FROM documents) WHERE k <= 3")
def top_k_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return S.capped(docs, ["source"], 3, [F.desc("n_chars"), F.col("doc_id")])


@query("SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY (doc_id * 7919) % 10007, doc_id) AS k FROM documents) WHERE k <= 20")
def cap_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("source", "doc_id")
    return S.capped(docs, ["source"], 20, [(F.col("doc_id") * 7919) % 10007, F.col("doc_id")])


@query("SELECT doc_id, CASE WHEN (doc_id * 1103515245 + 12345) % 2147483648 < 64424509 THEN 'test' ELSE 'train' END AS split FROM documents")
def arithmetic_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.arithmetic_split(read_table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.03)


DRAW = sql_draw(7, "doc_id")


@query(f"SELECT doc_id, CASE WHEN ({DRAW} % {1 << 53})::DOUBLE / {1 << 53} < 0.03 THEN 'test' ELSE 'train' END AS split FROM documents")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.hash_split(read_table(spark, sf_dir, "documents").select("doc_id"), 0.03, 7, "doc_id")


@query(f"SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {DRAW}, doc_id) <= 30 THEN 'test' ELSE 'train' END AS split FROM documents")
def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.exact_split(read_table(spark, sf_dir, "documents").select("doc_id"), 30, 7, "doc_id")


@query(f"SELECT doc_id, source, {DRAW} AS place FROM documents ORDER BY place, doc_id")
def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = S.shuffled(read_table(spark, sf_dir, "documents").select("doc_id", "source"), 7, "doc_id")
    return mixed.withColumn("place", S.draw(7, "doc_id"))


@query(f"SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY {DRAW}, doc_id LIMIT 1")
def pick_undone(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return S.pick_undone(docs, read_table(spark, sf_dir, "labels"), ["doc_id"], 7)
