"""Operators that depend on an order: budgets, shards, segments, cyclic choices, ordinals.

A global ordinal never goes through one task: rows are range-partitioned by the order, numbered inside their partition, and shifted
by the counts of the partitions before, of which there are as many as shuffle partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

INDEX_BITS = 33


def ordinal(df: DataFrame, *order: str | Column, name: str = "rn") -> DataFrame:
    """``df`` with a gapless number from 0 by ``order``, which must tell all rows apart."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    tagged = ranged.withColumn("_part", F.shiftright("_id", INDEX_BITS)).withColumn("_at", F.col("_id").bitwiseAND(F.lit((1 << INDEX_BITS) - 1)))
    counts = tagged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return tagged.join(F.broadcast(first), "_part").withColumn(name, F.col("_first") + F.col("_at")).drop("_id", "_part", "_at", "_first")


def within_budget(
    items: DataFrame, by: list[str], newest: list[Column], seconds: Column, usable: Column, limit: Column | float, most: int = 170
) -> DataFrame:
    """Items of each group, newest first, until the durations taken pass the limit; the one that crosses it stays. Unusable items
    take no time but count among the ``most`` that are looked at."""
    w = Window.partitionBy(*by).orderBy(*newest)
    spent = F.sum(F.when(usable, seconds).otherwise(F.lit(0.0))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    seen = items.withColumn("_spent", F.coalesce(spent, F.lit(0.0))).withColumn("_n", F.row_number().over(w))
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    return seen.where(usable & (F.col("_spent") <= limit) & (F.col("_n") <= most)).drop("_spent", "_n")


def range_shard(rn: Column, total: Column, shards: int) -> Column:
    """The shard t whose rows are from int(t*n/T) to int((t+1)*n/T); rn from 0."""
    return F.floor(((rn + 1) * shards - 1) / total).cast("long")


def segment(rn: Column, size: int) -> Column:
    """Which run of ``size`` rows a row belongs to."""
    return F.floor(rn / F.lit(size)).cast("long")


def cyclic(rn: Column, n: int) -> Column:
    """1, 2, ..., n, 1, ..."""
    return (F.pmod(rn, F.lit(n)) + 1).cast("long")


def every(rn: Column, k: int) -> Column:
    """Whether a row is one of each k."""
    return F.pmod(rn, F.lit(k)) == 0


def group_ordinal(df: DataFrame, by: list[str], order: list[str], name: str = "n") -> DataFrame:
    """A number from 1 in each group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def rows_between(df: DataFrame, first: int, last: int, *order: str) -> DataFrame:
    """Rows ``first`` to ``last`` - 1 of the order."""
    return ordinal(df, *order, name="_rn").where(F.col("_rn").between(first, last - 1)).drop("_rn")


def resume_point(names: DataFrame, column: str = "stem") -> DataFrame:
    """(next): the largest number among the names, 1 where there is none."""
    return names.agg(F.coalesce(F.max(F.col(column).try_cast("long")), F.lit(1).cast("long")).alias("next"))
