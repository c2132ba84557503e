"""Shuffles, splits and samples that depend on keys and a seed only, never on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def draw(seed: int, *key: str | Column) -> Column:
    """A pseudo-random long from 0 for a key: the first 60 bits of an MD5, which other engines compute alike."""
    named = F.concat_ws("|", *((F.col(k) if isinstance(k, str) else k).cast("string") for k in key), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 15), 16, 10).cast("long")


def uniform(seed: int, *key: str | Column) -> Column:
    """A pseudo-random double in [0, 1) for a key."""
    return F.pmod(draw(seed, *key), F.lit(1 << 53)) / F.lit(float(1 << 53))


def shuffled(df: DataFrame, seed: int, *key: str) -> DataFrame:
    """A global shuffle, as a sort by hash: range partitions, no single task."""
    return df.orderBy(draw(seed, *key), *key)


def hash_split(df: DataFrame, share: float, seed: int, *key: str) -> DataFrame:
    """``df`` with ``split``: 'test' for about that share of the keys."""
    return df.withColumn("split", F.when(uniform(seed, *key) < share, F.lit("test")).otherwise(F.lit("train")))


def arithmetic_split(df: DataFrame, column: str, share: float) -> DataFrame:
    """The same for an integer key, by a multiplicative congruence that other engines compute alike."""
    spread = F.pmod(F.col(column) * 1103515245 + 12345, F.lit(1 << 31))
    return df.withColumn("split", F.when(spread < int(share * (1 << 31)), F.lit("test")).otherwise(F.lit("train")))


def exact_split(df: DataFrame, n_test: int, seed: int, *key: str) -> DataFrame:
    """Exactly that many test rows (fewer in a smaller table): those with the smallest hashes. Keys must be unique."""
    chosen = df.select(*key).orderBy(draw(seed, *key), *key).limit(n_test).withColumn("_t", F.lit(True))
    return df.join(chosen, list(key), "left").withColumn("split", F.when(F.col("_t"), F.lit("test")).otherwise(F.lit("train"))).drop("_t")


def capped(df: DataFrame, by: list[str], most: int, order: list[Column | str]) -> DataFrame:
    """At most so many rows of each group, by an order: this operator is the cap itself."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


def pick_undone(items: DataFrame, done: DataFrame, on: list[str], seed: int) -> DataFrame:
    """One item that is not done yet, by seed; empty if all are."""
    return items.join(done.select(*on), on, "left_anti").orderBy(draw(seed, *on), *on).limit(1)


def random_index(n: Column | int, seed: int, *key: str | Column) -> Column:
    """0 to n - 1."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(draw(seed, *key), n).cast("int")


def draws_with_replacement(values: Column, count: Column, seed: int, *key: str | Column) -> Column:
    """``count`` entries of an array, drawn with replacement."""
    each = F.transform(F.sequence(F.lit(1), count), lambda i: F.element_at(values, (F.pmod(draw(seed, *key, i), F.size(values).cast("long")) + 1).cast("int")))
    return F.when(count > 0, each).otherwise(F.slice(values, 1, 0))


def binary_pattern(ones: Column, length: Column, seed: int, *key: str | Column) -> Column:
    """An array of 0 and 1 with exactly so many ones, shuffled by hash; more ones than places is an error."""
    plain = F.concat(F.array_repeat(F.lit(1), ones), F.array_repeat(F.lit(0), length - ones))
    mixed = F.transform(F.array_sort(F.transform(plain, lambda x, i: F.struct(draw(seed, *key, i).alias("h"), x.alias("x")))), lambda s: s["x"])
    return F.when(ones > length, F.raise_error(F.lit("more ones than places"))).otherwise(mixed)
