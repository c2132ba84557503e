"""Vocabulary counts, unseen words, synthetic sentences."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.operators.sampling import binary_pattern, draws_with_replacement


def word_counts(rows: DataFrame, words: Column, dedup: bool = False) -> DataFrame:
    """(word, num): compound words and their syllables. A word of one syllable counts as both, unless ``dedup``.

    Each word brings its syllables along, so that the rows are read and split once."""
    parts = F.split("word", " ")
    syllables = F.array_remove(F.coalesce(parts, F.array().cast("array<string>")), "")
    if dedup:
        syllables = F.when(F.size(parts) > 1, syllables).otherwise(F.array().cast("array<string>"))
    each = rows.select(F.explode(words).alias("word"))
    return each.select(F.explode(F.concat(F.array("word"), syllables)).alias("word")).groupBy("word").agg(F.count("*").alias("num"))


def unseen_terms(vocabulary: DataFrame, seen: DataFrame, column: str = "word") -> DataFrame:
    """Terms of the vocabulary that were not seen and hold at least one syllable that was not."""
    fresh = vocabulary.select(column).distinct().join(seen.select(column).distinct(), column, "left_anti")
    parts = fresh.select(column, F.explode(F.split(column, " ")).alias("_part")).where("_part <> ''")
    known = seen.select(F.col(column).alias("_part")).distinct()
    return parts.join(known, "_part", "left_anti").select(column).distinct()


def sentence(unseen: Column, seen: Column, length: int, share: float, seed: int, *key: str | Column) -> Column:
    """ceil(length * share) unseen words and seen ones for the rest, in a shuffled pattern."""
    n = math.ceil(length * share)
    one = draws_with_replacement(unseen, F.lit(n), seed, *key)
    two = draws_with_replacement(seen, F.lit(length - n), seed + 1, *key)
    pattern = binary_pattern(F.lit(n), F.lit(length), seed + 2, *key)
    placed = F.transform(
        pattern,
        lambda x, i: F.when(x == 1, F.get(one, F.aggregate(F.slice(pattern, 1, i), F.lit(0), lambda s, y: s + y)))
        .otherwise(F.get(two, i - F.aggregate(F.slice(pattern, 1, i), F.lit(0), lambda s, y: s + y))),
    )
    return F.trim(F.array_join(placed, " "))


def totals(rows: DataFrame, by: list[str], words: Column) -> DataFrame:
    """Sentences, words and words a sentence of each group."""
    sums = rows.groupBy(*by).agg(F.count("*").alias("n_sentences"), F.coalesce(F.sum(F.size(words).cast("long")), F.lit(0)).alias("n_words"))
    return sums.withColumn("mean_words", F.col("n_words") / F.col("n_sentences"))
