"""Manifests: matching audio with labels, skipping what is done, deleting by list, merging tiers. Nothing is removed from disk;
each operator returns the rows that stay or go."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.text import contributor
from voxloom.functions.wer import corpus_wer, word_edits


def matched(audio: DataFrame, labels: DataFrame, on: list[str]) -> DataFrame:
    """Audio with its label."""
    return audio.join(labels, on, "inner")


def unmatched(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``left`` without a partner; also the not-yet-done filter, with the done listing as ``right``."""
    return left.join(right.select(*on), on, "left_anti")


def kept(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``left`` with a partner."""
    return left.join(right.select(*on), on, "left_semi")


def mismatches(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Keys on one side only, with ``side``: 'left_only' or 'right_only'."""
    a = left.select(*on).distinct().withColumn("_a", F.lit(True))
    b = right.select(*on).distinct().withColumn("_b", F.lit(True))
    side = F.when(F.col("_b").isNull(), F.lit("left_only")).otherwise(F.lit("right_only"))
    return a.join(b, on, "full_outer").where("_a IS NULL OR _b IS NULL").select(*on, side.alias("side"))


def delete_list(*lists: DataFrame, column: str = "file") -> DataFrame:
    """(dir, file_name) from the distinct union of lists of paths."""
    every = reduce(DataFrame.union, [x.select(column) for x in lists]).distinct()
    return every.select(F.regexp_extract(column, r"^(.*)/[^/]*$", 1).alias("dir"), F.element_at(F.split(column, "/"), -1).alias("file_name"))


def files_by_parent(paths: DataFrame, column: str = "file") -> DataFrame:
    """(dir, files): the distinct names of each directory, sorted."""
    return delete_list(paths, column=column).groupBy("dir").agg(F.array_sort(F.collect_set("file_name")).alias("files"))


def pruned_dirs(audio_dirs: DataFrame, aligned: DataFrame, depth: int = 3) -> DataFrame:
    """(dir, keep): an audio directory stays if an aligned one, of that many parts and with a text, has its name."""
    valid = aligned.where(F.size(F.split("dir", "/")) == depth).where("n_txt > 0").select("dir").distinct()
    return audio_dirs.join(valid.withColumn("_ok", F.lit(True)), "dir", "left").select("dir", F.col("_ok").isNotNull().alias("keep"))


def tiers(rows: DataFrame, take_gap: bool) -> DataFrame:
    """Aligned rows that go into a manifest: those without a gap class, those without gaps, and gapped ones if asked."""
    good = F.col("gap_class").isNull() | F.col("gap_class").isin("nogap", *(["gap"] if take_gap else []))
    return rows.where(good)


def union_all(*tables: DataFrame, drop: tuple[str, ...] = ("is_changed",)) -> DataFrame:
    """All rows of tables whose columns may drift; optional columns are dropped first."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.drop(*drop) for t in tables])


def union_same(*tables: DataFrame) -> DataFrame:
    """All rows of tables that must have the same columns; another header is an error, not a row."""
    names = [sorted(t.columns) for t in tables]
    if any(n != names[0] for n in names):
        raise ValueError(f"the tables differ in columns: {names}")
    return reduce(DataFrame.unionByName, tables)


def union_by_channel(files: DataFrame, name: str = "file_name") -> DataFrame:
    """``files`` with the channel that the third part of a file's name tells."""
    return files.withColumn("channel", F.get(F.split(name, "_"), F.lit(2)))


def contributions(files: DataFrame, name: str = "file_name") -> DataFrame:
    """(name, id, num): labelled files of each contributor."""
    return files.select(contributor(F.col(name)).alias("c")).groupBy("c.name", "c.id").agg(F.count("*").alias("num"))


def with_fixes(original: DataFrame, fixed: DataFrame, on: list[str]) -> DataFrame:
    """Original labels with the fixed text, null where there is none."""
    return original.join(fixed, on, "left")


def accepted_folders(
    pairs: DataFrame, folder: str = "dir", original: str = "original", fixed: str = "fixed",
    least_files: int = 3, least_share: float = 0.1, most_wer: float = 8.0, least_perfect: int = 5,
) -> DataFrame:
    """(folder, n_files, n_done, n_perfect, wer, accepted) from label pairs; fixed is null where nothing was done.

    Accepted: enough is done, enough of it is unchanged, and the word error rate between both is low."""
    ref, hyp = F.split(F.col(original), " "), F.split(F.col(fixed), " ")
    ref, hyp = F.array_remove(ref, ""), F.array_remove(hyp, "")
    done = F.col(fixed).isNotNull()
    each = pairs.select(
        folder, done.alias("done"), (done & (F.col(original) == F.col(fixed))).alias("same"),
        F.when(done, word_edits(ref, hyp)).alias("edits"), F.when(done, F.size(ref)).alias("words"),
    )
    sums = each.groupBy(folder).agg(
        F.count("*").alias("n_files"), F.count_if("done").alias("n_done"), F.count_if("same").alias("n_perfect"),
        corpus_wer(F.col("edits"), F.col("words")).alias("wer"),
    )
    good = (
        (F.col("n_done") >= F.col("n_files") * least_share) & (F.col("n_done") >= least_files)
        & (F.col("n_perfect") >= F.least(F.lit(least_perfect), F.col("n_files"))) & (F.col("wer") <= most_wer)
    )
    return sums.withColumn("accepted", F.coalesce(good, F.lit(False)))


def marked_done(queue: DataFrame, at: Column, column: str = "is_complete") -> DataFrame:
    """A work queue with the flag set on the rows that ``at`` names; written elsewhere, as inputs stay."""
    return queue.withColumn(column, F.when(at, F.lit(1)).otherwise(F.col(column)))


def null_split(rows: DataFrame, column: str = "transcription") -> tuple[DataFrame, DataFrame]:
    """(rows with a text, rows without)."""
    return rows.where(F.col(column).isNotNull()), rows.where(F.col(column).isNull())


def reconciled(recordings: DataFrame, chunks: DataFrame, on: str, raw: str, part: str) -> DataFrame:
    """(key, raw_duration, splited_duration) of recordings and the sum of their chunks, 0 where there are none."""
    sums = chunks.groupBy(on).agg(F.sum(part).alias("_sum"))
    return recordings.join(sums, on, "left").select(on, F.col(raw).alias("raw_duration"), F.coalesce("_sum", F.lit(0.0)).alias("splited_duration"))


def hours(clips: DataFrame, by: str, seconds: str) -> DataFrame:
    return clips.groupBy(by).agg((F.sum(seconds) / 3600).alias("hours"))


def argmax(rows: DataFrame, by: list[str], value: str, weight: str) -> DataFrame:
    """The value with the largest weight in each group; ties go to the smallest value."""
    best = F.min_by(F.col(value), F.struct(-F.col(weight).cast("double"), F.col(value)))
    return rows.groupBy(*by).agg(best.alias(value))


def joined_text(rows: DataFrame, by: list[str], order: str, text: str, separator: str) -> DataFrame:
    """The texts of each group in order, joined. One group's texts meet in a task: a recording, not a corpus."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return rows.groupBy(*by).agg(F.array_join(F.transform(ordered, lambda x: x["t"]), separator).alias(text))
