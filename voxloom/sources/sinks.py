"""Sinks: manifests, reports, text per row, segmented and sharded columnar sets, JSON results. All write new paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.ordered import ordinal, segment
from voxloom.sources.files import CSV


def write_manifest(df: DataFrame, path: str, by: str | None = "dir") -> None:
    """CSV without an index column, a folder for each directory."""
    writer = df.write.options(**{k: v for k, v in CSV.items() if k != "multiLine"})
    (writer.partitionBy(by) if by else writer).csv(path)


def write_report(df: DataFrame, path: str, score: str, *key: str) -> None:
    """A score report, worst first, ties by key, as one file: a report is read by people and as small as its selection."""
    df.orderBy(F.desc(score), *key).coalesce(1).write.options(**{k: v for k, v in CSV.items() if k != "multiLine"}).csv(path)


def write_tiers(rows: DataFrame, path: str) -> None:
    """Aligned texts by tier and gap class."""
    rows.write.partitionBy("tier", "gap_class").parquet(path)


def write_columnar(df: DataFrame, path: str, shards: int | None = None, rows_per_file: int | None = None) -> None:
    """Parquet in that many shards, or files of at most so many rows."""
    out = df.repartition(shards) if shards else df
    writer = out.write if rows_per_file is None else out.write.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def segmented(df: DataFrame, size: int, *order: str) -> DataFrame:
    """``df`` with ``segment``: rows 0 to size - 1 of the order have 0, and so on."""
    return ordinal(df, *order, name="_rn").withColumn("segment", segment(F.col("_rn"), size)).drop("_rn")


def write_segments(df: DataFrame, path: str, size: int, *order: str, done: DataFrame | None = None) -> None:
    """Segments as folders; those in ``done`` (segment) are skipped."""
    rows = segmented(df, size, *order)
    rows = rows if done is None else rows.join(F.broadcast(done.select("segment").distinct()), "segment", "left_anti")
    rows.write.mode("append").partitionBy("segment").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_texts(df: DataFrame, path: str, text: str = "text") -> None:
    """One line of text a row."""
    df.select(F.col(text).alias("value")).write.text(path)
