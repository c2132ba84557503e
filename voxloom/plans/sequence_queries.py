"""Alignment, packing, pluggable maps and streams over the driver's tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators import clip_packing as K
from voxloom.operators import mapper
from voxloom.operators.alignment import Policy, align_column, align_recordings
from voxloom.plans.registry import query
from voxloom.plans.wer_queries import pairs
from voxloom.session import read_table, spread


@query()
def sw_align_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pairs(spark, sf_dir).select("conv_id", "turn", align_column(F.col("label"), F.col("pred")).alias("a"))
    return rows.select("conv_id", "turn", "a.score", "a.matches", "a.mismatches", "a.gap_count", "a.cigar", "a.overall_accuracy")


@query()
def sw_align_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pairs(spark, sf_dir).select("conv_id", "turn", align_column(F.col("label"), F.col("pred"), "char").alias("a"))
    return rows.select("conv_id", "turn", "a.score", "a.matches", "a.mismatches", "a.cigar", "a.overall_accuracy")


@query()
def align_recording(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spread(read_table(spark, sf_dir, "conversations"))
    rec = F.col("conv_id").cast("string")
    whole = turns.groupBy(rec.alias("rec")).agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    targets = whole.select("rec", F.array_join(F.transform("t", lambda x: x["text"]), " ").alias("text"))
    queries = turns.select(rec.alias("rec"), F.col("turn").alias("ord"), F.concat(F.col("turn").cast("string"), F.lit(".txt")).alias("file_name"), "text")
    return align_recordings(targets, queries, Policy()).select("rec", "file_name", "tier", "gap_class", "accuracy", "r_pos", "r_end")


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(part, ord, clip, length): lineitems of a supplier in order; quantities are seconds at 100 samples."""
    rows = read_table(spark, sf_dir, "lineitem")
    name = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"))
    return rows.select(F.col("l_suppkey").cast("string").alias("part"), F.col("l_orderkey").alias("ord"), name.alias("clip"), (F.col("l_quantity") * 100).cast("long").alias("length"))


SECONDS = {"window": 3000, "pause_least": 500, "pause_most": 1000}


@query()
def pack_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.pack_clips(clips(spark, sf_dir), K.Packing(**SECONDS))


@query()
def pack_clips_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.pack_clips(clips(spark, sf_dir), K.Packing(K.UNLABELLED, **(SECONDS | {"pause_most": 700})))


@query()
def pack_clips_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.pack_clips(clips(spark, sf_dir).where("ord > 100"), K.Packing(K.STREAMED, pad=0, **SECONDS))


def upper_model():
    """Stands for a model that is loaded once a task."""

    def run(table: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": table["doc_id"], "text": table["text"].fillna("").str.upper()})

    return run


@query("SELECT doc_id, replace(upper(text), 'ẞ', 'SS') AS text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def transcribe_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = spread(read_table(spark, sf_dir, "documents")).select("doc_id", "text")
    return mapper.apply(todo, upper_model, "doc_id long, text string", read_table(spark, sf_dir, "labels"), ["doc_id"])
