"""Documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import decontaminate, jaccard_join, line_dedup, packing, quality_rules
from voxloom.llm.common import BLANKS, Scratch
from voxloom.session import read_table, spread

#: Up to so many doc_ids (8 bytes each) are sent to every task; a longer list is joined by shuffle.
MOST_SENT = 1_000_000


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the doc_ids in ``gone``."""
    gone = Scratch.write(gone.select("doc_id").distinct(), "gone")
    return docs.join(F.broadcast(gone) if gone.count() <= MOST_SENT else gone, "doc_id", "left_anti").select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned decision list reject go."""
    return quality_rules.judged(docs, read_table(spark, sf_dir, "labels")).where("kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; so does a document that has nothing else."""
    got = line_dedup.deduplicated(docs).where((F.col("n_dropped") == 0) | (F.btrim("text", F.lit(BLANKS)) != ""))
    return got.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each class of linked documents stays."""
    return without(docs, jaccard_join.link_classes(docs).where("doc_id <> component_id"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return without(docs, decontaminate.hits(docs, read_table(spark, sf_dir, "benchmark")).where("n_hit > 0"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequences and offsets."""
    return packing.packed(Scratch.write(packing.pieces(docs), "pieces"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("packing", packed),
]

#: The decision list is learned and the ids come from a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a written table, read again by the next."""
    docs = spread(read_table(spark, sf_dir, "documents"))
    for name, stage in STAGES:
        docs = Scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
