"""Streams over files: each runs to its end into a table of the session and returns that."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators.clip_packing import Packing
from voxloom.plans.registry import query
from voxloom.session import read_table
from voxloom.sources.files import stream
from voxloom.streaming import incremental as I


def finished(rows: DataFrame, mode: str = "append") -> DataFrame:
    """A stream's whole output. Checkpoints lie in the session's checkpoint folder, or a temporary one where none is set."""
    spark = rows.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="voxloom-stream-")
    path = f"{root.rstrip('/')}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("append" if mode == "append" else "overwrite").parquet(f"{path}/out")

    I.run_to_end(rows, f"{path}/state", write, mode)
    return spark.read.schema(rows.schema).parquet(f"{path}/out")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream; its folder is watched for this one file."""
    schema = read_table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@query("SELECT event_id, user_id FROM events WHERE event_id NOT IN (SELECT doc_id FROM labels)")
def stream_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("event_id"))
    return finished(I.undone(source(spark, sf_dir, "events").select("event_id", "user_id"), done, ["event_id"]))


@query()
def stream_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("part"), F.col("event_id").alias("ord"), F.col("event_id").cast("string").alias("clip"),
        (F.pmod(F.col("event_id") * 37, F.lit(900)) + 100).alias("length"),
    )
    return finished(I.pack_stream(rows, Packing(window=3000, pause_least=500, pause_most=1000)))


@query("SELECT event_type, time_bucket(INTERVAL '5 minutes', ts) AS start, count(*) AS n FROM events GROUP BY 1, 2")
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = I.windowed_counts(source(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type")
    return finished(counts, "complete").select("event_type", F.col("window.start").cast("timestamp_ntz").alias("start"), "n")
