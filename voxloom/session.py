"""Session helpers shared by every part of the engine."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below ``sf_dir``, which may lie in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A table of fewer stored bytes than this for each core may lie in a single row group, which is a single task.
LEAST_A_CORE = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where it is too small to be read by all: a small file is often one row group, and so one task however
    much work its rows are. Larger tables are left as they are read; the rows are the same."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if 1 < cores and size < cores * LEAST_A_CORE else df


def share_package(spark: SparkSession) -> SparkSession:
    """Lets Python workers on machines that see this folder import the package without further settings."""
    root = str(Path(__file__).resolve().parent.parent)
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A local session with the settings that tests and benchmarks use."""
    return share_package(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("voxloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
