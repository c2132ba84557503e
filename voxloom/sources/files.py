"""Sources: files, texts, CSV manifests, prompts, audio folders, columnar sets, JSON state. Schemas are stated, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators.paths import with_parts

MANIFEST = "file_name string, transcription string"
PACKED_MANIFEST = f"{MANIFEST}, type string"
WER_REPORT = "file string, whisper_script string, assigned_label string, wer_error double"
EVALUATION = "pred string, label string, pred_wer double, path string"
AUGMENT_PLAN = "audio string, effect_index int, out_files string"
CHANNEL_QUEUE = "channel_link string, duration_limit int, flag int, is_complete int"
VIDEO_INFO = "title string, seconds double, link string, transcript string"
READING_STATE = "last_file_reading string, final_read_segment int"
CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "nullValue": "", "emptyValue": ""}


def files(spark: SparkSession, root: str, pattern: str = "*", content: bool = False) -> DataFrame:
    """All files below a root that match a pattern: path, length, modificationTime, their parts, and their bytes if asked."""
    got = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    got = got if content else got.drop("content")
    return with_parts(got.withColumn("path", F.regexp_replace("path", "^file:/+", "/")), "path", root)


def texts(spark: SparkSession, root: str, pattern: str = "*.txt") -> DataFrame:
    """Whole text files with their path parts."""
    got = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root, wholetext=True)
    named = got.select(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("path"), F.col("value").alias("text"))
    return with_parts(named, "path", root)


def manifest(spark: SparkSession, path: str, schema: str = MANIFEST) -> DataFrame:
    """A CSV with a header and quoted line breaks; an empty field is null. ``dir`` tells the folder of the file."""
    got = spark.read.options(**CSV).schema(schema).csv(path)
    return got.withColumn("dir", F.regexp_replace(F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1), "^file:/+", "/"))


def links(spark: SparkSession, path: str, schema: str = VIDEO_INFO) -> DataFrame:
    """Crawl rows whose link is there; short rows read as null and go."""
    return spark.read.options(**CSV).schema(schema).csv(path).where(F.col("link").isNotNull())


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """(word) for each line; an empty last line is no word."""
    return spark.read.text(path).where("value <> ''").select(F.col("value").alias("word"))


def prompts(spark: SparkSession, path: str) -> DataFrame:
    """(speaker, file_name, text) from lines ``speaker_utterance word word ...``."""
    parts = F.split("value", " ", 2)
    speaker = F.get(F.split(F.get(parts, F.lit(0)), "_"), F.lit(0))
    return spark.read.text(path).where("value <> ''").select(
        speaker.alias("speaker"), F.concat(speaker, F.lit("/"), F.get(parts, F.lit(0)), F.lit(".wav")).alias("file_name"),
        F.lower(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))).alias("text"),
    )


def audio_folder(spark: SparkSession, root: str, metadata: DataFrame | None = None) -> DataFrame:
    """Audio files with bytes and, if a manifest (dir, file_name, ...) is given, its columns; without one, labels are left out."""
    audio = files(spark, root, "*.wav", content=True).withColumn("dir", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    return audio if metadata is None else audio.withColumnRenamed("name", "file_name").join(metadata, ["dir", "file_name"])


def columnar(spark: SparkSession, root: str, optional: tuple[str, ...] = ("is_changed",)) -> DataFrame:
    """All Parquet sets below a root as one table, columns that may be missing dropped."""
    return spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(root).drop(*optional)


def state(spark: SparkSession, path: str, schema: str = READING_STATE) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def stream(spark: SparkSession, root: str, schema, per_trigger: int = 1) -> DataFrame:
    """Parquet files as a stream of records, some files a trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(root)
