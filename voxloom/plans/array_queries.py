"""Array queries: ``embeddings`` stand for samples, token lengths for labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions import arrays as A
from voxloom.functions import text as T
from voxloom.operators import audio as W
from voxloom.operators.mapper import padded_batch
from voxloom.operators.vocabulary import sentence
from voxloom.plans.registry import query, quoted, sql_draw
from voxloom.plans.text_queries import sql_tokens
from voxloom.session import read_table, spread


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "embeddings")).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


@query("""
WITH c AS (SELECT vec_id, embedding AS x, unnest(generate_series(1, (len(embedding) + 19) // 20)) AS n FROM embeddings)
SELECT vec_id, n::INTEGER AS n, len(x[20 * n - 19 : 20 * n])::INTEGER AS filled, 20 AS size, round(list_sum(list_transform(x[20 * n - 19 : 20 * n], lambda v: v::DOUBLE)), 6) AS total FROM c
""")
def fixed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = W.chunk_rows(samples(spark, sf_dir), "vec_id", "x", 20)
    sizes = samples(spark, sf_dir).select("vec_id", F.size("x").alias("all"))
    total = F.aggregate("chunk", F.lit(0.0), lambda s, x: s + x)
    return chunks.join(sizes, "vec_id").select(
        "vec_id", "n", F.least(F.lit(20), F.col("all") - (F.col("n") - 1) * 20).alias("filled"), F.size("chunk").alias("size"), F.round(total, 6).alias("total")
    )


@query("SELECT doc_id, (doc_id % 50) * 24 + 1 AS first, least((doc_id % 50 + 1) * 24, n_chars) AS last FROM documents")
def segment_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", A.segment_range(F.col("doc_id") % 50 + 1, F.col("n_chars")).alias("r")).select("doc_id", "r.first", "r.last")


@query("""
SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE)) / len(embedding)), 6) AS rms FROM embeddings
WHERE sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE)) / len(embedding)) >= 0.12
""")
def rms_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir).select("vec_id", A.rms(F.col("x")).alias("rms"))
    return rows.where("rms >= 0.12").select("vec_id", F.round("rms", 6).alias("rms"))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 30")
def long_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").where("l_quantity > 30").select("l_orderkey", "l_linenumber", "l_quantity")


LABELS = f"(SELECT doc_id, doc_id // 16 AS batch, list_transform({sql_tokens('text')}, lambda w: length(w)::INTEGER) AS labels FROM documents)"


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.transform(T.tokens(F.col("text")), F.char_length)
    return read_table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 16).alias("batch"), ids.alias("labels"))


@query(f"""
SELECT doc_id, batch, list_concat(labels, list_transform(generate_series(1, n - len(labels)), lambda i: -100)) AS labels
FROM (SELECT *, max(len(labels)) OVER (PARTITION BY batch) AS n FROM {LABELS})
""")
def pad_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return padded_batch(labels(spark, sf_dir), "batch", "labels").select("doc_id", "batch", "labels")


@query(f"""
SELECT doc_id, list_transform(list_concat(labels, [-100, -100]), lambda x: CASE WHEN x = -100 THEN 50257 ELSE x END) AS labels,
  CASE WHEN labels[1] = 3 THEN labels[2:] ELSE labels END AS bare FROM {LABELS}
""")
def restore_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = F.concat("labels", F.array(F.lit(-100), F.lit(-100)))
    return labels(spark, sf_dir).select("doc_id", A.restored_labels(filled, 50257).alias("labels"), A.without_first(F.col("labels"), 3).alias("bare"))


@query("""
SELECT vec_id, list_concat(list_transform(generate_series(1, 10), lambda i: 0.0::DOUBLE), list_transform(embedding, lambda v: v::DOUBLE),
  list_transform(generate_series(1, 15), lambda i: 0.0::DOUBLE)) AS mixed FROM embeddings
""")
def mix_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples(spark, sf_dir).select("vec_id", A.mixed_in(A.zeros(F.size("x") + 25), F.col("x"), F.lit(10)).alias("mixed"))


@query("SELECT vec_id, 'p' || vec_id AS path, embedding AS samples, label FROM embeddings")
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    audio = F.struct(F.concat(F.lit("p"), F.col("vec_id").cast("string")).alias("path"), F.col("embedding").alias("array"), F.lit(16000).alias("sampling_rate"))
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", audio.alias("audio"), F.col("label").alias("transcription"))
    return rows.select("vec_id", "audio.path", F.col("audio.array").alias("samples"), F.col("transcription").alias("label"))


@query("SELECT vec_id, NULL::VARCHAR AS path, 16000 AS rate FROM embeddings")
def null_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", F.struct(F.lit("p").alias("path"), F.lit(16000).alias("sampling_rate")).alias("audio"))
    emptied = rows.withColumn("audio", F.col("audio").withField("path", F.lit(None).cast("string")))
    return emptied.select("vec_id", F.col("audio.path").alias("path"), F.col("audio.sampling_rate").alias("rate"))


@query("SELECT vec_id, len(embedding)::INTEGER AS n, len(embedding) AS frames, len(embedding)::DOUBLE / 16000 AS seconds, len(embedding)::INTEGER AS decoded FROM embeddings")
def wav_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    blob = samples(spark, sf_dir).select("vec_id", F.size("x").alias("n"), W.wav_bytes(F.col("x")).alias("content"))
    told = blob.select("vec_id", "n", W.wav_header(F.col("content")).alias("h"), W.wav_samples(F.col("content")).alias("y"))
    return told.select("vec_id", "n", "h.frames", "h.seconds", F.size("y").alias("decoded"))


@query()
def silence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each sample sounds for 125 samples, quiet ones not at all."""
    sound = F.flatten(F.transform("x", lambda v: F.transform(F.sequence(F.lit(0), F.lit(124)), lambda i: F.when(F.abs(v) >= 0.1, v * F.sin(i.cast("double"))).otherwise(F.lit(0.0)))))
    rows = samples(spark, sf_dir).select("vec_id", sound.alias("x"))
    return W.split_by_silence(rows, "vec_id", "x", rate=100, top_db=30, frame=64, most=10, least=1).select("vec_id", "n", F.size("piece").alias("length"))


@query("""
SELECT vec_id, n AS noisy, n AS bent, list_sort(list_transform(embedding, lambda v: v::DOUBLE))[n - floor((n - 1) * 0.2)::INTEGER] AS peak,
  n AS mixed, n AS passed, n AS shifted, n AS wet FROM (SELECT *, len(embedding)::INTEGER AS n FROM embeddings)
""")
def effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("x")
    return samples(spark, sf_dir).select(
        "vec_id", F.size(W.with_noise(x, 3, F.col("vec_id"))).alias("noisy"), F.size(W.with_tanh(x, 0.5)).alias("bent"),
        F.array_max(W.with_clipping(x, 40)).alias("peak"), F.size(W.with_background(x, F.slice("x", 1, 7), 10.0)).alias("mixed"),
        F.size(W.with_band_pass(x, 100.0, 6000.0)).alias("passed"), F.size(W.with_pitch(x, -2.0)).alias("shifted"), F.size(W.with_room(x)).alias("wet"),
    )


def _effect_sql() -> str:
    table = W.effect_weights(10)
    index = f"({sql_draw(5, 'doc_id')} % {table[-1][3]})"
    cases = " ".join(f"WHEN i < {end} THEN {quoted(name)}" for name, _, _, end in table)
    return f"SELECT doc_id, (i + 1)::INTEGER AS effect_index, CASE {cases} END AS effect FROM (SELECT doc_id, {index} AS i FROM documents)"


@query(_effect_sql())
def effect_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.augment_plan(read_table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 10, 5)


@query(f"""
WITH d AS (SELECT doc_id,
    list_transform([1, 2, 3], lambda i: ['alpha', 'beta', 'gamma'][{sql_draw(9, 'doc_id', 'i')} % 3 + 1]) AS one,
    list_transform([1, 2, 3, 4, 5], lambda i: ['the', 'of', 'and', 'to'][{sql_draw(10, 'doc_id', 'i')} % 4 + 1]) AS two,
    list_sort(list_transform([0, 1, 2, 3, 4, 5, 6, 7], lambda i: {{'h': {sql_draw(11, 'doc_id', 'i')}, 'x': CASE WHEN i < 3 THEN 1 ELSE 0 END}})) AS pattern FROM documents),
e AS (SELECT doc_id, one, two, list_transform(pattern, lambda p: p.x) AS xs FROM d)
SELECT doc_id, array_to_string(list_transform(xs, lambda x, i: CASE WHEN x = 1 THEN one[list_sum(xs[1 : i])::INTEGER] ELSE two[(i - list_sum(xs[1 : i]))::INTEGER] END), ' ') AS text FROM e
""")
def unseen_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array(*(F.lit(w) for w in ("alpha", "beta", "gamma"))), F.array(*(F.lit(w) for w in ("the", "of", "and", "to")))
    return read_table(spark, sf_dir, "documents").select("doc_id", sentence(*words, 8, 0.3, 9, "doc_id").alias("text"))
