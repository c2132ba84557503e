"""Word error rate: each turn of a conversation is the reference of the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.functions.wer import corpus_wer, word_edits
from voxloom.operators.manifest import accepted_folders
from voxloom.operators.mapper import corrected
from voxloom.plans.registry import query
from voxloom.plans.text_queries import SQL_NORMAL, sql_tokens
from voxloom.session import read_table, spread


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, role, label, pred)."""
    turns = spread(read_table(spark, sf_dir, "conversations"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("pred"))
    return turns.select("conv_id", "turn", "role", F.col("text").alias("label")).join(after, ["conv_id", "turn"])


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, role, edits, n_ref)."""
    words = pairs(spark, sf_dir).select(
        "conv_id", "turn", "role", T.tokens(T.normalize(F.col("label"))).alias("r"), T.tokens(T.normalize(F.col("pred"))).alias("h")
    )
    counted = F.struct(word_edits(F.col("r"), F.col("h")).alias("edits"), F.size("r").cast("long").alias("n_ref"))
    # a generator of one row: later filters and projections then use what was computed instead of computing it again
    return words.select("conv_id", "turn", "role", F.inline(F.array(counted)))


#: Edit distance row by row: the running minimum along a row is taken after the step costs are subtracted.
EDITS = f"""
WITH RECURSIVE p AS MATERIALIZED (
  SELECT a.conv_id, a.turn, a.role, {sql_tokens(SQL_NORMAL.replace('text', 'a.text'))} AS r, {sql_tokens(SQL_NORMAL.replace('text', 'b.text'))} AS h
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
dp(conv_id, turn, i, d) AS (
  SELECT conv_id, turn, 0, range(0, len(h) + 1) FROM p
  UNION ALL
  SELECT conv_id, turn, i + 1, list_transform(range(0, len(t)), lambda j: j + list_min(t[1 : j + 1])) FROM (
    SELECT dp.conv_id, dp.turn, i, list_transform(range(0, len(h) + 1),
      lambda j: least(d[j + 1] + 1, CASE WHEN j > 0 THEN d[j] + (h[j] <> r[i + 1])::INT ELSE 1000000 END) - j) AS t
    FROM dp JOIN p ON p.conv_id = dp.conv_id AND p.turn = dp.turn WHERE i < len(r))),
e AS MATERIALIZED (
  SELECT p.conv_id, p.turn, p.role, d[-1]::BIGINT AS edits, len(r)::BIGINT AS n_ref
  FROM dp JOIN p ON p.conv_id = dp.conv_id AND p.turn = dp.turn WHERE i = len(r))
"""
def rate() -> Column:
    return F.when(F.col("n_ref") > 0, 100.0 * F.col("edits") / F.col("n_ref"))


SQL_RATE = "CASE WHEN n_ref > 0 THEN 100.0::DOUBLE * edits / n_ref END"


@query(EDITS + f"SELECT conv_id, turn, edits, n_ref, {SQL_RATE} AS wer FROM e")
def utterance_wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits(spark, sf_dir).select("conv_id", "turn", "edits", "n_ref", rate().alias("wer"))


@query(EDITS + f"SELECT conv_id, turn, {SQL_RATE} AS wer FROM e WHERE {SQL_RATE} > 100 ORDER BY wer DESC, conv_id, turn")
def wer_report_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sorting looks at the rows twice: the exchange of narrow rows keeps the rates from being computed twice
    told = edits(spark, sf_dir).select("conv_id", "turn", rate().alias("wer")).where("wer > 100").repartition("conv_id", "turn")
    return told.orderBy(F.desc("wer"), "conv_id", "turn")


@query(EDITS + "SELECT 100.0::DOUBLE * sum(edits) / sum(n_ref) AS wer FROM e")
def corpus_wer_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits(spark, sf_dir).agg(corpus_wer(F.col("edits"), F.col("n_ref")).alias("wer"))


@query(EDITS + "SELECT role, 100.0::DOUBLE * sum(edits) / sum(n_ref) AS wer FROM e GROUP BY role")
def corpus_wer_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits(spark, sf_dir).groupBy("role").agg(corpus_wer(F.col("edits"), F.col("n_ref")).alias("wer"))


@query(EDITS + f"SELECT conv_id, turn, edits FROM e WHERE {SQL_RATE} <= 110")
def wer_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits(spark, sf_dir).where(rate() <= 110).select("conv_id", "turn", "edits")


@query("""
WITH c AS (SELECT conv_id, turn, text, CASE WHEN turn % 3 = 0 THEN upper(text) WHEN turn % 3 = 1 THEN text || '.' ELSE text END AS fixed FROM conversations)
SELECT conv_id, turn, text AS pred_with_llm, (turn % 3 = 2)::INTEGER AS is_changed_llm FROM c
""")
def spell_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("turn") % 3
    fixed = F.when(turn == 0, F.upper("text")).when(turn == 1, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    rows = read_table(spark, sf_dir, "conversations").where(F.col("text").isNotNull()).select("conv_id", "turn", F.col("text").alias("label"), F.col("text").alias("pred"), fixed.alias("fixed"))
    return corrected(rows, "pred", "label", "fixed", "llm").select("conv_id", "turn", "pred_with_llm", "is_changed_llm")


@query("""
WITH f AS (SELECT conv_id::VARCHAR AS dir, text AS original, CASE WHEN turn % 4 = 3 THEN NULL WHEN turn % 4 = 2 THEN text || ' x' ELSE text END AS fixed FROM conversations),
g AS (
  SELECT dir, count(*) AS n_files, (count(fixed))::BIGINT AS n_done, (count(*) FILTER (fixed = original))::BIGINT AS n_perfect,
    CASE WHEN sum(CASE WHEN fixed IS NOT NULL THEN len(list_filter(string_split(original, ' '), lambda x: x <> '')) END) > 0 THEN
      100.0::DOUBLE * sum(CASE WHEN fixed IS NOT NULL THEN (fixed <> original)::INT END)
        / sum(CASE WHEN fixed IS NOT NULL THEN len(list_filter(string_split(original, ' '), lambda x: x <> '')) END) END AS wer
  FROM f GROUP BY dir)
SELECT *, coalesce(n_done >= n_files * 0.1 AND n_done >= 3 AND n_perfect >= least(5, n_files) AND wer <= 8, false) AS accepted FROM g
""")
def folder_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("turn") % 4
    fixed = F.when(turn == 3, F.lit(None)).when(turn == 2, F.concat("text", F.lit(" x"))).otherwise(F.col("text"))
    rows = read_table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("dir"), F.col("text").alias("original"), fixed.alias("fixed"))
    return accepted_folders(rows)
