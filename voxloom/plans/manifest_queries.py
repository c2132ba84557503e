"""Manifest queries: ``documents`` stand for audio (source: folder, doc_id: stem), ``labels`` for what was checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators import manifest as M
from voxloom.operators import paths as P
from voxloom.operators.ordered import resume_point
from voxloom.plans.registry import query
from voxloom.session import read_table

FILE = "source || '/' || lang || '/' || doc_id || '.wav'"


def tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars"), read_table(spark, sf_dir, "labels")


def paths(spark: SparkSession, sf_dir: str, root: str = "") -> DataFrame:
    """(doc_id, path): a directory tree in which every third file lies one layer higher."""
    docs = read_table(spark, sf_dir, "documents")
    deep = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".wav")))
    high = F.concat_ws("/", "source", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return docs.select("doc_id", F.concat(F.lit(root), F.when(F.col("doc_id") % 3 == 0, high).otherwise(deep)).alias("rel_path"))


SQL_PATHS = """
WITH f AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source || '/' || doc_id || '.txt' ELSE source || '/' || lang || '/' || doc_id || '.wav' END AS rel_path FROM documents),
d0 AS (SELECT DISTINCT regexp_extract(rel_path, '^(.*)/[^/]*$', 1) AS dir FROM f),
dirs AS (SELECT dir FROM d0 UNION SELECT regexp_extract(dir, '^(.*)/[^/]*$', 1) FROM d0 WHERE contains(dir, '/')),
leaves AS (SELECT dir FROM dirs WHERE dir NOT IN (SELECT regexp_extract(dir, '^(.*)/[^/]*$', 1) FROM dirs))
"""


@query("SELECT d.doc_id, source, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def manifest_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir)
    return M.matched(docs, labels, ["doc_id"]).select("doc_id", "source", "quality")


@query("SELECT count(*) AS n_missing FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def manifest_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir)
    return M.unmatched(docs, labels, ["doc_id"]).agg(F.count("*").alias("n_missing"))


@query("""
WITH a AS (SELECT DISTINCT doc_id FROM documents WHERE n_chars > 500), b AS (SELECT DISTINCT doc_id FROM labels)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'left_only' ELSE 'right_only' END AS side
FROM a FULL JOIN b ON a.doc_id = b.doc_id WHERE a.doc_id IS NULL OR b.doc_id IS NULL
""")
def manifest_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir)
    return M.mismatches(docs.where("n_chars > 500"), labels, ["doc_id"])


@query("SELECT doc_id, source, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def todo_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.unmatched(*tables(spark, sf_dir), ["doc_id"])


@query("SELECT doc_id, source, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def keep_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.kept(*tables(spark, sf_dir), ["doc_id"])


def _bad_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs, labels = tables(spark, sf_dir)
    named = docs.select(F.concat_ws("/", "source", "lang").alias("dir"), F.concat(F.col("doc_id").cast("string"), F.lit(".wav")).alias("file_name"), "doc_id")
    file = F.concat_ws("/", "dir", "file_name").alias("file")
    bad = named.join(labels.where("quality = 0"), "doc_id").select(file)
    toxic = named.join(labels.where("toxic = 1"), "doc_id").select(file)
    return named, bad, toxic


@query("""
SELECT source || '/' || lang AS dir, doc_id || '.wav' AS file_name FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 OR toxic = 1)
""")
def delete_by_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    named, bad, toxic = _bad_files(spark, sf_dir)
    return M.unmatched(named.drop("doc_id"), M.delete_list(bad, toxic), ["dir", "file_name"])


@query("""
SELECT source || '/' || lang AS dir, list_sort(list(DISTINCT d.doc_id || '.wav')) AS files
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 0 GROUP BY 1
""")
def group_files_by_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.files_by_parent(_bad_files(spark, sf_dir)[1])


@query("""
WITH a AS (SELECT DISTINCT 'r/' || source || '/' || lang AS dir FROM documents),
g AS (SELECT 'r/' || source || '/' || lang AS dir, sum(l.quality) AS n FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1)
SELECT a.dir, coalesce(g.n, 0) > 0 AS keep FROM a LEFT JOIN g ON a.dir = g.dir
""")
def prune_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir)
    named = docs.withColumn("dir", F.concat_ws("/", F.lit("r"), "source", "lang"))
    aligned = named.join(labels, "doc_id").groupBy("dir").agg(F.sum("quality").alias("n_txt"))
    return M.pruned_dirs(named.select("dir").distinct(), aligned)


@query("SELECT d.doc_id, source, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def lookup_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir)
    return M.with_fixes(docs, labels, ["doc_id"]).select("doc_id", "source", "quality")


@query("""
WITH m AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT CASE WHEN quality IS NULL THEN 'deleted' ELSE 'kept' END AS side, count(*) AS n FROM m GROUP BY 1
""")
def null_label_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir)
    kept, deleted = M.null_split(M.with_fixes(docs, labels, ["doc_id"]), "quality")
    parts = [x.agg(F.count("*").alias("n")).select(F.lit(s).alias("side"), "n") for s, x in (("kept", kept), ("deleted", deleted))]
    return parts[0].union(parts[1])


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'nogap' ELSE 'gap' END AS gap_class FROM documents WHERE doc_id % 3 <> 2")
def tier_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("doc_id") % 3 == 1, F.lit("nogap")).when(F.col("doc_id") % 3 == 2, F.lit("gap"))
    return M.tiers(tables(spark, sf_dir)[0].select("doc_id", kind.alias("gap_class")), take_gap=False)


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit(1).alias("is_changed"))
    return M.union_all(customers, suppliers)


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def distinct_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read_table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    return a.union(read_table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def except_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir)
    return docs.select("doc_id").subtract(labels.select("doc_id"))


@query("SELECT source || '_' || lang AS name, (doc_id % 7)::VARCHAR AS id, count(*) AS num FROM documents GROUP BY 1, 2")
def contributor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("a_b_"), F.concat_ws("_", "source", "lang", (F.col("doc_id") % 7).cast("string")), F.lit(".txt"))
    return M.contributions(tables(spark, sf_dir)[0].select(name.alias("file_name")))


@query("SELECT source AS channel, count(*) AS n FROM documents GROUP BY 1")
def union_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat_ws("_", F.lit("video_info"), "source", "lang", F.col("doc_id").cast("string"))
    docs = tables(spark, sf_dir)[0].select("doc_id", name.alias("file_name"))
    whole = M.union_same(docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1"))
    return M.union_by_channel(whole).groupBy("channel").agg(F.count("*").alias("n"))


@query("""
SELECT o_orderkey, o_totalprice AS raw_duration, coalesce(s, 0.0) AS splited_duration
FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
""")
def duration_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    return M.reconciled(read_table(spark, sf_dir, "orders"), clips, "o_orderkey", "o_totalprice", "l_quantity")


@query("""
SELECT n_name AS root, sum(l_quantity) / 3600 AS hours FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1
""")
def hours_by_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity")
    suppliers = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nations = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("root"))
    return M.hours(clips.join(suppliers, "l_suppkey").join(nations, "s_nationkey"), "root", "l_quantity")


@query(SQL_PATHS + """
SELECT dir, count(*) AS n FROM (SELECT regexp_extract(rel_path, '^(.*)/[^/]*$', 1) AS dir FROM f) WHERE dir IN (SELECT dir FROM leaves) GROUP BY dir HAVING count(*) < 12
""")
def small_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.small_dirs(paths(spark, sf_dir), fewer=12)


@query(SQL_PATHS + "SELECT dir FROM leaves")
def leaf_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.leaf_dirs(paths(spark, sf_dir))


@query(SQL_PATHS + "SELECT DISTINCT regexp_extract(rel_path, '^(.*)/[^/]*$', 1) AS dir FROM f WHERE rel_path LIKE '%.txt'")
def dirs_with_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.dirs_with(paths(spark, sf_dir), "txt")


@query(SQL_PATHS + """
SELECT a.dir, max(len(string_split(b.dir, '/')) - len(string_split(a.dir, '/')) + 1)::BIGINT AS depth
FROM dirs a JOIN dirs b ON b.dir = a.dir OR starts_with(b.dir, a.dir || '/') GROUP BY a.dir
""")
def dir_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.dir_depths(paths(spark, sf_dir))


@query(SQL_PATHS + """
SELECT doc_id, '/b/' || regexp_replace(rel_path, '\\.[^./]*$', '.txt') AS label_path, regexp_extract(rel_path, '^(.*)/[^/]*$', 1) AS dir,
  doc_id || '.' || rel_path[-3:] AS name, doc_id::VARCHAR AS stem, rel_path[-3:] AS ext FROM f
""")
def reroot_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = paths(spark, sf_dir, "/a/").select("doc_id", F.col("rel_path").alias("path"))
    return P.with_parts(rows, "path", "/a").select("doc_id", P.rerooted(F.col("path"), "/a", "/b", ".txt").alias("label_path"), "dir", "name", "stem", "ext")


@query(SQL_PATHS + "SELECT doc_id, regexp_extract(rel_path, '^(.*/)[^/]*$', 1) || (doc_id + 1000) || rel_path[-4:] AS new_path FROM f")
def offset_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.offset_names(paths(spark, sf_dir), 1000).select("doc_id", "new_path")


@query("""
WITH n AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2)
SELECT source, arg_min(lang, (-n, lang)) AS lang FROM (SELECT source, lang, n FROM n) GROUP BY source
""")
def argmax_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tables(spark, sf_dir)[0].groupBy("source", "lang").agg(F.count("*").alias("n"))
    return M.argmax(counts, ["source"], "lang", "n")


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def raw_transcript_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.joined_text(read_table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text", "\n")


@query("SELECT o_orderkey, (o_orderstatus = 'F' OR o_orderkey % 10 = 3)::INTEGER AS is_complete FROM orders")
def queue_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = read_table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("is_complete"))
    return M.marked_done(queue, F.col("o_orderkey") % 10 == 3)


@query("SELECT coalesce(max(doc_id), 1) AS next FROM documents")
def resume_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume_point(P.with_parts(paths(spark, sf_dir), "rel_path"))


@query("""
SELECT (doc_id // 100) AS segment, count(*) AS n, (count(*) FILTER (n_chars > 1000))::BIGINT AS n_valid, (count(*) FILTER (NOT n_chars > 1000))::BIGINT AS n_missed
FROM documents GROUP BY 1
""")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables(spark, sf_dir)[0].withColumn("segment", F.floor(F.col("doc_id") / 100))
    return rows.groupBy("segment").agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") > 1000).alias("n_valid"), F.count_if(~(F.col("n_chars") > 1000)).alias("n_missed"))


@query("SELECT event_id, user_id FROM events WHERE event_type IN ('click', 'view') AND value > 10")
def item_kind_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view") & (F.col("value") > 10)).select("event_id", "user_id")


@query("SELECT doc_id, source || '_1' AS name FROM documents WHERE contains(source || '_1', '_1') AND doc_id % 2 = 0")
def tier_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = tables(spark, sf_dir)[0].select("doc_id", F.concat("source", F.when(F.col("doc_id") % 2 == 0, F.lit("_1")).otherwise(F.lit("_0"))).alias("name"))
    return named.where(F.contains("name", F.lit("_1")))
