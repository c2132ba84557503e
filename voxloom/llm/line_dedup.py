"""Line deduplication: keep bitmaps from range-partitioned line hashes (operator 2, DataFrame functions only).

A line's key is the line without ASCII white space at both ends and with A-Z lower-cased. A key of at least
``min_chars`` code points held by at least ``min_docs`` documents loses all its lines except those in the largest
doc_id that holds it. Keys are compared by 128-bit hashes.

Plan: one scan hashes the long lines of every document; the hashes are range-partitioned with (document, position) as
the secondary order, so that the lines of one very common key spread over several ranges; each range streams its
runs, which keeps one row (count, first occurrence) a key and range; these rows meet in a small grouped aggregation.
Only keys past ``min_docs`` are joined back to the lines, and what leaves is one run-length bitmap a document, never
text.

Defined cases: null and empty texts are one empty line, kept; an empty table gives an empty result; rows that repeat a
doc_id are one document: they count once, and a position that one of them loses all of them lose; further columns are carried or ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import BLANKS, Scratch, ascii_lower, key128, let
from voxloom.session import read_table, spread

MIN_CHARS, MIN_DOCS = 20, 3


def lines_of(text: Column) -> Column:
    """All lines of a text; null or empty: one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, pos, h1, h2) of every line whose key is long enough."""
    raw = docs.select("doc_id", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    key = F.btrim(ascii_lower(F.col("line")), F.lit(BLANKS))
    keyed = raw.select("doc_id", "pos", key.alias("key")).where(F.char_length("key") >= min_chars)
    h1, h2 = key128(F.col("key"))
    return keyed.select("doc_id", "pos", h1.alias("h1"), h2.alias("h2"))


def keep_runs(dropped: Column) -> Column:
    """Sorted positions of dropped lines as a run-length bitmap: lengths of kept and dropped runs in turn, kept first;
    the kept run after the last dropped line is left out."""
    starts = F.filter(dropped, lambda p, i: (i == 0) | (F.get(dropped, i - 1) != p - 1))
    ends = F.filter(dropped, lambda p, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) != p + 1))
    return F.flatten(
        F.transform(
            starts,
            lambda p, i: F.array(
                p - F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1) + 1), F.get(ends, i) - p + 1
            ),
        )
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_dropped, runs) of the documents that lose lines; runs: see :func:`keep_runs`."""
    lines = Scratch.write(line_hashes(docs, min_chars), "lines")
    ranged = lines.repartitionByRange("h1", "h2", "doc_id").sortWithinPartitions("h1", "h2", F.desc("doc_id"), "pos")
    held = ranged.groupBy("h1", "h2", "doc_id").agg(F.min("pos").alias("pos"))
    heads = held.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("first_doc"))
    # written, so that the join below has a plain exchange on both sides and adaptive execution can split a hot key
    repeated = Scratch.write(heads.where(F.col("n_docs") >= min_docs).drop("n_docs"), "repeated")
    lost = lines.join(repeated, ["h1", "h2"]).where("doc_id <> first_doc").select("doc_id", "pos")
    sets = lost.groupBy("doc_id").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    return sets.select(
        "doc_id", F.size("dropped").cast("long").alias("n_dropped"), let(F.col("dropped"), keep_runs).alias("runs")
    )


def kept_lines(lines: Column, runs: Column) -> Column:
    """The kept lines, taken run by run; null runs keep all."""

    def cut(parts: Column) -> Column:
        lengths, pairs = parts["r"], F.size(parts["r"])
        ends = F.aggregate(
            lengths,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<array<string>>").alias("out"), F.lit(True).alias("keep")),
            lambda s, n: F.struct(
                (s["at"] + n).alias("at"),
                F.when(s["keep"], F.concat(s["out"], F.array(F.slice(parts["l"], s["at"] + 1, n)))).otherwise(s["out"]).alias("out"),
                (~s["keep"]).alias("keep"),
            ),
            lambda s: F.concat(s["out"], F.array(F.slice(parts["l"], s["at"] + 1, F.size(parts["l"])))),
        )
        return F.when(pairs > 0, F.flatten(ends)).otherwise(parts["l"])

    return F.when(runs.isNull(), lines).otherwise(let(F.struct(lines.alias("l"), runs.alias("r")), cut))


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the lost lines taken out of ``text``, and (n_lines, n_dropped); a null text becomes empty.

    The bitmaps are the build side of a shuffled hash join: they hold a few numbers for each document with losses,
    and the texts are not sorted."""
    maps = keep_bitmaps(docs, min_chars, min_docs)
    named = maps.select(F.col("doc_id").alias("__dedup_doc"), F.col("n_dropped").alias("__dedup_n"), F.col("runs").alias("__dedup_runs"))
    joined = docs.join(named.hint("shuffle_hash"), F.col("doc_id") == F.col("__dedup_doc"), "left")
    kept = let(lines_of(F.col("text")), lambda ls: F.struct(
        F.size(ls).cast("long").alias("n"), F.array_join(kept_lines(ls, F.col("__dedup_runs")), "\n").alias("text")
    ))
    cut = joined.withColumn("__dedup_kept", kept)
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return cut.select(
        *others,
        F.col("__dedup_kept.text").alias("text"),
        F.col("__dedup_kept.n").alias("n_lines"),
        F.coalesce("__dedup_n", F.lit(0)).cast("long").alias("n_dropped"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query over all ``documents``."""
    docs = spread(read_table(spark, sf_dir, "documents")).select("doc_id", "text")
    return deduplicated(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH base AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
raw AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM base),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM raw),
rep AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, k.pos, k.line, (r.key IS NOT NULL AND k.doc_id <> r.last_doc) AS lost
  FROM keyed k LEFT JOIN rep r ON k.key = r.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (lost))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
