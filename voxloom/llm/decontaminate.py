"""Benchmark decontamination by a prefix-filtered set join (operator 4, DataFrame functions only).

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window is ``window`` consecutive words of an
item; an item with fewer words, but not none, is one window. A document word inside any occurrence of a window is hit.

Method: a window is contained only if all its words are, so its necessary prefix is one word: the rarest of the window
by document frequency over all documents. The document side joins on these prefix words only; where they are few
(``max_inline``, a bound that is checked), a set-membership test inside the scan drops all other positions before any row
is made, otherwise every position joins by shuffle. A candidate carries its neighbouring words, at most two windows of
them; length and positional bounds discard those that would start before or end after the document, and the rest are
verified word for word.

Defined cases: a null or wordless text has no words, no hits and is clean; items without words have no windows; equal
windows of several items count for each item; rows that repeat a doc_id are told apart; an empty benchmark leaves every
document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxloom.llm.common import Scratch, ascii_lower, let, pieces
from voxloom.session import read_table, spread

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Up to so many words may be set into a plan as a set to test against, and up to so many windows broadcast.
MAX_INLINE, MAX_BROADCAST = 20_000, 200_000


def item_words(text: Column) -> Column:
    """The words of a text; null has none."""
    return pieces(ascii_lower(text), WORD_GAP)


def windows_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, words): the distinct windows of every item."""
    words = items.select("item_id", item_words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - window + 1, F.lit(1)))
    return words.select(
        "item_id", F.explode(F.transform(starts, lambda i: F.slice(F.col("ws"), i, window))).alias("words")
    ).distinct()


def few_values(df: DataFrame, column: str, most: int) -> list | None:
    """The distinct values of a column if they are at most ``most``, else None."""
    got = [r[0] for r in df.select(column).distinct().limit(most + 1).collect()]
    return got if len(got) <= most else None


def document_frequency(docs: DataFrame, wanted: DataFrame, inline: list | None) -> DataFrame:
    """(word, df): in how many documents each wanted word is found, over all documents."""
    words = F.array_distinct(item_words(F.col("text")))
    if inline is not None:
        words = F.filter(words, lambda w: w.isin(inline)) if inline else F.array().cast("array<string>")
    found = docs.select(F.explode(words).alias("word"))
    if inline is None:
        found = found.join(wanted, "word", "left_semi")
    return found.groupBy("word").agg(F.count("*").alias("df"))


def prefixed(windows: DataFrame, docs: DataFrame, max_inline: int = MAX_INLINE) -> DataFrame:
    """(window_id, words, anchor, offset): every distinct window with the place of its rarest word."""
    distinct = windows.select("words").distinct()
    wanted = distinct.select(F.explode("words").alias("word")).distinct()
    counts = document_frequency(docs, wanted, few_values(wanted, "word", max_inline))
    placed = distinct.select("words", F.posexplode("words").alias("offset", "word"))
    ranked = placed.join(counts, "word", "left").select(
        "words", "word", "offset", F.coalesce("df", F.lit(0)).alias("df")
    )
    first = Window.partitionBy("words").orderBy("df", "word", "offset")
    return (
        ranked.withColumn("_n", F.row_number().over(first))
        .where("_n = 1")
        .select(F.xxhash64("words").alias("window_id"), "words", F.col("word").alias("anchor"), "offset")
    )


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_inline: int = MAX_INLINE) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids) for every row of ``docs``; item_ids: sorted as strings."""
    windows = Scratch.write(windows_of(items, window), "windows")
    anchors = Scratch.write(prefixed(windows, docs, max_inline), "anchors")
    few = few_values(anchors, "anchor", max_inline)
    small = anchors.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST

    def candidates(ws: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(ws) - 1)
        picked = every if few is None else F.filter(every, lambda i: F.get(ws, i).isin(few))
        near = F.transform(
            picked,
            lambda i: F.struct(
                i.alias("at"),
                F.greatest(i - window + 1, F.lit(0)).alias("from"),
                F.slice(ws, F.greatest(i - window + 2, F.lit(1)), i + window - F.greatest(i - window + 1, F.lit(0))).alias("near"),
            ),
        )
        none = F.array().cast("array<struct<at:int,from:int,near:array<string>>>")
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.when(F.size(ws) == 0, none).otherwise(near if few != [] else none).alias("c"),
        )

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), let(item_words(F.col("text")), candidates).alias("d"))
    each = rows.select("doc_id", "_row", F.col("d.n_words").alias("n_words"), F.explode_outer("d.c").alias("c")).select(
        "doc_id", "_row", "n_words", F.col("c.at").alias("at"), F.col("c.from").alias("from"),
        F.get("c.near", F.col("c.at") - F.col("c.from")).alias("anchor"), F.col("c.near").alias("near"),
    )
    start = F.col("at") - F.col("offset")
    inside = (start >= 0) & (start + F.size("words") <= F.col("n_words"))
    exact = F.slice("near", start - F.col("from") + 1, F.size("words")) == F.col("words")
    table = F.broadcast(anchors) if small else anchors
    met = each.join(table, "anchor", "left").select(
        "doc_id", "_row", "n_words",
        F.when(inside & exact, F.struct(start.cast("long").alias("s"), (start + F.size("words")).cast("long").alias("e"), "window_id")).alias("hit"),
    )
    by_row = met.groupBy("doc_id", "_row").agg(F.max("n_words").alias("n_words"), F.sort_array(F.collect_set("hit")).alias("hits"))
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, h: F.struct(
            (acc["n"] + F.greatest(h["e"] - F.greatest(h["s"], acc["end"]), F.lit(0).cast("long"))).alias("n"),
            F.greatest(acc["end"], h["e"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    found = by_row.select("doc_id", "_row", "n_words", covered.alias("n_hit"), F.array_distinct("hits.window_id").alias("w"))
    owners = windows.select(F.xxhash64("words").alias("window_id"), F.col("item_id").cast("string").alias("item"))
    owned = found.select("doc_id", "_row", "n_words", "n_hit", F.explode_outer("w").alias("window_id"))
    owned = owned.join(F.broadcast(owners) if small else owners, "window_id", "left")
    return owned.groupBy("doc_id", "_row").agg(
        F.max("n_words").alias("n_words"), F.max("n_hit").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("item_ids")
    ).drop("_row")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query over all ``documents`` against all of ``benchmark``."""
    docs = spread(read_table(spark, sf_dir, "documents")).select("doc_id", "text")
    found = hits(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
i AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
iw AS (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS s FROM i WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, array_to_string(ws[s : s + 9], ' ') AS w, least(len(ws), 10) AS n FROM iw),
sizes AS (SELECT DISTINCT n FROM win),
dp AS (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS s FROM d, sizes WHERE len(ws) >= n),
occ AS (SELECT dp.doc_id, dp.s, dp.n, win.item_id FROM dp JOIN win ON win.n = dp.n AND array_to_string(dp.ws[dp.s : dp.s + dp.n - 1], ' ') = win.w),
pos AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM occ),
h AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(it.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(it.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""
