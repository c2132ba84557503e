"""WARC derivative builder (operator 10).

A response record becomes linked derivatives: a ``metadata`` record (application/warc-fields: title, language, links) and a
``conversion`` record (text/plain). Both name the response in WARC-Refers-To, keep its target, date and HTTP header block, and carry
digests of their own block and of the source payload. All of it is one projection over the page and an explode: no shuffle.

Record ids are uuids from the MD5 of (kind, page_id, url, payload digest), so that a rebuilt derivative has the id of the first.
Digests are ``sha1:`` and base32, as usual in WARC.

Defined cases: a null or empty page is an empty payload and gives an empty conversion; a null url is an empty target;
repeated rows give equal records each; an empty table gives an empty result; a ``headers`` column, where there is one,
is the source's HTTP header block, else a plain one is written; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import let
from voxloom.session import read_table, spread

DATE = "2024-01-01T00:00:00Z"
#: Fixed: elements without text of their own, elements that end a line, and named entities, ``&amp;`` last.
SILENT = ("script", "style", "head", "noscript", "template")
BLOCKS = "p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|header|footer|nav|pre|blockquote|td|th|title"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))
DIGITS, LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(value: Column) -> Column:
    """``sha1:`` and the base32 of the SHA-1."""

    def coded(digest: Column) -> Column:
        parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
        return F.concat(F.lit("sha1:"), F.translate(F.concat(*parts), DIGITS, LETTERS))

    return let(F.sha1(value), coded)


def uuid_of(value: Column) -> Column:
    """A record id from the MD5 of a value."""
    shape = "^(.{8})(.{4})(.{4})(.{4})(.{12})$"
    return F.regexp_replace(F.md5(value), shape, "<urn:uuid:$1-$2-$3-$4-$5>")


def decoded(text: Column) -> Column:
    for entity, letter in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(letter))
    return text


def plain_text(html: Column) -> Column:
    """The text of a page: silent elements and comments gone, block ends as line ends, blanks collapsed."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    for name in SILENT:
        text = F.regexp_replace(text, rf"(?is)<{name}\b.*?</{name}\s*>", " ")
    text = F.regexp_replace(text, rf"(?i)</?(?:{BLOCKS})\b[^>]*>", "\n")
    text = decoded(F.regexp_replace(text, "<[^>]*>", ""))
    text = F.regexp_replace(text, r"[ \t\r\f\x0B]+", " ")
    return F.btrim(F.regexp_replace(F.regexp_replace(text, " ?\n ?", "\n"), "\n+", "\n"), F.lit(" \n"))


def fields(html: Column) -> Column:
    """The block of the metadata record: title, language and links, one field a line."""
    title = decoded(F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title\s*>", 1), r"[\r\n]+", " "))
    language = F.regexp_extract(html, r"(?i)<html[^>]*\blang=\"([^\"]*)\"", 1)
    links = F.transform(
        F.regexp_extract_all(html, F.lit(r"(?i)<a\s[^>]*href=\"([^\"]*)\""), F.lit(1)), lambda x: F.concat(F.lit("outlink: "), x, F.lit("\r\n"))
    )
    return F.concat(F.lit("title: "), title, F.lit("\r\nlanguage: "), language, F.lit("\r\n"), F.array_join(links, ""))


def derivatives(pages: DataFrame, date: str = DATE) -> DataFrame:
    """One row for each record: the response's, its metadata and its conversion, with ``block`` and ``header``."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    plain = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    source = F.coalesce(F.col("headers"), plain) if "headers" in pages.columns else plain
    base = pages.select("page_id", url.alias("url"), html.alias("html"), source.alias("source"))
    base = base.withColumn("payload", sha1_base32(F.col("html")))

    def record(kind: str, mime: str, block: Column) -> Column:
        name = F.concat_ws("\n", F.lit(kind), F.col("page_id").cast("string"), F.col("url"), F.col("payload"))
        response = F.concat_ws("\n", F.lit("response"), F.col("page_id").cast("string"), F.col("url"), F.col("payload"))
        return F.struct(
            F.lit(kind).alias("record_type"), uuid_of(name).alias("record_id"),
            (F.lit(None).cast("string") if kind == "response" else uuid_of(response)).alias("refers_to"),
            F.lit(mime).alias("content_type"), block.alias("block"),
        )

    made = F.array(
        record("response", "application/http; msgtype=response", F.concat("source", "html")),
        record("metadata", "application/warc-fields", fields(F.col("html"))),
        record("conversion", "text/plain", plain_text(F.col("html"))),
    )
    rows = base.select("page_id", "url", "payload", "source", F.explode(made).alias("r")).select("page_id", "url", "payload", "source", "r.*")
    rows = rows.withColumn("content_length", F.octet_length("block").cast("long")).withColumn("block_digest", sha1_base32(F.col("block")))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"), F.lit("\r\nWARC-Record-ID: "), F.col("record_id"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Refers-To: "), F.col("refers_to")), F.lit("")),
        F.lit("\r\nWARC-Target-URI: "), F.col("url"), F.lit(f"\r\nWARC-Date: {date}\r\nContent-Type: "), F.col("content_type"),
        F.lit("\r\nWARC-Block-Digest: "), F.col("block_digest"), F.lit("\r\nWARC-Payload-Digest: "), F.col("payload"),
        F.lit("\r\nContent-Length: "), F.col("content_length").cast("string"), F.lit("\r\n\r\n"),
    )
    return rows.withColumn("header", header)


def write_warc(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Derivatives as gzip files of whole records, one file a task, in any store that Spark writes."""
    rows = derivatives(pages, date).select(F.concat("header", "block", F.lit("\r\n")).alias("value"))
    rows.write.option("compression", "gzip").option("lineSep", "\r\n").text(path)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query over all ``pages``: every record, blocks as lengths and digests."""
    got = derivatives(spread(read_table(spark, sf_dir, "pages")))
    return got.select(
        "page_id", "record_type", "record_id", "refers_to", F.col("url").alias("target_uri"), "content_type", "content_length", "block_digest",
        F.col("payload").alias("payload_digest"), F.sha2("header", 256).alias("header_sha256"), F.sha2("source", 256).alias("source_header_sha256"),
    )


def _sql_digest(value: str) -> str:
    parts = " || ".join(f"to_base(('0x' || substr(sha1({value}), {1 + 10 * k}, 10))::UBIGINT::BIGINT, 32, 8)" for k in range(4))
    return f"('sha1:' || translate({parts}, '{DIGITS}', '{LETTERS}'))"


def _sql_uuid(kind: str) -> str:
    name = f"('{kind}' || chr(10) || page_id::VARCHAR || chr(10) || url || chr(10) || payload)"
    return rf"regexp_replace(md5({name}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '<urn:uuid:\1-\2-\3-\4-\5>')"


def _sql_decoded(text: str) -> str:
    for entity, letter in ENTITIES:
        text = f"replace({text}, '{entity}', '{letter.replace(chr(39), chr(39) * 2)}')"
    return text


def _sql_plain() -> str:
    text = "regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g')"
    for name in SILENT:
        text = rf"regexp_replace({text}, '(?is)<{name}\b.*?</{name}\s*>', ' ', 'g')"
    text = rf"regexp_replace({text}, '(?i)</?(?:{BLOCKS})\b[^>]*>', chr(10), 'g')"
    text = _sql_decoded(f"regexp_replace({text}, '<[^>]*>', '', 'g')")
    text = rf"regexp_replace({text}, '[ \t\r\f\x0B]+', ' ', 'g')"
    return rf"trim(regexp_replace(regexp_replace({text}, ' ?\n ?', chr(10), 'g'), '\n+', chr(10), 'g'), ' ' || chr(10))"


def _sql_fields() -> str:
    end = "chr(13) || chr(10)"
    title = _sql_decoded(r"regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title\s*>', 1), '[\r\n]+', ' ', 'g')")
    language = r"""regexp_extract(html, '(?i)<html[^>]*\blang="([^"]*)"', 1)"""
    links = rf"""array_to_string(list_transform(regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]*)"', 1), lambda x: 'outlink: ' || x || {end}), '')"""
    return f"('title: ' || {title} || {end} || 'language: ' || {language} || {end} || {links})"


def oracle() -> str:
    """The query's rows in SQL."""
    end = "chr(13) || chr(10)"
    source = f"('HTTP/1.1 200 OK' || {end} || 'Content-Type: text/html; charset=utf-8' || {end} || 'Content-Length: ' || strlen(html)::VARCHAR || {end} || {end})"
    kinds = (
        ("response", "application/http; msgtype=response", "source || html", "NULL::VARCHAR"),
        ("metadata", "application/warc-fields", _sql_fields(), _sql_uuid("response")),
        ("conversion", "text/plain", _sql_plain(), _sql_uuid("response")),
    )
    made = " UNION ALL ".join(
        f"SELECT page_id, url, payload, source, '{k}' AS record_type, {_sql_uuid(k)} AS record_id, {to} AS refers_to, '{mime}' AS content_type, {block} AS block FROM s"
        for k, mime, block, to in kinds
    )
    header = (
        f"'WARC/1.1' || {end} || 'WARC-Type: ' || record_type || {end} || 'WARC-Record-ID: ' || record_id || "
        f"coalesce({end} || 'WARC-Refers-To: ' || refers_to, '') || {end} || 'WARC-Target-URI: ' || url || {end} || 'WARC-Date: {DATE}' || {end} || "
        f"'Content-Type: ' || content_type || {end} || 'WARC-Block-Digest: ' || block_digest || {end} || 'WARC-Payload-Digest: ' || payload || "
        f"{end} || 'Content-Length: ' || content_length::VARCHAR || {end} || {end}"
    )
    return f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
s AS (SELECT *, {_sql_digest('html')} AS payload, {source} AS source FROM p),
r AS ({made}),
d AS (SELECT *, strlen(block)::BIGINT AS content_length, {_sql_digest('block')} AS block_digest FROM r)
SELECT page_id, record_type, record_id, refers_to, url AS target_uri, content_type, content_length, block_digest, payload AS payload_digest,
  sha256({header}) AS header_sha256, sha256(source) AS source_header_sha256
FROM d
"""
