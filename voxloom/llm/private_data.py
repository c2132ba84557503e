"""Personal data by bootstrapped contextual extraction (operator 5, DataFrame functions only).

Base identifiers are found by pattern and checks in every whole text. They seed a graph: a lexical pattern (the word
before, or the two words before) meets the instances it introduces. Pattern scores are the smoothed share of an
identifier kind among what they introduce; instance scores are the best evidence of their patterns; both are iterated by joins
over edges that are counted first, so that copies and very common patterns are single rows. Instances that no base pattern
found and that high-confidence patterns introduce become further spans of that kind.

The words before are those of the whole text, of at most ``BEFORE`` code points; in them, words with @ stand as @ and runs of
digits as 0, so that the members of a list have patterns too. A pattern's share counts values that are neither seeds nor scored
yet in full, except that one with the form of the kind counts ``OPEN`` only: five distinct seeds outweigh one such value.

Regular expressions are written without ambiguous repetition, so that very long runs of letters or digits take linear
time; ``\\G`` lets a match begin where the one before ended.

Defined cases: a null or empty text has no spans; rows that repeat a doc_id are told apart and give a row each; an empty
table gives an empty result; base spans never go; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import Scratch, let
from voxloom.session import read_table, spread

KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
CANDIDATE = r"(?:(?<![^ \t-\r])|\G)[^ \t-\r]*?[0-9@][^ \t-\r]*+"
WORD_BEFORE = r"([^ \t-\r]+)[ \t-\r]+$"
TWO_BEFORE = r"([^ \t-\r]+[ \t-\r]+[^ \t-\r]+)[ \t-\r]+$"
#: Rounds of the graph, least score of a pattern and an instance, least number of distinct seeds behind a pattern,
#: smoothing, the weight of an open value with the form of the kind, and code points of text that hold the words before.
ROUNDS, CONFIDENT, SUPPORT, SMOOTH, OPEN, BEFORE = 3, 0.9, 5, 0.5, 0.05, 256
#: By kind: least digits of a new instance, and of one with the form of the kind.
LEAST_DIGITS, FORM_DIGITS = (0, 1, 4, 3), (0, 1, 12, 7)


def found(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, text, before), in code points; before: the gap to the left."""

    def placed(x: Column) -> Column:
        lengths = F.transform(x["hits"], lambda h, i: F.struct(F.char_length(F.get(x["gaps"], i)).alias("gap"), F.char_length(h).alias("hit")))
        kind = "struct<at:int,out:array<struct<start:int,end:int>>>"
        steps = F.aggregate(
            lengths,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")).cast(kind),
            lambda s, n: F.struct(
                (s["at"] + n["gap"] + n["hit"]).alias("at"),
                F.concat(s["out"], F.array(F.struct((s["at"] + n["gap"]).alias("start"), (s["at"] + n["gap"] + n["hit"]).alias("end")))).alias("out"),
            ).cast(kind),
            lambda s: s["out"],
        )
        return F.zip_with(
            steps, F.zip_with(x["hits"], F.slice(x["gaps"], 1, F.size(x["hits"])), lambda h, g: F.struct(h.alias("h"), g.alias("g"))),
            lambda p, t: F.struct(p["start"].alias("start"), p["end"].alias("end"), t["h"].alias("text"), t["g"].alias("before")),
        )

    return let(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps")), placed)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    doubled = F.transform(
        F.split(F.reverse(number), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x) % 10 == 0


def small_part(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.char_length(bare) <= 2) | ((F.char_length(bare) == 3) & (bare <= "255"))


NONE = "array<struct<kind:int,start:int,end:int>>"


def passing(good: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda m: good(m["text"])


def named(kind: int) -> Callable[[Column], Column]:
    return lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))


def of_kind(kind: int) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end), by kind as in ``KINDS``, then start."""
    checks = {
        "email": (F.contains(text, F.lit("@")), EMAIL, lambda t: F.lit(True)),
        "ip": (F.contains(text, F.lit(".")) & text.rlike("[0-9]"), IP, lambda t: F.forall(F.split(t, r"\."), small_part)),
        "card": (text.rlike("[0-9]"), CARD, lambda t: let(digits(t), lambda d: F.when(F.char_length(d).between(16, 19), luhn(d)).otherwise(F.lit(False)))),
        "phone": (F.contains(text, F.lit("+")), PHONE, lambda t: F.char_length(digits(t)).between(8, 15)),
    }
    parts = []
    for k, kind in enumerate(KINDS):
        gate, pattern, good = checks[kind]
        spans = F.transform(F.filter(found(text, pattern), passing(good)), named(k))
        parts.append(F.when(gate, spans).otherwise(F.array().cast(NONE)))
    return F.concat(*parts)


def candidates(text: Column, spans: Column) -> Column:
    """Tokens with a digit or @: (start, end, value, kind, one, two). kind: that of the base span a token begins, whose text is then
    the value, else null; one, two: the words before. Tokens inside a base span are left out."""
    core = r"^[^A-Za-z0-9+(]+|[^A-Za-z0-9)]+$"

    def left(hits: Column, i: Column) -> Column:
        """The end of the text before candidate i: tokens without a digit or @ lie in the gaps between candidates."""
        parts = [F.get(hits, i - 2)["text"], F.get(hits, i - 1)["before"], F.get(hits, i - 1)["text"], F.get(hits, i)["before"]]
        end = F.lower(F.right(F.concat(*(F.right(F.coalesce(x, F.lit("")), F.lit(BEFORE)) for x in parts)), F.lit(BEFORE)))
        return F.regexp_replace(F.regexp_replace(end, r"[^ \t-\r@]*+@[^ \t-\r]*+", "@"), "[0-9]+", "0")

    def described(m: Column, before: Column) -> Column:
        over = F.get(F.filter(spans, lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"])), F.lit(0))
        return let(over, lambda o: F.struct(
            m["start"].alias("start"), m["end"].alias("end"),
            F.lower(F.when(o.isNull(), F.regexp_replace(m["text"], core, "")).otherwise(F.substring(text, o["start"] + 1, o["end"] - o["start"]))).alias("value"),
            o["kind"].alias("kind"),
            F.regexp_extract(before, WORD_BEFORE, 1).alias("one"),
            F.regexp_extract(before, TWO_BEFORE, 1).alias("two"),
            (o.isNotNull() & (o["start"] < m["start"])).alias("inside"),
        ))

    def all_of(hits: Column) -> Column:
        return F.transform(hits, lambda m, i: let(left(hits, i), lambda before: described(m, before)))

    return F.when(text.rlike("[0-9@]"), F.filter(let(found(text, CANDIDATE), all_of), lambda c: ~c["inside"]))


def admitted(value: Column, least: tuple[int, ...]) -> list[Column]:
    """For each kind, whether a value may be a new instance: an e-mail has an @, an address two separators, others digits."""
    signs = (F.contains(value, F.lit("@")), value.rlike("[.:][^.:]*[.:]"), F.lit(True), F.lit(True))
    return [sign & (F.char_length(digits(value)) >= n) for sign, n in zip(signs, least, strict=True)]


def extracted(docs: DataFrame) -> DataFrame:
    """(doc_id, row, base, cands) for every row; a narrow written table, from one scan of the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), let(text, lambda t: let(
        base_spans(t), lambda s: F.struct(s.alias("base"), candidates(t, s).alias("cands"))
    )).alias("x"))
    return Scratch.write(out.select("doc_id", "row", "x.base", "x.cands"), "spans")


def discovered(rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(row, start, end, kind) of candidates that high-confidence patterns introduce."""
    each = rows.select("row", F.explode("cands").alias("c")).select("row", "c.*")
    patterns = F.array_compact(F.array(
        F.when(F.col("one") != "", F.concat(F.lit("1:"), "one")), F.when(F.col("two") != "", F.concat(F.lit("2:"), "two"))
    ))
    edges = Scratch.write(
        each.select(F.explode(patterns).alias("pattern"), "value", "kind").groupBy("pattern", "value", "kind").agg(F.count("*").alias("n")), "edges"
    )
    seeds = edges.where("kind IS NOT NULL").groupBy("value", "kind").agg(F.lit(1.0).alias("score"))
    scores = seeds
    strong, fits = None, F.get(F.array(*admitted(F.col("value"), LEAST_DIGITS)), F.col("kind"))
    for _ in range(rounds):
        known = edges.join(scores.withColumnRenamed("kind", "as"), "value")
        weight = known.groupBy("pattern", F.col("as").alias("kind")).agg(
            F.sum(F.col("n") * F.col("score")).alias("w"), F.count_distinct(F.when(F.col("kind").isNotNull(), F.col("value"))).alias("support")
        )
        told = edges.join(scores.select("value", F.lit(True).alias("told")).distinct(), "value", "left")
        counted = [F.sum(F.when(F.col("told").isNull() & form, F.col("n") * OPEN).otherwise(F.col("n"))) for form in admitted(F.col("value"), FORM_DIGITS)]
        total = told.groupBy("pattern").agg(F.array(*counted).alias("n"))
        trust = F.col("w") / (F.get("n", F.col("kind")) + SMOOTH)
        strong = weight.where(F.col("support") >= SUPPORT).join(total, "pattern").select("pattern", "kind", trust.alias("trust")).where(F.col("trust") >= CONFIDENT)
        strong = Scratch.write(strong, "patterns")
        new = edges.where("kind IS NULL").drop("kind").join(strong, "pattern").where(fits).groupBy("value", "kind").agg(F.max("trust").alias("score"))
        scores = Scratch.write(seeds.union(new.join(seeds, ["value", "kind"], "left_anti").select("value", "kind", "score")), "instances")
    open_ones = each.where("kind IS NULL")
    met = open_ones.select("row", "start", "end", "value", F.explode(patterns).alias("pattern")).join(strong, "pattern").where(fits)
    return met.groupBy("row", "start", "end").agg(F.min_by("kind", F.struct(-F.col("trust"), F.col("kind"))).alias("kind"))


def joined_spans(spans: Column) -> Column:
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, start, end); spans holds base."""
    rows = extracted(docs)
    more = discovered(rows).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    all_spans = F.sort_array(F.concat("base", F.coalesce("more", F.array().cast(NONE))))
    return rows.drop("cands").join(more, "row", "left").select("doc_id", "base", all_spans.alias("spans"))


def op5_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query over all ``documents``."""
    got = personal_data(spread(read_table(spark, sf_dir, "documents")).select("doc_id", "text"))
    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return got.select("doc_id", *counts, F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))
