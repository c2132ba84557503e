"""Quality rules as a learned decision list (operator 8, DataFrame functions only).

Statistics of every whole text are Spark expressions. A decision list for rejection is learned from labelled statistics
by sequential covering: grow a conjunction of thresholds by FOIL gain on two thirds of the labelled rows, prune it on
the last third, keep it if it is precise enough there, take away what it covers, go on. The result is an ordered
conditional expression, so that applying it is part of the same scan.

The learner sees a bounded sample: at most ``MAX_LABELLED`` labelled documents, those with the smallest hashes of
doc_id, less those that the base rules reject anyway: the list is for what they leave. Everything else covers all rows.

Defined cases: a null or empty text has no words and fails the base rules; labels without documents, with null quality
or with several rows for a document (the lowest counts) are handled; without labels of both kinds no rule is learned and
only the base rules reject; repeated rows are judged alike; further columns are carried along.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import BLANKS, blank_words, let
from voxloom.session import read_table, spread

MAX_LABELLED = 6000
MIN_PRECISION, MIN_COVER, MAX_RULES, MAX_CONDITIONS, CUTS = 0.99, 8, 10, 4, 48
#: A text of up to so many words packs a window's hash and place into one long.
PACKED = 65_536
FEATURES = ("words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "exclaim_share", "distinct_share", "words_per_line")


def repeated_words(ws: Column) -> Column:
    """How many words are in a 3-word window found twice or more, first findings included."""
    starts = F.sequence(F.lit(0), F.size(ws) - 3)

    def window(i: Column) -> Column:
        return F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2))

    def twice(sorted_windows: Column, same) -> Column:
        return F.filter(
            sorted_windows,
            lambda x, k: F.coalesce(same(x, F.get(sorted_windows, k - 1)), F.lit(False))
            | F.coalesce(same(x, F.get(sorted_windows, k + 1)), F.lit(False)),
        )

    packed = F.sort_array(F.transform(starts, lambda i: window(i).bitwiseAND(F.lit(-PACKED)).bitwiseOR(i.cast("long"))))
    quick = let(packed, lambda s: F.transform(
        twice(s, lambda x, y: F.shiftright(x, 16) == F.shiftright(y, 16)), lambda x: x.bitwiseAND(F.lit(PACKED - 1)).cast("int")
    ))
    pairs = F.sort_array(F.transform(starts, lambda i: F.struct(window(i).alias("h"), i.alias("i"))))
    long = let(pairs, lambda s: F.transform(twice(s, lambda x, y: x["h"] == y["h"]), lambda x: x["i"]))
    places = F.when(F.size(ws) < 3, F.array().cast("array<int>")).when(F.size(ws) <= PACKED, quick).otherwise(long)
    return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))))


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``_s`` of counts of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")

    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.char_length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda ls: F.struct(F.size(ls).cast("long").alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("dup"))).alias("lines"),
            repeated_words(ws).cast("long").alias("n_repeat_words"),
            F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_upper"),
            F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclaim"),
            F.size(F.array_distinct(ws)).cast("long").alias("n_distinct"),
        )

    # a generator of one row: filters on the counts use what was computed instead of computing it for each count they name
    return docs.drop("_s").select("*", F.explode(F.array(let(blank_words(F.col("text")), of_words))).alias("_s"))


def features() -> dict[str, Column]:
    """The learner's numbers, from the struct of counts."""
    s = lambda k: F.col(f"_s.{k}").cast("double")
    over = lambda a, b: a / F.greatest(b, F.lit(1.0))
    return {
        "words": s("n_words"),
        "mean_word": over(s("word_chars"), s("n_words")),
        "symbol_share": over(s("n_symbols"), s("word_chars")),
        "dup_line_share": over(s("lines.dup"), s("lines.n")),
        "repeat_share": over(s("n_repeat_words"), s("n_words")),
        "upper_share": over(s("n_upper"), s("word_chars")),
        "exclaim_share": over(s("n_exclaim"), s("word_chars")),
        "distinct_share": over(s("n_distinct"), s("n_words")),
        "words_per_line": over(s("n_words"), s("lines.n")),
    }


def base_failed() -> Column:
    """Whether the base rules reject, from the struct of counts."""
    return (F.col("_s.n_words") < 50) | (F.col("_s.n_repeat_words") * 100 > F.col("_s.n_words") * 50)


@dataclass(frozen=True)
class Condition:
    """``feature >= cut`` if ``above``, else ``feature < cut``."""

    feature: str
    above: bool
    cut: float

    def holds(self, row: dict) -> bool:
        return (row[self.feature] >= self.cut) == self.above

    def column(self, named: dict[str, Column]) -> Column:
        value = named[self.feature]
        return value >= self.cut if self.above else value < self.cut


def grow(rows: list[tuple[dict, bool]]) -> list[Condition]:
    """A conjunction with few kept rows among those it covers, each condition chosen by FOIL gain."""
    rule: list[Condition] = []
    covered = rows
    while len(rule) < MAX_CONDITIONS:
        bad, good = sum(y for _, y in covered), sum(not y for _, y in covered)
        if not bad or not good:
            break
        before, best = math.log2(bad / (bad + good)), (1e-9, None)
        for name in FEATURES:
            ordered = sorted((x[name], y) for x, y in covered)
            total, seen_bad, step = len(ordered), 0, max(1, len(ordered) // CUTS)
            for k in range(1, total):
                seen_bad += ordered[k - 1][1]
                if ordered[k][0] == ordered[k - 1][0] or (k % step and ordered[k][1] == ordered[k - 1][1]):
                    continue
                cut = (ordered[k][0] + ordered[k - 1][0]) / 2
                for above, p, n in ((False, seen_bad, k), (True, bad - seen_bad, total - k)):
                    if p and (gain := p * (math.log2(p / n) - before)) > best[0]:
                        best = (gain, Condition(name, above, cut))
        if best[1] is None:
            break
        rule.append(best[1])
        covered = [r for r in covered if best[1].holds(r[0])]
    return rule


def score(rule: list[Condition], rows: list[tuple[dict, bool]]) -> tuple[int, int]:
    """(rejected rightly, rejected wrongly)."""
    hit = [y for x, y in rows if all(c.holds(x) for c in rule)]
    return sum(hit), len(hit) - sum(hit)


def learn(rows: list[tuple[dict, bool]]) -> list[list[Condition]]:
    """The decision list: ordered conjunctions that reject. rows: (features, bad); their order decides the folds."""
    rules: list[list[Condition]] = []
    rest = rows
    for _ in range(MAX_RULES):
        growing, pruning = [r for k, r in enumerate(rest) if k % 3], rest[::3]
        rule = grow(growing)
        if not rule:
            break
        worth = lambda r: (lambda p, n: (p - 5 * n) / (p + n) if p + n else -2)(*score(r, pruning))
        rule = max((rule[: k + 1] for k in range(len(rule))), key=worth)
        p, n = score(rule, pruning)
        all_p, all_n = score(rule, rest)
        if all_p < MIN_COVER or p < MIN_PRECISION * (p + n) or all_p < MIN_PRECISION * (all_p + all_n) or not p:
            break
        rules.append(rule)
        rest = [r for r in rest if not all(c.holds(r[0]) for c in rule)]
    return rules


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> list[tuple[dict, bool]]:
    """(features, bad) of at most ``most`` labelled documents that pass the base rules, by doc_id; which ones depends on doc_ids only."""
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    n = known.count()
    space = 1 << 20
    share = space if n <= most else int(space * most * 0.95 / n)
    chosen = known.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(space)) < share).limit(most)
    read = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    named = features()
    got = statistics(read).where(~base_failed()).select("doc_id", "_quality", *(named[k].alias(k) for k in FEATURES)).limit(most).collect()
    got.sort(key=lambda r: (r["doc_id"], *(r[k] for k in FEATURES)))
    return [({k: r[k] for k in FEATURES}, r["_quality"] == 0) for r in got]


def decision_column(rules: list[list[Condition]]) -> Column:
    """The number of the first rule that rejects, from 1; 0: none does."""
    named = features()
    out = None
    for k, rule in enumerate(rules, 1):
        every = rule[0].column(named)
        for c in rule[1:]:
            every = every & c.column(named)
        out = F.when(every, F.lit(k)) if out is None else out.when(every, F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with the struct ``_s`` of counts, ``base_failed``, ``rule`` and ``kept``."""
    rules = learn(labelled_sample(docs, labels))
    out = statistics(docs).withColumn("base_failed", base_failed()).withColumn("rule", decision_column(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query over all ``documents``, learning from ``labels``."""
    docs = spread(read_table(spark, sf_dir, "documents")).select("doc_id", "text")
    return judged(docs, read_table(spark, sf_dir, "labels")).select(
        "doc_id", "_s.n_words", "_s.word_chars", "_s.n_symbols", F.col("_s.lines.dup").alias("n_dup_lines"),
        "_s.n_repeat_words", "base_failed", "kept", "rule",
    )
