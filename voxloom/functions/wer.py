"""Word error rate inside Catalyst.

Each distinct word of a pair gets a code point, so that the built-in ``levenshtein`` counts word edits. A pair may hold up to
``DISTINCT_WORDS`` distinct words; rows beyond that give null instead of a wrong number, and :func:`word_edits_array` counts
those without such a bound.

An empty reference has no rate (null); its insertions still count in a corpus's edits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.functions.binding import let
from voxloom.functions.text import tokens

#: Code points from U+0100 up to the surrogates.
FIRST, DISTINCT_WORDS = 0x100, 0xD800 - 0x100


def encoded(words: Column, known: Column) -> Column:
    """The words of one side as a string of one character each."""
    codes = F.transform(words, lambda w: F.lpad(F.hex((F.array_position(known, w) + (FIRST - 1)).cast("long")), 4, "0"))
    return F.decode(F.unhex(F.array_join(codes, "")), "UTF-16BE")


def word_edits(reference: Column, hypothesis: Column) -> Column:
    """Substitutions, deletions and insertions between two arrays of words."""

    def count(x: Column) -> Column:
        r, h, known = x["r"], x["h"], x["known"]
        short = F.when(F.size(r) == 0, F.size(h)).when(F.size(h) == 0, F.size(r))
        return short.when(F.size(known) <= DISTINCT_WORDS, F.levenshtein(encoded(r, known), encoded(h, known))).cast("long")

    both = F.struct(reference.alias("r"), hypothesis.alias("h"), F.array_distinct(F.concat(reference, hypothesis)).alias("known"))
    return let(both, count)


def word_edits_array(reference: Column, hypothesis: Column) -> Column:
    """The same by a row-wise fold over arrays, with no bound on distinct words."""
    first = F.sequence(F.lit(0), F.size(hypothesis))

    def row(above: Column, word: Column, at: Column) -> Column:
        return F.aggregate(
            F.arrays_zip(hypothesis.alias("h"), F.slice(above, 1, F.size(hypothesis)).alias("d"), F.slice(above, 2, F.size(hypothesis)).alias("u")),
            F.array(at),
            lambda out, x: F.concat(out, F.array(F.least(
                x["d"] + (x["h"] != word).cast("int"), x["u"] + 1, F.element_at(out, -1) + 1
            ))),
        )

    done = F.aggregate(
        F.transform(reference, lambda w, i: F.struct(w.alias("w"), (i + 1).alias("i"))), first, lambda above, x: row(above, x["w"], x["i"])
    )
    return F.when(F.size(hypothesis) == 0, F.size(reference)).otherwise(F.element_at(done, -1)).cast("long")


def utterance_wer(reference: Column, hypothesis: Column) -> Column:
    """100 * edits / reference words of two texts; null for a reference without words."""
    both = F.struct(tokens(reference).alias("r"), tokens(hypothesis).alias("h"))
    return let(both, lambda x: F.when(F.size(x["r"]) > 0, 100.0 * word_edits(x["r"], x["h"]) / F.size(x["r"])))


def corpus_wer(edits: Column, reference_words: Column) -> Column:
    """An aggregate: the ratio of sums, not the mean of ratios."""
    return F.when(F.sum(reference_words) > 0, 100.0 * F.sum(edits) / F.sum(reference_words))
