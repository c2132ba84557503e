"""Sample and label arrays as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rms(samples: Column) -> Column:
    """Root mean square; null for an empty array."""
    total = F.aggregate(samples, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return F.when(F.size(samples) > 0, F.sqrt(total / F.size(samples)))


def is_silent(samples: Column, threshold: float = 1e-9) -> Column:
    return rms(samples) < threshold


def duration(samples: Column, rate: int = 16000) -> Column:
    """Seconds."""
    return F.size(samples) / F.lit(rate)


def zeros(n: Column) -> Column:
    return F.array_repeat(F.lit(0.0), n.cast("int"))


def mixed_in(buffer: Column, clip: Column, start: Column) -> Column:
    """``buffer`` with ``clip`` written over it from ``start`` (0-based)."""
    head = F.slice(buffer, 1, start)
    tail = F.slice(buffer, start + F.size(clip) + 1, F.greatest(F.size(buffer) - start - F.size(clip), F.lit(0)))
    return F.concat(head, clip, tail)


def fixed_chunks(samples: Column, size: int) -> Column:
    """Array of arrays of ``size`` samples; the last is padded with zeros; none for an empty array."""
    n = F.ceil(F.size(samples) / F.lit(size)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.slice(samples, k * size + 1, size))
    padded = F.transform(cut, lambda c: F.concat(c.cast("array<double>"), F.array_repeat(F.lit(0.0), F.lit(size) - F.size(c))))
    return F.when(F.size(samples) > 0, padded).otherwise(F.array().cast("array<array<double>>"))


def segment_range(segment: Column, total: Column, duration_s: int = 120, chunk_s: int = 5) -> Column:
    """(first, last) chunk ordinals, from 1, of a segment, from 1."""
    per = duration_s // chunk_s
    return F.struct(((segment - 1) * per + 1).alias("first"), F.least(segment * per, total).alias("last"))


def padded_labels(labels: Column, longest: Column, fill: int = -100) -> Column:
    """Labels filled up to the longest of the batch."""
    return F.concat(labels, F.array_repeat(F.lit(fill), (longest - F.size(labels)).cast("int")))


def without_first(labels: Column, token: int) -> Column:
    """Labels without a leading token, where they begin with it."""
    return F.when(F.get(labels, F.lit(0)) == token, F.slice(labels, 2, F.greatest(F.size(labels), F.lit(0)))).otherwise(labels)


def restored_labels(labels: Column, pad: int, fill: int = -100) -> Column:
    return F.transform(labels, lambda x: F.when(x == fill, F.lit(pad)).otherwise(x))


def concatenated(*parts: Column) -> Column:
    return F.concat(*parts)
