"""Word shingles as sorted arrays of 64-bit hashes, computed on Arrow batches with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bounded(batches: Iterator[pa.RecordBatch], text: int, most: int = 6_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of column ``text``, or one row where a text is longer."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy()
        part = np.cumsum(sizes, dtype=np.int64) // most
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def coded_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, the code of each word in order, where each text's
    codes begin and the last end)."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded, starts = parts.flatten().dictionary_encode(), parts.offsets.to_numpy()
    words, which = coded.dictionary, coded.indices.to_numpy()
    none = pc.index(words, "").as_py()
    if none >= 0:
        real = which != none
        ends = np.concatenate([[0], np.cumsum(real)])
        which, starts = which[real], ends[starts]
        # the empty word goes: words behind it move up
        words, which = pa.concat_arrays([words[:none], words[none + 1 :]]), which - (which > none)
    return words, which, starts


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, where each text's words begin and the last end)."""
    words, which, starts = coded_words(texts)
    by_word = np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))
    return by_word[which], starts


def shingle_sets(texts: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """For each text its distinct shingles, sorted; a text of fewer words, but not none, is one shingle."""
    words, starts = word_hashes(texts)
    rolled = words[: max(0, len(words) - width + 1)].copy()
    for k in range(1, width):
        rolled = rolled * STEP + words[k : len(rolled) + k]
    rolled = mixed(rolled)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        n = b - a
        if n >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif n:
            whole = np.array([n], np.uint64)
            for w in words[a:b]:
                whole = whole * STEP + w
            yield mixed(whole ^ STEP)
        else:
            yield words[:0]
