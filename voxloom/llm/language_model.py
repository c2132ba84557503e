"""Hashed maximum-entropy language model (operator 9).

``P(word | history) = P(class | history) * P(word | class, history)``. The class of a word follows from its training count (bands
of equal token mass) and a hash of its last two letters. The class factor is a softmax over weights of hashed features: the word
before, the word before that (a skip feature) and both together. The word factor goes down a binary tree of nested classes, by the
bits of the word's hash, to the word: each step is a softmax of two over weights of the same features with the node, on top of
the step's share by counts. Features move the upper ``LEVELS`` levels, and more as the corpus grows; deeper nodes hold few rare words
and keep their shares by count, which scores held-out text better than moving them too. Leaves are at least twice as many as a
class has words; words that still meet in one share it by count. Unknown words share the free place of the rarest band's class of
their ending, which no feature moves.

Counts of all training words are grouped in Spark, keyed by 64-bit hashes of the words. The weights (tables that grow
with the cube root of the training tokens) are trained by distributed gradient updates: in each round every task takes Adagrad steps from the common weights over its own training documents, and the
changes are averaged by their tokens. Rounds see disjoint parts of the training documents, so each is read once for training.
Scoring runs over numpy batches: counts and classes are looked up once for each distinct word of a batch.

Training needs no counts: a word is in the rarest band unless it is one of the few in a compact table of the others, and its steps
lie in the tree's array (at most 16 bytes a word). So it runs once over all tokens at every size. Scoring is sent the counts in
slices of at most ``SLICE`` words; with more words, several passes each add up the tokens of their own slice, whose sum is the same.

Defined cases: a null, empty or blank text is the end token alone; without training documents the model is uniform; a null
doc_id counts as the empty text for the fold; repeated rows give a row each; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import Scratch
from voxloom.llm.shingles import STEP, bounded, coded_words, mixed
from voxloom.session import read_table, spread

FOLDS, HELD_OUT = 5, 1
SLICE = 8_000_000
BANDS, ENDINGS = 4, 4
CLASSES = BANDS * ENDINGS
#: Weights that a task hands over at once; tokens of a class step and of a trainer, before growth.
PART, ROUNDS, RATE, STEP_TOKENS, TRAINER_TOKENS = 1 << 14, 2, 0.1, 8192, 4_000_000
#: Tokens whose steps fit a processor's cache.
AT_ONCE = 4096
#: Levels of the tree that features move, before growth.
LEVELS = 8
#: Bytes of text that a task works on at once, about.
TEXT = 3_000_000
#: A word of its own that no text can hold, and what stands before a text.
END_WORD, BEFORE = "\n", np.uint64(0)


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo the number of folds."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


#: Words of up to so many bytes are hashed together, longer ones one by one.
LONG_WORD = 64


def word_keys(words: pa.Array) -> np.ndarray:
    """A 64-bit key of each word, none of them empty; its lowest two bits are a hash of the word's last two bytes.

    The other bits are a multilinear hash: each byte times the multiplier of its place, added up, then mixed with the length."""
    words = words.cast(pa.string())
    size = pc.binary_length(words).to_numpy()
    few = np.flatnonzero(size > LONG_WORD)
    out = np.empty(len(size), np.uint64)
    for k in few.tolist():
        word = words[k].as_py().encode()
        out[k] = (xxhash.xxh64_intdigest(word) & ~(ENDINGS - 1)) | (xxhash.xxh32_intdigest(word[-2:]) & (ENDINGS - 1))
    rest = np.flatnonzero(size <= LONG_WORD)
    if not len(rest):
        return out
    words, size = words.take(pa.array(rest)) if len(few) else words, size[rest].astype(np.int64)
    first = np.frombuffer(words.buffers()[1], np.int32)[words.offset]
    ends = np.cumsum(size)
    held = np.frombuffer(words.buffers()[2], np.uint8)[first : first + ends[-1]].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(held)) - np.repeat(ends - size, size)
    factor = mixed(np.arange(1, LONG_WORD + 1, dtype=np.uint64) * STEP)
    last = held[ends - 1] + np.where(size > 1, held[ends - 2], np.uint64(0)) * np.uint64(257)
    whole = mixed(np.add.reduceat(held * factor[place], ends - size) + size.astype(np.uint64))
    out[rest] = (whole & ~np.uint64(ENDINGS - 1)) | (mixed(last * STEP) >> np.uint64(62))
    return out


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys of the distinct tokens, code of each token in order with one end for each text, where texts begin and end)."""
    words, which, starts = coded_words(texts)
    n = len(starts) - 1
    codes = np.full(len(which) + n, len(words), np.int64)
    at = np.ones(len(codes), bool)
    at[starts[1:] + np.arange(n)] = False
    codes[at] = which
    return np.append(word_keys(words), word_keys(pa.array([END_WORD]))), codes, starts + np.arange(n + 1)


def word_counts(train: DataFrame) -> DataFrame:
    """(key, c) of every distinct token of the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 0, TEXT):
            keys, codes, _ = tokens(batch.column(0))
            n = np.bincount(codes, minlength=len(keys))
            some = n > 0
            yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(n[some])], ["key", "c"])

    return train.select("text").mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


class Classes:
    """Bands of counts with about equal token mass, and the totals of each class."""

    def __init__(self, histogram: list[tuple[int, int, int]]):
        """histogram: (count, ending, how many words have both)."""
        table = np.array(sorted(histogram) or [(1, 0, 0)], dtype=np.int64)
        mass = np.cumsum(table[:, 0] * table[:, 2])
        self.total, self.distinct = int(mass[-1]), int(table[:, 2].sum())
        # a count belongs to one band whole: the band in which its mass begins
        first = {}
        for (c, _, n), m in zip(table.tolist(), mass.tolist(), strict=True):
            first.setdefault(c, m - c * n)
        bounds = [c for c, m in first.items()]
        band = [min(BANDS - 1, BANDS * m // max(1, self.total)) for m in first.values()]
        self.least = np.array([next((c for c, b in zip(bounds, band, strict=True) if b >= k), 1 << 62) for k in range(1, BANDS)], np.int64)
        of = self.of(table[:, 0], table[:, 1])
        self.tokens = np.bincount(of, table[:, 0] * table[:, 2], CLASSES)
        self.words = np.bincount(of, table[:, 2], CLASSES)

    def of(self, count: np.ndarray, ending: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.least, count, side="right") * ENDINGS + ending

    def word_log10(self, count: np.ndarray, of: np.ndarray) -> np.ndarray:
        """log10 P(word | class); classes of the rarest band keep one free place for all unknown words."""
        spare = (of < ENDINGS).astype(np.float64)
        return np.log10((count + 0.5) / (self.tokens[of] + 0.5 * (self.words[of] + np.maximum(spare, count == 0))))

    def base_log10(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.total + 0.5 * (self.distinct + 1)))


def history(keys: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the three features of each token."""
    one, two = np.empty(len(codes), np.uint64), np.empty(len(codes), np.uint64)
    of = keys[codes]
    one[1:], two[2:] = of[:-1], of[:-2]
    two[:2] = BEFORE
    one[starts[:-1]] = BEFORE
    two[starts[:-1]] = BEFORE
    second = starts[:-1] + 1
    two[second[second < starts[1:]]] = BEFORE
    return mixed(one * STEP), mixed(two * STEP + np.uint64(1)), mixed(one * STEP + two)


class Model:
    """Weights of the class factor and of the tree in one array, and the tree's shares by counts."""

    def __init__(self, classes: Classes):
        self.growth = round((np.log2(max(2, classes.total)) - 22) / 3)
        bits = max(0, self.growth)
        #: Rows of the class factor for the word before, the one before that, and both.
        self.sizes = (1 << (13 + bits), 1 << (13 + bits), 1 << (14 + bits))
        self.rows, self.tree_bits = sum(self.sizes), max(14, 18 + self.growth)
        self.weights = np.zeros(self.rows * CLASSES + (1 << self.tree_bits), np.float32)
        self.depth = np.array([max(0, int(n) - 1).bit_length() + 1 for n in classes.words], np.int64)
        self.first = np.concatenate([[0], np.cumsum(1 << self.depth)])
        #: Levels of the tree, from the top, whose steps the features move; below, words have their shares by count.
        self.moved = LEVELS + max(0, self.growth // 2)
        self.logits = np.zeros(0, np.float32)
        self.common, self.bands = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    @property
    def of_classes(self) -> np.ndarray:
        return self.weights[: self.rows * CLASSES].reshape(-1, CLASSES)

    @property
    def of_tree(self) -> np.ndarray:
        return self.weights[self.rows * CLASSES :]

    def learn_counts(self, classes: Classes, parts: Iterator[Slice]) -> None:
        """The shares of the tree's nodes, and the words outside the rarest band."""
        mass, common, bands = np.zeros(self.first[-1], np.float32), [], []
        for part in parts:
            of = classes.of(part.counts.astype(np.int64), (part.keys & np.uint64(ENDINGS - 1)).astype(np.int64))
            leaf = self.first[of] + (part.keys >> (64 - self.depth[of]).astype(np.uint64)).astype(np.int64)
            np.add.at(mass, leaf, part.counts.astype(np.float32) + np.float32(0.5))
            some = of >= ENDINGS
            common.append(part.keys[some])
            bands.append(of[some] // ENDINGS)
        keys, bands = np.concatenate([*common, self.common]), np.concatenate([*bands, self.bands])
        at = np.argsort(keys)
        self.common, self.bands = keys[at], bands[at].astype(np.int8)
        self.logits = np.full(self.first[-1], np.nan, np.float32)
        for start, depth in zip(self.first[:-1].tolist(), self.depth.tolist(), strict=True):
            m = mass[start : start + (1 << depth)]
            for d in range(depth - 1, -1, -1):
                left, right = m[0::2], m[1::2]
                both = (left > 0) & (right > 0)
                self.logits[start + (1 << d) : start + (2 << d)][both] = np.log(right[both] / left[both])
                m = left + right

    def trained_class(self, keys: np.ndarray) -> np.ndarray:
        """The class of words of the training documents."""
        band = np.zeros(len(keys), np.int64)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, keys), len(self.common) - 1)
            band = np.where(self.common[at] == keys, self.bands[at], 0).astype(np.int64)
        return band * ENDINGS + (keys & np.uint64(ENDINGS - 1)).astype(np.int64)

    @property
    def starts(self) -> list[int]:
        return [0, self.sizes[0], self.sizes[0] + self.sizes[1]]

    def class_rows(self, hashes: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        return tuple((h >> np.uint64(65 - int(n).bit_length())).astype(np.int64) + s for h, n, s in zip(hashes, self.sizes, self.starts, strict=True))

    def paths(self, keys: np.ndarray, of: np.ndarray) -> Paths:
        """The nodes with two sides on the upper part of the way to each known word."""
        depth = self.depth[of]
        taken = np.minimum(depth, self.moved)
        word = np.repeat(np.arange(len(keys)), taken)
        d = np.arange(len(word)) - np.repeat(np.cumsum(taken) - taken, taken)
        left = np.repeat(depth, taken) - d
        lead = np.repeat((keys >> (64 - depth).astype(np.uint64)).astype(np.int64), taken)
        node = np.repeat(self.first[of], taken) + (np.int64(1) << d) + (lead >> left)
        base = self.logits[node]
        some = np.isfinite(base)
        side = 2 * ((lead >> (left - 1)) & 1)[some].astype(np.float32) - 1
        n = np.bincount(word[some], minlength=len(keys))
        base = base[some]
        share = np.bincount(word[some], np.log(1 + np.exp(-side * base)), len(keys))
        return Paths(node[some].astype(np.uint64) * STEP, base, side, np.cumsum(n) - n, n, share)

    def steps(self, paths: Paths, codes: np.ndarray, hashes: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """(number of steps, path entry, tree weights of the three features, logit) of the steps of the tokens ``codes``."""
        n = paths.count[codes]
        at = np.arange(n.sum()) + np.repeat(paths.start[codes] - (np.cumsum(n) - n), n)
        node, shift, table = paths.node[at], np.uint64(64 - self.tree_bits), self.of_tree
        places, z = [], paths.base[at]
        for h in hashes:
            place = np.repeat(h, n)
            place += node
            place >>= shift
            places.append(place.view(np.int64))
            z += table[places[-1]]
        return n, at, places, z

    def tree_log10(self, paths: Paths, codes: np.ndarray, hashes: tuple[np.ndarray, ...]) -> np.ndarray:
        """What the features add to log10 P(word | class) of each token."""
        n, at, _, z = self.steps(paths, codes, hashes)
        z *= paths.side[at]
        np.exp(np.negative(z, out=z), out=z)
        z += 1
        some, out = n > 0, paths.share[codes]
        if len(z):
            each = np.log(z, out=z)
            out[some] -= np.add.reduceat(each, (np.cumsum(n) - n)[some], dtype=np.float64)
        return out / np.log(10)

    def tree_step(self, paths: Paths, codes: np.ndarray, hashes: tuple[np.ndarray, ...], speed: np.ndarray) -> None:
        """One Adagrad step of the tree's weights."""
        where, pushes = [], []
        for s in range(0, len(codes), AT_ONCE):
            _, at, places, z = self.steps(paths, codes[s : s + AT_ONCE], tuple(h[s : s + AT_ONCE] for h in hashes))
            push = 1 / (1 + np.exp(-z)) - (paths.side[at] > 0)
            where += places
            pushes += [push] * 3
        step = np.bincount(np.concatenate(where), np.concatenate(pushes), 1 << self.tree_bits).astype(np.float32)
        speed += step * step
        step *= np.float32(RATE)
        self.of_tree[:] -= np.divide(step, np.sqrt(speed), out=step)


class Paths(NamedTuple):
    """Steps to each of some words: node times ``STEP``, logit by counts, side (1 right, -1 left); where a word's begin, how many,
    and minus the sum of their natural logarithms by counts."""

    node: np.ndarray
    base: np.ndarray
    side: np.ndarray
    start: np.ndarray
    count: np.ndarray
    share: np.ndarray


def class_odds(weights: np.ndarray, rows: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logits less the largest of the token, their exponentials, the sum of those), one row a token."""
    z = weights[rows[0]]
    z += weights[rows[1]]
    z += weights[rows[2]]
    z -= z.max(axis=1, keepdims=True)
    each = np.exp(z)
    return z, each, each.sum(axis=1, keepdims=True)


def class_shares(weights: np.ndarray, rows: tuple[np.ndarray, ...]) -> np.ndarray:
    """P(class | history), one row a token."""
    _, each, total = class_odds(weights, rows)
    each /= total
    return each


def class_log(weights: np.ndarray, rows: tuple[np.ndarray, ...], of: np.ndarray) -> np.ndarray:
    """The natural logarithm of P(class | history) for each token's class ``of``."""
    z, _, total = class_odds(weights, rows)
    return z[np.arange(len(of)), of] - np.log(total[:, 0])


class Slice:
    """The counts of the words whose key falls into one part of the key space."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, part: int, parts: int):
        at = np.argsort(keys)
        narrow = np.uint32 if not len(counts) or counts.max() < 1 << 32 else np.int64
        self.keys, self.counts, self.part, self.parts = keys[at], counts[at].astype(narrow), part, parts

    def mine(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(8)) % np.uint64(self.parts) == self.part if self.parts > 1 else np.ones(len(keys), bool)

    def count(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0).astype(np.int64)


def slices(counts: DataFrame, distinct: int, most: int) -> Iterator[Slice]:
    parts = max(1, -(-distinct // most))
    for part in range(parts):
        mine = counts if parts == 1 else counts.where(F.pmod(F.shiftrightunsigned("key", 8), F.lit(parts)) == part)
        got = mine.toArrow()
        yield Slice(got["key"].to_numpy().view(np.uint64), got["c"].to_numpy(), part, parts)


def gradient_round(train: DataFrame, model: Model, trainers: int) -> DataFrame:
    """(part, n, change): what each task's steps change in each part of the weights, and its tokens."""
    held = train.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, n = copy(held.value), 0
        start = told.weights
        told.weights = start.copy()
        now, speed, tree_speed = told.of_classes, np.full(told.rows, 1e-2, np.float32), np.full(1 << told.tree_bits, 1e-2, np.float32)
        tree_tokens = 1 << (told.tree_bits - 6)
        for batch in bounded(batches, 0, TEXT):
            keys, codes, starts = tokens(batch.column(0))
            used = np.bincount(codes, minlength=len(keys)) > 0
            word_class = told.trained_class(keys)
            of, hashes = word_class[codes], history(keys, codes, starts)
            rows, paths = told.class_rows(hashes), told.paths(keys[used], word_class[used])
            place = np.cumsum(used) - 1
            for s in range(0, len(codes), STEP_TOKENS):
                cut = slice(s, s + STEP_TOKENS)
                mine = tuple(r[cut] for r in rows)
                push = class_shares(now, mine)
                push[np.arange(len(push)), of[cut]] -= 1
                for r, n_rows, first_row in zip(mine, told.sizes, told.starts, strict=True):
                    # few rows are sorted as 16-bit numbers, in linear time
                    order = np.argsort((r - first_row).astype(np.uint16) if n_rows <= 1 << 16 else r, kind="stable")
                    ordered = r[order]
                    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
                    each, count = ordered[first], np.diff(first, append=len(ordered))
                    step = np.add.reduceat(push[order], first, axis=0) / np.sqrt(count)[:, None].astype(np.float32)
                    speed[each] += (step * step).mean(axis=1)
                    now[each] -= RATE * step / np.sqrt(speed[each])[:, None]
            for s in range(0, len(codes), tree_tokens):
                cut = slice(s, s + tree_tokens)
                told.tree_step(paths, place[codes[cut]], tuple(h[cut] for h in hashes), tree_speed)
            n += len(codes)
        if n:
            change = (told.weights - start).reshape(-1, PART)
            for k in np.flatnonzero(change.any(axis=1)).tolist():
                columns = [pa.array([k], pa.int32()), pa.array([n], pa.int64()), pa.array([change[k].astype(np.float16).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "n", "change"])

    return train.select("text").coalesce(trainers).mapInArrow(run, "part int, n long, change binary")


def averaged(changes: DataFrame, weights: np.ndarray, tokens_seen: float) -> np.ndarray:
    """The weights after one round."""

    def add(part: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(PART, np.float64)
        for n, change in zip(rows["n"], rows["change"], strict=True):
            total += n * np.frombuffer(change, np.float16).astype(np.float64)
        return pd.DataFrame({"part": [part[0]], "change": [(total / tokens_seen).astype(np.float32).tobytes()]})

    new = weights.copy().reshape(-1, PART)
    for row in changes.groupBy("part").applyInPandas(add, "part int, change binary").collect():  # as large as the weights
        new[row["part"]] += np.frombuffer(row["change"], np.float32)
    return new.reshape(-1)


SCORES = "doc_id long, row long, n_tokens long, n_known long, base_score double, score double"


def slice_scores(docs: DataFrame, known: Slice, classes: Classes, model: Model) -> DataFrame:
    """The sums over the tokens of one slice, for every row of ``docs`` (doc_id, row, text)."""
    held = docs.sparkSession.sparkContext.broadcast((known, classes, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, told, fit = held.value
        for batch in bounded(batches, 2, TEXT):
            keys, codes, starts = tokens(batch.column(2))
            count, mine = words.count(keys), words.mine(keys)
            of = told.of(count, (keys & np.uint64(ENDINGS - 1)).astype(np.int64))
            values = np.stack([mine, mine & (count > 0), np.where(mine, told.base_log10(count), 0.0), np.where(mine, told.word_log10(count, of), 0.0)], axis=1).astype(np.float64)[codes]
            hashes, seen = history(keys, codes, starts), mine & (count > 0)
            rows, paths = fit.class_rows(hashes), fit.paths(keys[seen], of[seen])
            place, of, chosen = np.cumsum(seen) - 1, of[codes], np.flatnonzero(mine[codes])
            for s in range(0, len(chosen), AT_ONCE):
                at = chosen[s : s + AT_ONCE]
                values[at, 3] += class_log(fit.of_classes, tuple(r[at] for r in rows), of[at]) / np.log(10)
                at = at[seen[codes[at]]]
                values[at, 3] += fit.tree_log10(paths, place[codes[at]], tuple(h[at] for h in hashes))
            if not len(starts) - 1:
                continue
            sums = np.add.reduceat(values, starts[:-1], axis=0)
            columns = [batch.column(0), batch.column(1), *(pa.array(sums[:, k].astype(np.int64)) for k in (0, 1)), *(pa.array(sums[:, k]) for k in (2, 3))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_tokens", "n_known", "base_score", "score"])

    return docs.mapInArrow(run, SCORES)


def fitted(train: DataFrame, most: int = SLICE, rounds: int = ROUNDS) -> tuple[DataFrame, Classes, Model]:
    """(the written counts, the classes, the trained model) from training documents (doc_id, text)."""
    counts = Scratch.write(word_counts(train), "counts")
    ending = F.col("key").bitwiseAND(F.lit(ENDINGS - 1))
    table = counts.groupBy("c", ending.alias("e")).agg(F.count("*").alias("n")).collect()
    classes = Classes([(r["c"], r["e"], r["n"]) for r in table])
    model = Model(classes)
    if not classes.total:
        return counts, classes, model
    model.learn_counts(classes, slices(counts, classes.distinct, most))
    prior = np.log(np.maximum(classes.tokens, 0.5) / max(1.0, classes.tokens.sum())) / 3
    model.of_classes[:] = prior.astype(np.float32)
    trainers = max(1, -(-classes.total // (TRAINER_TOKENS << max(0, model.growth // 2))))
    for k in range(rounds):
        part = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == k)
        changes = Scratch.write(gradient_round(part, model, trainers), "changes")
        seen = changes.groupBy("part").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
        if seen:
            model.weights = averaged(changes, model.weights, seen)
    return counts, classes, model


def scored(docs: DataFrame, most: int = SLICE, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts, classes, model = fitted(docs.where(fold(F.col("doc_id")) != HELD_OUT), most, rounds)
    numbered = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    parts = [slice_scores(numbered, known, classes, model) for known in slices(counts, classes.distinct, most)]
    got = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            got = got.union(p)
        sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
        got = got.groupBy("doc_id", "row").agg(*sums)
    return got.select(
        "doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
        F.lit(classes.total).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query over all ``documents``."""
    return scored(spread(read_table(spark, sf_dir, "documents")))
