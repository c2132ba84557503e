"""Local alignment of ordered query chunks to a reference text.

The scores of a row depend on the cell to the left only through a gap chain, so a row is filled as one numpy pass over the cells above
and a running maximum along the row. Traceback prefers a pair, then a skipped reference word, then a skipped query word; the best
cell is the first largest in row order. A gap extends only a positive neighbour.

Many pairs are aligned together (``aligned_together``): the cells of an anti-diagonal need only the two before it, so that each
numpy pass fills one diagonal of all the tables at once, in 16 bits where the scores fit. The results are those of one table at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIR, SKIP_REF, SKIP_QUERY = "m", "d", "i"
#: Cells of the tables that are filled at a time; a larger table is filled alone.
CELLS = 8 << 20
#: A diagonal's numpy passes take about the time of so many cells besides their own; a row's of a single table, and each of its cells.
PASS, ROW, CELL = 20_000, 30_000, 10
#: Characters of the texts that are held as words at a time.
CHARACTERS = 4 << 20
RESULT = (
    "score int, q_pos int, r_pos int, q_end int, r_end int, matches int, mismatches int, gap_count int, cigar string, "
    "result_query string, result_ref string, accuracy_on_words double, accuracy_on_query double, overall_accuracy double"
)


@dataclass(frozen=True)
class Scores:
    match: int = 1
    mismatch: int = -1
    gap: int = -2


@dataclass
class Aligned:
    score: int
    q_pos: int
    r_pos: int
    q_end: int
    r_end: int
    matches: int
    mismatches: int
    gap_count: int
    cigar: str
    result_query: str
    result_ref: str
    accuracy_on_words: float
    accuracy_on_query: float
    overall_accuracy: float


NOTHING = Aligned(0, 0, 0, -1, -1, 0, 0, 0, "", "", "", 0.0, 0.0, 0.0)


def codes(query: Sequence[str], ref: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Both sides as numbers that are equal where the words are, whatever their case."""
    known: dict[str, int] = {}
    both = [known.setdefault(w.upper(), len(known)) for w in (*query, *ref)]
    return np.array(both[: len(query)], np.int64), np.array(both[len(query) :], np.int64)


def filled(q: np.ndarray, r: np.ndarray, s: Scores) -> np.ndarray:
    """The score matrix, one row and column of zeros first."""
    table = np.zeros((len(q) + 1, len(r) + 1), np.int32)
    reach = -s.gap * np.arange(1, len(r) + 1, dtype=np.int32)
    for k in range(1, len(q) + 1):
        above = table[k - 1]
        down = np.where(above[1:] > 0, above[1:] + s.gap, 0)
        best = np.maximum(np.maximum(above[:-1] + np.where(r == q[k - 1], s.match, s.mismatch), down), 0)
        # a chain of gaps from an earlier cell of the row loses one gap a step and dies at zero, as best is never below zero
        table[k, 1:] = np.maximum(np.maximum.accumulate(best + reach) - reach, 0) if s.gap < 0 else best
    return table


def traced(table: np.ndarray, q: np.ndarray, r: np.ndarray, s: Scores) -> tuple[str, int, int, int]:
    """(operations from the front, row, column, score) of the best local alignment."""
    score = int(table.max()) if table.size else 0
    row, col = divmod(int(table.argmax()), table.shape[1]) if score > 0 else (0, 0)
    out = []
    while table[row, col] > 0:
        here = table[row, col]
        if here == table[row - 1, col - 1] + (s.match if q[row - 1] == r[col - 1] else s.mismatch):
            out.append(PAIR)
            row, col = row - 1, col - 1
        elif table[row, col - 1] > 0 and here == table[row, col - 1] + s.gap:
            out.append(SKIP_REF)
            col -= 1
        else:
            out.append(SKIP_QUERY)
            row -= 1
    return "".join(reversed(out)), row, col, score


Codes = tuple[np.ndarray, np.ndarray]


def single(n: int, m: int) -> int:
    """The time of a single table filled by rows, in cells of tables filled together: short queries in long texts have few rows."""
    return n * (ROW + CELL * m)


def batches(sizes: list[tuple[int, int]]) -> Iterator[list[int]]:
    """Positions of pairs of like sizes, so that filling them up to the largest costs less than a batch of their own would."""
    held: list[int] = []
    rows = cols = 0
    for k in sorted(range(len(sizes)), key=lambda k: (int(4 * np.log2(sizes[k][0] + 1)), sizes[k][1])):
        n, m = max(rows, sizes[k][0]), max(cols, sizes[k][1])
        more = (n * m - rows * cols) * len(held) + n * m - sizes[k][0] * sizes[k][1]
        if held and (n * m * (len(held) + 1) > CELLS or more > min(PASS * sum(sizes[k]), single(*sizes[k]))):
            yield held
            held, (n, m) = [], sizes[k]
        held.append(k)
        rows, cols = n, m
    if held:
        yield held


def traced_together(pairs: list[Codes], s: Scores) -> list[tuple[str, int, int, int]]:
    """``traced(filled(q, r, s), q, r, s)`` of each pair (q, r); codes are not negative."""
    n, m, size = max(len(q) for q, _ in pairs), max(len(r) for _, r in pairs), len(pairs)
    few = sum(single(len(q), len(r)) for q, r in pairs) < PASS * (n + m) + n * m * size
    if few or s.gap >= 0 or s.mismatch >= 0:  # without losses, cells beyond a pair's own could hold the best
        return [traced(filled(q, r, s), q, r, s) for q, r in pairs]
    top = 1 + max(int(x.max(initial=0)) for both in pairs for x in both)
    kind = np.int16 if max(top + 1, s.match * (min(n, m) + 1), s.match - s.mismatch, -s.gap) < 1 << 14 else np.int32
    # filled up by codes that equal none; the reference runs backwards, as it does along a diagonal
    down, back = np.full((n, size), top, kind), np.full((m, size), top + 1, kind)
    for k, (q, r) in enumerate(pairs):
        down[: len(q), k], back[m - len(r) :, k] = q, r[::-1]
    lows, highs = np.maximum(np.arange(n + m + 1) - m, 0), np.minimum(np.arange(n + m + 1), n)
    ends = np.cumsum((highs - lows + 1) * size)
    flat, best, buffer = np.empty(int(ends[-1]), kind), np.zeros((n + 1, size), kind), np.empty((n, size), kind)
    lines = [part.reshape(-1, size) for part in np.split(flat, ends[:-1])]
    for d, here in enumerate(lines):
        low, high = max(1, d - m), min(n, d - 1)
        if d <= m:
            here[0] = 0
        if d <= n:
            here[-1] = 0
        if low > high:
            continue
        above, corner = lines[d - 1][low - 1 - lows[d - 1] :], lines[d - 2][low - 1 - lows[d - 2] :]
        count = high - low + 1
        own, other, out = buffer[:count], here[low - lows[d] :][:count], best[low : high + 1]
        np.bitwise_xor(down[low - 1 : high], back[m - d + low : m - d + high + 1], out=own)
        np.minimum(own, 1, out=own)
        np.multiply(own, s.mismatch - s.match, out=own)
        np.add(own, s.match, out=own)
        np.add(own, corner[:count], out=own)
        # a gap is negative, so a neighbour of zero extended by it is below zero
        np.maximum(above[:count], above[1 : count + 1], out=other)
        np.add(other, s.gap, out=other)
        np.maximum(other, own, out=other)
        np.maximum(other, 0, out=other)
        np.maximum(out, other, out=out)
    first = (np.concatenate([[0], ends[:-1]]) - lows * size).tolist()
    cells, places = memoryview(flat), np.array(first)
    found = []
    for k, (row, score) in enumerate(zip(best.argmax(axis=0).tolist(), best.max(axis=0).tolist(), strict=True)):
        if score <= 0:
            found.append(("", 0, 0, 0))
            continue
        col = 1 + int((flat[places[row + 1 : row + m + 1] + (row * size + k)] == score).argmax())
        q, r, here, ops = pairs[k][0].tolist(), pairs[k][1].tolist(), score, []
        at = row * size + k
        while here > 0:
            corner = cells[first[row + col - 2] + at - size]
            if here == corner + (s.match if q[row - 1] == r[col - 1] else s.mismatch):
                ops.append(PAIR)
                row, col, at, here = row - 1, col - 1, at - size, corner
                continue
            left = cells[first[row + col - 1] + at]
            if left > 0 and here == left + s.gap:
                ops.append(SKIP_REF)
                col, here = col - 1, left
            else:
                ops.append(SKIP_QUERY)
                row, at = row - 1, at - size
                here = cells[first[row + col] + at]
        ops.reverse()
        found.append(("".join(ops), row, col, score))
    return found


def run_lengths(ops: Iterable[str]) -> list[tuple[int, str]]:
    return [(sum(1 for _ in run), op) for op, run in groupby(ops)]


def words_along(ref: list[str], query: list[str], q: list[int], r: list[int], found: tuple[str, int, int, int]) -> Aligned:
    """What :func:`align_words` tells of a trace."""
    ops, row, col, score = found
    lead = 0
    while len(ops) + lead < len(query) and col >= 0 and ref[col] != query[0]:
        lead, col = lead + 1, col - 1
    if col < 0:
        lead, col = lead - 1, 0
    ops = SKIP_REF * lead + ops
    i, j, matches, mismatches, gaps, n_q, n_r = col, row, 0, 0, 0, 0, 0
    out_q, out_r = [], []

    def pair() -> bool:
        return q[j] == r[i]

    for op in ops:
        if op == PAIR:
            matches, mismatches = matches + pair(), mismatches + (not pair())
            out_q.append(query[j])
            out_r.append(ref[i])
            i, j, n_q, n_r = i + 1, j + 1, n_q + 1, n_r + 1
        elif op == SKIP_QUERY:
            out_q.append(query[j])
            out_r.append("-")
            j, n_q, gaps = j + 1, n_q + 1, gaps + 1
        else:
            out_q.append("-")
            out_r.append(ref[i])
            i, n_r, gaps = i + 1, n_r + 1, gaps + 1
    while n_q < len(query) and j < len(query) and i < len(ref):
        matches, mismatches = matches + pair(), mismatches + (not pair())
        out_q.append(query[j])
        out_r.append(ref[i])
        i, j, n_q, n_r = i + 1, j + 1, n_q + 1, n_r + 1
    on_words = matches / (matches + mismatches + gaps) if matches + mismatches else 0.0
    on_query = n_q / len(query)
    cigar = "".join(f"{n}{op}" for n, op in run_lengths(ops))
    return Aligned(
        score, row, col, row + n_q - 1, col + n_r - 1, matches, mismatches, gaps, cigar, " ".join(out_q), " ".join(out_r), on_words, on_query, on_words * on_query
    )


def chars_along(ref: str, query: str, q: list[int], r: list[int], found: tuple[str, int, int, int]) -> Aligned:
    """What :func:`align_chars` tells of a trace."""
    ops, row, col, score = found
    i, j, matches, out_q = col, row, 0, []
    runs = run_lengths(ops)
    for n, op in runs:
        if op == PAIR:
            matches += sum(a == b for a, b in zip(q[j : j + n], r[i : i + n], strict=True))
        out_q.append("-" * n if op == SKIP_REF else query[j : j + n])
        i, j = i + n * (op != SKIP_QUERY), j + n * (op != SKIP_REF)
    gaps = sum(n for n, op in runs if op != PAIR)
    on_words = matches / len(ops) if ops else 0.0
    on_query = (j - row) / len(query)
    cigar = "".join(f"{n}{op}" for n, op in runs)
    return Aligned(score, row, col, j, i, matches, len(ops) - matches, gaps, cigar, "".join(out_q), ref[col:i], on_words, on_query, on_words * on_query)


Side = list[str] | str


def aligned_together(texts: list[tuple[Side, Side]], pairs: list[Codes], s: Scores, level: str) -> list[Aligned]:
    """The alignment of each (ref, query), given their codes (query, ref)."""
    along = words_along if level == "word" else chars_along
    out = [NOTHING] * len(texts)
    full = [k for k, (ref, query) in enumerate(texts) if ref and query]
    for batch in batches([(len(pairs[k][0]), len(pairs[k][1])) for k in full]):
        held = [full[k] for k in batch]
        for k, found in zip(held, traced_together([pairs[k] for k in held], s), strict=True):
            out[k] = along(*texts[k], pairs[k][0].tolist(), pairs[k][1].tolist(), found)
    return out


def align_words(ref: list[str], query: list[str], s: Scores = Scores()) -> Aligned:
    """Word level: extended to the left by reference words up to the query's first word or length, and to the right word by word."""
    return aligned_together([(ref, query)], [codes(query, ref)], s, "word")[0]


def align_chars(ref: str, query: str, s: Scores = Scores()) -> Aligned:
    """Character level: gaps count as mismatches, nothing is extended, ends are exclusive."""
    return aligned_together([(ref, query)], [codes(query, ref)], s, "char")[0]


def align_column(ref: Column, query: Column, level: str = "word", s: Scores = Scores()) -> Column:
    """A struct of ``RESULT`` for two text columns."""

    def run(refs: pd.Series, queries: pd.Series) -> pd.DataFrame:
        split: Callable[[str], Side] = str.split if level == "word" else str.strip
        rows: list[Aligned] = []
        texts: list[tuple[Side, Side]] = []
        size = 0

        def align() -> None:
            rows.extend(aligned_together(texts, [codes(query, ref) for ref, query in texts], s, level))
            texts.clear()

        for a, b in zip(refs, queries, strict=True):
            a, b = a or "", b or ""
            texts.append((split(a), split(b)))
            size += len(a) + len(b)
            if size > CHARACTERS:
                align()
                size = 0
        align()
        return pd.DataFrame([tuple(vars(a).values()) for a in rows], columns=list(Aligned.__dataclass_fields__))

    return F.pandas_udf(run, RESULT)(ref, query)


def pretty(a: Aligned) -> str:
    """Query, marks and reference, one under the other."""
    q, r = a.result_query.split(" "), a.result_ref.split(" ")
    width = [max(len(x), len(y)) for x, y in zip(q, r, strict=False)]
    mark = [" " if "-" in (x, y) else "|" if x.upper() == y.upper() else "." for x, y in zip(q, r, strict=False)]
    rows = ([x.ljust(n) for x, n in zip(part, width, strict=False)] for part in (q, mark, r))
    return "\n".join(" ".join(row).rstrip() for row in rows)


@dataclass(frozen=True)
class Policy:
    """How a recording's chunks move over its text."""

    accepted: float = 0.95
    pending: float = 0.8
    level: str = "word"
    scores: Scores = Scores()
    skip: int = 3
    cut: int = 5
    space: int = 1000
    cumulate: int = 200
    terminate: int = 100


Placed = tuple[str, str, str, Aligned]


def walk(target: str, chunks: list[tuple[str, str]], p: Policy, out: list[Placed]) -> Generator[tuple[Side, Side, Codes], Aligned, None]:
    """Asks for one alignment (ref, query, codes) after the other, and adds what found a place to ``out``."""
    split: Callable[[str], Side] = str.split if p.level == "word" else str.strip
    text, known = split(target), {}
    told = np.array([known.setdefault(w.upper(), len(known)) for w in text], np.int64)
    cursor, space, fails, moved = -1, p.space, 0, False
    for name, raw in chunks:
        if fails > p.terminate and not moved:
            return
        query = split(raw)
        if len(query) < p.skip:
            space += p.cumulate
            continue
        window = slice(None) if cursor == -1 else slice(cursor, cursor + space)
        a = yield text[window], query, (np.array([known.setdefault(w.upper(), len(known)) for w in query], np.int64), told[window])
        tier = "perfect" if a.overall_accuracy == 1 else "accepted" if a.overall_accuracy >= p.accepted else "pending" if a.overall_accuracy >= p.pending else ""
        if not tier:
            fails += 1
            space += p.cumulate
            continue
        fails = 0
        gapped = tier != "perfect" and SKIP_QUERY in a.cigar
        if not gapped:
            out.append((name, tier, a.result_ref, a))
        elif a.mismatches <= len(query) / 10 + 1:
            out.append((name, tier, a.result_query, a))
        if len(query) > p.cut * (2 if tier == "pending" else 1):
            cursor, space, moved = cursor + a.r_end, p.space, True
        else:
            space += p.cumulate


def placed_together(recordings: list[tuple[str, list[tuple[str, str]]]], p: Policy = Policy()) -> list[list[Placed]]:
    """:func:`aligned_chunks` of each (target, chunks): the recordings go side by side, a chunk of each at a time."""
    out: list[list[Placed]] = [[] for _ in recordings]
    walks = [walk(target, chunks, p, placed) for (target, chunks), placed in zip(recordings, out, strict=True)]
    asked = [(w, got) for w in walks if (got := next(w, None))]
    while asked:
        answers = aligned_together([got[:2] for _, got in asked], [got[2] for _, got in asked], p.scores, p.level)
        asked = [(w, got) for (w, _), a in zip(asked, answers, strict=True) if (got := answered(w, a))]
    return out


def answered(w: Generator, a: Aligned) -> tuple | None:
    """What is asked next; none at the end."""
    try:
        return w.send(a)
    except StopIteration:
        return None


def aligned_chunks(target: str, chunks: list[tuple[str, str]], p: Policy = Policy()) -> Iterator[Placed]:
    """(file_name, tier, text, alignment) for the chunks, in order, that found a place.

    Until the first chunk moves the cursor the whole text is searched; then a window from the cursor, which grows by ``cumulate``
    with each chunk that does not move it. Too many failures in a row before that first move end the recording."""
    yield from placed_together([(target, chunks)], p)[0]


ALIGNED = "rec string, file_name string, tier string, gap_class string, text string, accuracy double, r_pos int, r_end int, mismatches int, gap_count int"


def align_recordings(targets: DataFrame, queries: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """The windowed alignment join of targets (rec, text) and queries (rec, ord, file_name, text).

    Sequential in a recording, parallel over recordings; a target travels once to its recording's task. A task reads its recordings
    in order, and aligns as many side by side as have ``CHARACTERS`` together. Recordings without a target give no rows (see
    :func:`voxloom.operators.manifest.unmatched`)."""

    def placed(held: list[tuple[str, str, list[tuple[str, str]]]]) -> pd.DataFrame:
        rows = [
            (rec, name, tier, None if tier == "perfect" else "gap" if "-" in text else "nogap", text, a.overall_accuracy, a.r_pos, a.r_end, a.mismatches, a.gap_count)
            for (rec, *_), found in zip(held, placed_together([h[1:] for h in held], policy), strict=True)
            for name, tier, text, a in found
        ]
        return pd.DataFrame(rows, columns=[f.strip().split(" ")[0] for f in ALIGNED.split(",")])

    def run(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[str, str, list[tuple[str, str]]]] = []
        size = 0
        for table in tables:
            for rec, chunk, name, text in zip(table["rec"], table["_chunk"], table["file_name"], table["text"], strict=True):
                known = bool(held) and held[-1][0] == rec
                if not chunk and not known:
                    if size > CHARACTERS:
                        yield placed(held)
                        held, size = [], 0
                    held.append((rec, text or "", []))
                elif chunk and known:
                    held[-1][2].append((name, text or ""))
                size += len(text or "")
        yield placed(held)

    none = [F.lit(None).cast(queries.schema[c].dataType).alias(c) for c in ("ord", "file_name")]
    first = targets.select("rec", F.lit(False).alias("_chunk"), *none, "text")
    rows = first.union(queries.select("rec", F.lit(True).alias("_chunk"), "ord", "file_name", "text")).repartition("rec")
    return rows.sortWithinPartitions("rec", "_chunk", F.asc_nulls_last("ord"), F.asc_nulls_last("file_name")).mapInPandas(run, ALIGNED)
