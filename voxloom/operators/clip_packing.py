"""Packing short clips, in order, into windows of fixed length after cyclic patterns of clips and pauses.

A clip longer than a window is rejected instead of blocking the rest, and the clip that did not fit is carried on to the end.
Windows without a clip are dropped, but use up their pattern. Pauses are drawn from hashes of the group, window and place."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: the pattern cycles of the three packers; s is a clip, - a pause ------------------------------------
LABELLED = (
    "sssss", "ssss-", "sss-s", "sss--", "ss-ss", "ss-s-", "ss--s", "ss---", "s-sss", "s-ss-", "s-s-s", "s-s--", "s--ss", "s--s-", "s---s",
    "s----", "-ssss", "-sss-", "-ss-s", "-ss--", "-s-ss", "-s-s-", "-s--s", "-s---", "--sss", "--ss-", "--s-s", "--s--", "---ss",
)
UNLABELLED = ("sssss", "ssss-", "sss-s", "ss-ss", "s-sss", "-ssss")
STREAMED = ("s---", "-s--", "--s-", "---s", "s-s-", "-s-s", "ss--", "-ss-", "--ss", "sss-", "-sss")
# ------------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Packing:
    """Lengths are in samples. pad: to so many letters a window's type is filled with pauses."""

    patterns: tuple[str, ...] = LABELLED
    window: int = 30 * 16000
    pause_least: int = 5 * 16000
    pause_most: int = 10 * 16000
    pad: int = 5
    keep_silent: bool = False
    seed: int = 0


@dataclass
class State:
    """What a stream of clips leaves behind between batches: the window being filled."""

    turn: int = 0
    place: int = 0
    at: int = 0
    kind: str = ""
    clips: list[tuple[str, int]] = field(default_factory=list)
    windows: int = 0


def pause(p: Packing, group: str, state: State) -> int:
    """The length of the pause at this place."""
    room = p.window - state.at
    low, high = min(room - 1, p.pause_least), min(room, p.pause_most)
    if high <= low:
        return max(0, low)
    return low + xxhash.xxh64_intdigest(f"{p.seed}:{group}:{state.turn}:{state.place}") % (high - low)


def closed(p: Packing, state: State) -> tuple[int, str, list[tuple[str, int]]] | None:
    """Ends the window; (number, type, clips with offsets) if it counts."""
    done = None
    if state.clips or (p.keep_silent and state.kind):
        state.windows += 1
        done = (state.windows, state.kind.ljust(p.pad, "-"), state.clips)
    state.turn, state.place, state.at, state.kind, state.clips = state.turn + 1, 0, 0, "", []
    return done


def packed(p: Packing, group: str, clips: Iterator[tuple[str, int]], state: State, rejects: list[str], last: bool) -> Iterator[tuple[int, str, list[tuple[str, int]]]]:
    """Windows that the clips fill; the state goes on to the next call unless this is the last."""
    for name, length in clips:
        if length > p.window:
            rejects.append(name)
            continue
        while True:
            pattern = p.patterns[state.turn % len(p.patterns)]
            while state.place < len(pattern) and pattern[state.place] == "-":
                state.at += pause(p, group, state)
                state.kind += "-"
                state.place += 1
            if state.place < len(pattern) and state.at + length <= p.window:
                state.clips.append((name, state.at))
                state.at += length
                state.kind += "s"
                state.place += 1
                break
            if done := closed(p, state):
                yield done
    if last and (done := closed(p, state)):
        yield done


WINDOWS = "part string, window_no int, type string, ord int, clip string, start_at long"


def pack_clips(clips: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """(part, window_no, type, ord, clip, start_at): clips (part, ord, clip, length) in their windows, each part by itself.

    Rejected clips have a null window."""
    names = [f.strip().split(" ")[0] for f in WINDOWS.split(",")]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["ord", "clip"])
        rejects: list[str] = []
        stream = zip(rows["clip"], rows["length"], strict=True)
        out = [
            (key[0], n, kind, k, clip, at)
            for n, kind, held in packed(packing, str(key[0]), stream, State(), rejects, last=True)
            for k, (clip, at) in enumerate(held, 1)
        ]
        out += [(key[0], None, None, None, clip, None) for clip in rejects]
        table = pd.DataFrame(out, columns=names)
        return table.astype({"window_no": "Int32", "ord": "Int32", "start_at": "Int64"})

    given = clips.select("part", "ord", "clip", F.col("length").cast("long").alias("length"))
    return given.groupBy("part").applyInPandas(run, WINDOWS)


def window_manifest(windows: DataFrame, texts: DataFrame) -> DataFrame:
    """(part, file_name, transcription, type): the texts of each window joined in order."""
    met = windows.where("window_no IS NOT NULL").join(texts.select("part", "clip", "text"), ["part", "clip"])
    ordered = F.array_sort(F.collect_list(F.struct("ord", "text")))
    return met.groupBy("part", "window_no", "type").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("transcription")).select(
        "part", F.concat(F.col("window_no").cast("string"), F.lit(".wav")).alias("file_name"), "transcription", "type"
    )


def window_samples(length: int, clips: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """The samples of a window, silent where no clip is."""
    out = np.zeros(length)
    for samples, at in clips:
        out[at : at + len(samples)] = samples
    return out
