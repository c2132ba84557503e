"""Streaming counterparts: not-yet-done records, and packing with the open window as state."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from voxloom.operators.clip_packing import Packing, State, packed

PACKED = "part string, window_no int, type string, ord int, clip string, start_at long"
SAVED = "state string"


def undone(stream: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Records of a stream whose key is not in a static listing."""
    return stream.join(done.select(*on), on, "left_anti")


def once(stream: DataFrame, on: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """The first record of each key within the watermark; state older than that is dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(on)


def pack_stream(clips: DataFrame, packing: Packing = Packing(), close: str = "") -> DataFrame:
    """Windows of a stream of clips (part, ord, clip, length) that comes in order for each part.

    A window leaves as soon as a clip does not fit it. What is open stays in the state as long as the stream runs, and a row whose
    clip equals ``close`` ends its part. Rejected clips leave with a null window."""
    names = [f.strip().split(" ")[0] for f in PACKED.split(",")]

    def run(key: tuple, tables: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = State(**json.loads(state.get[0])) if state.exists else State()
        kept.clips = [tuple(c) for c in kept.clips]
        rows = pd.concat(list(tables)).sort_values(["ord", "clip"])
        last = bool((rows["clip"] == close).any())
        rows = rows[rows["clip"] != close]
        rejects: list[str] = []
        out = [
            (key[0], n, kind, k, clip, at)
            for n, kind, held in packed(packing, str(key[0]), zip(rows["clip"].tolist(), rows["length"].astype(int).tolist(), strict=True), kept, rejects, last)
            for k, (clip, at) in enumerate(held, 1)
        ]
        out += [(key[0], None, None, None, clip, None) for clip in rejects]
        state.update((json.dumps(vars(kept)),))
        yield pd.DataFrame(out, columns=names).astype({"window_no": "Int32", "ord": "Int32", "start_at": "Int64"})

    given = clips.select("part", "ord", "clip", F.col("length").cast("long").alias("length"))
    return given.groupBy("part").applyInPandasWithState(run, PACKED, SAVED, "append", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts by time window and key. An extension: the original has no event time."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))


def run_to_end(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Processes all that is there, batch by batch, and ends; a rerun with the same checkpoint goes on where this one ended."""
    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
