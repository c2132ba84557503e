"""Audio over arrays of samples: WAV bytes in, chunks, silence, effects. Kernels are numpy in Arrow-batched UDFs."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.arrays import fixed_chunks
from voxloom.operators.sampling import draw, random_index, uniform

RATE = 16000


def each(arrays: pa.Array) -> Iterator[np.ndarray | None]:
    """The samples of each row where they lie in the Arrow array; None for null."""
    ends, values = arrays.offsets.to_numpy(), arrays.values.to_numpy(zero_copy_only=False)
    for k, valid in enumerate(arrays.is_valid().to_pylist()):
        yield np.asarray(values[ends[k] : ends[k + 1]], float) if valid else None


def lists(rows: Iterable[np.ndarray | None]) -> pa.Array:
    """Rows of samples as an Arrow array: 8 bytes a sample, where lists of Python's numbers take 32."""
    held = list(rows)
    ends = np.cumsum([0, *(0 if x is None else len(x) for x in held)]).astype(np.int32)
    values = pa.array(np.concatenate([np.empty(0), *(x for x in held if x is not None)]), pa.float64(), from_pandas=True)
    return pa.ListArray.from_arrays(ends, values, mask=pa.array([x is None for x in held], pa.bool_()))


def wav_header(content: Column) -> Column:
    """(rate, channels, frames, seconds) from WAV bytes; null where they are none."""

    def run(blobs: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([header(b) for b in blobs], columns=["rate", "channels", "frames", "seconds"]).astype({"rate": "Int32", "channels": "Int32", "frames": "Int64"})

    return F.pandas_udf(run, "rate int, channels int, frames long, seconds double")(content)


def header(blob: bytes | None) -> tuple:
    try:
        with wave.open(io.BytesIO(blob or b"")) as w:
            return w.getframerate(), w.getnchannels(), w.getnframes(), w.getnframes() / w.getframerate()
    except (wave.Error, EOFError):
        return None, None, None, None


def decodable(content: Column) -> Column:
    """Whether the bytes are a readable WAV."""
    return wav_header(content)["frames"].isNotNull()


def decoded(blob: bytes | None, rate: int = RATE, offset: float = 0.0, seconds: float | None = None) -> np.ndarray | None:
    """Mono samples in [-1, 1) of 16-bit PCM, cut and resampled linearly; null for other bytes."""
    try:
        with wave.open(io.BytesIO(blob or b"")) as w:
            if w.getsampwidth() != 2:
                return None
            own = w.getframerate()
            w.setpos(min(w.getnframes(), int(offset * own)))
            raw = w.readframes(w.getnframes() if seconds is None else int(seconds * own))
            mono = np.frombuffer(raw, "<i2").reshape(-1, w.getnchannels()).mean(axis=1) / 32768
    except (wave.Error, EOFError):
        return None
    if own == rate or not len(mono):
        return mono
    n = int(round(len(mono) * rate / own))
    return np.interp(np.arange(n) * own / rate, np.arange(len(mono)), mono)


def wav_samples(content: Column, rate: int = RATE, offset: float = 0.0, seconds: float | None = None) -> Column:
    def run(blobs: pa.Array) -> pa.Array:
        return lists(decoded(b.as_py(), rate, offset, seconds) for b in blobs)

    return F.arrow_udf(run, "array<double>")(content)


def wav_bytes(samples: Column, rate: int = RATE) -> Column:
    """16-bit PCM WAV bytes of mono samples."""

    def one(values) -> bytes | None:
        if values is None:
            return None
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(2)
            w.setframerate(rate)
            w.writeframes((np.clip(np.asarray(values, float), -1, 32767 / 32768) * 32768).round().astype("<i2").tobytes())
        return out.getvalue()

    def run(arrays: pa.Array) -> pa.Array:
        return pa.array([one(x) for x in each(arrays)], pa.binary())

    return F.arrow_udf(run, "binary")(samples)


def chunk_rows(audio: DataFrame, key: str, samples: str, size: int) -> DataFrame:
    """(key, n, chunk): fixed chunks numbered from 1, the last filled with zeros."""
    return audio.select(key, F.posexplode(fixed_chunks(F.col(samples), size)).alias("_at", "chunk")).select(key, (F.col("_at") + 1).alias("n"), "chunk")


def loud_spans(x: np.ndarray, top_db: float, frame: int, hop: int) -> list[tuple[int, int]]:
    """(start, end) of the runs of frames that are less than ``top_db`` under the loudest, frames being centred and edges mirrored by zeros."""
    if not len(x):
        return []
    padded = np.pad(x.astype(float) ** 2, frame // 2)
    total = np.concatenate([[0.0], np.cumsum(padded)])
    at = np.arange(0, len(padded) - frame + 1, hop)
    power = np.maximum((total[at + frame] - total[at]) / frame, 1e-20)
    loud = 10 * np.log10(power / max(power.max(), 1e-20)) > -top_db
    edges = np.flatnonzero(np.diff(np.concatenate([[0], loud.astype(int), [0]])))
    return [(min(len(x), a * hop), min(len(x), b * hop)) for a, b in edges.reshape(-1, 2).tolist()]


def silence_pieces(
    x: np.ndarray, rate: int, top_db: float, frame: int, most: float, least: float, depth: int = 0
) -> tuple[list[np.ndarray], np.ndarray | None]:
    """(pieces between ``least`` and ``most`` seconds, what is left over). Short pieces are merged into the next one; long ones are split
    again with half the frame, down to a frame of two samples."""
    if len(x) < rate * least:
        return [], x
    out: list[np.ndarray] = []
    carry: np.ndarray | None = None
    for a, b in loud_spans(x, top_db, frame, max(512, frame // 8)):
        piece = x[a:b] if carry is None else np.concatenate([carry, x[a:b]])
        carry = None
        if len(piece) < rate * least:
            carry = piece
        elif len(piece) > rate * most and frame >= 4 and depth < 16:
            more, carry = silence_pieces(piece, rate, int(top_db), frame // 2, most, least, depth + 1)
            out += more
        else:
            out.append(piece)
    return out, carry


def split_by_silence(
    audio: DataFrame, key: str, samples: str, rate: int = RATE, top_db: float = 30, frame: int = 2048, most: float = 30, least: float = 1
) -> DataFrame:
    """(key, n, piece): pieces between silences, numbered from 1; the unfinished last one is left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in batches:
            rows = []
            for k, x in zip(table[key], table[samples], strict=True):
                if x is not None:
                    found, _ = silence_pieces(np.asarray(x, float), rate, top_db, frame, most, least)
                    rows += [(k, n, piece) for n, piece in enumerate(found, 1)]
            yield pd.DataFrame(rows, columns=[key, "n", "piece"])

    kind = audio.select(key).schema[0].dataType.simpleString()
    return audio.select(key, samples).mapInPandas(run, f"{key} {kind}, n int, piece array<double>")


# --- fixed values: how often each kind of effect is in the table, besides six for each background sound ----------------------
EFFECT_COPIES = (("gauss_high", 1000), ("gauss_average", 1000), ("band_pass", 5000), ("clip", 5000), ("tanh", 5000), ("pitch", 5000))
BACKGROUND_EFFECTS = ("background_high", "background_average", "background_gauss", "background_band_pass", "background_tanh", "background_pitch")
# ------------------------------------------------------------------------------------------------------------------


def effect_weights(backgrounds: int) -> list[tuple[str, int, int, int]]:
    """(effect, weight, first, end): the effect table as cumulative weights."""
    each = [*((k, backgrounds) for k in BACKGROUND_EFFECTS), *EFFECT_COPIES]
    out, at = [], 0
    for name, n in each:
        out.append((name, n, at, at + n))
        at += n
    return out


def augment_plan(files: DataFrame, path: str, backgrounds: int, seed: int) -> DataFrame:
    """``files`` with effect_index (from 1) and effect, drawn by weight and seed."""
    table = effect_weights(backgrounds)
    index = random_index(table[-1][3], seed, path)
    effect = F.lit(None).cast("string")
    for name, _, first, end in reversed(table):
        effect = F.when((index >= first) & (index < end), F.lit(name)).otherwise(effect)
    return files.withColumn("effect_index", index + 1).withColumn("effect", effect)


def with_noise(samples: Column, seed: int, key: Column, least_db: float = 1.0, most_db: float = 20.0) -> Column:
    """Gaussian noise at a signal-to-noise ratio drawn for the key."""
    level = uniform(seed, key) * (most_db - least_db) + least_db

    def one(x: np.ndarray | None, db: float, d: int) -> np.ndarray | None:
        if x is None:
            return None
        power = np.sqrt(np.mean(x**2)) if len(x) else 0.0
        return x + np.random.default_rng(int(d) & ((1 << 63) - 1)).normal(0.0, power / 10 ** (db / 20), len(x))

    def run(arrays: pa.Array, levels: pa.Array, draws: pa.Array) -> pa.Array:
        return lists(one(*row) for row in zip(each(arrays), levels.to_numpy(zero_copy_only=False), draws.to_pylist(), strict=True))

    return F.arrow_udf(run, "array<double>")(samples, level, draw(seed, key))


def with_tanh(samples: Column, strength: Column | float) -> Column:
    """Tanh distortion that keeps the root mean square of the input."""

    def one(x: np.ndarray | None, s: float) -> np.ndarray | None:
        if x is None:
            return None
        peak = np.quantile(np.abs(x), 0.99 - 0.98 * s) if len(x) else 0.0
        bent = np.tanh(x / (peak + 1e-6))
        old, new = (np.sqrt(np.mean(v**2)) if len(v) else 0.0 for v in (x, bent))
        return bent * (old / new if new > 1e-9 else 1.0)

    def run(arrays: pa.Array, by: pa.Array) -> pa.Array:
        return lists(one(*row) for row in zip(each(arrays), by.to_numpy(zero_copy_only=False), strict=True))

    return F.arrow_udf(run, "array<double>")(samples, strength if isinstance(strength, Column) else F.lit(float(strength)))


def with_clipping(samples: Column, percent: int) -> Column:
    """Samples beyond the outer percentiles are set to them. A Spark expression: sorted values, no Python."""
    ordered = F.sort_array(samples)
    n = F.size(samples)
    low = F.element_at(ordered, (F.floor((n - 1) * (percent / 200)) + 1).cast("int"))
    high = F.element_at(ordered, (n - F.floor((n - 1) * (percent / 200))).cast("int"))
    return F.when(n > 0, F.transform(samples, lambda x: F.least(F.greatest(x, low), high))).otherwise(samples)


def with_background(samples: Column, noise: Column, snr_db: Column | float) -> Column:
    """Noise, repeated or cut to length and polarity inverted, mixed in at a signal-to-noise ratio."""

    def one(x: np.ndarray | None, y: np.ndarray | None, db: float) -> np.ndarray | None:
        if x is None or y is None or not len(y):
            return x
        y = -np.resize(y, len(x))
        a, b = (np.sqrt(np.mean(v**2)) if len(v) else 0.0 for v in (x, y))
        return x + y * (a / b / 10 ** (db / 20) if b > 1e-12 else 0.0)

    def run(arrays: pa.Array, noises: pa.Array, levels: pa.Array) -> pa.Array:
        return lists(one(*row) for row in zip(each(arrays), each(noises), levels.to_numpy(zero_copy_only=False), strict=True))

    return F.arrow_udf(run, "array<double>")(samples, noise, snr_db if isinstance(snr_db, Column) else F.lit(float(snr_db)))


def filtered(x: np.ndarray, rate: int, low: float, high: float) -> np.ndarray:
    """Only the frequencies between two, in Hz."""
    spectrum, at = np.fft.rfft(x), np.fft.rfftfreq(len(x), 1 / rate)
    return np.fft.irfft(np.where((at >= low) & (at <= high), spectrum, 0), len(x))


def shifted(x: np.ndarray, semitones: float, frame: int = 1024) -> np.ndarray:
    """Another pitch at the same length: a phase vocoder stretches, linear resampling brings the length back."""
    ratio, hop, window = 2.0 ** (semitones / 12), frame // 4, np.hanning(frame)
    padded = np.pad(x, (frame // 2, 2 * frame))
    count = (len(padded) - frame) // hop + 1
    spectra = np.fft.rfft(np.stack([padded[k * hop : k * hop + frame] for k in range(count)]) * window, axis=1)
    expected = 2 * np.pi * hop * np.arange(spectra.shape[1]) / frame
    places = np.arange(0, count - 1, 1 / ratio)
    whole = places.astype(int)
    part = (places - whole)[:, None]
    size = (1 - part) * np.abs(spectra[whole]) + part * np.abs(spectra[whole + 1])
    drift = np.angle(spectra[whole + 1]) - np.angle(spectra[whole]) - expected
    advance = expected + drift - 2 * np.pi * np.round(drift / (2 * np.pi))
    phase = np.angle(spectra[0]) + np.concatenate([np.zeros((1, len(expected))), np.cumsum(advance, axis=0)[:-1]])
    frames = np.fft.irfft(size * np.exp(1j * phase), frame, axis=1) * window
    out, weight = np.zeros(hop * len(frames) + frame), np.zeros(hop * len(frames) + frame)
    for k, f in enumerate(frames):
        out[k * hop : k * hop + frame] += f
        weight[k * hop : k * hop + frame] += window**2
    n = int(round(len(x) * ratio))
    long = (out / np.maximum(weight, 1e-3))[frame // 2 : frame // 2 + n]
    return np.interp(np.linspace(0, max(0, len(long) - 1), len(x)), np.arange(len(long)), long)


def in_room(x: np.ndarray, rate: int, seconds: float, seed: int) -> np.ndarray:
    """Convolved with decaying noise, a simple room, at the input's level and length."""
    n = max(1, int(rate * seconds))
    tail = np.random.default_rng(seed).normal(size=n) * np.exp(-6.9 * np.arange(n) / n)
    tail[0] = 1.0
    size = 1 << (len(x) + n - 1).bit_length()
    wet = np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(tail, size), size)[: len(x)]
    return wet * (np.sqrt(np.mean(x**2)) / max(np.sqrt(np.mean(wet**2)), 1e-12))


def by_kernel(samples: Column, kernel) -> Column:
    """A numpy function of one array over a column; nulls stay null, empty arrays stay empty."""

    def run(arrays: pa.Array) -> pa.Array:
        return lists(kernel(x) if x is not None and len(x) else x for x in each(arrays))

    return F.arrow_udf(run, "array<double>")(samples)


def with_band_pass(samples: Column, low: float, high: float, rate: int = RATE) -> Column:
    return by_kernel(samples, lambda x: filtered(x, rate, low, high))


def with_pitch(samples: Column, semitones: float) -> Column:
    return by_kernel(samples, lambda x: shifted(x, semitones))


def with_room(samples: Column, seconds: float = 0.3, seed: int = 0, rate: int = RATE) -> Column:
    return by_kernel(samples, lambda x: in_room(x, rate, seconds, seed))
