"""Numpy on sample arrays inside tasks: pitch by autocorrelation and a best path, short-time spectra and their inverse."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tracker:
    """Frames of ``window`` seconds each ``step``; lags of pitches from ``low`` to ``high`` Hz; costs of a path."""

    low: float = 75.0
    high: float = 500.0
    window: float = 0.03
    step: float = 0.01
    candidates: int = 5
    voicing: float = 0.45
    octave: float = 0.01
    jump: float = 0.35
    switch: float = 0.14
    silence: float = 0.03
    block: int = 2048

    def lags(self, rate: int) -> np.ndarray:
        return np.arange(max(1, math.ceil(rate / self.high)), math.floor(rate / self.low) + 1)


def correlations(x: np.ndarray, rate: int, t: Tracker = Tracker()) -> np.ndarray:
    """Normalised autocorrelation of each frame (rows) at each lag: of its window with the window so many samples on.

    Frames whose window is quieter than ``silence`` times the peak throughout have zeros.
    """
    x = np.asarray(x, np.float64)
    lags, wide, hop = t.lags(rate), max(1, int(rate * t.window)), max(1, int(rate * t.step))
    span = wide + (int(lags[-1]) if len(lags) else 0)
    if not len(lags) or len(x) < span:
        return np.zeros((0, len(lags)))
    frames = np.lib.stride_tricks.sliding_window_view(x, span)[::hop]
    loud = t.silence * np.abs(x).max()
    out = np.zeros((len(frames), len(lags)))
    for a in range(0, len(frames), t.block):
        part = frames[a : a + t.block]
        base = part[:, :wide]
        energy = np.concatenate([np.zeros((len(part), 1)), np.cumsum(part * part, axis=1)], axis=1)
        own = energy[:, wide]
        for k, lag in enumerate(lags.tolist()):
            both = own * (energy[:, lag + wide] - energy[:, lag])
            product = np.einsum("ij,ij->i", base, part[:, lag : lag + wide])
            np.divide(product, np.sqrt(np.maximum(both, 0)), out=out[a : a + len(part), k], where=both > 1e-18)
        out[a : a + len(part)][np.abs(base).max(axis=1) <= loud] = 0
    return np.clip(out, -1, 1)


def best_path(r: np.ndarray, lags: np.ndarray, t: Tracker = Tracker()) -> np.ndarray:
    """The lag of each frame (0: no voice) on the cheapest path through the frames' strongest local peaks.

    A voiced frame costs 1 - r and ``octave`` for each octave over the least lag, one without voice 1 - ``voicing``;
    neighbours cost ``jump`` for each octave between them, ``switch`` where voice begins or ends.  Of equal paths the one
    without voice, then with the stronger peak, wins.
    """
    n = len(r)
    if not n or not r.shape[1]:
        return np.zeros(n, np.int64)
    edge = np.pad(r, ((0, 0), (1, 1)), constant_values=-np.inf)
    peak = (r >= edge[:, :-2]) & (r > edge[:, 2:]) & (r > 0)
    strength = np.where(peak, r, -np.inf)
    order = np.argsort(-strength, axis=1, kind="stable")[:, : t.candidates]
    at = np.take_along_axis(strength, order, axis=1)
    lag = np.where(np.isfinite(at), lags[order], 1)
    own = np.where(np.isfinite(at), 1 - at + t.octave * np.log2(lag / lags[0]), np.inf)
    own = np.concatenate([np.full((n, 1), 1 - t.voicing), own], axis=1)
    height = np.log2(lag)
    total, back = own[0], np.zeros((n, own.shape[1]), np.int64)
    for i in range(1, n):
        move = np.empty((own.shape[1],) * 2)  # from, to
        move[0, 0], move[0, 1:], move[1:, 0] = 0, t.switch, t.switch
        move[1:, 1:] = t.jump * np.abs(height[i - 1][:, None] - height[i][None, :])
        way = total[:, None] + move
        back[i] = way.argmin(axis=0)
        total = way[back[i], np.arange(len(total))] + own[i]
    state = int(total.argmin())
    path = np.zeros(n, np.int64)
    for i in range(n - 1, -1, -1):
        path[i] = lag[i, state - 1] if state else 0
        state = back[i, state]
    return path


def voiced_bounds(x: np.ndarray, rate: int, t: Tracker = Tracker()) -> tuple[int, int] | None:
    """Sample numbers of the middles of the first and the last voiced frame; None without voice."""
    voiced = np.flatnonzero(best_path(correlations(x, rate, t), t.lags(rate), t))
    hop, half = max(1, int(rate * t.step)), max(1, int(rate * t.window)) // 2
    return (int(voiced[0]) * hop + half, int(voiced[-1]) * hop + half) if len(voiced) else None


def _clean(x) -> np.ndarray | None:
    return None if x is None else np.array([0.0 if v is None or not math.isfinite(v) else v for v in x], np.float64)


def voiced_column(df: DataFrame, rate: int, *, samples="samples", into="voiced", tracker: Tracker = Tracker()) -> DataFrame:
    """``df`` with ``into``: start and end (sample numbers) of voice in sample arrays; null for null arrays and without voice.

    Null and non-finite samples count as silence.
    """
    kept = df.drop(into)
    names, kind = kept.columns, pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            found = [None if (x := _clean(v)) is None else voiced_bounds(x, rate, tracker) for v in batch.column(names.index(samples)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f and {"start": f[0], "end": f[1]} for f in found], kind)], names=[*names, into])

    return kept.mapInArrow(run, kept.withColumn(into, F.lit(None).cast("struct<start:bigint,end:bigint>")).schema)


# --- short-time spectra --------------------------------------------------------------------------


def window_of(n: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)


def spectra(x: np.ndarray, n: int, hop: int) -> np.ndarray:
    """Short-time transform: bins by frames, frames centred at each ``hop``, the signal mirrored at its ends."""
    x = np.pad(np.asarray(x, np.float64), n // 2, mode="reflect" if len(x) > n // 2 else "constant")
    frames = np.lib.stride_tricks.sliding_window_view(x, n)[::hop]
    return np.fft.rfft(frames * window_of(n), axis=1).T


def signal(z: np.ndarray, n: int, hop: int, length: int) -> np.ndarray:
    """The signal whose short-time transform is nearest to z: frames overlapped and added, over the windows' squares."""
    w = window_of(n)
    frames = np.fft.irfft(z.T, n, axis=1) * w
    size = (len(frames) - 1) * hop + n
    out, weight = np.zeros(max(size, length + n)), np.zeros(max(size, length + n))
    for i, frame in enumerate(frames):
        out[i * hop : i * hop + n] += frame
        weight[i * hop : i * hop + n] += w * w
    return (out / np.maximum(weight, 1e-10))[n // 2 : n // 2 + length]


def spectral_error(x: np.ndarray, magnitude: np.ndarray, n: int, hop: int) -> float:
    """Distance between a signal's magnitudes and the wanted ones, over the latter's size."""
    return float(np.linalg.norm(np.abs(spectra(x, n, hop)) - magnitude) / max(np.linalg.norm(magnitude), 1e-30))


def griffin_lim(magnitude: np.ndarray, hop: int, length: int, rounds: int = 32, seed: int = 0) -> np.ndarray:
    """A signal of the given length whose short-time magnitudes are near the given ones (bins by frames).

    Phases start at random (of a fixed seed); each round takes the phases of the signal that the last ones gave.
    """
    n = 2 * (len(magnitude) - 1)
    z = magnitude * np.exp(2j * np.pi * np.random.default_rng(seed).random(magnitude.shape))
    x = signal(z, n, hop, length)
    for _ in range(rounds):
        z = spectra(x, n, hop)[:, : magnitude.shape[1]]
        x = signal(magnitude * np.exp(1j * np.angle(z)), n, hop, length)
    return x


def spectrogram_column(df: DataFrame, n: int, hop: int, *, samples="samples", into="spectrogram") -> DataFrame:
    """``df`` with power spectra (ARRAY<ARRAY<DOUBLE>>, bins by frames) of sample arrays; null arrays stay null."""
    return _mapped(df, samples, into, "array<array<double>>", pa.list_(pa.list_(pa.float64())), lambda x: None if (s := _clean(x)) is None else list(np.abs(spectra(s, n, hop)) ** 2))


def inverted_column(df: DataFrame, hop: int, length: int, *, rounds: int = 32, spectrogram="spectrogram", into="samples") -> DataFrame:
    """``df`` with sample arrays made from power spectra by ``griffin_lim``; null ones stay null."""

    def one(rows):
        m = None if rows is None or not rows else np.sqrt(np.maximum(np.array([_clean(r) for r in rows]), 0))
        return None if m is None or m.ndim != 2 or not m.shape[1] else griffin_lim(m, hop, length, rounds)

    return _mapped(df, spectrogram, into, "array<double>", pa.list_(pa.float64()), one)


def _mapped(df: DataFrame, column: str, into: str, kind: str, arrow_kind, function) -> DataFrame:
    kept = df.drop(into) if into != column else df
    names = kept.columns

    def run(batches):
        for batch in batches:
            made = pa.array(list(map(function, batch.column(names.index(column)).to_pylist())), arrow_kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*names, into])

    return kept.mapInArrow(run, kept.withColumn(into, F.lit(None).cast(kind)).schema)
