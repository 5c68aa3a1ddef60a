"""Recordings: RIFF chunks by range reads, samples of all usual formats, windowed-sinc resampling, re-encoding."""

from __future__ import annotations

import io
import math
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.sources import filesystems

PCM, FLOAT, EXTENSIBLE = 1, 3, 0xFFFE
HALF_WIDTH = 16
BLOCK = 8192


def chunk_walk(read: Callable[[int, int], bytes], size: int) -> dict:
    """format, channels, rate, bits, at, n_bytes (of the samples), n_frames of a RIFF file that is read by ranges.

    Chunks are walked one by one, however many and however long; only their heads and the fmt chunk are read.  Sizes are
    those the chunks give, also of a file cut short.  ValueError: no RIFF file, or one without fmt or data chunk.
    """
    head = read(0, 12)
    if head[:4] != b"RIFF" or head[8:] != b"WAVE":
        raise ValueError("no RIFF WAVE file")
    at, held = 12, None
    while at + 8 <= size:
        name, length = struct.unpack("<4sI", read(at, 8))
        if name == b"fmt ":
            fmt = read(at + 8, min(length, 40))
            if len(fmt) < 16:
                raise ValueError("the fmt chunk is too short")
            kind, channels, rate, _, align, bits = struct.unpack("<HHIIHH", fmt[:16])
            if kind == EXTENSIBLE and len(fmt) >= 26:
                kind = struct.unpack("<H", fmt[24:26])[0]
            held = {"format": kind, "channels": channels, "rate": rate, "bits": bits, "align": align}
        elif name == b"data":
            if held is None:
                raise ValueError("samples come before their format")
            align = held.pop("align") or held["channels"] * held["bits"] // 8
            return {**held, "at": at + 8, "n_bytes": length, "n_frames": length // align if align else 0}
        at += 8 + length + length % 2
    raise ValueError("no data chunk")


_FACTS = {"seconds": "double", "rate": "long", "channels": "int", "bits": "int", "n_frames": "long", "head_bytes": "long", "error": "string"}


def wav_facts(files: DataFrame, path: str = "path") -> DataFrame:
    """``files`` with seconds, rate, channels, bits, n_frames, head_bytes (read for this) and error; the samples aren't read.

    A file that can't be opened or walked has nulls and an error.  Columns with these names are replaced.
    """
    kept = files.drop(*_FACTS)
    names = kept.columns
    kinds = [pa.float64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]

    def facts(where):
        try:
            fs, own = filesystems.located(where)
            with fs.open_input_file(own) as handle:
                counted = filesystems.Counted(handle)
                w = chunk_walk(counted.at, counted.size)
            return w["n_frames"] / w["rate"] if w["rate"] else None, w["rate"], w["channels"], w["bits"], w["n_frames"], counted.read_bytes, None
        except (OSError, ValueError, struct.error, AttributeError) as failure:
            return *(None,) * 6, f"{type(failure).__name__}: {failure}"

    def run(batches):
        for batch in batches:
            rows = list(zip(*map(facts, batch.column(names.index(path)).to_pylist()))) or [[]] * len(_FACTS)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(rows, kinds))], names=[*names, *_FACTS])

    return kept.mapInArrow(run, kept.withColumns({n: F.lit(None).cast(t) for n, t in _FACTS.items()}).schema)


# --- samples -------------------------------------------------------------------------------------


def samples_of(raw: bytes, kind: int, bits: int, channels: int) -> np.ndarray:
    """Frames by channels between -1 and 1, of 8-bit unsigned, 16-, 24- and 32-bit whole and 32- and 64-bit float samples."""
    wide = bits // 8 * channels
    raw = raw[: len(raw) - len(raw) % wide] if wide else b""
    if kind == FLOAT and bits in (32, 64):
        x = np.frombuffer(raw, f"<f{bits // 8}").astype(np.float64)
    elif kind == PCM and bits == 8:
        x = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    elif kind == PCM and bits in (16, 32):
        x = np.frombuffer(raw, f"<i{bits // 8}") / 2.0 ** (bits - 1)
    elif kind == PCM and bits == 24:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8) / 2.0**23
    else:
        raise ValueError(f"samples of format {kind} with {bits} bits aren't decoded")
    return x.reshape(-1, channels)


def kernels(up: int, down: int, half_width: int = HALF_WIDTH) -> np.ndarray:
    """Taps of each of ``up`` phases: a sinc cut at the lower of both rates under a Hann window, each phase summing to one."""
    cut = min(1.0, up / down)
    reach = half_width / cut
    near = math.ceil(reach)
    offset = np.arange(1 - near, near + 1)[None, :] - np.arange(up)[:, None] / up
    taps = np.sinc(cut * offset) * np.where(np.abs(offset) < reach, 0.5 * (1 + np.cos(np.pi * offset / reach)), 0.0)
    return taps / taps.sum(axis=1, keepdims=True)


def resampled(x: np.ndarray, own: int, rate: int, half_width: int = HALF_WIDTH, block: int = BLOCK) -> np.ndarray:
    """Samples at another rate by a polyphase filter, ``block`` outputs at a time; outside of the signal is silence."""
    if own == rate or not len(x):
        return np.asarray(x, np.float64)
    g = math.gcd(own, rate)
    up, down = rate // g, own // g
    taps = kernels(up, down, half_width)
    near = taps.shape[1] // 2
    n = -(-len(x) * up // down)
    out = np.empty(n)
    padded = np.concatenate([np.zeros(near), x, np.zeros(near + 1)])
    place = np.arange(taps.shape[1]) + 1
    for a in range(0, n, block):
        at = np.arange(a, min(a + block, n), dtype=np.int64) * down
        out[a : a + len(at)] = (padded[(at // up)[:, None] + place] * taps[at % up]).sum(axis=1)
    return out


def decoded(content: bytes, rate: int | None = None) -> tuple[np.ndarray, int]:
    """Mono samples (mean of the channels) and their rate: the file's own, or the one given."""
    w = chunk_walk(lambda at, n: content[at : at + n], len(content))
    x = samples_of(content[w["at"] : w["at"] + w["n_bytes"]], w["format"], w["bits"], w["channels"]).mean(axis=1)
    return (resampled(x, w["rate"], rate), rate) if rate else (x, w["rate"])


def encoded(x: np.ndarray, rate: int) -> bytes:
    """A mono 16-bit PCM file; samples beyond -1 and 1 are cut."""
    data = np.round(np.clip(x, -1.0, 32767 / 32768) * 32768).astype("<i2").tobytes()
    out = io.BytesIO()
    out.write(b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, PCM, 1, rate, 2 * rate, 2, 16))
    out.write(b"data" + struct.pack("<I", len(data)) + data)
    return out.getvalue()


def resampled_column(df: DataFrame, own: int, rate: int, samples: str = "samples", half_width: int = HALF_WIDTH) -> DataFrame:
    """``df`` with its sample arrays at another rate; null arrays stay null, null samples count as silence."""
    names = df.columns

    def run(batches):
        for batch in batches:
            out = [None if x is None else resampled(np.array([0.0 if v is None else v for v in x]), own, rate, half_width) for x in batch.column(names.index(samples)).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.float64())) if n == samples else batch.column(i) for i, n in enumerate(names)], names=names)

    return df.mapInArrow(run, df.withColumn(samples, F.col(samples).cast("array<double>")).schema)
