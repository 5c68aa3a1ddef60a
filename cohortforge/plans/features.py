"""Feature extraction: what is missing, a pluggable model boundary, merging, quality metrics and search."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import signals
from cohortforge.functions import tensors as T
from cohortforge.functions.scalars import normalize_label
from cohortforge.sources import audio

IDS = ["participant_id", "session_id", "task_name"]


#: Rows of a spectrogram as it should be; one of another height was made with other settings.
SPECTROGRAM_ROWS = 201


def usable(held: DataFrame, rows: int = SPECTROGRAM_ROWS) -> DataFrame:
    """Held features (feature_group, feature_name, data) without whole groups whose spectrogram has another number of rows."""
    stale = held.where((F.col("feature_name") == "spectrogram") & (F.coalesce(F.size("data"), F.lit(0)) != rows)).select(*IDS, "feature_group").distinct()
    return held.join(stale, [*IDS, "feature_group"], "left_anti")


def missing(recordings: DataFrame, held: DataFrame, required: Sequence[str]) -> DataFrame:
    """Recordings with the feature groups they still need; pass ``usable`` ones to have stale spectrograms made again."""
    have = held.groupBy(*IDS).agg(F.collect_set("feature_group").alias("_have"))
    want = F.array(*(F.lit(x) for x in required))
    need = F.array_except(want, F.coalesce("_have", F.array().cast("array<string>")))
    return recordings.join(have, IDS, "left").withColumn("needed", F.array_sort(need)).drop("_have").where(F.size("needed") > 0)


def merged(old: DataFrame, new: DataFrame, keys: Sequence[str] = (*IDS, "feature_group", "feature_name")) -> DataFrame:
    """Held features, and new ones where there was none."""
    rest = [c for c in old.columns if c not in keys]
    a = old.select(*keys, *(F.col(c).alias(f"_o_{c}") for c in rest))
    return a.join(new, list(keys), "full_outer").select(*keys, *(F.coalesce(f"_o_{c}", c).alias(c) for c in rest))


def retried(function: Callable, times: int = 3, wait: float = 0.5) -> Callable:
    """A function called again when it fails, the last failure passed on."""

    def run(*args):
        for left in reversed(range(times)):
            try:
                return function(*args)
            except Exception:
                if not left:
                    raise
                time.sleep(wait)

    return run


def decoded_wav(content: bytes, rate: int = 16_000) -> np.ndarray:
    """Mono samples of a recording (8- to 32-bit PCM or float, any channels) at the given rate."""
    return audio.decoded(content, rate)[0].astype(np.float32)


def simple_features(samples: np.ndarray, rate: int) -> dict[str, float]:
    """A deterministic stand-in for a model: duration, peak, energy and crossings."""
    if not len(samples):
        return {"duration": 0.0, "peak": 0.0, "rms": 0.0, "crossings": 0.0}
    return {"duration": len(samples) / rate, "peak": float(np.abs(samples).max()), "rms": float(np.sqrt(np.mean(samples.astype(float) ** 2))), "crossings": float(np.sum(np.diff(np.signbit(samples))))}


def extracted(files: DataFrame, extractor: Callable[[np.ndarray, int], dict[str, float]] = simple_features, rate: int = 16_000, group: str = "basic") -> DataFrame:
    """path, feature_group, feature_name, value, error of (path, content); a failing file gives one error row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    rows += [(path, group, k, v, None) for k, v in retried(extractor, 3, 0.0)(decoded_wav(bytes(content), rate), rate).items()]
                except Exception as failure:
                    rows.append((path, group, None, None, str(failure)))
            yield pd.DataFrame(rows, columns=["path", "feature_group", "feature_name", "value", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, feature_group string, feature_name string, value double, error string")


def annotated(files: DataFrame, models: dict[str, Callable[[np.ndarray, int], str]], rate: int = 16_000) -> DataFrame:
    """path, model, result, error of pluggable models (speaker turns, speaker vectors, transcripts as text or JSON) over (path, content).

    A model that fails gives null and its error; the others still run.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                for name, model in models.items():
                    try:
                        rows.append((path, name, model(decoded_wav(bytes(content), rate), rate), None))
                    except Exception as failure:
                        rows.append((path, name, None, f"{type(failure).__name__}: {failure}"))
            yield pd.DataFrame(rows, columns=["path", "model", "result", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, model string, result string, error string")


def framed_metrics(samples: DataFrame, rate: int = 16_000, window: float = 0.025, step: float = 0.0125) -> DataFrame:
    """ids, proportion_clipped_metric, proportion_silent_metric, peak_snr_from_spectral_metric, spectral_gating_snr_metric, amplitude_modulation_depth_metric of sample arrays, over windows of 25 ms each 12.5 ms.

    Peak over mean spectral power and signal over noise power (noise: the quietest tenth of windows) in decibels; depth of
    the windows' peaks as (largest - least) / (largest + least).  Null for recordings without a window.
    """
    wide, hop = int(rate * window), int(rate * step)

    def one(x) -> list[float | None]:
        x = np.asarray([] if x is None else x, np.float64)
        if len(x) < wide:
            return [None] * 5
        frames = np.lib.stride_tricks.sliding_window_view(x, wide)[::hop]
        power = (np.abs(np.fft.rfft(frames * np.hanning(wide))) ** 2).mean(axis=1)
        tiny = 1e-12
        ordered = np.sort(power)
        noise = ordered[: max(1, len(ordered) // 10)].mean()
        peaks = np.abs(frames).max(axis=1)
        depth = (peaks.max() - peaks.min()) / max(peaks.max() + peaks.min(), tiny)
        decibels = lambda a, b: float(10 * np.log10((a + tiny) / (b + tiny)))
        return [float((np.abs(x) >= 0.99).mean()), float((np.abs(x) < 0.01).mean()), decibels(power.max(), power.mean()), decibels(max(power.mean() - noise, 0.0), noise), float(depth)]

    names = ["proportion_clipped_metric", "proportion_silent_metric", "peak_snr_from_spectral_metric", "spectral_gating_snr_metric", "amplitude_modulation_depth_metric"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = pd.DataFrame([one(x) for x in pdf["samples"]], columns=names, index=pdf.index, dtype="float64")
            yield pd.concat([pdf[IDS], values], axis=1)

    out = samples.select(*IDS, "samples").mapInPandas(run, "participant_id string, session_id string, task_name string, " + ", ".join(f"{n} double" for n in names))
    return out.withColumn("task_name", normalize_label("task_name"))


def quality_metrics(samples: DataFrame, clip: float = 0.99, silence: float = 0.01) -> DataFrame:
    """Shares of clipped and silent samples and peak-to-mean ratio, with their checks; ids first, task labels normalised."""
    loud = F.transform("samples", lambda x: F.abs(x.cast("double")))
    n = F.size("samples")
    df = samples.withColumn("_loud", loud)
    share = lambda keep: F.size(F.filter("_loud", keep)) / n
    mean = F.aggregate("_loud", F.lit(0.0), lambda s, x: s + x) / n
    df = df.withColumns({"proportion_clipped_metric": share(lambda x: x >= clip), "proportion_silent_metric": share(lambda x: x < silence), "peak_to_mean_metric": F.array_max("_loud") / F.nullif(mean, F.lit(0.0))})
    checks = {"proportion_clipped_check": F.col("proportion_clipped_metric") < 0.05, "proportion_silent_check": F.col("proportion_silent_metric") < 0.5}
    return df.withColumns(checks).select("participant_id", "session_id", normalize_label("task_name").alias("task_name"), "proportion_clipped_metric", "proportion_silent_metric", "peak_to_mean_metric", *checks)


def trimmed(samples: DataFrame, rate: int = 16_000, tracker: signals.Tracker = signals.Tracker()) -> DataFrame:
    """``samples`` with n_samples, energy and voiced (start, end in samples) and trim: flag, start, end (seconds), percent and method.

    Recordings are cut to their voice if it holds a fifth of them, else to what is louder than a tenth of the peak, else not;
    null for arrays without samples.  Null samples and NaN count as silence.
    """
    sound = F.transform("samples", lambda x: F.when(x.isNull() | F.isnan(x), F.lit(0.0)).otherwise(x.cast("double")))
    df = signals.voiced_column(samples.withColumn("samples", sound), rate, tracker=tracker).withColumns({"n_samples": F.size("samples"), "energy": T.energy_bounds("samples")})
    seconds = lambda c: F.col(c) / rate
    decision = T.trim_decision(seconds("n_samples"), seconds("energy.start"), seconds("energy.end"), seconds("voiced.start"), seconds("voiced.end"))
    return df.withColumn("trim", F.when(F.col("n_samples") > 0, decision))


def speaker_flags(df: DataFrame, segments: str = "segments", speech: str = "is_speech") -> DataFrame:
    """Speakers, share of the main one, and what is wrong, from ARRAY<STRUCT<speaker,start,end>>."""
    s = F.col(segments)
    speakers = F.array_distinct(F.transform(s, lambda x: x["speaker"]))
    lasting = lambda who: F.aggregate(F.filter(s, lambda x: x["speaker"] == who), F.lit(0.0), lambda a, x: a + x["end"] - x["start"])
    total = F.aggregate(s, F.lit(0.0), lambda a, x: a + x["end"] - x["start"])
    ratio = F.array_max(F.transform(speakers, lasting)) / F.nullif(total, F.lit(0.0))
    n = F.size(speakers)
    flag = F.when((n == 0) & F.col(speech), "no_speakers_found").when((n > 1) & (F.col("primary_ratio") < 0.8), "no_primary_speaker_found").when(n > 2, "many_speakers_found")
    return df.withColumns({"n_speakers": n, "primary_ratio": ratio}).withColumn("flag", flag)


def searched(corpus: DataFrame, query: Sequence[float], k: int = 10, cutoff: float = 0.0, vector: str = "embedding") -> DataFrame:
    """The k rows most like a query vector, above a cut-off."""
    q = F.array(*(F.lit(float(x)) for x in query))
    return corpus.withColumn("similarity", T.cosine(vector, q)).where(F.col("similarity") > cutoff).orderBy(F.desc("similarity"), corpus.columns[0]).limit(k)
