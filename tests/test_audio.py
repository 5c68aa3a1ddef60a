"""Recordings by range reads, resampling, pitch, short-time spectra, copies: against brute force and known signals."""

import hashlib
import itertools
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortforge.functions import signals
from cohortforge.plans import features
from cohortforge.sources import audio, filesystems, sinks


def riff(frames: bytes, rate=8000, kind=1, bits=16, channels=1, before=(), after=b"", extensible=False) -> bytes:
    wide = bits // 8 * channels
    fmt = struct.pack("<HHIIHH", 0xFFFE if extensible else kind, channels, rate, rate * wide, wide, bits)
    fmt += struct.pack("<HHIH", 22, bits, 0, kind) + bytes(14) if extensible else b""
    chunks = b"".join(n + struct.pack("<I", len(b)) + b + b"\0" * (len(b) % 2) for n, b in before)
    body = b"WAVE" + chunks + b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(frames)) + frames + after
    return b"RIFF" + struct.pack("<I", len(body)) + body


TONE = np.sin(np.arange(4000) * 2 * np.pi * 200 / 8000) * 0.5


def test_heads_of_any_length(spark, tmp_path):
    sound = (TONE * 32767).astype("<i2").tobytes()
    cases = {
        "plain": riff(sound),
        "large": riff(sound, before=[(b"LIST", b"x" * 1_000_001)]),
        "many": riff(sound, before=[(b"junk", b"y" * (k % 3)) for k in range(100)]),
        "extensible": riff(sound, extensible=True),
        "cut": riff(sound)[:2000],
        "empty": b"",
        "short": b"RIFF",
        "other": b"\0" * 100,
        "no data": riff(b"")[:36],
    }
    for name, content in cases.items():
        (tmp_path / f"{name}.wav").write_bytes(content)
    df = spark.createDataFrame([(str(tmp_path / f"{n}.wav"), n, "given") for n in [*cases, "missing"]] + [(None, "null", "given")], "path string, name string, error string")
    got = {r.name: r for r in audio.wav_facts(df).collect()}
    for name in ("plain", "large", "many", "extensible", "cut"):
        assert (got[name].seconds, got[name].rate, got[name].channels, got[name].bits, got[name].error) == (0.5, 8000, 1, 16, None)
        assert got[name].head_bytes < 2000
    assert got["large"].head_bytes < 100
    assert all(got[n].seconds is None and got[n].error for n in ("empty", "short", "other", "no data", "missing", "null"))


@pytest.mark.parametrize("kind, bits", [(1, 8), (1, 16), (1, 24), (1, 32), (3, 32), (3, 64)])
def test_all_sample_formats(kind, bits):
    stereo = np.stack([TONE, -TONE / 2], axis=1)
    if kind == 3:
        raw = stereo.astype(f"<f{bits // 8}").tobytes()
    elif bits == 8:
        raw = np.round(stereo * 128 + 128).astype(np.uint8).tobytes()
    else:
        whole = np.round(stereo * (2.0 ** (bits - 1) - 1)).astype(np.int64)
        raw = b"".join(int(v).to_bytes(bits // 8, "little", signed=True) for v in whole.ravel())
    x, rate = audio.decoded(riff(raw, kind=kind, bits=bits, channels=2))
    assert rate == 8000 and np.abs(x - TONE / 4).max() < 2.0 ** (2 - min(bits, 24))


def test_undecoded_formats_raise():
    with pytest.raises(ValueError):
        audio.decoded(riff(b"ab", kind=7, bits=8))


def resampled_by_force(x, own, rate, half):
    cut, n = min(1.0, rate / own), -(-len(x) * rate // own) if (own % rate or True) else 0
    reach, out = half / cut, []
    for k in range(n):
        t = k * own / rate
        taps = [(j, np.sinc(cut * (j - t)) * 0.5 * (1 + math.cos(math.pi * (j - t) / reach))) for j in range(math.floor(t - reach), math.ceil(t + reach) + 1) if abs(j - t) < reach]
        total = sum(w for _, w in taps)
        out.append(sum(x[j] * w for j, w in taps if 0 <= j < len(x)) / total)
    return np.array(out)


@pytest.mark.parametrize("own, rate", [(8000, 16000), (16000, 8000), (44100, 16000), (3, 2), (7, 7)])
def test_resampling_by_force(own, rate):
    x = np.random.default_rng(own).normal(size=300)
    got = audio.resampled(x, own, rate, half_width=8, block=64)
    assert len(got) == math.ceil(len(x) * rate / own)
    wanted = x if own == rate else resampled_by_force(x, own, rate, 8)
    assert np.abs(got - wanted).max() < 1e-9


def test_resampling_keeps_out_what_would_alias():
    t = np.arange(16000) / 16000
    high = np.sin(2 * np.pi * 6500 * t)  # over half the new rate
    linear = np.interp(np.arange(0, 16000, 2), np.arange(16000), high)
    assert np.abs(audio.resampled(high, 16000, 8000)[200:-200]).max() < 0.01 < 0.5 < np.abs(linear[200:-200]).max()
    low = np.sin(2 * np.pi * 1000 * t)
    assert np.abs(audio.resampled(low, 16000, 8000)[200:-200] - low[::2][200:-200]).max() < 0.005


def test_copies_and_recoded(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(riff((TONE * 32767).astype("<i2").tobytes()))
    (tmp_path / "b.bin").write_bytes(b"z" * 3000)
    pairs = [(f"{tmp_path}/a.wav", f"{tmp_path}/out/x/a.wav"), (f"file:{tmp_path}/b.bin", f"file://{tmp_path}/out/b.bin"), (f"{tmp_path}/none", f"{tmp_path}/out/none"), (None, None)]
    df = spark.createDataFrame(pairs, "source string, target string")
    got = {r.source: r for r in sinks.copies(df).collect()}
    assert (tmp_path / "out/x/a.wav").read_bytes() == (tmp_path / "a.wav").read_bytes()
    assert got[pairs[1][0]].sha256 == hashlib.sha256(b"z" * 3000).hexdigest() and got[pairs[1][0]].n_bytes == 3000
    assert got[pairs[2][0]].error.startswith("FileNotFoundError") and got[None].error
    assert sorted(p.name for p in (tmp_path / "out").rglob("*") if p.is_file()) == ["a.wav", "b.bin"]
    again = sinks.recoded(df.limit(1).withColumn("target", F.lit(f"{tmp_path}/out/r.wav")), 16000).first()
    x, rate = audio.decoded((tmp_path / "out/r.wav").read_bytes())
    assert again.error is None and rate == 16000 and len(x) == 8000
    assert np.abs(x[500:-500:2] - TONE[250:-250]).max() < 0.01


def test_an_interrupted_copy_leaves_nothing(tmp_path):
    target = tmp_path / "d" / "x"
    target.parent.mkdir()
    target.write_bytes(b"before")

    def parts():
        yield b"half"
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        filesystems.written(str(target), parts())
    assert target.read_bytes() == b"before" and list(target.parent.iterdir()) == [target]


def test_unknown_file_systems_raise():
    with pytest.raises(OSError):
        filesystems.located("nosuch://host/x")


# --- pitch ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("hertz", [90, 120, 200, 310, 440])
def test_known_tones_within_one_lag(hertz):
    rate = 8000
    x = np.concatenate([np.zeros(2000), np.sin(np.arange(4000) * 2 * np.pi * hertz / rate), np.zeros(2000)])
    t = signals.Tracker()
    path = signals.best_path(signals.correlations(x, rate, t), t.lags(rate), t)
    inside = path[26:70]
    assert (np.abs(inside - rate / hertz) <= 1).all()
    start, end = signals.voiced_bounds(x, rate, t)
    assert abs(start - 2000) <= 320 and abs(end - 6000) <= 320


def test_noise_and_silence_have_no_voice():
    assert signals.voiced_bounds(np.zeros(8000), 8000) is None
    assert signals.voiced_bounds(np.zeros(3), 8000) is None
    assert signals.voiced_bounds(np.random.default_rng(1).normal(size=8000), 8000) is None


def test_correlations_by_force():
    rate, t = 1000, signals.Tracker(low=100, high=500, window=0.016, step=0.004, block=3)
    x = np.random.default_rng(3).normal(size=80)
    got, lags, wide = signals.correlations(x, rate, t), t.lags(rate), 16
    assert lags.tolist() == list(range(2, 11)) and len(got) == (80 - 26) // 4 + 1
    for i, row in enumerate(got):
        for lag, value in zip(lags, row):
            a, b = x[4 * i : 4 * i + wide], x[4 * i + lag : 4 * i + lag + wide]
            assert abs(value - a @ b / math.sqrt(a @ a * (b @ b))) < 1e-9


def test_best_path_by_force():
    t = signals.Tracker(candidates=2)
    lags = np.arange(4, 14)
    for seed in range(25):
        r = np.random.default_rng(seed).uniform(-0.2, 1, (5, len(lags)))
        states = []
        for row in r:
            peaks = [k for k in range(len(lags)) if row[k] > 0 and (k == 0 or row[k] >= row[k - 1]) and (k == len(lags) - 1 or row[k] > row[k + 1])]
            peaks = sorted(peaks, key=lambda k: -row[k])[:2]
            states.append([(0, 1 - t.voicing)] + [(int(lags[k]), 1 - row[k] + t.octave * math.log2(lags[k] / lags[0])) for k in peaks])

        def cost(path):
            total = sum(c for _, c in path)
            for (a, _), (b, _) in zip(path, path[1:]):
                total += t.jump * abs(math.log2(a / b)) if a and b else t.switch if a or b else 0
            return total

        best = min(map(cost, itertools.product(*states)))
        got = signals.best_path(r, lags, t).tolist()
        assert abs(cost([next(s for s in own if s[0] == g) for own, g in zip(states, got)]) - best) < 1e-9


def test_trimmed_uses_voice(spark):
    rate = 8000
    voice = np.concatenate([np.random.default_rng(0).normal(size=8000) * 0.2, np.sin(np.arange(8000) * 2 * np.pi * 150 / rate), np.zeros(8000)])
    clicks = np.zeros(24000)
    clicks[[9000, 20000]] = 1
    rows = [("voice", voice.tolist()), ("clicks", clicks.tolist()), ("none", None), ("empty", []), ("gaps", [None, float("nan")] * 50)]
    got = {r.k: r for r in features.trimmed(spark.createDataFrame(rows, "k string, samples array<double>"), rate).collect()}
    assert got["voice"].trim.method == "voice" and abs(got["voice"].trim.start - 1) < 0.05 and abs(got["voice"].trim.end - 2) < 0.05
    assert got["clicks"].trim.method == "energy" and abs(got["clicks"].trim.start - 9000 / rate) < 0.01
    assert got["none"].trim is None and got["none"].voiced is None
    assert got["gaps"].trim.method == "none"


# --- spectra -------------------------------------------------------------------------------------


def test_a_consistent_spectrum_returns_its_signal():
    x = np.random.default_rng(2).normal(size=1000)
    z = signals.spectra(x, 64, 16)
    assert np.abs(signals.signal(z, 64, 16, 1000) - x).max() < 1e-9


def test_griffin_lim_error_falls():
    t = np.arange(4000) / 8000
    x = np.sin(2 * np.pi * 300 * t) + 0.5 * np.sin(2 * np.pi * (500 + 400 * t) * t)
    m = np.abs(signals.spectra(x, 256, 64))
    errors = [signals.spectral_error(signals.griffin_lim(m, 64, 4000, rounds), m, 256, 64) for rounds in range(0, 24, 3)]
    assert all(b <= a + 1e-9 for a, b in zip(errors, errors[1:]))
    assert errors[-1] < 0.4 * errors[0]


def test_spectrogram_columns(spark):
    x = np.sin(np.arange(512) / 3)
    df = spark.createDataFrame([(1, x.tolist()), (2, None)], "k int, samples array<double>")
    spectra = signals.spectrogram_column(df, 64, 16)
    back = {r.k: r.samples for r in signals.inverted_column(spectra, 16, 512).collect()}
    assert back[2] is None
    m = np.abs(signals.spectra(x, 64, 16))
    assert signals.spectral_error(np.array(back[1]), m, 64, 16) < 0.2
