"""Payload files: written, read back by ranges, filters pushed down, foreign pickles refused."""

import io
import pickle
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortforge.sources import payloads


def features():
    return {"torchaudio": {"mfcc": np.arange(6, dtype=np.float32).reshape(2, 3), "pitch": np.array([1.5, np.nan], np.float32)}, "opensmile": {"f0": 2.5, "n": 3, "ok": True, "note": "x"}, "duration": 4.0, "big": {"n": 1 << 40}}


def test_round_trip():
    got = {(g, n): (shape, None if x is None else x.tolist(), v) for g, n, shape, x, v in payloads.entries(io.BytesIO(payloads.packed(features())))}
    assert got["torchaudio", "mfcc"] == ([2, 3], [0, 1, 2, 3, 4, 5], None)
    assert got["torchaudio", "pitch"][0] == [2] and np.isnan(got["torchaudio", "pitch"][1][1])
    assert got["opensmile", "f0"][2] == 2.5 and got["opensmile", "n"][2] == 3.0 and got["opensmile", "ok"][2] == 1.0
    assert got["opensmile", "note"] == (None, None, None)
    assert got["duration", None][2] == 4.0 and got["big", "n"][2] == float(1 << 40)


@pytest.mark.parametrize("dtype", sorted(payloads.STORAGES.values()))
def test_all_storages(dtype):
    x = np.array([[0, 1], [1, 1]]).astype(dtype)
    (row,) = payloads.entries(io.BytesIO(payloads.packed({"g": {"x": x}})))
    assert row[2] == [2, 2] and row[3].tolist() == [0, 1, 1, 1]


def archive(data: bytes) -> io.BytesIO:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a/data.pkl", data)
    out.seek(0)
    return out


class _Evil:
    def __reduce__(self):
        return eval, ("1 + 1",)


@pytest.mark.parametrize(
    "data",
    [
        pickle.dumps({"a": _Evil()}, 2),
        pickle.dumps({"a": _Evil()}, 4),
        b"\x80\x02cos\nsystem\nU\x01x\x85R.",
        b"(S'x'\nios\nsystem\n.",  # INST
        b"\x80\x02ccollections\nOrderedDict\n)\x81}b.",  # NEWOBJ, BUILD
        b"\x80\x02X\x01\x00\x00\x00xQ.",  # a persistent id that is no storage
        b"\x80\x02" + payloads.packed({"g": {"x": np.zeros(4, np.float32)}})[:40],
    ],
)
def test_foreign_pickles_raise(data):
    with pytest.raises((pickle.UnpicklingError, ValueError, EOFError)):
        list(payloads.entries(archive(data)))


def test_a_tensor_beyond_its_storage_raises():
    whole = payloads.packed({"g": {"x": np.zeros(4, np.float32)}})
    with zipfile.ZipFile(io.BytesIO(whole)) as z:
        data = z.read("features/data.pkl").replace(b"J\x04\x00\x00\x00tJ\x01", b"J\x05\x00\x00\x00tJ\x01")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a/data.pkl", data.replace(b"(J\x04\x00\x00\x00t", b"(J\x09\x00\x00\x00t"))
        z.writestr("a/data/0", bytes(16))
    with pytest.raises(pickle.UnpicklingError):
        list(payloads.entries(out))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("p"))
    rows = []
    for p in range(6):
        rows += [(f"p{p}", "s", "read", "torchaudio", "mfcc", [2, 2], [float(p), 1.0, 2.0, 3.0], None), (f"p{p}", "s", "read", "torchaudio", "pitch", [3], [1.0, 2.0, 3.0], None), (f"p{p}", "s", "read", "opensmile", "f0", None, None, p / 2)]
    df = spark.createDataFrame(rows, payloads.SCHEMA.replace("path string, ", ""))
    done = payloads.payload_files(df, root).collect()
    assert len(done) == 6 and not any(r.error for r in done)
    (__import__("pathlib").Path(root) / "sub-p0" / "other.pt").write_bytes(b"no payload by its name")
    return root, df


def test_source(spark, folder):
    root, df = folder
    got = payloads.payloads(spark, root, 1)
    assert got.rdd.getNumPartitions() == 6
    assert sorted(map(str, got.drop("path").collect())) == sorted(map(str, df.collect()))
    m = got.where("feature_name = 'mfcc'").select(payloads.as_matrix().alias("m")).first().m
    assert np.array(m).shape == (2, 2)
    assert got.where("feature_name = 'pitch'").select(payloads.as_matrix().alias("m")).first().m == [[1.0, 2.0, 3.0]]
    assert got.where("feature_name = 'f0'").select(payloads.as_matrix().alias("m")).first().m is None


def test_filters_are_pushed(spark, folder):
    root, _ = folder
    df = payloads.payloads(spark, root, 1)
    some = df.where((F.col("participant_id") == "p3") & F.col("feature_name").isin("mfcc", "f0"))
    assert some.rdd.getNumPartitions() == 1
    assert sorted(r.feature_name for r in some.collect()) == ["f0", "mfcc"]
    assert df.where("participant_id = 'nobody'").count() == 0
    assert df.where("value > 1").count() == 3  # not pushed, applied by Spark


def test_no_files(spark, tmp_path):
    assert payloads.payloads(spark, str(tmp_path)).count() == 0
