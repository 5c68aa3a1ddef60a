"""Fixed examples of the column functions, null rules and order-dependent operators."""

import hashlib
import hmac
import io
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortforge.functions import scalars as S
from cohortforge.functions import tensors as T
from cohortforge.operators import aggregates, joins, nested, select, windows
from cohortforge.plans import deidentify, features, survey, validate
from cohortforge.sources import audio, files, sinks
from cohortforge.streaming import incremental


def one(spark, value, column):
    kind = "string" if value is None else None
    df = spark.createDataFrame([(value,)], f"v {kind or 'string'}")
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text, label", [("  Rainbow Passage ", "rainbow-passage"), ("A--b__c", "a-b-c"), ("(x)", "x"), (None, None), ("!!!", "")])
def test_normalize_label(spark, text, label):
    assert one(spark, text, S.normalize_label("v")) == label
    assert one(spark, label, S.normalize_label("v")) == label


def test_scalars(spark):
    assert one(spark, "5f0c5b34-b634-4564-b97c-b44435a3e0ff", S.reduce_id("v")) == "5f0c5b34"
    assert one(spark, "sub-1_ses-2_task-Free Speech_features", S.sanitize_task_entity("v")) == "sub-1_ses-2_task-free-speech_features"
    assert one(spark, "Cape V (one)", S.recording_to_task_name("v")) == "cape-v-one"
    assert one(spark, "glides-1-2", S.strip_counters("v")) == "glides"
    assert one(spark, "/x/sub-01/ses-a/audio/sub-01_ses-a_task-t.wav", S.path_entity("v", "ses")) == "a"
    assert one(spark, "sub-01_ses-a_task-t.wav", S.path_entity("v", "sub")) == "01"
    assert one(spark, "$50,000 to $74,999", S.upper_amount("v")) == 74999
    assert one(spark, "4-Mar", S.lookup("v", S.MONTH_LIKE_RANGES, default="v")) == "3 - 4"
    assert one(spark, "other", S.lookup("v", S.MONTH_LIKE_RANGES, default="v")) == "other"
    assert one(spark, "it's", S.clean_value("v")) == "its"
    assert one(spark, "3.0", S.clean_value("v")) == "3"
    assert one(spark, "some words here", S.camel_case("v")) == "someWordsHere"
    assert one(spark, "Checked", S.import_cell("v")) == "1"
    assert one(spark, None, S.no_answer("v")) is True


def test_pseudonym_is_hmac(spark):
    key = b"k" * 32
    expected = int(hmac.new(key, b"P1", hashlib.sha256).hexdigest()[:12], 16) % 10**6
    assert one(spark, "P1", S.pseudonym("v", key)) == f"{expected:06d}"


def test_pseudonyms_collide_and_stay(spark):
    ids = spark.createDataFrame([(f"P{i}",) for i in range(9)] + [("P1",), (None,)], "id string")
    held = spark.createDataFrame([("P0", "7"), ("old", "3")], "id string, pseudonym string")
    done = {r.id: r.pseudonym for r in windows.pseudonyms(ids.where("id <> 'P8'"), b"k", held=held, digits=1).collect()}
    assert done["P0"] == "7" and done["old"] == "3" and len(done) == 9 and len(set(done.values())) == 9


def test_exclusion_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "id string")
    removed = spark.createDataFrame([("a",), ("a",)], "id string")
    assert sorted(str(r.id) for r in joins.excluded(df, removed, "id").collect()) == ["None", "b"]
    assert [r.id for r in joins.included(df, removed, "id").collect()] == ["a"]


def test_select(spark):
    df = spark.createDataFrame([("1", "Session", "x", "NA"), ("2", None, "y", "")], "record_id string, redcap_repeat_instrument string, a string, b string")
    df = select.default_instrument(select.nulls_normalized(df))
    assert [r.redcap_repeat_instrument for r in df.orderBy("record_id").collect()] == ["Session", "Participant"]
    got = select.select_instrument(df, "Session", ["record_id", "zz", "a"])
    assert got.columns == ["record_id", "zz", "a"] and got.first().zz is None
    assert "b" not in select.without_empty_columns(df).columns
    with pytest.raises(ValueError):
        select.default_instrument(df.drop("redcap_repeat_instrument"))
    assert select.header_verdict(["a", "b"], ["a", "b"], []) == "ok"
    assert select.header_verdict(["A", "B"], ["a", "b"], ["A", "B"]) == "error"
    assert select.header_verdict(["a", "A", "c"], ["a"], ["A"]) == "warn"


def test_reorganized(spark):
    df = spark.createDataFrame([("s1", "x", "y"), ("s2", "z", "w")], "schema_name string, a string, b string")
    out = select.reorganized(df, [("s1", "a", "t", "one"), ("s2", "b", "u", "two"), ("s3", "a", "v", "three")])
    assert [tuple(r) for r in out["t"].collect()] == [("x",)] and [tuple(r) for r in out["u"].collect()] == [("w",)]
    assert out["v"].count() == 2
    with pytest.raises(ValueError):
        select.reorganized(df, [("s1", "a", "t", "one"), ("s1", "b", "t", "one")])


def test_paths_with_cycle(spark):
    folders = spark.createDataFrame([("a", "root", None), ("b", "sub", "a"), ("c", "x", "d"), ("d", "y", "c"), ("e", "z", "nowhere")], "id string, name string, parent string")
    got = {r.id: r.path for r in joins.full_paths(folders).collect()}
    assert got == {"a": "root", "b": "root/sub", "c": None, "d": None, "e": None}


def test_windows(spark):
    df = spark.createDataFrame([(1, "p", None), (2, "p", "x"), (3, "p", None), (4, "q", None)], "i int, k string, v string")
    assert [r.v for r in windows.filled(df, "k", ["v"], "i").orderBy("i").collect()] == ["x", "x", "x", None]
    assert [r._number for r in windows.numbered(df, ["i"]).orderBy("i").collect()] == [1, 2, 3, 4]
    held = spark.createDataFrame([("z", "000001")], "k string, anon_id string")
    assert {r.k: r.anon_id for r in windows.minted(df, held, "k").collect()} == {"z": "000001", "p": "000002", "q": "000003"}
    chunks = sinks.id_chunks(spark.createDataFrame([(str(i),) for i in range(25)] * 2, "id string"), "id", 10)
    assert chunks.groupBy("chunk").count().orderBy("chunk").collect() == [(0, 10), (1, 10), (2, 5)]


def test_duration_of_one_answer(spark):
    rows = spark.createDataFrame([("99999", "s", "x/y/schema", "items/age", ["25"], "2024-01-01T00:00:00.000Z", "2024-01-01T00:00:40.809Z")], "record string, session string, activity string, is_about string, values array<string>, started string, ended string")
    assert survey.response_rows(rows, True).first().duration_ms == 809
    assert survey.response_rows(rows).first().duration_ms == 40809


def test_tensors(spark):
    m = [[1.0, 0.0, 100.0], [1e-3, 1.0, 10.0]]
    df = spark.createDataFrame([(m,)], "m array<array<float>>").withColumn("d", T.decibels("m")).withColumn("d", T.with_dynamic_range("d"))
    got = np.array(df.first().d)
    power = 10 * np.log10(np.maximum(np.float32(m).astype(float), 1e-10))
    assert np.allclose(got, np.maximum(power, power.max() - 80))
    nan = spark.createDataFrame([([[float("nan")]],), (None,), ([[1.0, float("nan")]],)], "m array<array<float>>")
    assert nan.where(T.has_values("m")).count() == 1 and nan.where(T.has_nan("m")).count() == 2
    bounds = spark.createDataFrame([([0.0, 0.0, 1.0, 0.5, 0.0],)], "s array<double>").select(T.energy_bounds("s").alias("b")).first().b
    assert (bounds.start, bounds.end) == (2, 3)


def test_metrics_exclusion(spark):
    metrics = spark.createDataFrame([("001", "001", "reading"), ("001", "001", "not-reading"), ("001", "001", "Audio Check")], "participant_id string, session_id string, task_name string")
    none = spark.createDataFrame([], "old_id string, new_id string")
    stems = spark.createDataFrame([("sub-001_ses-001_task-reading",)], "stem string")
    got = deidentify.metrics_deidentified(metrics, none, none, spark.createDataFrame([], "participant_id string"), stems)
    assert [r.task_name for r in got.collect()] == ["not-reading"]


def test_body_measures(spark):
    df = spark.createDataFrame([(170.0, 80.0, "Metric"), (70.0, 180.0, "US")], "height double, weight double, unit string")
    assert [tuple(r)[:2] for r in validate.body_measures(df).collect()] == [(67.0, 176.0), (70.0, 180.0)]


def test_survey_rows(spark):
    r = spark.createDataFrame([(1, "i", "age", ["25"]), (1, "i", "many", ["1", "3"]), (1, "i", "free", ["x", "y"])], "record int, instrument string, item string, values array<string>")
    choices = spark.createDataFrame([("many", "1", "a", True, 3), ("free", "9", "b", True, None)], "item string, value string, label string, multiple boolean, n_options int")
    got = {x.column: x.value for x in nested.survey_rows(r, choices).collect()}
    assert got == {"age": "25", "many___1": "Checked", "many___2": "Unchecked", "many___3": "Checked", "free": "x;y"}


def test_features_from_wav(spark, tmp_path):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(16000)
        w.writeframes((np.sin(np.arange(16000) / 5) * 20000).astype("<i2").tobytes())
    folder = tmp_path / "sub-1/ses-1/audio"
    folder.mkdir(parents=True)
    (folder / "sub-1_ses-1_task-a.wav").write_bytes(out.getvalue())
    (folder / "sub-1_ses-1_task-b.wav").write_bytes(b"broken")
    found = files.inventory(spark, str(tmp_path), content=True)
    assert sorted(r.task_name for r in found.collect()) == ["a", "b"]
    assert audio.wav_facts(found.drop("content")).where("task_name = 'a'").first().seconds == 1.0
    rows = features.extracted(found).collect()
    assert sum(r.error is not None for r in rows) == 1
    assert {r.feature_name: r.value for r in rows if not r.error}["duration"] == 1.0


def test_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", "a"), ("2", None)], "record_id string, x string")
    sinks.single_file(df, str(tmp_path / "t.tsv"))
    back = files.participants(spark, str(tmp_path / "t.tsv"))
    assert sorted(map(str, (tuple(r) for r in back.collect()))) == ["('1', 'a')", "('2', None)"]
    assert files.participants(spark, str(tmp_path / "none.tsv")).count() == 0


def test_feature_parquet(spark, tmp_path):
    tensors = spark.createDataFrame([("p", "s", "t", "torchaudio", "mfcc", [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]]), ("p", "s", "u", "torchaudio", "mfcc", None)], "participant_id string, session_id string, task_name string, feature_group string, feature_name string, data array<array<float>>")
    sinks.feature_parquet(deidentify.feature_table(tensors, "torchaudio", "mfcc"), str(tmp_path / "f"))
    row = spark.read.parquet(str(tmp_path / "f")).first()
    assert row.mfcc == [[1.0, 3.0], [4.0, 6.0]] and row.n_frames == 2


def test_growing_ids(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "ids")
    for batch in (["b", "a"], ["c", "a"]):
        spark.createDataFrame([(x,) for x in batch], "participant_id string").write.mode("append").parquet(source)
        stream = spark.readStream.schema("participant_id string").parquet(source)
        incremental.growing_ids(stream, target, str(tmp_path / "check")).awaitTermination()
    assert {r.participant_id: r.anon_id for r in spark.read.parquet(target).collect()} == {"a": "000001", "b": "000002", "c": "000003"}


def test_streamed_counts(spark, tmp_path):
    rows = spark.sql("SELECT 1L AS event_id, timestamp'2024-01-01 00:10:00' AS ts, 'x' AS event_type, 2.0D AS value UNION ALL SELECT 2L, timestamp'2024-01-01 00:20:00', 'x', 3.0D")
    rows.write.parquet(str(tmp_path / "e"))
    stream = incremental.event_counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e")))
    q = stream.writeStream.format("memory").queryName("counts").outputMode("complete").start()
    q.processAllAvailable(), q.stop()
    assert [(r.n, r.total) for r in spark.table("counts").collect()] == [(2, 5.0)]


def test_same_rows(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    assert aggregates.same_rows(a, a) and not aggregates.same_rows(a, a.distinct())


def test_pseudonyms_equal_those_given_one_by_one(spark):
    """Ids 1 to 15 000 and two digits for few ids, so that ids whose salted text is another id collide."""
    import hashlib
    import hmac

    from cohortforge.operators import windows

    key = b"k"
    number = lambda text, digits: f"{int(hmac.new(key, text.encode(), hashlib.sha256).hexdigest()[:12], 16) % 10**digits:0{digits}d}"
    for n, digits, held in ((15_000, 6, {}), (60, 2, {"3": "41", "x": "07"})):
        ids = [str(i) for i in range(1, n + 1)]
        want, taken = dict(held), set(held.values())
        for i in sorted(set(ids) - set(held)):
            candidates = (number(i + (str(tries) if tries else ""), digits) for tries in range(1000))
            want[i] = next(c for c in candidates if c not in taken)
            taken.add(want[i])
        df = spark.createDataFrame([(i,) for i in [*ids, ids[0], None]], "id string")
        old = spark.createDataFrame([*held.items()], "id string, pseudonym string") if held else None
        got = windows.pseudonyms(df, key, held=old, digits=digits)
        assert {r.id: r.pseudonym for r in got.collect()} == want
        assert got.count() == len(want)


def test_pseudonyms_of_nearly_as_many_ids_as_numbers(spark):
    """One step a round takes over a hundred rounds here; plans must not grow with them, and too many ids end at once."""
    key = b"k"
    number = lambda text: f"{int(hmac.new(key, text.encode(), hashlib.sha256).hexdigest()[:12], 16) % 1000:03d}"
    held = {"5": "041", "x": "007", "y": "no number", "z": None}
    want, taken = dict(held), set(held.values())
    for i in sorted({str(i) for i in range(980)} - set(held)):
        want[i] = next(c for c in (number(i + (str(tries) if tries else "")) for tries in range(100_000)) if c not in taken)
        taken.add(want[i])
    ids = lambda n: spark.range(n).select(F.col("id").cast("string").alias("id"))
    old = spark.createDataFrame([*held.items()], "id string, pseudonym string")
    assert {r.id: r.pseudonym for r in windows.pseudonyms(ids(980), key, held=old, digits=3).collect()} == want
    with pytest.raises(ValueError, match="don't fit"):
        windows.pseudonyms(ids(1000), key, held=old.where("id <> '5'"), digits=3)


def wav(seconds: float, rate: int = 8000, extra: bytes = b"") -> bytes:
    """A 16-bit mono file, with another chunk before its data if asked for."""
    import struct

    data = struct.pack(f"<{int(seconds * rate)}h", *([1000] * int(seconds * rate)))
    other = b"LIST" + struct.pack("<I", len(extra)) + extra + b"\0" * (len(extra) % 2) if extra else b""
    body = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, 2 * rate, 2, 16) + other + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def test_phenotype_pair_metadata_and_text_search(spark, tmp_path):
    import json

    from cohortforge.sources import files

    (tmp_path / "t.tsv").write_text("participant\tage\n1\t20\n2\tn/a\n")
    (tmp_path / "t.json").write_text(json.dumps(indent=2, obj={"s1": {"data_elements": {"age": {"description": "old"}}}, "s2": {"data_elements": {"age": {"description": "Age"}, "x": 1}}}))
    df, entries = files.phenotype_pair(spark, str(tmp_path / "t.tsv"), str(tmp_path / "t.json"))
    assert df.columns == ["participant", "age"] and df.count() == 2
    got = {r.column: r.entry for r in entries.collect()}
    assert set(got) == {"age", "x", "record_id"} and json.loads(got["age"]) == {"description": "Age"}
    side = tmp_path / "d" / "sub-1"
    side.mkdir(parents=True)
    (side / "a_recording-metadata.json").write_text('{"task_name": "read",\n "n": 3}\n')
    (side / "b_recording-metadata.json").write_text("{not json")
    rows = files.metadata_rows(spark, str(tmp_path / "d"), "task_name string, n int")
    assert [(r.task_name, r.n) for r in rows.collect()] == [("read", 3)]
    assert files.metadata_rows(spark, str(tmp_path / "d"), "task_name string", "*.none").count() == 0
    found = files.text_found(spark, str(tmp_path / "d"), "read").collect()
    assert [(r.in_name, r.in_text) for r in found] == [(False, True)]
    assert list(files.records(spark.range(3).orderBy("id"))) == [{"id": 0}, {"id": 1}, {"id": 2}]


def test_release_is_written_once(spark, tmp_path):
    from cohortforge.plans import release

    out = str(tmp_path / "out")
    note = tmp_path / "README.md"
    note.write_text("x")
    ids = spark.createDataFrame([("p1", "n1"), ("p2", "n2")], "old_id string, new_id string")
    sessions = spark.createDataFrame([("s1", "1")], "old_id string, new_id string")
    removed = spark.createDataFrame([("p2",)], "participant_id string")
    stems = spark.createDataFrame([("sub-n1_ses-1_task-bad",)], "stem string")
    table = spark.createDataFrame([("p1", "s1", 3, "secret"), ("p2", "s1", 4, "secret")], "record_id string, session_id string, score int, name string")
    paths = [f"d/sub-{p}/ses-s1/audio/sub-{p}_ses-s1_task-{t}.wav" for p in ("p1", "p2") for t in ("good", "bad")]
    features = spark.createDataFrame([(p, "s1", "good", "ppgs", "ppgs", 1.0) for p in ("p1", "p2")], "participant_id string, session_id string, task_name string, feature_group string, feature_name string, value double")
    args = ({"scores": table}, {"all": features}, spark.createDataFrame([(p,) for p in paths], "path string"), ids, sessions, removed, stems, ["good", "bad"], ["name"], [str(note)])
    assert release.released(spark, out, *args) == {"phenotype/scores": 1, "features/all": 1, "files": 1, "static": 1}
    assert [r.new_path for r in spark.read.parquet(f"{out}/files").collect()] == ["sub-n1/ses-1/audio/sub-n1_ses-1_task-good.wav"]
    held = spark.read.csv(f"{out}/phenotype/scores", sep="\t", header=True).collect()
    assert [r.asDict() for r in held] == [{"participant_id": "n1", "session_id": "1", "score": "3"}]
    with pytest.raises(FileExistsError):
        release.released(spark, out, *args)


def test_written_texts_and_models_that_fail(spark, tmp_path):
    from cohortforge.plans import features
    from cohortforge.sources import sinks

    sessions = spark.createDataFrame([("p1", "s2", None), ("p1", "s1", "ok"), ("p2", "s3", "x")], "record_id string, session_id string, status string")
    done = sinks.texts_written(sinks.session_files(sessions, str(tmp_path))).collect()
    assert len(done) == 2 and not any(r.error for r in done)
    assert (tmp_path / "sub-p1" / "sessions.tsv").read_text() == "record_id\tsession_id\tstatus\np1\ts1\tok\np1\ts2\t\n"

    def broken(samples, rate):
        raise RuntimeError("no model")

    files = spark.createDataFrame([("a", wav(0.1)), ("b", b"junk")], "path string, content binary")
    got = {(r.path, r.model): (r.result, r.error) for r in features.annotated(files, {"length": lambda x, rate: str(len(x) // (rate // 1000)), "turns": broken}).collect()}
    assert got["a", "length"] == ("100", None) and got["a", "turns"] == (None, "RuntimeError: no model")
    assert got["b", "length"][0] is None and got["b", "length"][1]


def test_framed_metrics_and_half_precision(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from cohortforge.functions import tensors as T
    from cohortforge.plans import features

    loud = (0.5 * np.sin(np.arange(4000) * 0.3)).tolist()
    df = spark.createDataFrame([("p", "s", "A b", [1.0] * 2000 + [0.0] * 2000), ("q", "s", "t", loud), ("r", "s", "t", []), ("n", "s", "t", None)], "participant_id string, session_id string, task_name string, samples array<double>")
    got = {r.participant_id: r for r in features.framed_metrics(df).collect()}
    assert got["p"].task_name == "a-b" and got["p"].proportion_clipped_metric == 0.5 and got["p"].proportion_silent_metric == 0.5 and got["p"].amplitude_modulation_depth_metric == 1.0
    assert got["q"].amplitude_modulation_depth_metric < 0.1 and got["q"].peak_snr_from_spectral_metric < 1
    assert got["r"].proportion_clipped_metric is None and got["n"].spectral_gating_snr_metric is None
    values = [0.1, 1 / 3, 65519.0, 65520.0, -70000.0, 1e-8, 6e-8, 0.0, -2.5, float("inf"), 2049.0, 2051.0]
    halves = spark.createDataFrame([(values,)], "v array<double>").select(T.half(F.array("v"))[0].alias("h")).first().h
    assert halves == np.array(values).astype(np.float16).astype(float).tolist()


def test_percentiles_and_paths_at_size(spark):
    import numpy as np

    from cohortforge.operators import aggregates, joins, windows

    random = np.random.default_rng(3)
    values = [*random.normal(size=3000).round(2).tolist(), *[0.5] * 1500, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    held = np.array(values[:-1])
    for share in (0.0, 0.1, 0.5, 0.905, 1.0):
        for most in (10_000, 10):
            assert aggregates.exact_percentile(df, "v", share, most) == pytest.approx(float(np.quantile(held, share)))
    assert aggregates.exact_percentile(df.where("v > 1e9"), "v", 0.5) is None and aggregates.size_cut(df.where("v > 1e9"), "v", 5).count() == 0
    chain = [(str(i), f"f{i}", str(i - 1) if i else None) for i in range(300)]
    circle = [("a", "a", "b"), ("b", "b", "c"), ("c", "c", "a"), ("d", "d", "a"), ("e", "e", "gone"), ("f", "f", "e")]
    got = {r.id: r.path for r in joins.full_paths(spark.createDataFrame(chain + circle, "id string, name string, parent string")).collect()}
    assert got["299"] == "/".join(f"f{i}" for i in range(300)) and [got[x] for x in "abcdef"] == [None] * 6
    ranks = windows.dense_ranked(spark.createDataFrame([(3,), (1,), (None,), (3,), (2,)], "v int"), "v").collect()
    assert sorted((r.v or 0, r.rank) for r in ranks) == [(0, -1), (1, 1), (2, 2), (3, 3), (3, 3)]
