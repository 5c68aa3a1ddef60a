"""Whole runs: an export becomes a folder, payloads a bundle, and a bundle is validated."""

import json

import numpy as np
import pytest

from cohortforge.plans import dataset, features
from cohortforge.sources import audio, files, payloads

U = [f"0000000{k}-aaaa-bbbb-cccc-0123456789ab" for k in range(4)]
COLUMNS = {
    "Session": ["record_id", "session_id", "session_status"],
    "Acoustic Task": ["acoustic_task_id", "acoustic_task_session_id", "acoustic_task_name"],
    "Recording": ["recording_id", "recording_acoustic_task_id", "recording_name"],
}


@pytest.fixture(scope="module")
def export(spark):
    names = ["record_id", "redcap_repeat_instrument", "session_id", "session_status", *COLUMNS["Acoustic Task"], *COLUMNS["Recording"]]
    rows = [{"record_id": "p1"}, {"record_id": "p2"}]
    rows += [{"record_id": p, "redcap_repeat_instrument": "Session", "session_id": s, "session_status": "ok"} for p, s in (("p1", "s1"), ("p1", "s2"), ("p2", "s3"))]
    rows += [{"redcap_repeat_instrument": "Acoustic Task", "acoustic_task_id": f"a{k}", "acoustic_task_session_id": s, "acoustic_task_name": n} for k, s, n in ((1, "s1", "Free Speech"), (2, "s3", "Glides_up"), (3, "s2", None))]
    rows += [{"redcap_repeat_instrument": "Recording", "recording_id": U[k], "recording_acoustic_task_id": a, "recording_name": n} for k, a, n in ((0, "a1", "Free Speech one"), (1, "a2", "Glides_up 1"), (2, "a2", "Glides_up 2"), (3, "a3", "lost"))]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"{n} string" for n in names))


def test_an_export_becomes_a_folder(spark, export, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    tone = audio.encoded(np.sin(np.arange(800) / 4) * 0.5, 8000)
    for k in (0, 1, 3):
        (source / f"x_{U[k].upper()}.wav").write_bytes(tone)
    instructions = spark.createDataFrame([("glides", 1, "glide up", "p"), ("free", 2, "talk", None)], "key string, at int, instructions string, prompts string")
    done = dataset.built(spark, export, str(out), str(source), instructions, COLUMNS)
    assert (out / "participants.tsv").read_text().split() == ["participant_id", "p1", "p2"]
    assert (out / "sub-p1/sessions.tsv").read_text() == "record_id\tsession_id\tsession_status\np1\ts1\tok\np1\ts2\tok\n"
    one = out / "sub-p1/ses-s1/audio/sub-p1_ses-s1_task-Free-Speech-one"
    assert one.with_suffix(".wav").read_bytes() == tone
    meta = json.loads((out / "sub-p2/ses-s3/audio/sub-p2_ses-s3_task-Glides-up-1_recording-metadata.json").read_text())
    assert meta == {"recording_id": U[1], "session_id": "s3", "task_name": "glides_up-1", "instructions": "glide up", "prompts": "p", "audio_channel_count": 1, "audio_sample_rate": "16000"}
    assert len(list(out.rglob("*.wav"))) == 2 and len(list(out.rglob("*metadata.json"))) == 3
    assert done["audio"].where("error is not null").count() == 0 and done["audio"].count() == 2
    one.with_suffix(".wav").unlink()
    again = dataset.built(spark, export, str(out), str(source), instructions, COLUMNS, rate=16000)
    assert again["audio"].count() == 1  # the other is there
    assert len(audio.decoded(one.with_suffix(".wav").read_bytes())[0]) == 1600


@pytest.fixture(scope="module")
def bundle(spark, tmp_path_factory):
    root, out = (str(tmp_path_factory.mktemp(n)) for n in ("bids", "bundle"))
    rows = []
    for p in ("n1", "n2", "n3"):
        for task in ("read", "Talk"):
            rows += [(p, f"s{p}", task, "torchaudio", "spectrogram", [3, 4], [1.0] * 12, None), (p, f"s{p}", task, "torchaudio", "mfcc", [2, 4], [float("nan")] * 8 if p == "n3" else [2.0] * 8, None), (p, f"s{p}", task, "opensmile", "f0", None, None, 1.5)]
    df = spark.createDataFrame(rows, payloads.SCHEMA.replace("path string, ", ""))
    assert payloads.payload_files(df, root).where("error is not null").count() == 0
    (__import__("pathlib").Path(root) / "phenotype/task").mkdir(parents=True)
    (__import__("pathlib").Path(root) / "phenotype/task/session.tsv").write_text("participant_id\tsession_id\nn1\tsn1\nn2\tsn2\nn3\tsn3\n")
    stats = {r.file: (r.status, r.n, r.participants, r.tasks) for r in dataset.bundled(spark, root, out, {"f0": "pitch"}, 2).collect()}
    return out, stats


def issues(spark, out, removed=(), original=(), tasks=("read", "talk")):
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "participant_id string")
    return {(r.rule, r.table): r.n for r in dataset.bundle_issues(spark, out, frame(removed), frame(original), list(tasks)).collect()}


def test_a_bundle_and_its_counts(spark, bundle):
    out, stats = bundle
    assert stats["torchaudio_spectrogram.parquet"] == ("created", 6, 3, 2)
    assert stats["torchaudio_mfcc.parquet"] == ("created", 4, 2, 2)  # all-NaN ones are left out
    assert stats["sparc_ema.parquet"] == ("skipped(no-data)", 0, 0, 0)
    assert stats["static_features.tsv"] == ("created", 6, 3, 2)
    row = spark.read.parquet(f"{out}/features/torchaudio_spectrogram.parquet").first()
    assert row.n_frames == 2 and np.allclose(row.spectrogram, 0)  # each second frame, in decibels
    assert json.loads(open(f"{out}/features/static_features.json").read()) == {"f0": {"description": "pitch"}}
    assert open(f"{out}/phenotype/task/session.tsv").read().startswith("participant_id")


def test_a_bundle_is_validated(spark, bundle, tmp_path):
    import shutil
    from pathlib import Path

    out, _ = bundle
    assert issues(spark, out) == {}
    got = issues(spark, out, ["n1", "x"], ["n2"], ["read"])
    assert got["removed_participant", "torchaudio_mfcc.parquet"] == 1 and got["original_participant", "phenotype/task/session.tsv"] == 1
    assert got["unexpected_task", "torchaudio_spectrogram.parquet"] == 1
    broken = tmp_path / "b"
    shutil.copytree(out, broken)
    (broken / "features/static_features.json").unlink()
    Path(broken / "phenotype/task/session.tsv").write_text("participant_id\tsession_id\nn1\tsn1\n")
    got = issues(spark, str(broken))
    assert got["missing_file", "static_features.json"] == 1 and got["unknown_session", "torchaudio_spectrogram.parquet"] == 2 and got["unknown_session", "static_features.tsv"] == 2
    shutil.rmtree(broken / "phenotype")
    (broken / "features/.static_features.tsv.crc").unlink()
    (broken / "features/static_features.tsv").write_text("participant_id\nn1\n")
    got = issues(spark, str(broken))
    assert got["missing_folder", "phenotype"] == 1 and got["missing_column", "static_features.tsv: session_id"] == 1
    assert issues(spark, str(tmp_path / "none")) == {("missing_folder", "features"): 1}


def test_no_payloads_raise(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        dataset.bundled(spark, str(tmp_path), str(tmp_path / "o"), {})


def test_stale_spectrograms_and_followed_dictionaries(spark):
    schema = "participant_id string, session_id string, task_name string, feature_group string, feature_name string, data array<array<float>>"
    held = spark.createDataFrame([("p", "s", "t", "torchaudio", "spectrogram", [[1.0]] * 201), ("p", "s", "t", "torchaudio", "mfcc", [[1.0]]), ("q", "s", "t", "torchaudio", "spectrogram", [[1.0]] * 400), ("q", "s", "t", "torchaudio", "mfcc", [[1.0]]), ("q", "s", "t", "ppgs", "ppgs", None)], schema)
    good = features.usable(held)
    assert sorted((r.participant_id, r.feature_name) for r in good.collect()) == [("p", "mfcc"), ("p", "spectrogram"), ("q", "ppgs")]
    recordings = held.select("participant_id", "session_id", "task_name").distinct()
    assert {r.participant_id: r.needed for r in features.missing(recordings, good, ["torchaudio"]).collect()} == {"q": ["torchaudio"]}
    before, after = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), spark.createDataFrame([(1, 3)], "a int, c int")
    elements = spark.createDataFrame([("a",), ("b",), ("other",)], "column string")
    assert sorted(r.column for r in dataset.dictionary_followed(elements, before, after).collect()) == ["a", "other"]


def test_a_survey_is_imported(spark, tmp_path):
    def answer(item, value):
        return [{"@type": "x:ResponseActivity", "used": ["p/activities/basics"], "startedAtTime": "2024-01-01T00:00:00.000Z", "endedAtTime": "2024-01-01T00:00:09.500Z"}, {"@type": "x:Response", "isAbout": f"p/items/{item}", "value": value}]

    for record, session, item, value in (("1AB", "s1", "age", "25"), ("1AB", "s1", "many", ["1", "3"]), ("2 CD", "s2", "mood", "b"), ("toolong", "s3", "age", "1")):
        folder = tmp_path / "r" / record / session
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{item}.jsonld").write_text(json.dumps(answer(item, value), indent=1))
    (tmp_path / "r/1AB/s1/broken.jsonld").write_text("{")
    sound = tmp_path / "a/1AB/s1-"
    sound.mkdir(parents=True)
    for k in (0, 1):
        (sound / f"long_sounds_task_{k + 1}_10_plus-{U[k]}.wav").write_bytes(audio.encoded(np.zeros(4000 * (k + 1)), 8000))
    choices = spark.createDataFrame([("many", str(k), "x", True, 3) for k in (1, 2, 3)] + [("mood", "b", "bad", False, None)], "item string, value string, label string, multiple boolean, n_options int")
    got = dataset.imported(spark, str(tmp_path / "r"), choices, str(tmp_path / "a"))
    answers = {(r.record, r.column): r.value for r in got["answers"].collect()}
    assert answers == {("001AB", "age"): "25", ("001AB", "many___1"): "Checked", ("001AB", "many___2"): "Unchecked", ("001AB", "many___3"): "Checked", ("2", "mood"): "Bad"}
    assert {r.record for r in got["participants"].collect()} == {"001AB", "2"}
    assert {r.session_duration for r in got["sessions"].collect()} == {9.5}
    assert sorted(r.duration for r in got["recordings"].collect()) == [0.5, 1.0]
    assert [r.acoustic_task_duration for r in got["tasks"].collect()] == [1.5]


def test_responses_are_listed_and_read_in_tasks(spark, tmp_path):
    """Spark's reader would hold every file on the driver; what is found and read stays the same."""
    text = json.dumps([{"@type": "x:ResponseActivity", "used": ["p/a"]}, {"@type": "x:Response", "isAbout": "p/i", "value": "\u00fc"}], ensure_ascii=False)
    shown = ["1/s1/a.jsonld", "1/s1/b.jsonld", "2 x/s 2/a#b%.jsonld", "deep/er/3/s3/a.jsonld", "_k=v/s4/a.jsonld"]
    for name in [*shown, "1/s1/a.json", "1/.s/a.jsonld", "1/_s/a.jsonld", "1/s1/.a.jsonld", "1/s1/_a.jsonld"]:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text, encoding="utf-8")
    (tmp_path / "4/empty").mkdir(parents=True)
    (tmp_path / "1/s1/gone.jsonld").symlink_to(tmp_path / "nowhere")
    got = files.survey_responses(spark, str(tmp_path))
    assert sorted((r.record, r.session, *r["values"]) for r in got.collect()) == sorted((r, s, "\u00fc") for r, s in [("1", "s1"), ("1", "s1"), ("2", "s 2"), ("3", "s3"), ("_k=v", "s4")])
    assert not [f for f in got.inputFiles() if f.endswith(".jsonld")]
    by_spark = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonld").text(str(tmp_path), wholetext=True)
    texts = files.texts_below(spark, f"file:{tmp_path}", ".jsonld")
    assert sorted(r.value for r in texts.collect()) == sorted(r.value for r in by_spark.collect()) and sorted(r.path for r in texts.collect()) == sorted(str(tmp_path / x) for x in shown)
    assert files.texts_below(spark, f"{tmp_path}/1/s*", ".jsonld").count() == 2 and files.texts_below(spark, str(tmp_path / "4"), ".jsonld").count() == 0


def test_recordings_with_their_features(spark, tmp_path):
    schema = payloads.SCHEMA.replace("path string, ", "")
    rows = [(p, "s", "t", "torchaudio", "spectrogram", [2, 2], [1.0, 2.0, 3.0, 4.0], None) for p in ("a", "b")]
    assert payloads.payload_files(spark.createDataFrame(rows, schema), str(tmp_path)).where("error is not null").count() == 0
    item = {"item": [{"linkId": "record_id", "answer": [{"valueString": "r1"}]}, {"linkId": "other", "answer": []}]}
    (tmp_path / "sub-a/ses-s/audio/sub-a_ses-s_task-t.json").write_text(json.dumps(item, indent=2))
    (row,) = dataset.recordings_with_features(spark, str(tmp_path), "torchaudio", "spectrogram", ["record_id", "recording_name"]).collect()
    assert (row.stem, row.record_id, row.recording_name, row.data) == ("sub-a_ses-s_task-t", "r1", None, [[1.0, 2.0], [3.0, 4.0]])
