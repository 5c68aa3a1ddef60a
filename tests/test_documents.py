"""Dictionaries as documents, instructions by parts of names, bundles and releases, against brute force."""

import json

import pytest
from pyspark.sql import functions as F

from cohortforge.operators import documents, select
from cohortforge.plans import release, survey
from cohortforge.sources import sinks

DOCS = ['{"z": 1, "a": {"y": [1, {"q": null}], "b/c": "1", "~": {}}, "m": "1"}', "{}", "[1, [], {\"k\": true}]", "not json", None, '{"a": 1.5}', '"text"']


def leaves(x, path=""):
    if isinstance(x, dict) and x:
        for k, v in x.items():
            yield from leaves(v, f"{path}/{k.replace('~', '~0').replace('/', '~1')}")
    elif isinstance(x, list) and x:
        for k, v in enumerate(x):
            yield from leaves(v, f"{path}/{k}")
    else:
        yield path, x


def parsed(text):
    try:
        return json.loads(text)
    except (ValueError, TypeError):
        return None


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(DOCS)), "id int, json string")


def test_flattened(docs):
    got = sorted((r.id, r.path, json.dumps(json.loads(r.value))) for r in documents.flattened(docs, "id").collect())
    assert got == sorted((i, p, json.dumps(v)) for i, t in enumerate(DOCS) if parsed(t) is not None for p, v in leaves(parsed(t)))


def test_differences(spark, docs):
    other = spark.createDataFrame([(0, DOCS[0].replace('"q": null', '"q": 0')), (1, '{"new": [{}]}'), (2, DOCS[2]), (9, '{"k": 1}')], "id int, json string")
    got = {(r.id, r.path): (r.in_a, r.in_b) for r in documents.differences(docs, other, "id").collect()}
    assert got == {(0, "/a/y/1/q"): ("null", "0"), (1, ""): ("{}", None), (1, "/new/0"): (None, "{}"), (5, "/a"): ("1.5", None), (6, ""): ('"text"', None), (9, "/k"): (None, "1")}
    assert documents.differences(docs, docs, "id").count() == 0


def test_key_differences_of_all_documents(spark):
    one = lambda *texts: spark.createDataFrame([(t,) for t in texts], "json string")
    got = {(r.name, r.only_in) for r in documents.key_differences(one('{"x": 1, "y": {"k": 2}}', None), one('{"y": 3, "z": null}', "bad")).collect()}
    assert got == {("x", "a"), ("z", "b")}


def test_forms(spark, docs):
    row = lambda c: [r.x for r in docs.orderBy("id").select(c.alias("x")).collect()]
    assert row(documents.header("json"))[:3] == ["z\ta\tm", "", None]
    assert row(documents.described(F.json_object_keys("json")))[0] == '{"z":{"description":""},"a":{"description":""},"m":{"description":""}}'
    order = F.array(*(F.lit(x) for x in ("m", "gone", "a")))
    got = row(documents.sorted_like("json", order))
    assert list(json.loads(got[0])) == ["m", "a"] and json.loads(got[0])["a"] == json.loads(DOCS[0])["a"] and got[1] == "{}" and got[3] is None
    odd = spark.createDataFrame([('{"a\\"b\\\\": 1}',)], "json string").select(documents.described(F.json_object_keys("json")).alias("x")).first().x
    assert json.loads(odd) == {'a"b\\': {"description": ""}}


def test_values_by_reference(spark, docs):
    reference = spark.createDataFrame([("z", '{"n": 1}'), ("m", None), ("left", "0")], "name string, value string")
    got = {r.id: r.json for r in documents.updated(docs, reference, "id", strict=False).collect()}
    assert json.loads(got[0]) == {"z": {"n": 1}, "a": json.loads(DOCS[0])["a"], "m": None} and list(json.loads(got[0])) == ["z", "a", "m"]
    assert [got[i] for i in (1, 2, 3, 4)] == DOCS[1:5]
    assert [r.name for r in documents.unused(docs, reference).collect()] == ["left"]
    with pytest.raises(Exception, match="not in the reference"):
        documents.updated(docs, reference, "id").collect()


def test_instructions_by_parts_of_names(spark):
    names = ["Free Speech one", "glides", "RAINBOW passage", "aaaa", "", None, "été à la mer", "xy", "the free"]
    keys = [("speech", 3), ("free", 1), ("Rainbow", 7), ("bow", 9), ("a", 20), ("aa", 15), ("été", 4), ("xyz", 0), (None, 0), ("glides-high", 2), ("x", 30), ("free", 0)]
    for more in ([], [("", 5)]):
        every = keys + more
        got = {r.id: r.at for r in survey.instructions_found(spark.createDataFrame(list(enumerate(names)), "id int, name string"), spark.createDataFrame(every, "key string, at int"), "id").collect()}
        wanted = {}
        for i, name in enumerate(names):
            held = [at for k, at in every if k is not None and name is not None and k.lower() in name.lower()]
            if held:
                wanted[i] = min(held)
        assert got == wanted
    assert survey.instructions_found(spark.createDataFrame([(1, "a")], "id int, name string"), spark.createDataFrame([], "key string, at int"), "id").count() == 0


def test_recording_metadata(spark):
    rec = spark.createDataFrame([(1, "s1", "Free Speech 2"), (2, "s2", None)], "recording_id int, recording_session_id string, recording_name string")
    ins = spark.createDataFrame([("speech", 2, "talk", "p"), ("free", 1, "be free", None)], "key string, at int, instructions string, prompts string")
    got = {r.recording_id: r for r in survey.recording_metadata(rec, ins).collect()}
    assert tuple(got[1]) == (1, "s1", "free-speech-2", "be free", None, 1, "16000")
    assert got[2].instructions == "" and got[2].task_name is None


def test_bundle_is_laid_out_for_pruning(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = [(f"p{i % 40:02d}", "s", f"t{i}", [float(i)] * 3, [[1.0, 2.0]]) for i in range(400)] + [("p07", "s", f"u{i}", [0.5] * 3, None) for i in range(400)]
    df = spark.createDataFrame(rows, "participant_id string, session_id string, task_name string, mfcc array<float>, spectrogram array<array<float>>").repartition(7)
    for split in (False, True):
        root = str(tmp_path / f"b{split}")
        done = sinks.feature_bundle(df, root, 6, split_floats=split)
        assert done.agg(F.sum("n_rows")).first()[0] == 800 and done.count() > 3
        files: dict[str, set] = {}
        for path in sorted(tmp_path.glob(f"b{split}/*.parquet")):
            f = pq.ParquetFile(path)
            ids = f.read(["participant_id", "task_name"]).to_pylist()
            assert ids == sorted(ids, key=lambda r: (r["participant_id"], r["task_name"]))
            for r in ids:
                files.setdefault(r["participant_id"], set()).add(path.name)
            column = lambda k: f.metadata.row_group(0).column(k)  # noqa: B023, E731
            paths = {column(k).path_in_schema: column(k) for k in range(f.metadata.num_columns)}
            assert {c.compression for c in paths.values()} == {"ZSTD"} and all(c.has_column_index for c in paths.values())
            encodings = next(c.encodings for p, c in paths.items() if p.startswith("mfcc"))
            assert ("BYTE_STREAM_SPLIT" in encodings) == split
            assert "BYTE_STREAM_SPLIT" not in next(c.encodings for p, c in paths.items() if p.startswith("spectrogram"))
        assert all(len(x) == 1 for p, x in files.items() if p != "p07") and len(files["p07"]) > 1
    assert spark.read.parquet(str(tmp_path / "bFalse")).where("participant_id = 'p03'").count() == 10


def test_rows_between_and_dictionary_bound(spark, tmp_path):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("_row_id")).repartition(5)
    assert sorted(r[0] for r in select.rows_between(df, 10, 15).collect()) == [10, 11, 12, 13, 14]
    elements = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "column string, description string")
    assert json.loads(sinks.dictionary_json(spark, elements, str(tmp_path / "d")))["data_elements"]["b"] == {"description": "y"}
    with pytest.raises(ValueError):
        sinks.dictionary_json(spark, elements, str(tmp_path / "e"), most=2)


def test_unprocessed_by_force(spark):
    names = ["sub-1_ses-2_task-a.wav", "sub-1_ses-2_task-a_features.pt", "sub-1_ses-2_task-ab.WAV", "sub-1_ses-2_task-abc.txt", "sub-1.wav", "plain.wav", "plain_x.PT", "sub-9_ses-9_x.wav", "deep.name.wav", "deep.name.txt"]
    paths = [f"{d}{n}" for d in ("", "d/", "d/e/") for n in names if not (d == "d/" and n.endswith(".txt"))]
    wanted = set()
    for p in paths:
        folder, name = p.rpartition("/")[0], p.rpartition("/")[2]
        if name.lower().endswith(".wav"):
            stem = name.rpartition(".")[0]
            for kind, ending in (("features", ".pt"), ("transcription", ".txt")):
                if not any(q.rpartition("/")[0] == folder and q.rpartition("/")[2].startswith(stem) and q.lower().endswith(ending) for q in paths):
                    wanted.add((p, kind))
    got = [tuple(r) for r in release.unprocessed(spark.createDataFrame([(p,) for p in paths], "path string")).collect()]
    assert set(got) == wanted and len(got) == len(wanted)


def test_a_failed_release_leaves_nothing_and_runs_again(spark, tmp_path):
    pairs = spark.createDataFrame([("p1", "n1")], "old_id string, new_id string")
    none = spark.createDataFrame([], "participant_id string")
    stems = spark.createDataFrame([], "stem string")
    table = spark.createDataFrame([("p1", "1"), ("p2", "2")], "participant_id string, x string")
    out = str(tmp_path / "release")
    with pytest.raises(OSError):
        release.released(spark, out, {"t": table}, None, None, pairs, pairs, none, stems, static=[str(tmp_path / "missing")])
    assert not (tmp_path / "release").exists()
    assert release.released(spark, out, {"t": table}, None, None, pairs, pairs, none, stems) == {"phenotype/t": 2}
    assert (tmp_path / "release").exists() and not (tmp_path / "release.part").exists()
    with pytest.raises(FileExistsError):
        release.released(spark, out, {"t": table}, None, None, pairs, pairs, none, stems)
