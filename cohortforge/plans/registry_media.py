"""Registered queries over files: payloads, recordings, bundles; signals; instructions found in texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import signals
from cohortforge.operators.tables import own_folder
from cohortforge.plans import dataset, features, survey
from cohortforge.plans.registry import query
from cohortforge.plans.workers import importable
from cohortforge.sources import audio, filesystems, payloads, sinks

RATE = 1000
TRACKER = signals.Tracker(low=90, high=500, window=0.016, step=0.004)


def _vectors(t) -> DataFrame:
    """Vectors as recordings of one participant each."""
    e = t("embeddings")
    importable(e.sparkSession)
    return e.select("vec_id", F.col("vec_id").cast("string").alias("participant_id"), F.lit("s").alias("session_id"), F.concat(F.lit("t"), F.coalesce(F.col("label").cast("string"), F.lit(""))).alias("task_name"), "embedding")


@query("payload_features", """
SELECT CAST(vec_id AS VARCHAR) AS participant_id, 't' || coalesce(CAST(label AS VARCHAR), '') AS task_name, unnest(['torchaudio.mfcc', 'torchaudio.pitch', 'opensmile.f0']) AS feature, unnest([2, 1, NULL]) AS high,
  unnest([CAST(embedding[3] AS DOUBLE), CAST(embedding[64] AS DOUBLE), NULL]) AS some, unnest([NULL, NULL, CAST(embedding[1] AS DOUBLE)]) AS value FROM embeddings""")
def _(t):
    """Vectors written as payload files, one each, and read back by ranges."""
    v = _vectors(t)
    numbers = F.col("embedding").cast("array<double>")
    n = F.size("embedding")
    feature = lambda group, name, shape, x, value: F.struct(F.lit(group).alias("feature_group"), F.lit(name).alias("feature_name"), shape.alias("shape"), x.alias("numbers"), value.alias("value"))
    no_shape, no_numbers, no_value = F.lit(None).cast("array<int>"), F.lit(None).cast("array<double>"), F.lit(None).cast("double")
    each = F.array(
        feature("torchaudio", "mfcc", F.array(F.lit(2), (n / 2).cast("int")), numbers, no_value),
        feature("torchaudio", "pitch", F.array(n), numbers, no_value),
        feature("opensmile", "f0", no_shape, no_numbers, F.col("embedding")[0].cast("double")),
    )
    root = own_folder(v.sparkSession)
    sinks.failed_raise(payloads.payload_files(v.select("participant_id", "session_id", "task_name", F.explode(each).alias("f")).select("participant_id", "session_id", "task_name", "f.*"), root))
    back = payloads.payloads(v.sparkSession, root).withColumn("m", payloads.as_matrix())
    some = F.when(F.col("feature_name") == "mfcc", F.get(F.col("m")[0], F.lit(2))).otherwise(F.element_at(F.element_at("m", -1), -1)).cast("double")
    return back.select("participant_id", "task_name", F.concat_ws(".", "feature_group", "feature_name").alias("feature"), F.when(F.col("m").isNotNull(), F.size("m")).alias("high"), some.alias("some"), "value")


@query("recordings_measured", f"SELECT CAST(vec_id AS VARCHAR) AS participant_id, len(embedding) / {RATE}.0 AS seconds, 1 AS channels, 16 AS bits, CAST(len(embedding) AS BIGINT) AS n_frames, 44 AS head_bytes FROM embeddings")
def _(t):
    """Vectors written as 16-bit recordings; their heads read by ranges."""
    v = _vectors(t)
    root = own_folder(v.sparkSession)

    def write(batches):
        import pyarrow as pa

        for batch in batches:
            paths = []
            for who, x in zip(*(c.to_pylist() for c in batch.columns)):
                paths.append(f"{root}/sub-{who}/ses-s/audio/sub-{who}_ses-s_task-t.wav")
                filesystems.written(paths[-1], [audio.encoded([y or 0.0 for y in x or ()], RATE)])
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["path"])

    files = v.select("participant_id", "embedding").mapInArrow(write, "path string")
    return audio.wav_facts(files).select(F.regexp_extract("path", r"/sub-([^/]+)/", 1).alias("participant_id"), "seconds", "channels", "bits", "n_frames", F.col("head_bytes").cast("int").alias("head_bytes"))


@query("resampled_vectors", """
WITH e AS (SELECT vec_id, embedding AS x, len(embedding) AS n FROM embeddings),
k AS (SELECT vec_id, x, n, unnest(range(0, CAST(ceil(n * 2 / 3.0) AS BIGINT))) AS k FROM e),
w AS (SELECT vec_id, x, n, k, unnest(range(CAST(floor(k * 1.5 - 6) AS BIGINT), CAST(ceil(k * 1.5 + 6) AS BIGINT) + 1)) AS j FROM k),
d AS (SELECT vec_id, k, CASE WHEN j >= 0 AND j < n THEN CAST(x[j + 1] AS DOUBLE) ELSE 0 END AS s, j - CAST(k * 1.5 AS DOUBLE) AS u FROM w),
f AS (SELECT vec_id, k, s, CASE WHEN u = 0 THEN 1 ELSE sin(pi() * u * 2 / 3) / (pi() * u * 2 / 3) END * 0.5 * (1 + cos(pi() * u / 6)) AS tap FROM d WHERE abs(u) < 6),
y AS (SELECT vec_id, k, sum(s * tap) / sum(tap) AS y FROM f GROUP BY 1, 2)
SELECT vec_id, count(*) AS n, round(sum(y), 5) AS total, round(sum(y * y), 5) AS power FROM y GROUP BY 1""")
def _(t):
    """Vectors as samples at two thirds of their rate, by a windowed sinc of four zeros to a side."""
    df = audio.resampled_column(_vectors(t).select("vec_id", F.col("embedding").cast("array<double>").alias("samples")), 3, 2, half_width=4)
    add = lambda f: F.aggregate("samples", F.lit(0.0), lambda s, x: s + f(x))
    return df.select("vec_id", F.size("samples").cast("long").alias("n"), F.round(add(lambda x: x), 5).alias("total"), F.round(add(lambda x: x * x), 5).alias("power"))


@query("voiced_trim")
def _(t):
    """Where each vector, taken as samples, has voice, and how it is trimmed; the best path isn't put in SQL, tests hold it to all paths."""
    df = features.trimmed(_vectors(t).select("vec_id", F.col("embedding").cast("array<double>").alias("samples")), RATE, TRACKER)
    return df.select("vec_id", "voiced.start", "voiced.end", F.col("trim.trimmed").alias("trimmed"), F.col("trim.method").alias("method"))


@query("spectra_inverted")
def _(t):
    """Power spectra of vectors made into samples again; whether the result is as long, and how loud it is."""
    df = signals.spectrogram_column(_vectors(t).select("vec_id", F.col("embedding").cast("array<double>").alias("samples")), 16, 4)
    back = signals.inverted_column(df.drop("samples"), 4, 64, rounds=8)
    power = F.aggregate("samples", F.lit(0.0), lambda s, x: s + x * x)
    return back.select("vec_id", F.size("samples").alias("n"), F.round(power, 3).alias("power"))


@query("feature_bundle", "SELECT label, count(*) AS n, count(DISTINCT vec_id) AS participants, round(sum(CAST(embedding[2] AS DOUBLE)), 4) AS second FROM (SELECT 't' || coalesce(CAST(label AS VARCHAR), '') AS label, vec_id, embedding FROM embeddings) GROUP BY 1")
def _(t):
    """A bundle written for pruning, read as a table."""
    v = _vectors(t)
    root = own_folder(v.sparkSession)
    sinks.feature_bundle(v.select("participant_id", "session_id", "task_name", F.col("embedding").alias("mfcc")), root, 8).count()
    back = v.sparkSession.read.parquet(root)
    return back.groupBy(F.col("task_name").alias("label")).agg(F.count("*").alias("n"), F.countDistinct("participant_id").alias("participants"), F.round(F.sum(F.col("mfcc")[1].cast("double")), 4).alias("second"))


@query("instructions_found", """
WITH k AS (SELECT w AS key, min(p_partkey) AS "at" FROM (SELECT unnest(string_split(p_name, ' ')) AS w, p_partkey FROM part) GROUP BY 1)
SELECT doc_id, min(k."at") AS "at" FROM documents JOIN k ON contains(lower(text), lower(key)) GROUP BY 1""")
def _(t):
    """The first word of part names that is anywhere in a document."""
    words = t("part").select(F.explode(F.split("p_name", " ")).alias("key"), F.col("p_partkey").alias("at"))
    return survey.instructions_found(t("documents"), words, "doc_id", "text")


@query("recording_metadata", """
WITH i AS (SELECT lower(p_type) AS key, min(p_name) AS instructions FROM part GROUP BY p_type),
r AS (SELECT o_orderkey, o_orderstatus AS s, lower(p_type) AS kind FROM orders JOIN part ON p_partkey = o_orderkey % 200)
SELECT o_orderkey AS recording_id, 's' || o_orderkey AS session_id, CASE s WHEN 'F' THEN 'other-one' ELSE 'a-' || kind || '-task' END AS task_name, CASE s WHEN 'F' THEN '' ELSE instructions END AS instructions FROM r JOIN i ON i.key = kind""")
def _(t):
    """Recordings with the instructions of the first task whose key is part of their name."""
    kinds = t("part").groupBy("p_type").agg(F.min("p_name").alias("instructions"))
    at = F.xxhash64("p_type")  # any order: no key here is part of another
    instructions = kinds.select(F.col("p_type").alias("key"), at.alias("at"), "instructions", F.lit(None).cast("string").alias("prompts"))
    o = t("orders").join(t("part").select("p_partkey", "p_type"), F.col("p_partkey") == F.col("o_orderkey") % 200)
    name = F.when(F.col("o_orderstatus") == "F", "Other One").otherwise(F.concat(F.lit("A "), "p_type", F.lit(" Task")))
    rows = o.select(F.col("o_orderkey").alias("recording_id"), F.concat(F.lit("s"), "o_orderkey").alias("recording_session_id"), name.alias("recording_name"))
    return survey.recording_metadata(rows, instructions).select("recording_id", "session_id", "task_name", "instructions")


def _bundle(t) -> tuple[str, DataFrame]:
    """A folder of payloads of all vectors, with a session table, made into a bundle: its path and its counts."""
    v = _vectors(t)
    spark = v.sparkSession
    root, out = own_folder(spark), own_folder(spark)
    numbers, n = F.col("embedding").cast("array<double>"), F.size("embedding")
    shape = F.array(F.lit(2), (n / 2).cast("int"))
    each = F.array(
        F.struct(F.lit("torchaudio").alias("feature_group"), F.lit("mfcc").alias("feature_name"), shape.alias("shape"), numbers.alias("numbers"), F.lit(None).cast("double").alias("value")),
        F.struct(F.lit("torchaudio").alias("feature_group"), F.when(F.col("vec_id") % 2 == 0, "spectrogram").otherwise("other").alias("feature_name"), shape.alias("shape"), F.transform(numbers, lambda x: F.abs(x)).alias("numbers"), F.lit(None).cast("double").alias("value")),
        F.struct(F.lit("opensmile").alias("feature_group"), F.lit("f0").alias("feature_name"), F.lit(None).cast("array<int>").alias("shape"), F.lit(None).cast("array<double>").alias("numbers"), F.col("embedding")[0].cast("double").alias("value")),
    )
    own = v.select("participant_id", F.concat(F.lit("s"), "participant_id").alias("session_id"), F.when(F.col("task_name") == "t3", "audio-check").otherwise(F.col("task_name")).alias("task_name"), F.explode(each).alias("f"))
    sinks.failed_raise(payloads.payload_files(own.select("participant_id", "session_id", "task_name", "f.*"), root))
    some = v.where("vec_id % 7 <> 0").select("participant_id", F.concat(F.lit("s"), "participant_id").alias("session_id"))
    sinks.single_file(some, f"{root}/phenotype/sessions.tsv")
    return out, dataset.bundled(spark, root, out, {"f0": "mean pitch"}, 4, [("torchaudio", "mfcc"), ("torchaudio", "spectrogram"), ("ppgs", "ppgs")])


@query("bundle_made", """
WITH e AS (SELECT vec_id, CASE coalesce(CAST(label AS VARCHAR), '') WHEN '3' THEN 'audio-check' ELSE 't' || coalesce(CAST(label AS VARCHAR), '') END AS task FROM embeddings)
SELECT 'torchaudio_mfcc.parquet' AS file, 'created' AS status, count(*) AS n, count(DISTINCT vec_id) AS participants, count(DISTINCT task) AS tasks FROM e
UNION ALL SELECT 'torchaudio_spectrogram.parquet', 'created', count(*), count(DISTINCT vec_id), count(DISTINCT task) FROM e WHERE vec_id % 2 = 0
UNION ALL SELECT 'ppgs.parquet', 'skipped(no-data)', 0, 0, 0 UNION ALL SELECT 'static_features.tsv', 'created', count(*), count(DISTINCT vec_id), count(DISTINCT task) FROM e""")
def _(t):
    return _bundle(t)[1]


@query("bundle_issues", """
WITH e AS (SELECT vec_id AS id, coalesce(label, -1) AS label FROM embeddings), f AS (SELECT 'torchaudio_mfcc.parquet' AS "table", * FROM e UNION ALL SELECT 'torchaudio_spectrogram.parquet', * FROM e WHERE id % 2 = 0)
SELECT 'removed_participant' AS rule, "table", count(DISTINCT id) AS n FROM f WHERE id % 10 = 4 GROUP BY 2
UNION ALL SELECT 'removed_participant', 'phenotype/sessions.tsv', count(*) FROM e WHERE id % 10 = 4 AND id % 7 <> 0
UNION ALL SELECT 'original_participant', "table", count(DISTINCT id) FROM f WHERE id % 10 = 6 GROUP BY 2 UNION ALL SELECT 'original_participant', 'phenotype/sessions.tsv', count(*) FROM e WHERE id % 10 = 6 AND id % 7 <> 0
UNION ALL SELECT 'unexpected_task', "table", 1 FROM f WHERE label = 3 GROUP BY 2
UNION ALL SELECT 'unknown_session', "table", count(DISTINCT id) FROM f WHERE id % 7 = 0 GROUP BY 2 UNION ALL SELECT 'unknown_session', 'static_features.tsv', count(DISTINCT id) FROM e WHERE id % 7 = 0""")
def _(t):
    """What is wrong with a bundle that holds removed and original participants, audio checks and sessions without a row."""
    out, _ = _bundle(t)
    ids = lambda k: t("embeddings").where(f"vec_id % 10 = {k}").select(F.col("vec_id").cast("string"))
    return dataset.bundle_issues(t("region").sparkSession, out, ids(4), ids(6), ["t", *(f"t{k}" for k in range(10))])
