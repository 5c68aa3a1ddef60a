"""Registered queries over tensors, recordings and their quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortforge.functions import tensors as T
from cohortforge.plans import deidentify, features
from cohortforge.plans.registry import query


def _matrix(t):
    """vec_id, a 2-row matrix of each vector and its double."""
    return t("embeddings").select("vec_id", F.array(F.col("embedding"), F.transform("embedding", lambda x: x * 2)).alias("m"))


@query("matrix_shape", "SELECT vec_id, len(embedding) AS frames, FALSE AS gaps, TRUE AS usable FROM embeddings")
def _(t):
    return _matrix(t).select("vec_id", T.n_frames("m").cast("long").alias("frames"), T.has_nan("m").alias("gaps"), T.has_values("m").alias("usable"))


@query("matrix_squeezed", "SELECT vec_id, CAST(embedding[3] AS DOUBLE) AS third, CAST(len(embedding) AS BIGINT) AS n FROM embeddings")
def _(t):
    m = t("embeddings").select("vec_id", F.transform("embedding", lambda x: F.array(x)).alias("m"))
    return m.select("vec_id", F.element_at(T.squeezed("m"), 3).cast("double").alias("third"), F.size(T.squeezed("m")).cast("long").alias("n"))


@query("feature_table", """
SELECT CAST(vec_id AS VARCHAR) AS participant_id, 's' AS session_id, 't' AS task_name, CAST((len(embedding) + 1) // 2 * 2 AS BIGINT) AS n_values, CAST((len(embedding) + 1) // 2 AS BIGINT) AS n_frames FROM embeddings WHERE vec_id % 5 <> 0""")
def _(t):
    nan = F.transform("m", lambda r: F.transform(r, lambda x: F.lit(float("nan")).cast("float")))
    data = F.when(F.col("vec_id") % 5 == 0, nan).otherwise(F.col("m"))
    long = _matrix(t).select(F.col("vec_id").cast("string").alias("participant_id"), F.lit("s").alias("session_id"), F.lit("t").alias("task_name"), F.lit("torchaudio").alias("feature_group"), F.lit("mfcc").alias("feature_name"), data.alias("data"))
    out = deidentify.feature_table(long, "torchaudio", "mfcc")
    return out.select("participant_id", "session_id", "task_name", F.size(F.flatten("mfcc")).cast("long").alias("n_values"), F.col("n_frames").cast("long").alias("n_frames"))


@query("static_table", "SELECT CAST(o_custkey AS VARCHAR) AS participant_id, CAST(o_orderkey AS VARCHAR) AS session_id, o_orderstatus AS task_name, o_totalprice * 2 AS f0, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS f1 FROM orders")
def _(t):
    o = t("orders").select(F.col("o_custkey").cast("string").alias("participant_id"), F.col("o_orderkey").cast("string").alias("session_id"), F.col("o_orderstatus").alias("task_name"), "o_totalprice", "o_orderkey")
    ids = ["participant_id", "session_id", "task_name"]
    part = lambda g, n, v, df=o: df.select(*ids, F.lit(g).alias("feature_group"), F.lit(n).alias("feature_name"), v.alias("value"))
    price = F.col("o_totalprice")
    scalars = part("opensmile", "f0", price).unionByName(part("torchaudio_squim", "f0", price * 2)).unionByName(part("praat_parselmouth", "f1", price, o.where("o_orderkey % 2 = 0"))).unionByName(part("unknown", "f1", price * 9))
    return deidentify.static_table(scalars, names=["f0", "f1"])


@query("energy_bounds", "SELECT vec_id, list_position(list_transform(embedding, lambda x: abs(x) > list_max(list_transform(embedding, lambda y: abs(y))) * CAST(0.1 AS DOUBLE)), TRUE) - 1 AS first FROM embeddings")
def _(t):
    return t("embeddings").select("vec_id", T.energy_bounds("embedding")["start"].alias("first"))


@query("trim_decisions", """
WITH x AS (SELECT o_orderkey, CAST(o_orderkey % 10 AS DOUBLE) AS vs, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 10 + o_orderkey % 4 AS DOUBLE) END AS ve, 0.25 AS es, CASE WHEN o_orderkey % 2 = 0 THEN 8.0 END AS ee FROM orders),
d AS (SELECT *, CASE WHEN ve - vs >= 2 THEN 'voice' WHEN ee - es >= 2 THEN 'energy' ELSE 'none' END AS method FROM x),
b AS (SELECT *, CASE method WHEN 'voice' THEN vs WHEN 'energy' THEN es ELSE 0 END AS s, CASE method WHEN 'voice' THEN ve WHEN 'energy' THEN ee ELSE 10 END AS e FROM d)
SELECT o_orderkey, method <> 'none' AND (s > 0.5 OR e < 9.5) AS trimmed, CAST(s AS DOUBLE) AS start, CAST(e AS DOUBLE) AS "end", round((1 - (e - s) / 10) * 100, 3) AS percent, method FROM b""")
def _(t):
    k = F.col("o_orderkey")
    x = t("orders").select("o_orderkey", F.lit(10.0).alias("n"), (k % 10).cast("double").alias("vs"), F.when(k % 3 != 0, (k % 10 + k % 4).cast("double")).alias("ve"), F.lit(0.25).alias("es"), F.when(k % 2 == 0, F.lit(8.0)).alias("ee"))
    return x.select("o_orderkey", T.trim_decision("n", "es", "ee", "vs", "ve").alias("d")).select("o_orderkey", "d.*")


@query("half_precision", "SELECT o_orderkey, CAST(round_even((o_orderkey % 2048) * 1.0, 0) AS DOUBLE) AS small, CAST(round_even((2048 + o_orderkey % 2048) / 2.0, 0) * 2 AS DOUBLE) AS large FROM orders")
def _(t):
    k = F.col("o_orderkey") % 2048
    m = T.half(F.array(F.array(k.cast("float"), (k + 2048).cast("float"))))
    return t("orders").select("o_orderkey", m.alias("m")).select("o_orderkey", F.col("m")[0][0].cast("double").alias("small"), F.col("m")[0][1].cast("double").alias("large"))


@query("speaker_flags", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS n_speakers, CASE o_orderkey % 4 WHEN 1 THEN 1.0 WHEN 2 THEN 0.6 WHEN 3 THEN 0.9 END AS primary_ratio,
  CASE o_orderkey % 4 WHEN 0 THEN 'no_speakers_found' WHEN 2 THEN 'no_primary_speaker_found' WHEN 3 THEN 'many_speakers_found' END AS flag FROM orders""")
def _(t):
    turn = lambda who, a, b: F.struct(F.lit(who).alias("speaker"), F.lit(a).cast("double").alias("start"), F.lit(b).cast("double").alias("end"))
    k = F.col("o_orderkey") % 4
    none = F.filter(F.array(turn("a", 0, 1)), lambda x: x["end"] < 0)
    s = F.when(k == 0, none).when(k == 1, F.array(turn("a", 0, 4), turn("a", 5, 6))).when(k == 2, F.array(turn("a", 0, 6), turn("b", 6, 10))).otherwise(F.array(turn("a", 0, 18), turn("b", 18, 19), turn("c", 19, 20)))
    df = t("orders").select("o_orderkey", s.alias("segments"), F.lit(True).alias("is_speech"))
    return features.speaker_flags(df).select("o_orderkey", F.col("n_speakers").cast("long").alias("n_speakers"), F.round("primary_ratio", 6).alias("primary_ratio"), "flag")


@query("sample_quality", """
SELECT CAST(vec_id AS VARCHAR) AS participant_id, len(list_filter(embedding, lambda x: abs(x) < 0.01)) / len(embedding) AS proportion_silent_metric, len(list_filter(embedding, lambda x: abs(x) >= 0.99)) / len(embedding) AS proportion_clipped_metric FROM embeddings""")
def _(t):
    s = t("embeddings").select(F.col("vec_id").cast("string").alias("participant_id"), F.lit("s").alias("session_id"), F.lit("t").alias("task_name"), F.col("embedding").alias("samples"))
    return features.quality_metrics(s).select("participant_id", "proportion_silent_metric", "proportion_clipped_metric")


@query("framed_quality")
def _(t):
    """Five metrics over frames of each vector taken as samples; spectra aren't put in SQL, tests hold them to their definitions."""
    s = t("embeddings").select(F.col("vec_id").cast("string").alias("participant_id"), F.lit("s").alias("session_id"), F.lit("t").alias("task_name"), F.col("embedding").alias("samples"))
    return features.framed_metrics(s, rate=1000, window=0.016, step=0.008)


@query("features_merged", "SELECT CAST(o_orderkey AS VARCHAR) AS session_id, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice ELSE o_totalprice + 1 END AS value FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0")
def _(t):
    key = lambda df, v: df.select(F.lit("p").alias("participant_id"), F.col("o_orderkey").cast("string").alias("session_id"), F.lit("t").alias("task_name"), F.lit("g").alias("feature_group"), F.lit("n").alias("feature_name"), v.alias("value"))
    old = key(t("orders").where("o_orderkey % 3 <> 0"), F.col("o_totalprice"))
    new = key(t("orders").where("o_orderkey % 2 = 0"), F.col("o_totalprice") + 1)
    return features.merged(old, new).select("session_id", "value")


@query("pooled_tokens", "SELECT vec_id, CAST(embedding[3] AS DOUBLE) AS third, CAST(len(embedding) AS BIGINT) AS n FROM embeddings")
def _(t):
    """The mean of a vector and its double under a mask that keeps the first alone."""
    pooled = T.mean_pooled("m", F.array(F.lit(1), F.lit(0)))
    return _matrix(t).select("vec_id", F.element_at(pooled, 3).alias("third"), F.size(pooled).cast("long").alias("n"))
