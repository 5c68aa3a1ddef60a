"""De-identification and release: whole-table compositions of the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import tensors as T
from cohortforge.functions.scalars import MONTH_LIKE_RANGES, canonical_stem, file_stem, lookup, normalize_label, path_entity, sanitize_task_entity
from cohortforge.operators import joins, select, windows

# Feature groups that may identify a speaker (group, name; no name: the whole group).
SENSITIVE = [("torchaudio", "mel_filter_bank"), ("torchaudio", "mfcc"), ("torchaudio", "mel_spectrogram"), ("torchaudio", "spectrogram"), ("ppgs", ""), ("transcription", ""), ("sparc", "ema")]
# The features of a bundle (group, name).
FEATURES = [("ppgs", "ppgs"), ("torchaudio", "pitch"), ("torchaudio", "mel_spectrogram"), ("torchaudio", "spectrogram"), ("torchaudio", "mfcc"), ("sparc", "ema"), ("sparc", "loudness"), ("sparc", "pitch"), ("sparc", "periodicity")]
STRIDED = ("spectrogram", "mfcc", "mel_spectrogram")


def phenotype_cleaned(df: DataFrame) -> DataFrame:
    """Recoded ranges, binary checkboxes, derived sex."""
    if "alcohol_amt" in df.columns:
        df = df.withColumn("alcohol_amt", lookup("alcohol_amt", MONTH_LIKE_RANGES, default="alcohol_amt"))
    df = select.checkboxes_binary(df)
    if {"gender_identity", "specify_gender_identity"} <= set(df.columns):
        df = select.sex_from_gender(df)
    return df


def phenotype_deidentified(df: DataFrame, participants: DataFrame, sessions: DataFrame, removed: DataFrame, private: Sequence[str], task: str | None = None) -> DataFrame:
    """A table without removed participants and private columns, ids remapped, task labels normalised."""
    df = select.renamed(df, {"record_id": "participant_id"})
    df = joins.excluded(df, removed.select(F.col(removed.columns[0]).alias("participant_id")), "participant_id")
    df = joins.remapped(df, participants, "participant_id")
    df = joins.remapped_like(df, sessions)
    df = df.drop(*private)
    return df.withColumn(task, normalize_label(task)) if task else df


def session_numbers(sessions: DataFrame) -> DataFrame:
    """old_id, new_id: a participant's sessions counted in id order."""
    distinct = sessions.select("participant_id", "session_id").where("session_id is not null").distinct()
    return windows.counted(distinct, "participant_id", "session_id", "new_id").select("participant_id", F.col("session_id").alias("old_id"), F.col("new_id").cast("string"))


def files_deidentified(files: DataFrame, participants: DataFrame, sessions: DataFrame, removed: DataFrame, stems: DataFrame, tasks: Sequence[str] | None) -> DataFrame:
    """Recordings that stay, with their new path; ``tasks``: normalised labels to include (None: all)."""
    f = files.withColumns({"participant_id": path_entity("path", "sub"), "session_id": path_entity("path", "ses"), "stem": file_stem("path")})
    f = joins.excluded(f, removed.select(F.col(removed.columns[0]).alias("participant_id")), "participant_id")
    f = joins.excluded_stems(f, stems)
    # one pattern, so that the label is made once: no audio check, and one of the tasks
    wanted = "" if tasks is None else "".join(["(?:", "|".join(rf"\Q{t}\E" for t in tasks) if tasks else "(?!)", ")"])
    f = f.where(normalize_label("stem").rlike(f"^(?!.*audio-check).*{wanted}"))
    f = joins.remapped(joins.remapped(f, participants, "participant_id"), sessions, "session_id")
    parts = F.split("stem", "_")
    tail = F.array_join(F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0))), "-")
    name = sanitize_task_entity(F.concat(F.lit("sub-"), "participant_id", F.lit("_ses-"), "session_id", F.lit("_"), tail))
    extension = F.regexp_extract("path", r"(\.[^./]+)$", 1)
    return f.withColumn("new_path", F.concat(F.lit("sub-"), "participant_id", F.lit("/ses-"), "session_id", F.lit("/audio/"), name, extension)).drop("stem")


def features_deidentified(features: DataFrame, removed: DataFrame, stems: DataFrame, tasks: Sequence[str]) -> DataFrame:
    """Long-form features of who stays; sensitive groups only for included tasks."""
    f = joins.excluded(features, removed.select(F.col(removed.columns[0]).alias("participant_id")), "participant_id")
    f = f.where(~normalize_label("task_name").contains("audio-check"))
    f = joins.excluded_stems(f.withColumn("stem", F.concat(F.lit("sub-"), "participant_id", F.lit("_ses-"), "session_id", F.lit("_task-"), "task_name")), stems).drop("stem")
    return select.without_sensitive(f, SENSITIVE, tasks)


def metrics_deidentified(metrics: DataFrame, participants: DataFrame, sessions: DataFrame, removed: DataFrame, stems: DataFrame) -> DataFrame:
    """Quality metrics of who stays, without audio checks and listed recordings (compared as normalised whole stems)."""
    m = joins.excluded(metrics, removed.select(F.col(removed.columns[0]).alias("participant_id")), "participant_id")
    m = m.where(~normalize_label("task_name").contains("audio-check"))
    stem = normalize_label(F.concat(F.lit("sub-"), "participant_id", F.lit("_ses-"), "session_id", F.lit("_task-"), "task_name"))
    listed = stems.select(normalize_label(canonical_stem("stem")).alias("_stem")).distinct()
    m = m.withColumn("_stem", stem).join(listed, "_stem", "left_anti").drop("_stem")
    return joins.remapped(joins.remapped(m, participants, "participant_id"), sessions, "session_id")


def feature_tables(tensors: DataFrame, features: Sequence[tuple[str, str]] = ()) -> dict[str, DataFrame]:
    """A table for each of the bundled features, by its name in the bundle."""
    return {name if group == name else f"{group}_{name}": feature_table(tensors, group, name) for group, name in features or FEATURES}


def feature_table(tensors: DataFrame, group: str, name: str) -> DataFrame:
    """participant, session, task, the feature and n_frames, ready to bundle; missing and all-NaN ones are left out."""
    df = tensors.where((F.col("feature_group") == group) & (F.col("feature_name") == name)).where(T.has_values("data"))
    data = F.col("data")
    if name == "spectrogram":
        df = df.withColumn("data", T.decibels("data")).withColumn("data", T.with_dynamic_range("data"))
        data = F.col("data").cast("array<array<float>>")
    if name in STRIDED:
        data = T.every(data)
    if group == "sparc" and name in ("loudness", "pitch", "periodicity"):
        data = T.squeezed("data")
        frames = F.size(data)
    elif group == "sparc":
        frames = F.size(data)
    else:
        frames = T.n_frames(data)
    return df.select("participant_id", "session_id", "task_name", data.alias(name), frames.cast("int").alias("n_frames")).sortWithinPartitions("participant_id", "task_name")


def static_table(scalars: DataFrame, groups: Sequence[str] = ("opensmile", "praat_parselmouth", "torchaudio_squim"), names: Sequence[str] = ()) -> DataFrame:
    """One row of scalar features for each recording; of equal names the later group counts."""
    rank = F.create_map(*(F.lit(x) for i, g in enumerate(groups) for x in (g, i)))
    ids = ["participant_id", "session_id", "task_name"]
    ranked = scalars.where(F.col("feature_group").isin(*groups)).withColumn("_r", F.try_element_at(rank, F.col("feature_group")))
    return ranked.groupBy(*ids).agg(*(F.max_by(F.when(F.col("feature_name") == n, F.col("value")), F.when(F.col("feature_name") == n, F.col("_r"))).alias(n) for n in names))


def release_issues(tables: Mapping[str, DataFrame], removed: DataFrame, original: DataFrame, allowed_tasks: Sequence[str], session_table: str) -> DataFrame:
    """rule, table, n of what a release must not hold: removed or original participants, tasks whose whole normalised label isn't allowed, unknown sessions."""
    out = []
    known = tables[session_table].select("session_id").distinct()
    for name, df in tables.items():
        if "participant_id" in df.columns:
            for rule, bad in (("removed_participant", removed), ("original_participant", original)):
                ids = bad.select(F.col(bad.columns[0]).alias("participant_id"))
                out.append(joins.included(df.select("participant_id").distinct(), ids, "participant_id").agg(F.lit(rule).alias("rule"), F.lit(name).alias("table"), F.count("*").alias("n")))
        if "task_name" in df.columns:
            labels = df.sparkSession.createDataFrame([(t,) for t in allowed_tasks if t.strip()], "allowed string").select(normalize_label("allowed").alias("_label"))
            tasks = df.where("task_name is not null").select("task_name").distinct().withColumn("_label", normalize_label("task_name"))
            out.append(tasks.join(labels, "_label", "left_anti").agg(F.lit("unexpected_task").alias("rule"), F.lit(name).alias("table"), F.count("*").alias("n")))
        if "session_id" in df.columns and name != session_table:
            out.append(df.select("session_id").where("session_id is not null").distinct().join(known, "session_id", "left_anti").agg(F.lit("unknown_session").alias("rule"), F.lit(name).alias("table"), F.count("*").alias("n")))
    issues = out[0]
    for more in out[1:]:
        issues = issues.unionByName(more)
    return issues.where("n > 0")
