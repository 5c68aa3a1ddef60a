"""Whole data sets on a shared file system: from an export to a folder of recordings, from there to a bundle, and its validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge.operators import aggregates, nested, select
from cohortforge.operators.tables import kept_once
from cohortforge.plans import deidentify, survey
from cohortforge.sources import audio, files, payloads, sinks

IDS = ["participant_id", "session_id", "task_name"]
# What a bundle must hold, where its sessions may be, and the groups of scalar features.
REQUIRED = ["torchaudio_spectrogram.parquet", "torchaudio_mfcc.parquet", "static_features.tsv", "static_features.json"]
SESSIONS = ["phenotype/task/session.tsv", "phenotype/sessions.tsv", "phenotype/session.tsv"]
STATIC = ("opensmile", "praat_parselmouth", "torchaudio_squim")
UUID = r"([0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})"


# --- from an export to a folder ------------------------------------------------------------------


def _label(name):
    return F.regexp_replace(name, "[ _]", "-")


def recording_targets(recordings: DataFrame, root: str) -> DataFrame:
    """``recordings`` (participant_id, session_id, recording_name) with folder and stem below ``root``."""
    who, when = F.concat(F.lit("sub-"), "participant_id"), F.concat(F.lit("ses-"), "session_id")
    return recordings.withColumns({"folder": F.concat_ws("/", F.lit(root), who, when, F.lit("audio")), "stem": F.concat_ws("_", who, when, F.concat(F.lit("task-"), _label("recording_name")))})


def built(spark: SparkSession, export: DataFrame, out: str, audio_root: str | None, instructions: DataFrame, columns: Mapping[str, Sequence[str]], rate: int | None = None) -> dict[str, DataFrame]:
    """A folder of participants, sessions, metadata and recordings made from a repeat-instrument export.

    ``columns``: the export's columns of Session, Acoustic Task and Recording.  A recording's file is the last one below
    ``audio_root`` whose name holds its id; recordings without one, and tasks without a name, have metadata or nothing.  With ``rate``
    files become mono 16-bit ones at that rate, else they are copied.  A file that is there already stays.

    Returns tables of what was done: participants, sessions, metadata and audio, each with path or target and error.
    """
    export = kept_once(files.default_instrument(export))
    of = lambda kind: select.select_instrument(export, kind, [c for c in columns[kind] if c in export.columns])
    sessions = of("Session").dropDuplicates(["record_id", "session_id"])
    tasks = of("Acoustic Task").where("acoustic_task_name is not null").select("acoustic_task_id", F.col("acoustic_task_session_id").alias("session_id"), "acoustic_task_name")
    recordings = of("Recording").select("recording_id", F.col("recording_acoustic_task_id").alias("acoustic_task_id"), "recording_name")
    who = sessions.select(F.col("record_id").alias("participant_id"), "session_id")
    placed = kept_once(recordings.join(tasks, "acoustic_task_id").join(who, "session_id").where("recording_name is not null"))

    participants = export.where(F.col("redcap_repeat_instrument") == "Participant").select("record_id").where("record_id is not null").distinct()
    sinks.single_file(participants.select(F.col("record_id").alias("participant_id")).orderBy("participant_id"), f"{out}/participants.tsv")
    written = kept_once(sinks.texts_written(sinks.session_files(sessions, out)))

    meta = survey.recording_metadata(placed.select("recording_id", "session_id", "recording_name"), instructions)
    own = recording_targets(placed, out).select("recording_id", F.concat_ws("/", "folder", F.concat("stem", F.lit("_recording-metadata.json"))).alias("path"))
    text = F.to_json(F.struct(*(c for c in meta.columns)))
    metadata = kept_once(sinks.texts_written(own.join(meta, "recording_id").select("path", text.alias("text"))))

    done = {"participants": participants, "sessions": written, "metadata": metadata}
    if audio_root:
        held = files.newest_by_uuid(files.inventory(spark, audio_root), UUID).select(F.lower("uuid").alias("_uuid"), F.col("path").alias("source"))
        wanted = recording_targets(placed, out).withColumn("_uuid", F.lower("recording_id")).join(held, "_uuid")
        extension = F.regexp_extract("source", r"(\.[^./]+)$", 1)
        pairs = wanted.select("source", F.concat("folder", F.lit("/"), "stem", extension).alias("target")).dropDuplicates(["target"])
        there = files.inventory(spark, out).select(F.concat(F.lit("/"), F.regexp_replace("path", "^[a-z0-9]+:/*", "")).alias("_there")) if files.exists(spark, out) else None
        if there is not None:
            pairs = pairs.join(there, F.regexp_replace("target", "^([a-z0-9]+:)?/*", "/") == F.col("_there"), "left_anti")
        done["audio"] = kept_once(sinks.recoded(pairs, rate) if rate else sinks.copies(pairs))
    return done


# --- survey responses ----------------------------------------------------------------------------


def imported(spark: SparkSession, responses: str, choices: DataFrame, audio_root: str | None = None) -> dict[str, DataFrame]:
    """Tables of a survey: participants, answers (record, instrument, column, value), sessions, and tasks and recordings of its audio.

    ``responses``: a folder of JSON-LD files <record>/<session>/*.jsonld; ``choices`` as for ``nested.survey_rows``.  ``audio_root``: a
    folder of recordings <record>/<session>/<task>-<uuid>.wav, whose lengths come from their heads.  Records are cleaned ids; those
    that aren't one have no rows.
    """
    raw = kept_once(files.survey_responses(spark, responses))
    rows = kept_once(survey.subject_ids_cleaned(survey.response_rows(raw), "record"))
    out = {
        "participants": rows.select("record").distinct(),
        "answers": nested.survey_rows(rows.select("record", "instrument", "item", "values"), choices),
        "sessions": survey.session_durations(rows),
    }
    if audio_root:
        found = audio.wav_facts(files.inventory(spark, audio_root).select("path")).select("path", F.coalesce("seconds", F.lit(0.0)).alias("duration"))
        out["tasks"], out["recordings"] = survey.audio_rows(kept_once(found))
    return out


# --- from a folder to a bundle -------------------------------------------------------------------


def bundled(spark: SparkSession, root: str, out: str, static: Mapping[str, str], n_files: int = 8, features: Sequence[tuple[str, str]] = (), split_floats: bool = False) -> DataFrame:
    """A bundle of the payloads below ``root``: a table for each feature, scalar features, their dictionary and the phenotype folder.

    ``static``: names of scalar features with their descriptions.  Payloads are read once and stored.  Returns file, status, n,
    participants, tasks of each table; a feature without values makes no file.  FileNotFoundError where there is no payload.
    """
    rows = payloads.payloads(spark, root).select(*IDS, "feature_group", F.coalesce("feature_name", "feature_group").alias("feature_name"), payloads.as_matrix().alias("data"), "value")
    rows = kept_once(rows)
    if rows.isEmpty():
        raise FileNotFoundError(f"no feature payloads below {root}")
    stats = []
    for name, df in deidentify.feature_tables(rows.where("data is not null"), features).items():
        path = f"{out}/features/{name}.parquet"
        df = kept_once(df)
        there = not df.isEmpty()
        if there:
            sinks.feature_bundle(df, path, n_files, IDS, split_floats)
        stats.append(_counted(df, f"{name}.parquet", "created" if there else "skipped(no-data)"))
    scalars = kept_once(deidentify.static_table(rows.where("value is not null"), STATIC, list(static)))
    sinks.single_file(scalars, f"{out}/features/static_features.tsv")
    elements = spark.createDataFrame(sorted(static.items()), "column string, description string")
    described = F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", F.struct("description"))))))
    sinks.failed_raise(sinks.texts_written(elements.agg(described.alias("text")).select(F.lit(f"{out}/features/static_features.json").alias("path"), "text")))
    stats.append(_counted(scalars, "static_features.tsv", "created"))
    if files.exists(spark, f"{root}/phenotype"):
        source = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/phenotype").select(F.col("path").alias("source"))
        below = F.regexp_extract("source", r".*?/phenotype/(.*)$", 1)
        sinks.failed_raise(sinks.copies(source.withColumn("target", F.concat(F.lit(f"{out}/phenotype/"), below))))
    return aggregates.union_all(stats)


def _counted(df: DataFrame, name: str, status: str) -> DataFrame:
    return df.agg(F.lit(name).alias("file"), F.lit(status).alias("status"), F.count("*").alias("n"), F.count_distinct("participant_id").alias("participants"), F.count_distinct("task_name").alias("tasks"))


def recordings_with_features(spark: SparkSession, root: str, group: str, name: str, fields: Sequence[str]) -> DataFrame:
    """Recordings below ``root`` with fields of their sidecar and one feature of their payload as rows of numbers (data).

    A sidecar <stem>.json beside <stem>_features.pt holds {item: [{linkId, answer: [{valueString}]}]}; recordings that lack either
    aren't there, a field that a sidecar lacks is null.
    """
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*_task-*.json").text(root, wholetext=True)
    stem = lambda path, ending: F.regexp_extract(path, f"([^/]+){ending}$", 1)
    sidecars = text.select(stem(F.col("_metadata.file_path"), r"\.json").alias("stem"), F.col("value").alias("response"))
    wide = nested.wide(nested.questionnaire_long(sidecars, "stem"), ["stem"], "link_id", "answer", fields)
    held = payloads.payloads(spark, root).where((F.col("feature_group") == group) & (F.col("feature_name") == name))
    return wide.join(held.select(stem(F.col("path"), r"_features\.pt").alias("stem"), payloads.as_matrix().alias("data")), "stem")


# --- validation ----------------------------------------------------------------------------------


def _inside(spark: SparkSession, folder: str, ending: str) -> list[str]:
    """Names in a folder (as many as a bundle has tables)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().endswith(ending)) if fs.exists(p) else []


def bundle_issues(spark: SparkSession, root: str, removed: DataFrame, original: DataFrame, allowed_tasks: Sequence[str]) -> DataFrame:
    """rule, table, n of what is wrong with a bundle: files that are missing or can't be read, and what ``release_issues`` finds in its tables.

    Unexpected tasks count in sensitive features alone.  Sessions of features must be among those of the phenotype's session table,
    or, without one, scalar features' sessions among those of the others.  An empty result passes.
    """
    features, found, tables = f"{root}/features", [], {}
    if not files.exists(spark, features):
        return spark.createDataFrame([("missing_folder", "features", 1)], "rule string, table string, n long")
    found += [("missing_file", n) for n in REQUIRED if not files.exists(spark, f"{features}/{n}")]
    names = _inside(spark, features, ".parquet")
    found += [] if names else [("no_parquet_files", "features")]
    if not files.exists(spark, f"{root}/phenotype"):
        found.append(("missing_folder", "phenotype"))
    for name in names:
        df = spark.read.parquet(f"{features}/{name}")
        lacks = [c for c in IDS if c not in df.columns]
        found += [("missing_column", f"{name}: {c}") for c in lacks]
        tables[name] = df.select(*(c for c in IDS if c in df.columns))
    where = [f"phenotype/{n}" for n in _inside(spark, f"{root}/phenotype", ".tsv")] + [f"phenotype/task/{n}" for n in _inside(spark, f"{root}/phenotype/task", ".tsv")]
    for name in where:
        df = files.delimited(spark, f"{root}/{name}")
        tables[name] = df.select(*(c for c in ("participant_id", "session_id") if c in df.columns and (c == "participant_id" or name in SESSIONS)))
    sessions = next((s for s in SESSIONS if s in tables), None)
    if sessions is None and where:
        found.append(("missing_file", "sessions.tsv"))
    if sessions and "session_id" not in tables[sessions].columns:
        found.append(("missing_column", f"{sessions}: session_id"))
        sessions = None
    if "static_features.tsv" not in {n for _, n in found}:
        df = files.delimited(spark, f"{features}/static_features.tsv")
        if "session_id" in df.columns:
            tables["static_features.tsv"] = df.select("session_id")
        else:
            found.append(("missing_column", "static_features.tsv: session_id"))
    tables = {n: df for n, df in tables.items() if df.columns}
    issues = [spark.createDataFrame([(rule, name, 1) for rule, name in found], "rule string, table string, n long")]
    sensitive = {f"{g}_{n}" if n else g for g, n in deidentify.SENSITIVE}
    if sessions is None:  # features vouch for one another
        known = [df.select("session_id") for n, df in tables.items() if n.endswith(".parquet") and "session_id" in df.columns]
        if known:
            tables["(all features)"], sessions = aggregates.union_all(known), "(all features)"
    if tables and sessions:
        tables = {n: df if n.removesuffix(".parquet") in sensitive or "task_name" not in df.columns else df.drop("task_name") for n, df in tables.items()}
        issues.append(deidentify.release_issues(tables, removed, original, allowed_tasks, sessions))
    return aggregates.union_all(issues)


def dictionary_followed(elements: DataFrame, before: DataFrame, after: DataFrame, column: str = "column") -> DataFrame:
    """A dictionary without the entries of columns that a table has lost; entries that never had one stay."""
    gone = [c for c in before.columns if c not in after.columns]
    return elements.where(~F.col(column).isin(*gone)) if gone else elements
