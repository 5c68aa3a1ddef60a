"""Survey exports and audio file lists as repeat-instrument rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions.scalars import elapsed_ms, parse_instant
from cohortforge.operators import windows
from cohortforge.operators.tables import kept_once

# Order of a paediatric protocol's parts (the first that occurs in a path counts), and row constants.
PROTOCOL = ["ready_for_school", "favorite_show_movie", "favorite_food", "outside_of_school", "abcs", "123s", "naming_animals", "role_naming", "naming_food", "noisy_sounds", "long_sounds", "silly_sounds", "picture", "sentence", "picture_description", "passage", "other"]
UUID = r"([0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})"


def protocol_rank(path):
    out = F.lit(len(PROTOCOL))
    for i in reversed(range(len(PROTOCOL))):
        out = F.when(F.col(path).contains(PROTOCOL[i]), F.lit(i)).otherwise(out)
    return out


def questionnaire_types(files: DataFrame, subject_only: bool = False, path: str = "path") -> DataFrame:
    """questionnaire: last parts of the stems of sub-*.json files in a subject's folder and, unless left out, its sessions' beh folders."""
    subject = F.regexp_extract(path, r"(?:^|/)sub-[^/]+/(sub-[^/]*)\.json$", 1)
    session = F.regexp_extract(path, r"(?:^|/)sub-[^/]+/ses-[^/]+/beh/(sub-[^/]*)\.json$", 1)
    stem = F.nullif(subject, F.lit("")) if subject_only else F.coalesce(F.nullif(subject, F.lit("")), F.nullif(session, F.lit("")))
    return files.select(F.element_at(F.split(stem, "_"), -1).alias("questionnaire")).where("questionnaire is not null").distinct()


def instrument(instruments: DataFrame, name: str, column: str = "name") -> dict:
    """The one instrument of a registry table with a name; none or several are an error."""
    found = instruments.where(F.col(column) == name).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{'no' if not found else 'more than one'} instrument is named {name}")
    return found[0].asDict()


def response_rows(responses: DataFrame, subsecond_only: bool = False) -> DataFrame:
    """record, session, instrument, item, values, start, end, duration from parsed responses and their activity times."""
    instrument = F.element_at(F.split("activity", "/"), -1)
    item = F.element_at(F.split("is_about", "/"), -1)
    start, end = parse_instant("started"), parse_instant("ended")
    return responses.select("record", "session", instrument.alias("instrument"), item.alias("item"), "values", start.alias("start"), end.alias("end"), elapsed_ms(start, end, subsecond_only).alias("duration_ms"))


def session_durations(rows: DataFrame) -> DataFrame:
    micros = F.unix_micros(F.max("end")) - F.unix_micros(F.min("start"))
    return rows.groupBy("record", "session").agg((micros / 1e6).alias("session_duration"))


def audio_rows(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Task rows and recording rows from (path, duration): .../<record>/<session>/<task>-<uuid>.wav.

    Recordings are numbered within their task in protocol order; a task lasts as long as its recordings.
    """
    parts = F.split("path", "/")
    name = F.regexp_replace(F.element_at(parts, -1), r"\.wav$", "")
    task = F.regexp_replace(F.regexp_replace(name, "-?" + UUID + "$", ""), "_task", "")
    f = files.select("path", "duration", F.element_at(parts, -3).alias("record_id"), F.regexp_replace(F.element_at(parts, -2), "-+$", "").alias("session_id"), task.alias("task"), F.regexp_extract(name, UUID, 1).alias("recording_id"), protocol_rank("path").alias("rank"))
    f = f.withColumn("task", F.regexp_replace("task", r"_\d+(_\d+_plus)?$", ""))
    f = f.withColumn("task_id", F.sha2(F.concat_ws("|", "record_id", "session_id", "task"), 256))
    recordings = f.withColumn("_order", F.struct("rank", "path"))
    recordings = windows.counted(recordings, "task_id", "_order", "n").select("record_id", "session_id", "task_id", "recording_id", F.concat_ws("-", "task", "n").alias("recording_name"), "duration", F.lit("Speech").alias("recording_profile_name"), F.lit("v1.0.0").alias("recording_profile_version"))
    tasks = f.groupBy("record_id", "session_id", "task_id", "task").agg(F.sum("duration").alias("acoustic_task_duration"), F.min("rank").alias("rank"))
    tasks = tasks.select("record_id", "session_id", F.col("task_id").alias("acoustic_task_id"), F.col("task").alias("acoustic_task_name"), F.lit("Pediatrics").alias("acoustic_task_cohort"), F.lit("Completed").alias("acoustic_task_status"), "acoustic_task_duration", "rank")
    return tasks, recordings


def instructions_found(names: DataFrame, instructions: DataFrame, id_col: str, name: str = "name", gram: int = 4) -> DataFrame:
    """id_col, at: the least position of an instruction whose key is part of the name (case doesn't count), for names with one.

    ``instructions``: key, at.  A key meets the names by one of its grams (pieces of ``gram`` characters, of fewer for shorter
    keys), the one that the fewest keys have; names that hold this gram are then looked at whole.  So no name is held against all
    keys.  An empty key is part of every name; null names and keys match nothing.  Ids must not be null.
    """
    keys = instructions.select(F.lower("key").alias("key"), "at").where("key is not null").groupBy("key").agg(F.min("at").alias("at"))
    # every place of a text begins a piece: a pattern that takes nothing sees all of them
    pieces = lambda text, n: F.array_distinct(F.regexp_extract_all(text, F.concat(F.lit("(?s)(?=(.{"), n.cast("string"), F.lit("}))")), F.lit(1)))
    own = keys.where("key <> ''").withColumn("n", F.least(F.length("key"), F.lit(gram)))
    grams = own.select("key", "at", "n", F.explode(pieces(F.col("key"), F.col("n"))).alias("gram"))
    anchors = kept_once(grams.join(grams.groupBy("gram").agg(F.count("*").alias("keys")), "gram").groupBy("key", "at", "n").agg(F.min(F.struct("keys", "gram"))["gram"].alias("gram")))
    texts = names.select(id_col, F.lower(name).alias("_text"))
    found = None
    for n in [r.n for r in anchors.select("n").distinct().collect()]:  # at most ``gram`` numbers
        some = anchors.where(F.col("n") == n).select("gram", "key", "at")
        met = texts.select(id_col, F.explode(pieces(F.col("_text"), F.lit(n))).alias("gram")).join(some, "gram").select(id_col, "key", "at")
        found = met if found is None else found.unionByName(met)
    empty = keys.where("key = ''").select(F.col("at").alias("_every"))  # one row at most
    whole = texts.where(F.col("_text").isNotNull()).join(F.broadcast(empty), F.lit(True), "inner").select(id_col, F.col("_every").alias("at"))
    if found is not None:
        held = found.join(texts, id_col).where(F.col("_text").contains(F.col("key"))).select(id_col, "at")
        whole = whole.unionByName(held)
    return whole.groupBy(id_col).agg(F.min("at").alias("at"))


def recording_metadata(recordings: DataFrame, instructions: DataFrame, id_col: str = "recording_id") -> DataFrame:
    """One metadata row for each recording: session_id, task_name (lower case, blanks as hyphens), instructions and prompts, and the
    fixed form of the files.

    ``recordings``: id_col, recording_name and one column whose name holds session_id.  ``instructions``: key, at, instructions,
    prompts; the first key (by ``at``) that is part of the task name counts, and without one instructions are empty.
    """
    session = next(c for c in recordings.columns if "session_id" in c)
    task = F.replace(F.lower("recording_name"), F.lit(" "), F.lit("-"))
    base = recordings.select(id_col, F.col(session).alias("session_id"), task.alias("task_name"))
    found = instructions_found(base, instructions, id_col, "task_name")
    texts = instructions.groupBy("at").agg(F.min_by("instructions", "key").alias("instructions"), F.min_by("prompts", "key").alias("prompts"))
    out = base.join(found.join(texts, "at").drop("at"), id_col, "left")
    return out.select(id_col, "session_id", "task_name", F.coalesce("instructions", F.lit("")).alias("instructions"), "prompts", F.lit(1).alias("audio_channel_count"), F.lit("16000").alias("audio_sample_rate"))


def subject_ids_cleaned(df: DataFrame, column: str = "record_id") -> DataFrame:
    """Ids without blanks and hyphens, numbers padded to four before two letters; longer ones are dropped."""
    plain = F.regexp_replace(column, r"[\s-]", "")
    number, letters = F.regexp_extract(plain, r"^(\d{1,3})([A-Za-z]{2})$", 1), F.regexp_extract(plain, r"^(\d{1,3})([A-Za-z]{2})$", 2)
    fixed = F.when(number != "", F.concat(F.lpad(number, 3, "0"), letters)).otherwise(plain)
    return df.withColumn(column, fixed).where(F.length(column) <= 5)
