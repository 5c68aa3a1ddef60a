"""Catalogue packages: files, subjects, biosamples and what describes what."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions.scalars import file_format, recording_parts, recording_to_task_name, strip_counters, whole_number
from cohortforge.operators import aggregates, windows

# Ontology terms used as constants.
ANATOMY, ASSOCIATION = "UBERON:0001737", "cfde_disease_association_type:1"
DISEASES = {"copd": "DOID:3083", "asthma": "DOID:2841"}
# Answers and their codes, by what they answer; conditions without a confirmed term have none.
CODES = {
    "race": {"race___1": "cfde_subject_race:0", "race___2": "cfde_subject_race:5", "race___3": "cfde_subject_race:2", "race___4": "cfde_subject_race:6", "race___5": "cfde_subject_race:3", "race___6": "cfde_subject_race:4", "race___7": "cfde_subject_race:4"},
    "sex": {"": "cfde_subject_sex:0", "Female": "cfde_subject_sex:1", "Male": "cfde_subject_sex:2"},
    "ethnicity": {"Not Hispanic or Latino": "cfde_subject_ethnicity:1", "Hispanic or Latino": "cfde_subject_ethnicity:0", "Prefer not to answer": ""},
    "paediatric_race": {
        "White": "cfde_subject_race:3",
        "Black or African American": "cfde_subject_race:2",
        "Asian": "cfde_subject_race:5",
        "American Indian or Alaska Native": "cfde_subject_race:0",
        "Native Hawaiian or Other Pacific Islander": "cfde_subject_race:6",
        "Other": "cfde_subject_race:4",
        "Canadian Indigenous or Aboriginal": "cfde_subject_race:4",
        "Prefer not to answer": "",
    },
    "paediatric_sex": {"": "cfde_subject_sex:0", "Female gender identity": "cfde_subject_sex:1", "Male gender identity": "cfde_subject_sex:2", "Other": "cfde_subject_sex:0"},
    "disease": {
        "airway_stenosis": "DOID:11527",
        "amyotrophic_lateral_sclerosis": "DOID:332",
        "anxiety": "DOID:2030",
        "bipolar_disorder": "DOID:3312",
        "cognitive_impairment": "DOID:10652",
        "depression": "DOID:1470",
        "laryngeal_cancer": "DOID:2600",
        "laryngeal_dystonia": "DOID:0050835",
        "laryngitis": "DOID:3437",
        "parkinsons_disease": "DOID:14330",
    },
}


def coded(column, kind: str):
    """The code of an answer; null for an answer without one, the code of an empty answer for a missing one where there is such."""
    table = F.create_map(*(F.lit(x) for pair in CODES[kind].items() for x in pair))
    value = F.coalesce(F.col(column), F.lit("")) if "" in CODES[kind] else F.col(column)
    return F.try_element_at(table, value)


def file_table(files: DataFrame, namespace: str) -> DataFrame:
    """local_id, size, sha256, md5, format of (path, content or digests, length)."""
    binary = "content" in files.columns
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.lit(namespace).alias("id_namespace"),
        name.alias("local_id"),
        whole_number(F.col("length").cast("string")).alias("size_in_bytes"),
        (F.sha2("content", 256) if binary else F.col("sha256")).alias("sha256"),
        (F.md5("content") if binary else F.col("md5")).alias("md5"),
        file_format("path").alias("file_format"),
    ).dropDuplicates(["local_id"])


def anonymous_ids(recordings: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """participant_id, anon_id: held ids stay, new participants are numbered on."""
    empty = recordings.select("participant_id", F.lit("").alias("anon_id")).limit(0)
    return windows.minted(recordings, held if held is not None else empty, "participant_id")


def biosamples(recordings: DataFrame, ids: DataFrame, terms: DataFrame) -> DataFrame:
    """One biosample for each (participant, session, task): anonymous id and the task's ontology term, if it has one."""
    r = recordings.select("participant_id", "session_id", strip_counters(recording_to_task_name("task_name")).alias("task")).distinct()
    r = r.join(ids, "participant_id").join(terms, "task", "left")
    return r.select(F.concat_ws("_", "anon_id", "session_id", "task").alias("local_id"), "anon_id", "session_id", "task", F.col("term").alias("assay_type"), F.lit(ANATOMY).alias("anatomy")).distinct()


def biosample_diseases(samples: DataFrame, diagnoses: DataFrame, ids: DataFrame) -> DataFrame:
    """Biosamples of participants with a positive diagnosis (participant_id, disease, value)."""
    yes = F.lower("value").isin("yes", "1", "true")
    positive = diagnoses.where(yes).select("participant_id", "disease").distinct().join(ids, "participant_id").select("anon_id", "disease")
    return samples.join(positive, "anon_id").select(F.col("local_id").alias("biosample_local_id"), F.lit(ASSOCIATION).alias("association_type"), "disease").distinct()


def described(files: DataFrame, samples: DataFrame, ids: DataFrame) -> DataFrame:
    """Recording files with the biosample of their participant, session and task."""
    f = files.withColumn("p", recording_parts("local_id")).where("p is not null")
    f = f.select("local_id", F.col("p.participant").alias("participant_id"), F.col("p.session").alias("session_id"), strip_counters(recording_to_task_name("p.task")).alias("task"))
    s = samples.select("anon_id", "session_id", "task", F.col("local_id").alias("biosample_local_id"))
    return f.join(ids, "participant_id").join(s, ["anon_id", "session_id", "task"]).select(F.col("local_id").alias("file_local_id"), "biosample_local_id").distinct()


def controlled(records: DataFrame, ids: DataFrame, held: DataFrame, project: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Files, new ids and crosswalk of a controlled release's (path, name, md5, size) records.

    Recordings go by their anonymous id and task; (participant, session) pairs that ``ids`` (participant_id, session_id,
    anon_id) lacks are numbered on from it, in order.  Other files keep their path.  Of equal local ids the first path counts.
    ``held``: local_id of known biosamples; ``new_biosample`` marks what they lack.
    """
    r = records.withColumn("p", recording_parts("name")).withColumns({"participant_id": F.col("p.participant"), "session_id": F.col("p.session"), "task": F.col("p.task"), "ext": F.concat(F.lit("."), F.col("p.extension"))}).drop("p")
    pair = F.struct("participant_id", "session_id")
    keyed = r.where("participant_id is not null").select(pair.alias("pair")).distinct()
    made = windows.minted(keyed, ids.select(pair.alias("pair"), "anon_id"), "pair")
    fresh = made.join(ids.select(pair.alias("pair")), "pair", "left_anti").select("pair.*", "anon_id")
    all_ids = made.select("pair.participant_id", "pair.session_id", "anon_id")
    r = r.join(all_ids, ["participant_id", "session_id"], "left")
    biosample = F.when(F.col("anon_id").isNotNull(), F.concat_ws("_", "anon_id", "task"))
    r = r.withColumn("biosample_local_id", biosample).withColumn("local_id", F.concat(F.lit(f"{project}/"), F.coalesce(F.concat("biosample_local_id", "ext"), "path")))
    r = windows.first_of(r, ["local_id"], "path")
    r = r.join(held.select(F.col("local_id").alias("biosample_local_id"), F.lit(True).alias("known")).distinct(), "biosample_local_id", "left")
    files = r.select("local_id", F.col("name").alias("filename"), file_format("name").alias("file_format"), "md5", "size", "biosample_local_id", (F.col("biosample_local_id").isNotNull() & F.col("known").isNull()).alias("new_biosample"))
    crosswalk = r.select("path", "local_id", "participant_id", "session_id", "task", "anon_id")
    return files, fresh, crosswalk


def subjects(answers: DataFrame, ids: DataFrame) -> DataFrame:
    """Latest sex, ethnicity and age of each participant (participant_id, field, value, _row_id)."""
    out = ids
    for field, alone in (("sex", None), ("ethnicity", None), ("age", "90 and above")):
        latest = aggregates.latest_answer(answers.where(F.col("field") == field), "participant_id", "value", "_row_id", alone)
        out = out.join(latest.select("participant_id", F.col("latest").alias(field)), "participant_id", "left")
    return out


def subject_races(answers: DataFrame, ids: DataFrame, opt_out: str = "Prefer not to answer") -> DataFrame:
    """One row for each race given; none for who prefers not to answer."""
    races = answers.where(F.col("field") == "race").select("participant_id", F.explode(F.split("value", ", ")).alias("race")).distinct()
    silent = races.where(F.col("race") == opt_out).select("participant_id").distinct()
    return races.join(silent, "participant_id", "left_anti").join(ids, "participant_id").select("anon_id", "race")
