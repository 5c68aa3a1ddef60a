"""Validation reports: choices, ranges, features, files, table comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import tensors as T
from cohortforge.functions.scalars import INCHES_PER_CENTIMETRE, POUNDS_PER_KILOGRAM, clean_value, imperial, normalize_label

# Allowed ranges of numeric fields.
RANGES = [
    ("diagnosis_as_ds_eps", 0, 100),
    ("smoking_age_regular_cigarette_smoking_age", 0, 125),
    ("smoking_age_stopped_age", 0, 125),
    ("smoking_years_cigarettes_years", 0, 125),
    ("smoking_cigarettes_day_current_avg_number", 0, 1000),
    ("phys_health_impact", 0, 30),
    ("phys_health_limited", 0, 30),
    ("hours_voice_activity", 0, 24),
    ("height", 0, 272),
    ("weight", 0, 635),
]


def cells(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """ids, field, value: cleaned non-missing cells in long form."""
    text = df.select(*ids, *(F.col(c).cast("string").alias(c) for c in columns))
    return text.unpivot(list(ids), list(columns), "field", "value").withColumn("value", clean_value("value")).where("value is not null")


def choice_violations(long: DataFrame, choices: DataFrame, sliders: DataFrame | None = None) -> DataFrame:
    """Cells of fields with choices (field, label) whose value is none of them, nor in a slider's 0..max (field, most)."""
    allowed = choices.select("field", F.col("label").alias("value")).distinct()
    out = long.join(choices.select("field").distinct(), "field", "left_semi").join(allowed, ["field", "value"], "left_anti")
    if sliders is not None:
        number = F.col("value").try_cast("long")
        out = out.join(sliders, "field", "left").where(~F.coalesce((number >= 0) & (number <= F.col("most")), F.lit(False))).drop("most")
    return out.withColumn("rule", F.lit("choice"))


def range_violations(long: DataFrame, ranges: DataFrame) -> DataFrame:
    """Cells of fields with a range (field, least, most) that aren't whole numbers within it."""
    number = F.col("value").try_cast("double")
    fits = number.isNotNull() & (number == F.floor(number)) & (number >= F.col("least")) & (number <= F.col("most"))
    return long.join(ranges, "field").where(~F.coalesce(fits, F.lit(False))).drop("least", "most").withColumn("rule", F.lit("range"))


def ranges_table(spark, ranges=RANGES) -> DataFrame:
    return spark.createDataFrame(ranges, "field string, least int, most int")


def known_value_violations(long: DataFrame, known: DataFrame) -> DataFrame:
    """Cells of fields with reference lists (field, value: provinces, languages) whose value is in none of them, whatever its case."""
    allowed = known.select("field", F.lower(F.trim("value")).alias("_v")).distinct()
    fields = known.select("field").distinct()
    out = long.join(fields, "field", "left_semi").withColumn("_v", F.lower(F.trim("value"))).join(allowed, ["field", "_v"], "left_anti")
    return out.drop("_v").withColumn("rule", F.lit("known_value"))


def table_violations(df: DataFrame, ids: Sequence[str], choices: DataFrame, ranges: DataFrame, known: DataFrame) -> DataFrame:
    """A table against its dictionary: choices, ranges and reference lists; Checked and Unchecked always pass."""
    long = cells(df, ids, [c for c in df.columns if c not in ids]).where(~F.col("value").isin("Checked", "Unchecked"))
    chosen = choice_violations(long, choices)
    free = long.join(choices.select("field").distinct(), "field", "left_anti")
    return chosen.unionByName(range_violations(free, ranges)).unionByName(known_value_violations(free, known))


def body_measures(df: DataFrame, unit: str = "unit") -> DataFrame:
    return df.withColumns({"height": imperial("height", INCHES_PER_CENTIMETRE, unit), "weight": imperial("weight", POUNDS_PER_KILOGRAM, unit)})


def violations(df: DataFrame, ids: Sequence[str], choices: DataFrame, ranges: DataFrame) -> DataFrame:
    """All choice and range violations of a table."""
    fields = [c for c in df.columns if c not in ids]
    long = cells(df, ids, fields)
    return choice_violations(long, choices).unionByName(range_violations(long, ranges))


def forbidden_features(features: DataFrame, tasks_allowed: DataFrame) -> DataFrame:
    """Feature groups with the tasks they hold but shouldn't, as a sorted list."""
    f = features.select("feature_group", normalize_label("task_name").alias("task")).distinct()
    bad = f.join(tasks_allowed.select(normalize_label("task_name").alias("task")).distinct(), "task", "left_anti")
    return bad.groupBy("feature_group").agg(F.sort_array(F.collect_set("task")).alias("tasks"))


def feature_report(recordings: DataFrame, payloads: DataFrame, expected: Sequence[tuple[str, str]]) -> DataFrame:
    """status, feature, n, sample of recordings without payload, with several, with missing or NaN features."""
    ids = ["participant_id", "session_id", "task_name"]
    held = payloads.groupBy(*ids).agg(F.max("n_payloads").alias("n_payloads"))
    r = recordings.join(held, ids, "left")
    stem = F.concat_ws("_", *ids)
    files = r.select(stem.alias("stem"), F.when(F.coalesce("n_payloads", F.lit(0)) == 0, "no_payload").when(F.col("n_payloads") > 1, "several_payloads").alias("status"), F.lit("").alias("feature")).where("status is not null")
    wanted = F.array(*(F.struct(F.lit(g).alias("feature_group"), F.lit(n).alias("feature_name")) for g, n in expected))
    each = payloads.select(*ids).distinct().select(*ids, F.explode(wanted).alias("w")).select(*ids, "w.*")
    got = payloads.select(*ids, "feature_group", "feature_name", T.has_nan("data").alias("nan"), F.col("data").isNull().alias("gone"))
    checked = each.join(got, [*ids, "feature_group", "feature_name"], "left")
    status = F.when(F.coalesce("gone", F.lit(True)), "missing").when(F.col("nan"), "nan")
    features = checked.select(stem.alias("stem"), status.alias("status"), F.concat_ws(".", "feature_group", "feature_name").alias("feature")).where("status is not null")
    return files.unionByName(features).groupBy("status", "feature").agg(F.count("*").alias("n"), F.min("stem").alias("sample"))


def recordings_without_file(recordings: DataFrame, files: DataFrame, key: str) -> DataFrame:
    return recordings.join(files.select(key).distinct(), key, "left_anti")


def column_counts(mapping: DataFrame, present: DataFrame) -> DataFrame:
    """what, n: columns of a table (``present``: column, repeats count once) by what a registry (column, deleted) says of them."""
    m = mapping.groupBy("column").agg(F.max("deleted").alias("deleted"))
    both = present.select("column", F.lit(True).alias("_in")).distinct().join(m, "column", "full_outer")
    here, known, gone = F.col("_in").isNotNull(), F.col("deleted").isNotNull(), F.coalesce("deleted", F.lit(False))
    kinds = {"total": here, "included": here & known & ~gone, "deleted": here & gone, "only_in_table": here & ~known, "only_in_mapping": ~here & ~gone}
    counts = both.agg(*(F.count_if(c).alias(n) for n, c in kinds.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(n).alias("what"), F.col(n).alias("n")) for n in kinds))).alias("x")).select("x.*")


def column_report(used: Sequence[str], deleted: Sequence[str], present: Sequence[str]) -> dict[str, int]:
    u, d, p = set(used), set(deleted), set(present)
    return {"total": len(p), "included": len(p & u), "deleted": len(p & d), "only_in_table": len(p - u - d), "only_in_mapping": len(u - p)}
