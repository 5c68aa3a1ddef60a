"""Projections, filters and schema operations on wide survey tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.functions.scalars import normalize_label

# Texts that scans take for missing.
MISSING = ["", "NA", "N/A", "n/a", "NaN", "nan", "-NaN", "-nan", "null", "NULL", "None", "<NA>", "#N/A"]


def nulls_normalized(df: DataFrame, missing: Sequence[str] = MISSING) -> DataFrame:
    """String cells that mean "missing" become null, in one projection."""
    kinds = dict(df.dtypes)
    return df.select(*(F.when(F.col(c).isin(*missing), None).otherwise(F.col(c)).alias(c) if kinds[c] == "string" else F.col(c) for c in df.columns))


def default_instrument(df: DataFrame, column: str = "redcap_repeat_instrument", default: str = "Participant") -> DataFrame:
    """Rows without an instrument are participant rows."""
    if column not in df.columns and "Repeat Instrument" in df.columns:
        df = df.withColumnRenamed("Repeat Instrument", column)
    if column not in df.columns:
        raise ValueError(f"the table has no column {column}")
    return df.withColumn(column, F.coalesce(column, F.lit(default)))


def select_instrument(df: DataFrame, instrument: str, columns: Sequence[str], discriminator: str = "redcap_repeat_instrument") -> DataFrame:
    """Rows of one instrument with its registered columns in order; missing ones are null."""
    held = set(df.columns)
    return df.where(F.col(discriminator) == instrument).select(*(F.col(c) if c in held else F.lit(None).cast("string").alias(c) for c in columns))


def renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Columns renamed; if a target is there already the source is dropped."""
    drop = [a for a, b in mapping.items() if a in df.columns and b in df.columns and a != b]
    return df.drop(*drop).withColumnsRenamed({a: b for a, b in mapping.items() if a not in drop})


def project_present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    return df.select(*(c for c in wanted if c in df.columns))


def without_empty_columns(df: DataFrame) -> DataFrame:
    """Columns with at least one value; one pass counts them all."""
    counts = df.agg(*(F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns))).first()
    return df.select(*(c for i, c in enumerate(df.columns) if counts[i]))


def without_blank_rows(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    return df.na.drop(how="all", subset=[c for c in df.columns if c not in ids])


def without_bare_rows(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Rows in which no column but the (filled) ids has a value are dropped."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in df.columns), F.lit(0))
    only_ids = sum((F.col(c).isNotNull().cast("int") for c in ids), F.lit(0))
    return df.where(~((filled == len(ids)) & (only_ids == len(ids))))


def checkbox_groups(columns: Iterable[str]) -> dict[str, list[str]]:
    """base___option columns by base."""
    out: dict[str, list[str]] = {}
    for c in columns:
        if m := re.match(r"^(.+?)___(.+)$", c):
            out.setdefault(m[1], []).append(c)
    return out


def checkboxes_binary(df: DataFrame) -> DataFrame:
    """Checkbox cells: 1 where something is written, else null."""
    boxes = {c for group in checkbox_groups(df.columns).values() for c in group}
    return df.select(*(F.when(F.trim(F.col(c).cast("string")) != "", F.lit(1).cast("byte")).alias(c) if c in boxes else F.col(c) for c in df.columns))


def checkboxes_collapsed(df: DataFrame, base: str, into: str | None = None) -> DataFrame:
    """One text of all checked options (but "other"), comma-joined; the columns go."""
    boxes = [c for c in checkbox_groups(df.columns).get(base, []) if not c.endswith("___other")]
    label = lambda c: c.split("___", 1)[1].replace("_", " ")
    joined = F.concat_ws(", ", *(F.when(F.lower(F.trim(F.col(c))) == "checked", F.lit(label(c))) for c in boxes))
    return df.withColumn(into or base, joined).drop(*checkbox_groups(df.columns).get(base, []))


def one_hot_merged(df: DataFrame, base: str) -> DataFrame:
    """The first value of base___n columns as one column."""
    boxes = checkbox_groups(df.columns).get(base, [])
    return df.withColumn(base, F.coalesce(*(F.col(c) for c in boxes))).drop(*boxes)


def reorganized(df: DataFrame, mapping: Sequence[tuple[str, str, str, str]], instrument_column: str = "schema_name") -> dict[str, DataFrame]:
    """Target tables from (source schema, source column, target schema, target column) rows.

    Rows are limited to the target's source instruments only if all of them occur; output names must not collide.
    """
    occurring = {r[0] for r in df.select(instrument_column).distinct().collect()} if instrument_column in df.columns else set()
    targets: dict[str, list[tuple[str, str, str]]] = {}
    for source, column, target, name in mapping:
        targets.setdefault(target, []).append((source, column, name))
    out = {}
    for target, parts in targets.items():
        names = [n for *_, n in parts]
        if len(set(names)) != len(names):
            raise ValueError(f"{target}: two columns get the same name")
        sources = {s for s, *_ in parts}
        rows = df.where(F.col(instrument_column).isin(*sorted(sources))) if sources and sources <= occurring else df
        out[target] = rows.select(*(F.col(c).alias(n) for _, c, n in parts if c in df.columns))
    return out


def sex_from_gender(df: DataFrame, gender: str = "gender_identity", specify: str = "specify_gender_identity", into: str = "sex_at_birth") -> DataFrame:
    """Sex at birth where the gender names it and a specification is given; placed after gender, the specification dropped."""
    value = F.when(F.col(gender).contains("Female") & F.col(specify).isNotNull(), "Female").when(F.col(gender).contains("Male") & F.col(specify).isNotNull(), "Male")
    cols = [c for c in df.columns if c not in (specify, into)]
    at = cols.index(gender) + 1
    return df.select(*cols[:at], value.alias(into), *cols[at:])


def header_verdict(columns: Iterable[str], coded: Iterable[str], labels: Iterable[str]) -> str:
    """ok, error or warn for a header that should hold coded names."""
    columns, coded, labels = list(columns), set(coded), set(labels)
    known = [c for c in columns if c in coded]
    if len(known) == len(columns):
        return "ok"
    if not known or 2 * sum(c in labels for c in columns) > len(columns):
        return "error"
    return "warn"


def header_verdicts(headers: DataFrame, names: DataFrame) -> DataFrame:
    """header, verdict as ``header_verdict`` gives it, of many headers: (header, c) rows against names (c, coded, label)."""
    kind = names.groupBy("c").agg(F.max("coded").alias("coded"), F.max("label").alias("label"))
    n = headers.join(kind, "c", "left").groupBy("header").agg(F.count("*").alias("n"), F.count_if("coded").alias("coded"), F.count_if("label").alias("labels"))
    verdict = F.when(F.col("coded") == F.col("n"), "ok").when((F.col("coded") == 0) | (2 * F.col("labels") > F.col("n")), "error").otherwise("warn")
    return n.select("header", verdict.alias("verdict"))


def flags_as_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Yes (any case, blanks around) as "1", all else as "0", nulls too."""
    return df.withColumns({c: F.when(F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))) == "yes", "1").otherwise("0") for c in columns if c in df.columns})


def dates_parsed(df: DataFrame) -> DataFrame:
    """Text columns named ..._date as times; what is none becomes null."""
    texts = {f.name for f in df.schema.fields if f.dataType.typeName() == "string" and f.name.lower().endswith("_date")}
    return df.withColumns({c: F.col(c).try_cast("timestamp") for c in sorted(texts)})


def literals_replaced(df: DataFrame, replaced: Mapping[str, Mapping[str, str]], anywhere: Mapping[str, str]) -> DataFrame:
    """Whole values replaced by column, then pieces of text replaced in every text column."""
    for c, values in replaced.items():
        if c in df.columns:
            table = F.create_map(*(F.lit(x) for pair in values.items() for x in pair))
            df = df.withColumn(c, F.coalesce(F.try_element_at(table, F.col(c)), F.col(c)))
    for old, new in anywhere.items():
        df = df.withColumns({f.name: F.replace(f.name, F.lit(old), F.lit(new)) for f in df.schema.fields if f.dataType.typeName() == "string"})
    return df


def rows_between(df: DataFrame, start: int, end: int, order: str = "_row_id") -> DataFrame:
    """Rows [start, end) in the given order, numbered across partitions."""
    from cohortforge.operators import windows

    return windows.numbered(df, [order], "_n").where((F.col("_n") > start) & (F.col("_n") <= end)).drop("_n")


def without_sensitive(features: DataFrame, sensitive: Sequence[tuple[str, str]], included_tasks: Sequence[str]) -> DataFrame:
    """Long-form features without sensitive groups, but for the tasks that may keep them."""
    keep = normalize_label("task_name").isin(*included_tasks) if included_tasks else F.lit(False)
    banned = F.lit(False)
    for group, name in sensitive:
        hit = F.col("feature_group") == group
        banned = banned | (hit & (F.col("feature_name") == name) if name else hit)
    return features.where(keep | ~banned)


def all_null(*cols: str) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNull()
    return out
