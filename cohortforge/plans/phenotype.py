"""Phenotype tables and their data dictionary from a wide export and a field mapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions.scalars import first_text
from cohortforge.operators import nested, select, windows
from cohortforge.plans import deidentify


def mapping_kept(mapping: DataFrame, drop_deleted: bool = True) -> DataFrame:
    """Field mapping without fields marked for deletion (any case of YES); unmarked ones stay."""
    return mapping.where(F.upper(F.coalesce("delete", F.lit(""))) != "YES") if drop_deleted else mapping


def dictionary_first(rows: DataFrame, key: str = "variable", order: str = "_row_id") -> DataFrame:
    """A dictionary's first row for each trimmed variable."""
    return windows.first_of(rows.withColumn(key, F.trim(key)).where(F.col(key) != ""), [key], order)


def protocol_items(protocol: DataFrame) -> DataFrame:
    """activity, item, at from (activity, order ARRAY, properties ARRAY): items in shown order, then those only listed."""
    listed = F.filter("properties", lambda x: x.startswith("items/"))
    both = F.array_distinct(F.concat("order", F.coalesce(listed, F.array())))
    return protocol.select("activity", F.posexplode(both).alias("at", "item")).select("activity", "item", "at")


def hidden_items(protocol: DataFrame) -> DataFrame:
    """Items listed or computed but never shown."""
    listed = F.array_union(F.coalesce("properties", F.array().cast("array<string>")), F.coalesce("compute", F.array().cast("array<string>")))
    return protocol.select("activity", F.explode(F.array_except(listed, F.col("order"))).alias("item"))


def schema_of_column(elements: DataFrame) -> DataFrame:
    """column, schema: of several schemas with a column the last."""
    return elements.groupBy("column").agg(F.max_by("schema", "_row_id").alias("schema"))


def short_names(schemas: DataFrame) -> DataFrame:
    """schema, name: the schema without its prefix, or as it is where that is ambiguous."""
    from pyspark.sql import Window

    short = F.regexp_replace("schema", "^[^_]*_", "")
    clash = F.count(F.lit(1)).over(Window.partitionBy("_short")) > 1
    return schemas.select("schema").distinct().withColumn("_short", short).select("schema", F.when(clash, F.col("schema")).otherwise(F.col("_short")).alias("name"))


def with_schema(df: DataFrame, instruments: DataFrame, column: str = "redcap_repeat_instrument") -> DataFrame:
    """Rows with their instrument's schema name; unknown instruments have none."""
    names = instruments.groupBy("text").agg(F.max_by("schema_name", "_row_id").alias("schema_name"))
    return df.join(names, df[column] == names["text"], "left").drop("text")


def tables(df: DataFrame, instruments: DataFrame, mapping: DataFrame, key: str = "record_id", order: str = "_row_id") -> dict[str, DataFrame]:
    """Target tables of a wide export: cleaned, reorganised, blank rows out, values filled within a participant.

    The mapping is a registry (columns, not data) and is read to the driver.
    """
    rows = with_schema(deidentify.phenotype_cleaned(df), instruments)
    plan = [tuple(r) for r in mapping_kept(mapping).select("schema_name_source", "column_name_source", "schema_name", "column_name").collect()]
    schemas = sorted({p[2] for p in plan})
    carried = [(s, c, s2, c) for s2 in schemas for s in {p[0] for p in plan if p[2] == s2} for c in (key, order) if c not in {p[3] for p in plan if p[2] == s2}]
    unique = list(dict.fromkeys((s2, c) for _, c, s2, _ in carried))
    plan = [(next(p[0] for p in plan if p[2] == s2), c, s2, c) for s2, c in unique] + plan
    out = {}
    for name, table in select.reorganized(rows, plan).items():
        table = select.without_blank_rows(table, [key, order])
        values = [c for c in table.columns if c not in (key, order)]
        out[name] = windows.filled(table, key, values, order).drop(order)
    return out


def dictionary(mapping: DataFrame, elements: DataFrame) -> DataFrame:
    """schema, column, description, datatype, choices of the target tables; one choice only for checkbox columns."""
    e = elements.select(F.col("schema").alias("schema_name_source"), F.col("column").alias("column_name_source"), F.col("description").alias("_d"), "question_en", "datatype", "choices")
    joined = mapping_kept(mapping).join(e, ["schema_name_source", "column_name_source"], "left")
    rows = joined.select(F.col("schema_name").alias("schema"), F.col("column_name").alias("column"), first_text("description", "_d", "question_en").alias("description"), "datatype", "choices")
    return nested.checkbox_elements(rows)


def binary_questions(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns whose values are all of Yes, No, Checked, Unchecked; one pass over the table."""
    allowed = F.array(*(F.lit(x) for x in ("Yes", "No", "Checked", "Unchecked")))
    counts = df.agg(*(F.count_if(F.col(c).isNotNull() & ~F.array_contains(allowed, F.col(c))).alias(f"c{i}") for i, c in enumerate(columns))).first()
    return [c for i, c in enumerate(columns) if not counts[i]]


def compared(registered: DataFrame, controlled: DataFrame) -> DataFrame:
    """side, n: rows that only one of two releases has, as often as it has them more."""
    cols = sorted(set(registered.columns) & set(controlled.columns))
    a, b = registered.select(*cols), controlled.select(*cols)
    one = a.exceptAll(b).agg(F.lit("registered").alias("side"), F.count("*").alias("n"))
    return one.unionByName(b.exceptAll(a).agg(F.lit("controlled").alias("side"), F.count("*").alias("n")))
