"""Long and wide shapes, questionnaires, choices and data dictionaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions.scalars import capitalized, first_text

RESPONSE = "struct<item:array<struct<linkId:string,answer:array<struct<valueString:string>>>>>"


def questionnaire_long(df: DataFrame, id_col: str, response: str = "response") -> DataFrame:
    """id, link_id, answer of a response column (JSON text); more than one answer to an item is an error."""
    items = df.select(id_col, F.explode_outer(F.from_json(response, RESPONSE)["item"]).alias("i"))
    answer = F.when(F.size("i.answer") > 1, F.raise_error("an item has several answers")).otherwise(F.get("i.answer", F.lit(0))["valueString"])
    return items.select(id_col, F.col("i.linkId").alias("link_id"), answer.alias("answer"))


def wide(df: DataFrame, ids: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """A long table with one column for each name; the names are given, so nothing is scanned for them."""
    return df.groupBy(*ids).agg(*(F.first(F.when(F.col(name) == n, F.col(value)), ignorenulls=True).alias(n) for n in names))


def melted(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


def survey_rows(responses: DataFrame, choices: DataFrame) -> DataFrame:
    """record, instrument, column, value from (record, instrument, item, values ARRAY) and choices (item, value, label, multiple, n_options).

    Single answers become capitalised labels.  Multiple ones become one Checked/Unchecked column for each
    option if all answers are numbers and the option count is known, else one text joined by ";".
    """
    labels = choices.select("item", "value", "label")
    kinds = choices.groupBy("item").agg(F.max("multiple").alias("multiple"), F.max("n_options").alias("n_options"))
    r = responses.join(kinds, "item", "left")
    single = r.where(~F.coalesce("multiple", F.lit(False))).select("record", "instrument", "item", F.get("values", F.lit(0)).alias("value"))
    single = single.join(labels, ["item", "value"], "left").select("record", "instrument", F.col("item").alias("column"), capitalized(F.coalesce("label", "value")).alias("value"))
    many = r.where(F.coalesce("multiple", F.lit(False)))
    digits = F.forall("values", lambda x: x.rlike(r"^\d+$")) & F.col("n_options").isNotNull()
    options = many.where(digits).select("record", "instrument", "item", "values", F.explode(F.sequence(F.lit(1), F.col("n_options").cast("int"))).alias("k"))
    boxes = options.select("record", "instrument", F.concat("item", F.lit("___"), F.col("k")).alias("column"), F.when(F.array_contains("values", F.col("k").cast("string")), "Checked").otherwise("Unchecked").alias("value"))
    joined = many.where(~F.coalesce(digits, F.lit(False))).select("record", "instrument", F.col("item").alias("column"), F.array_join("values", ";").alias("value"))
    return single.unionByName(boxes).unionByName(joined)


def data_elements(items: DataFrame) -> DataFrame:
    """schema, column, description, ... from (schema, column, mapped_description, description, question_en, ...)."""
    return items.withColumn("description", first_text("mapped_description", "description", "question_en")).drop("mapped_description")


def checkbox_elements(elements: DataFrame) -> DataFrame:
    """Dictionary entries of base___option columns keep only that option and become integers."""
    option = F.regexp_extract("column", "___(.+)$", 1)
    narrowed = F.when(option != "", F.filter("choices", lambda c: c["value"] == option)).otherwise(F.col("choices"))
    return elements.withColumn("choices", narrowed).withColumn("datatype", F.when(option != "", "xsd:integer").otherwise(F.col("datatype")))


def unique_choices(df: DataFrame, ids: Sequence[str], choices: str = "choices") -> DataFrame:
    """id, value, label of each choice, the first of equal values."""
    flat = df.select(*ids, F.posexplode(choices).alias("at", "c")).select(*ids, "at", F.col("c.value").alias("value"), F.col("c.label").alias("label"))
    return flat.groupBy(*ids, "value").agg(F.min_by("label", "at").alias("label"))
