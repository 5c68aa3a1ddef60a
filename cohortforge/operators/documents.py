"""Tables of JSON documents as VARIANT: leaves by path, differences, values by reference, keys in a given order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.functions.scalars import col
from cohortforge.operators.tables import kept_once


def _step(name) -> Column:
    """A key as part of a JSON pointer."""
    return F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def flattened(df: DataFrame, key: str, json: str = "json") -> DataFrame:
    """key, path (a JSON pointer), value (JSON text) of all leaves of documents; empty objects and arrays are leaves.

    Documents are opened level by level, as many times as the deepest is deep.  Null and malformed ones have no leaves.
    """
    spark = df.sparkSession
    level = df.select(key, F.lit("").alias("path"), F.try_parse_json(json).alias("v")).where("v is not null")
    out = None
    while True:
        level = kept_once(level)
        text = F.to_json("v")
        inner = F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)<") & ~text.isin("{}", "[]")
        leaves = level.where(~inner).select(key, "path", text.alias("value"))
        out = leaves if out is None else out.unionByName(leaves)
        open_ = level.where(inner)
        if open_.isEmpty():
            return out
        inside = open_.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select(F.col("pos"), F.col("key").alias("_key"), F.col("value").alias("_value")))
        place = F.coalesce(_step(F.col("_key")), F.col("pos").cast("string"))
        level = inside.select(key, F.concat("path", F.lit("/"), place).alias("path"), F.col("_value").alias("v"))


def differences(a: DataFrame, b: DataFrame, key: str, json: str = "json") -> DataFrame:
    """key, path, in_a, in_b of leaves that documents of one key don't have alike, at any depth; null where there is none.

    A document that only one side has differs in all its leaves.  Keys must not repeat.
    """
    sides = [flattened(df, key, json).withColumnRenamed("value", name) for df, name in ((a, "in_a"), (b, "in_b"))]
    return sides[0].join(sides[1], [key, "path"], "full_outer").where(~F.col("in_a").eqNullSafe(F.col("in_b"))).select(key, "path", "in_a", "in_b")


def members(json) -> Column:
    """key and value (VARIANT) of a document's own members, in its order; null for what is no object."""
    return F.map_entries(F.from_json(col(json), "map<string,variant>"))


def quoted(text) -> Column:
    """A string as JSON text."""
    whole = F.to_json(F.array(text))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def assembled(entries) -> Column:
    """JSON text of (key, value) pairs; values are JSON text."""
    return F.concat(F.lit("{"), F.array_join(F.transform(col(entries), lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["value"])), ","), F.lit("}"))


def described(keys) -> Column:
    """JSON text of a dictionary with an empty description for each name of an array."""
    return assembled(F.transform(col(keys), lambda k: F.struct(k.alias("key"), F.lit('{"description":""}').alias("value"))))


def header(json) -> Column:
    """The names of a document's members in its order, separated by tabs."""
    return F.array_join(F.json_object_keys(col(json)), "\t")


def sorted_like(json, order) -> Column:
    """A document's members in the order of an array of names; members that it doesn't name go.  Null for what is no object."""
    held = F.from_json(col(json), "map<string,variant>")
    named = F.filter(col(order), lambda k: F.map_contains_key(held, k))
    made = assembled(F.transform(named, lambda k: F.struct(k.alias("key"), F.to_json(F.element_at(held, k)).alias("value"))))
    return F.when(F.json_object_keys(col(json)).isNotNull(), made)


def updated(df: DataFrame, reference: DataFrame, key: str, json: str = "json", strict: bool = True) -> DataFrame:
    """key and the documents with each member's value taken from the reference (name, value as JSON text).

    A member that the reference lacks is an error, or stays as it is if not ``strict``.  The last value of a repeated name counts
    no more than the others: names must not repeat.  Documents that are no objects stay as they are.
    """
    rows = df.select(key, F.posexplode(members(json)).alias("_at", "_m")).select(key, "_at", F.col("_m.key").alias("name"), F.to_json("_m.value").alias("_own"))
    found = rows.join(reference.select("name", F.col("value").alias("_new"), F.lit(True).alias("_known")), "name", "left")
    own = F.raise_error(F.concat(F.lit("not in the reference: "), "name")).cast("string") if strict else F.col("_own")
    value = F.when(F.col("_known"), F.coalesce("_new", F.lit("null"))).otherwise(own)
    whole = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_at", F.col("name").alias("key"), value.alias("value")))).alias("_all"))
    made = whole.select(F.col(key).alias("_k"), assembled("_all").alias("_json"))
    return df.join(made, df[key].eqNullSafe(made["_k"]), "left").select(df[key], F.coalesce("_json", df[json]).alias(json))


def unused(df: DataFrame, reference: DataFrame, json: str = "json") -> DataFrame:
    """The reference's rows whose name no document has."""
    names = df.select(F.explode(F.json_object_keys(json)).alias("name")).distinct()
    return reference.join(names, "name", "left_anti")


def key_differences(a: DataFrame, b: DataFrame, key: str | None = None, json: str = "json") -> DataFrame:
    """Names of members that only one side's documents have (only_in: a or b): for each key, or of all documents together."""
    ids = [key] if key else []
    names = lambda df, n: df.select(*ids, F.explode(F.json_object_keys(json)).alias("name")).distinct().withColumn(n, F.lit(True))
    both = names(a, "in_a").join(names(b, "in_b"), [*ids, "name"], "full_outer")
    return both.where("in_a is null or in_b is null").select(*ids, "name", F.when(F.col("in_a").isNull(), "b").otherwise("a").alias("only_in"))
