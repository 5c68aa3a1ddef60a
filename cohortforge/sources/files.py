"""Scans: delimited tables, JSON trees, file inventories, configuration."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortforge.functions.scalars import path_entity
from cohortforge.operators.select import MISSING, default_instrument, nulls_normalized
from cohortforge.operators.tables import stored
from cohortforge.plans.workers import importable
from cohortforge.sources import filesystems

#: Entries of folders, and bytes of texts, that a task hands on at once.
LISTED, TEXT_BYTES = 10_000, 4 << 20


def delimited(spark: SparkSession, path: str, sep: str | None = None, missing: Sequence[str] = MISSING) -> DataFrame:
    """A table of strings (nothing is inferred); tab-separated unless the path ends in .csv."""
    sep = sep or ("," if path.endswith(".csv") else "\t")
    read = spark.read.options(header=True, sep=sep, multiLine=True, escape='"', quote='"')
    return nulls_normalized(read.csv(path), missing)


def repeat_instrument(spark: SparkSession, path: str) -> DataFrame:
    return default_instrument(delimited(spark, path, ","))


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns cast as a dictionary says; what doesn't fit becomes null."""
    return df.select(*(F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns))


def participants(spark: SparkSession, path: str) -> DataFrame:
    """The participants table, or an empty one."""
    if not exists(spark, path):
        return spark.createDataFrame([], "participant_id string")
    df = delimited(spark, path)
    return df if "participant_id" in df.columns else df.withColumnRenamed("record_id", "participant_id")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def inventory(spark: SparkSession, root: str, pattern: str = "*.wav", content: bool = False) -> DataFrame:
    """path, participant_id, session_id, task_name, name, length of files below a folder (contents only if asked for)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    df = df.select("path", "length", *(["content"] if content else []))
    return df.withColumns({"participant_id": path_entity("path", "sub"), "session_id": path_entity("path", "ses"), "task_name": path_entity("path", "task"), "name": F.element_at(F.split("path", "/"), -1)})


def phenotype_pair(spark: SparkSession, table: str, dictionary: str) -> tuple[DataFrame, DataFrame]:
    """A delimited table and its dictionary (column, entry as JSON text) from the ``data_elements`` of all schemas of a JSON file.

    Of equal names the last schema's entry counts.  A table and dictionary that both lack ``record_id`` get an entry for it.
    """
    df = delimited(spark, table)
    text = spark.read.text(dictionary, wholetext=True)
    schemas = text.select(F.from_json("value", "map<string,map<string,string>>").alias("m")).select(F.posexplode(F.map_entries("m")).alias("at", "s"))
    elements = F.from_json(F.col("s.value")["data_elements"], "map<string,string>")
    rows = schemas.select("at", F.explode(elements).alias("column", "entry")).groupBy("column").agg(F.max_by("entry", "at").alias("entry"))
    if "record_id" not in df.columns:
        known = rows.where(F.col("column") == "record_id").select("column")
        own = spark.createDataFrame([("record_id", '{"description": "Unique identifier for each participant."}')], "column string, entry string")
        rows = rows.unionByName(own.join(known, "column", "left_anti"))
    return df, rows


def metadata_rows(spark: SparkSession, root: str, schema: str, pattern: str = "*recording-metadata.json") -> DataFrame:
    """path and the fields of all JSON sidecars below a folder; files that can't be decoded are left out, none at all is an empty table."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    parsed = text.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", f"struct<{schema},_bad:string>", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.where("r is not null and r._bad is null").select("path", "r.*").drop("_bad")


def text_found(spark: SparkSession, root: str, wanted: str, pattern: str = "*.json") -> DataFrame:
    """path, in_name, in_text of files below a folder whose name or content holds the text (case counts)."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    return text.select(path.alias("path"), F.element_at(F.split(path, "/"), -1).contains(wanted).alias("in_name"), F.col("value").contains(wanted).alias("in_text")).where("in_name or in_text")


def records(df: DataFrame):
    """Rows one by one as dicts, fetched partition by partition: no more than two partitions are on the driver at once."""
    for row in df.toLocalIterator(prefetchPartitions=True):
        yield row.asDict(recursive=True)


def newest_by_uuid(files: DataFrame, pattern: str) -> DataFrame:
    """uuid, path: the last path of each uuid."""
    return files.withColumn("uuid", F.regexp_extract("path", pattern, 1)).where("uuid <> ''").groupBy("uuid").agg(F.max("path").alias("path"))


def texts_below(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """path, value of the files below a folder whose names end in ``suffix``, each as one text; hidden names (._) are left out.

    Spark's reader holds a record of each file on the driver.  Here tasks list the folders, one level after the other, and the
    lists stay in the shared folder; other tasks read the files.  Folders that Arrow doesn't open, patterns and single files go
    through Spark's reader.
    """
    where = _folder_for_arrow(spark, root)
    if where is None:
        text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").text(root, wholetext=True)
        return text.select(F.col("_metadata.file_path").alias("path"), "value")
    importable(spark)

    def listed(batches):
        fs, _ = filesystems.located(where)
        held = []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                held += filesystems.entries(fs, folder, suffix)
                while len(held) >= LISTED:
                    yield _batch(held[:LISTED], ("path", "is_folder"))
                    held = held[LISTED:]
        if held:
            yield _batch(held, ("path", "is_folder"))

    def read(batches):
        fs, _ = filesystems.located(where)
        held, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with fs.open_input_stream(path, compression=None) as handle:
                    data = handle.read()
                held.append((path, data.decode("utf-8", "replace")))
                size += len(data)
                if size >= TEXT_BYTES or len(held) >= LISTED:
                    yield _batch(held, ("path", "value"))
                    held, size = [], 0
        if held:
            yield _batch(held, ("path", "value"))

    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    folders, n, found = spark.createDataFrame([(filesystems.located(where)[1],)], "path string"), 1, None
    while n:
        level = stored(folders.repartition(min(n, most)).mapInArrow(listed, "path string, is_folder boolean"))
        folders, held = level.where("is_folder").select("path"), level.where("not is_folder").select("path")
        found, n = held if found is None else found.unionByName(held), folders.count()
    return found.repartition(most).mapInArrow(read, "path string, value string")


def _folder_for_arrow(spark: SparkSession, root: str) -> str | None:
    """A folder's whole path, as all machines know it; None if Arrow finds no folder there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    where = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    try:
        return where if filesystems.is_folder(where) else None
    except (OSError, ValueError):
        return None


def _batch(rows: list[tuple], names: Sequence[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=list(names))


RESPONSES = T.ArrayType(T.StructType([T.StructField("@type", T.StringType()), T.StructField("@id", T.StringType()), T.StructField("used", T.ArrayType(T.StringType())), T.StructField("startedAtTime", T.StringType()), T.StructField("endedAtTime", T.StringType()), T.StructField("isAbout", T.StringType()), T.StructField("value", T.StringType())]))


def survey_responses(spark: SparkSession, root: str) -> DataFrame:
    """record, session, activity, is_about, values, started, ended of all JSON-LD files <record>/<session>/*.jsonld; unreadable files are left out."""
    text = texts_below(spark, root, ".jsonld")
    parts = F.split("path", "/")
    rows = text.select(F.split(F.element_at(parts, -3), r"(\s|%20)+")[0].alias("record"), F.element_at(parts, -2).alias("session"), F.from_json("value", RESPONSES).alias("r")).where("r is not null")
    times = rows.select("*", F.get(F.filter("r", lambda x: x["@type"].endswith("ResponseActivity")), F.lit(0)).alias("a"))
    each = times.select("record", "session", "a", F.explode(F.filter("r", lambda x: x["@type"].endswith("Response"))).alias("x"))
    value = F.col("x.value")
    many = F.from_json(value, "array<string>")
    values = F.when(value.startswith("["), many).otherwise(F.array(value))
    return each.select("record", "session", F.element_at(F.coalesce("a.used", F.array(F.lit(""))), 1).alias("activity"), F.col("x.isAbout").alias("is_about"), values.alias("values"), F.col("a.startedAtTime").alias("started"), F.col("a.endedAtTime").alias("ended"))


def configuration(path: str, kind: type):
    """A JSON file that must hold a dict or a list."""
    if not Path(path).exists():
        raise FileNotFoundError(path)
    value = json.loads(Path(path).read_text())
    if not isinstance(value, kind):
        raise ValueError(f"{path} holds no {kind.__name__}")
    return value


def id_map(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(sorted(mapping.items()), "old_id string, new_id string")


def manifest(spark: SparkSession, path: str, candidates: dict[str, Sequence[str]]) -> DataFrame:
    """A manifest whose columns go by several names: the first that is there counts."""
    df = delimited(spark, path)
    found = {name: next((c for c in options if c in df.columns), None) for name, options in candidates.items()}
    return df.select(*(F.col(c).alias(n) if c else F.lit(None).cast("string").alias(n) for n, c in found.items()))
