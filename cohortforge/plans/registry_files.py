"""Registered queries that write files to the shared folder and read them back: scans, inventories, releases, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.operators import aggregates
from cohortforge.operators.tables import own_folder
from cohortforge.plans import catalogue, release, survey, validate
from cohortforge.plans.registry import query
from cohortforge.plans.workers import importable
from cohortforge.sources import files, sinks
from cohortforge.streaming import incremental


def _folder(t) -> tuple:
    spark = t("region").sparkSession
    importable(spark)
    return spark, own_folder(spark)


def _text(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))


# --- delimited tables ----------------------------------------------------------------------------


@query("delimited_scanned", "SELECT CAST(c_custkey AS VARCHAR) AS record_id, c_name, CASE WHEN c_nationkey % 3 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS site, 'a \"quoted\"' || chr(9) || 'cell' AS note FROM customer")
def _(t):
    """Participants written as tab-separated text, with missing values in words, and scanned as strings."""
    spark, root = _folder(t)
    site = F.when(F.col("c_nationkey") % 3 == 0, "NaN").otherwise(F.col("c_nationkey").cast("string"))
    df = t("customer").select(F.col("c_custkey").cast("string").alias("record_id"), "c_name", site.alias("site"), F.lit('a "quoted"\tcell').alias("note"))
    df.write.options(header=True, sep="\t", escape='"').csv(f"{root}/t.tsv")
    return files.delimited(spark, f"{root}/t.tsv")


@query("repeat_instruments_scanned", "SELECT coalesce(CASE WHEN event_type <> 'click' THEN event_type END, 'Participant') AS redcap_repeat_instrument, count(*) AS n, count(DISTINCT user_id) AS records FROM events GROUP BY 1")
def _(t):
    """An export in which some rows have no instrument."""
    spark, root = _folder(t)
    kind = F.when(F.col("event_type") != "click", F.col("event_type"))
    t("events").select(F.col("user_id").alias("record_id"), kind.alias("redcap_repeat_instrument"), "value").write.option("header", True).csv(f"{root}/export.csv")
    return files.repeat_instrument(spark, f"{root}/export.csv").groupBy("redcap_repeat_instrument").agg(F.count("*").alias("n"), F.count_distinct("record_id").alias("records"))


@query("typed_scan", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price, CAST(o_orderdate AS DATE) AS day FROM orders")
def _(t):
    """Texts cast as a dictionary says; what doesn't fit becomes null."""
    price = F.when(F.col("o_orderkey") % 5 == 0, "about ten").otherwise(F.col("o_totalprice").cast("string"))
    rows = t("orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), price.alias("price"), F.col("o_orderdate").cast("date").cast("string").alias("day"))
    return files.typed(rows, {"o_orderkey": "long", "price": "double", "day": "date"})


@query("participants_scanned", "SELECT CAST(c_custkey AS VARCHAR) AS participant_id, c_mktsegment FROM customer")
def _(t):
    """A participants table whose id goes by its older name, in one file."""
    spark, root = _folder(t)
    sinks.single_file(t("customer").select(F.col("c_custkey").alias("record_id"), "c_mktsegment"), f"{root}/participants.tsv")
    return files.participants(spark, f"{root}/participants.tsv")


@query("manifest_scanned", "SELECT 'd/' || doc_id AS path, md5(coalesce(text, '')) AS md5, CAST(NULL AS VARCHAR) AS size FROM documents")
def _(t):
    """A manifest whose columns go by other names."""
    spark, root = _folder(t)
    t("documents").select(F.concat(F.lit("d/"), "doc_id").alias("File Path"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("checksum")).write.options(header=True, sep="\t").csv(f"{root}/m.tsv")
    return files.manifest(spark, f"{root}/m.tsv", {"path": ["path", "File Path"], "md5": ["checksum", "md5"], "size": ["size"]})


@query("phenotype_pair_scanned", """
SELECT 'c_name' AS "column", 'name' AS description, count(*) AS n, count(*) AS filled FROM customer UNION ALL SELECT 'c_nationkey', 'site', count(*), count(*) FILTER (c_nationkey % 2 = 0) FROM customer""")
def _(t):
    """A table and its dictionary as files; each described column with its filled cells."""
    spark, root = _folder(t)
    site = F.when(F.col("c_nationkey") % 2 == 0, F.col("c_nationkey").cast("string"))
    t("customer").select(F.col("c_custkey").alias("record_id"), "c_name", site.alias("c_nationkey")).write.options(header=True, sep="\t").csv(f"{root}/p.tsv")
    elements = spark.createDataFrame([("c_name", "name"), ("c_nationkey", "site")], "column string, description string")
    text = sinks.dictionary_json(spark, elements, f"{root}/raw")
    spark.createDataFrame([(f'{{"schema": {text}}}',)], "value string").write.text(f"{root}/p.json")
    df, entries = files.phenotype_pair(spark, f"{root}/p.tsv", f"{root}/p.json")
    filled = df.agg(*(F.count(c).alias(c) for c in ("c_name", "c_nationkey")), F.count("*").alias("n")).unpivot(["n"], ["c_name", "c_nationkey"], "column", "filled")
    return entries.select("column", F.get_json_object("entry", "$.description").alias("description")).join(filled, "column")


# --- files ---------------------------------------------------------------------------------------


def _tree(t) -> tuple:
    """A small JSON file for each supplier, in a folder of its session, named by a uuid."""
    spark, root = _folder(t)
    k = F.col("s_suppkey").cast("string")
    uuid = F.concat(F.lpad(F.hex("s_suppkey"), 8, "0"), F.lit("-0000-4000-8000-000000000000"))
    folder = F.concat(F.lit(f"{root}/sub-"), k, F.lit("/ses-s"), F.col("s_nationkey"), F.lit("/audio/sub-"), k, F.lit("_ses-s"), F.col("s_nationkey"), F.lit("_task-t-"), uuid)
    text = F.when(F.col("s_suppkey") % 5 == 0, "{broken").otherwise(F.to_json(F.struct(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))))
    rows = t("supplier").select(F.concat(folder, F.lit("_recording-metadata.json")).alias("path"), text.alias("text"))
    sinks.failed_raise(sinks.texts_written(rows))
    return spark, root


@query("files_inventoried", "SELECT CAST(s_suppkey AS VARCHAR) AS participant_id, 's' || s_nationkey AS session_id, lower(lpad(printf('%X', s_suppkey), 8, '0')) || '-0000-4000-8000-000000000000' AS uuid FROM supplier")
def _(t):
    """Files found with the entities of their paths, and by the uuid in their names."""
    spark, root = _tree(t)
    held = files.inventory(spark, root, "*.json")
    pattern = r"([0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})"
    return files.newest_by_uuid(held, pattern).join(held, "path").select("participant_id", "session_id", F.lower("uuid").alias("uuid"))


@query("metadata_scanned", "SELECT s_name AS name, s_acctbal AS balance FROM supplier WHERE s_suppkey % 5 <> 0")
def _(t):
    """Sidecars read with a schema; files that can't be decoded are left out."""
    spark, root = _tree(t)
    return files.metadata_rows(spark, root, "name string, balance double").select("name", "balance")


@query("text_in_files", "SELECT CAST(s_suppkey AS VARCHAR) AS participant_id, contains(CAST(s_suppkey AS VARCHAR), '7') OR contains('s' || s_nationkey, '7') OR contains(printf('%X', s_suppkey), '7') AS in_name, CASE WHEN s_suppkey % 5 = 0 THEN FALSE ELSE contains(s_name, '7') OR contains(CAST(s_acctbal AS VARCHAR), '7') END AS in_text FROM supplier WHERE in_name OR in_text")
def _(t):
    spark, root = _tree(t)
    return files.text_found(spark, root, "7").select(F.regexp_extract("path", r"/sub-([^/]+)/", 1).alias("participant_id"), "in_name", "in_text")


@query("files_copied", "SELECT CAST(s_suppkey AS VARCHAR) AS participant_id, CASE WHEN s_suppkey % 7 = 0 THEN 'FileNotFoundError' END AS kind, CASE WHEN s_suppkey % 7 <> 0 AND s_suppkey % 5 = 0 THEN sha256('{broken') END AS sha256 FROM supplier")
def _(t):
    """Files copied whole under de-identified names, some of which aren't there."""
    spark, root = _tree(t)
    out = own_folder(spark)
    held = files.inventory(spark, root, "*.json")
    gone = F.col("participant_id").cast("long") % 7 == 0
    pairs = held.select(F.when(gone, F.concat("path", F.lit(".none"))).otherwise(F.col("path")).alias("source"), F.concat(F.lit(f"{out}/n"), "participant_id", F.lit(".json")).alias("target"))
    done = sinks.copies(pairs).withColumn("participant_id", F.regexp_extract("target", r"/n(\d+)\.json$", 1))
    broken = F.col("participant_id").cast("long") % 5 == 0
    return done.select("participant_id", F.nullif(F.regexp_extract("error", "^([^:]*)", 1), F.lit("")).alias("kind"), F.when(broken, F.col("sha256")).alias("sha256"))


@query("survey_scanned", """
SELECT CAST(conv_id AS VARCHAR) AS record, 's' || turn AS session, role AS item, CASE WHEN turn % 2 = 0 THEN coalesce(text, '') ELSE 'a;b' END AS answer, CAST(turn * 1000 + 250 AS BIGINT) AS duration_ms FROM conversations""")
def _(t):
    """Responses as JSON-LD files of a folder for each record and session."""
    spark, root = _folder(t)
    start = F.lit("2024-01-01T00:00:00.000Z")
    end = F.date_format(F.timestamp_millis(F.lit(1704067200000) + F.col("turn") * 1000 + 250), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    value = F.when(F.col("turn") % 2 == 0, F.to_json(F.array(F.coalesce("text", F.lit(""))))).otherwise('["a","b"]')
    one = F.when(F.col("turn") % 4 == 0, F.expr("substring(_v, 2, length(_v) - 2)")).otherwise(F.col("_v"))
    activity = F.concat(F.lit('{"@type":"reproschema:ResponseActivity","used":["x/items/act"],"startedAtTime":"'), start, F.lit('","endedAtTime":"'), end, F.lit('"}'))
    response = F.concat(F.lit('{"@type":"reproschema:Response","isAbout":"x/items/'), "role", F.lit('","value":'), one, F.lit("}"))
    rows = t("conversations").withColumn("_v", value).select(F.concat(F.lit(f"{root}/"), "conv_id", F.lit("/s"), "turn", F.lit("/"), "role", F.lit(".jsonld")).alias("path"), F.concat(F.lit("["), activity, F.lit(","), response, F.lit("]")).alias("text"))
    sinks.failed_raise(sinks.texts_written(rows))
    done = survey.response_rows(files.survey_responses(spark, root))
    return done.select("record", "session", "item", F.array_join("values", ";").alias("answer"), "duration_ms")


# --- sinks ---------------------------------------------------------------------------------------


@query("appended_and_reported", "SELECT o_orderstatus AS status, 2 * count(*) AS n FROM orders GROUP BY 1")
def _(t):
    """Rows appended twice, their counts written as JSON."""
    spark, root = _folder(t)
    for _ in range(2):
        sinks.appended(t("orders").select("o_orderkey", F.col("o_orderstatus").alias("status")), f"{root}/t")
    sinks.json_report(spark.read.parquet(f"{root}/t").groupBy("status").agg(F.count("*").alias("n")), f"{root}/r")
    return spark.read.schema("status string, n long").json(f"{root}/r")


@query("release_written", """
SELECT 'phenotype/customers' AS part, count(*) AS n FROM customer WHERE c_nationkey <> 5
UNION ALL SELECT 'features/prices', count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey <> 5 AND o_orderstatus <> 'P'""")
def _(t):
    """A release of a table and features, written once; rows of each part."""
    spark, root = _folder(t)
    c, o = t("customer"), t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    ids = c.select(F.col("c_custkey").cast("string").alias("old_id"), F.concat(F.lit("n"), "c_custkey").alias("new_id"))
    sessions = t("orders").select(F.col("o_orderkey").cast("string").alias("old_id"), F.concat(F.lit("s"), "o_orderkey").alias("new_id"))
    removed = c.where("c_nationkey = 5").select(F.col("c_custkey").cast("string").alias("participant_id"))
    task = F.when(F.col("o_orderstatus") == "P", "audio-check").otherwise("t")
    prices = o.select(F.col("c_custkey").cast("string").alias("participant_id"), F.col("o_orderkey").cast("string").alias("session_id"), task.alias("task_name"), F.lit("opensmile").alias("feature_group"), F.lit("f0").alias("feature_name"), "o_totalprice")
    none = c.limit(0).select(F.lit("").alias("stem"))
    table = c.select(F.col("c_custkey").cast("string").alias("record_id"), "c_name", "c_mktsegment")
    n = release.released(spark, f"{root}/release", {"customers": table}, {"prices": prices}, None, ids, sessions, removed, none, private=["c_name"])
    return spark.createDataFrame(sorted(n.items()), "part string, n long")


# --- streams -------------------------------------------------------------------------------------


@query("streamed_once", "SELECT CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS trigger, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1, 2")
def _(t):
    """Orders that arrive in two parts; each trigger writes what is new, and a third finds nothing."""
    spark, root = _folder(t)
    rows = t("orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    for part in (1, 0, None):
        if part is not None:
            rows.where(F.col("o_orderkey") % 2 == part).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        incremental.written_once(stream, lambda df: df.groupBy("status").agg(F.count("*").alias("n")), f"{root}/out", f"{root}/check").awaitTermination()
    done = spark.read.parquet(f"{root}/out")
    return done.select(F.col("batch").cast("int").alias("trigger"), "status", "n")


@query("ids_grown", """
WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS id, min(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END) AS arrived FROM orders GROUP BY 1)
SELECT id AS participant_id, CASE WHEN length(CAST(row_number() OVER (ORDER BY arrived, id) AS VARCHAR)) < 6 THEN lpad(CAST(row_number() OVER (ORDER BY arrived, id) AS VARCHAR), 6, '0') ELSE CAST(row_number() OVER (ORDER BY arrived, id) AS VARCHAR) END AS anon_id FROM f""")
def _(t):
    """Customers numbered when they first order, over two triggers."""
    spark, root = _folder(t)
    rows = t("orders").select(F.col("o_custkey").cast("string").alias("participant_id"), "o_orderstatus")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    for part in (rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus <> 'F'")):
        part.write.mode("append").parquet(f"{root}/in")
        incremental.growing_ids(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), f"{root}/ids", f"{root}/check").awaitTermination()
    if before:
        spark.conf.set(provider, before)
    return spark.read.parquet(f"{root}/ids").drop("batch")


# --- checks --------------------------------------------------------------------------------------


@query("field_validation", """
WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_returnflag' AS field, l_returnflag AS value, 'choice' AS rule FROM c WHERE l_returnflag = 'N'
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_quantity', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), 'range' FROM c WHERE l_quantity > 40""")
def _(t):
    """A table's cells against its choices and ranges."""
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    spark = t("region").sparkSession
    df = t("lineitem").select(*ids, "l_returnflag", F.col("l_quantity").cast("long").alias("l_quantity"))
    choices = spark.createDataFrame([("l_returnflag", "A"), ("l_returnflag", "R")], "field string, label string")
    return validate.violations(df, ids, choices, spark.createDataFrame([("l_quantity", 0, 40)], "field string, least int, most int"))


@query("offending_keys", "SELECT CAST(c_nationkey AS VARCHAR) AS key, count(*) AS n, 'not unique' AS problem FROM customer WHERE c_nationkey % 2 = 0 GROUP BY 1 HAVING count(*) > 1")
def _(t):
    """What a key that should be unique holds more than once; nulls don't count."""
    return aggregates.offenders(t("customer").select(F.when(F.col("c_nationkey") % 2 == 0, F.col("c_nationkey").cast("string")).alias("key")), "key")


@query("subject_codes", """
SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN 'cfde_subject_ethnicity:1' WHEN 1 THEN 'cfde_subject_ethnicity:0' ELSE '' END AS ethnicity,
  CASE c_nationkey % 4 WHEN 0 THEN 'cfde_subject_sex:1' WHEN 1 THEN 'cfde_subject_sex:2' ELSE 'cfde_subject_sex:0' END AS sex, CASE c_nationkey % 2 WHEN 0 THEN 'DOID:2030' END AS disease FROM customer""")
def _(t):
    """Answers as the codes of a catalogue."""
    k = F.col("c_nationkey")
    ethnicity = F.when(k % 3 == 0, "Not Hispanic or Latino").when(k % 3 == 1, "Hispanic or Latino").otherwise("Prefer not to answer")
    sex = F.when(k % 4 == 0, "Female gender identity").when(k % 4 == 1, "Male gender identity").otherwise("Other")
    df = t("customer").select("c_custkey", ethnicity.alias("ethnicity"), sex.alias("sex"), F.when(k % 2 == 0, "anxiety").otherwise("laryngeal_unknown").alias("disease"))
    return df.select("c_custkey", catalogue.coded("ethnicity", "ethnicity").alias("ethnicity"), catalogue.coded("sex", "paediatric_sex").alias("sex"), catalogue.coded("disease", "disease").alias("disease"))
