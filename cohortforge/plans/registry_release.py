"""Registered queries over releases, validation, phenotype tables and catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import scalars as S
from cohortforge.operators import aggregates, documents, joins, nested, select
from cohortforge.plans import catalogue, dashboards, deidentify, phenotype, release, survey, validate
from cohortforge.plans.registry import query
from cohortforge.sources import sinks


def _ids(df: DataFrame, old, new) -> DataFrame:
    return df.select(old.cast("string").alias("old_id"), new.cast("string").alias("new_id")).distinct()


def _literals(t, rows, schema: str) -> DataFrame:
    return t("region").sparkSession.createDataFrame(rows, schema)


# --- releases ------------------------------------------------------------------------------------

_STEMS = """
p AS (SELECT CAST(c_custkey AS VARCHAR) AS old_id, 'n' || c_custkey AS new_id FROM customer WHERE c_custkey % 2 = 0),
q AS (SELECT CAST(o_orderkey AS VARCHAR) AS old_id, 's' || o_orderkey AS new_id FROM orders WHERE o_orderkey % 3 = 0),
x AS (SELECT 'sub-' || o_custkey || '_ses-' || o_orderkey || '_task-t' AS stem FROM orders WHERE o_orderstatus <> 'P'
  UNION SELECT 'sub-n' || o_custkey || '_ses-s' || o_orderkey || '_task-t' FROM orders WHERE o_orderstatus = 'P'
  UNION SELECT 'sub-' || c_custkey || '_note' FROM customer UNION SELECT 'plain' FROM region)"""


@query("stems_expanded", f"""
WITH {_STEMS},
s AS (SELECT stem, regexp_extract(stem, '^sub-([^_]+)(?:_ses-([^_]+))?(.*)$', 1) AS sub, nullif(regexp_extract(stem, '^sub-([^_]+)(?:_ses-([^_]+))?(.*)$', 2), '') AS ses, regexp_extract(stem, '^sub-([^_]+)(?:_ses-([^_]+))?(.*)$', 3) AS rest FROM x),
f AS (SELECT 'sub-' || coalesce(p.new_id, sub) || coalesce('_ses-' || coalesce(q.new_id, ses), '') || rest AS stem FROM s LEFT JOIN p ON p.old_id = sub LEFT JOIN q ON q.old_id = ses WHERE sub <> ''),
b AS (SELECT 'sub-' || coalesce(p.old_id, sub) || coalesce('_ses-' || coalesce(q.old_id, ses), '') || rest AS stem FROM s LEFT JOIN p ON p.new_id = sub LEFT JOIN q ON q.new_id = ses WHERE sub <> '')
SELECT stem FROM x UNION SELECT stem FROM f UNION SELECT stem FROM b""")
def _(t):
    c, o = t("customer"), t("orders")
    participants = _ids(c.where("c_custkey % 2 = 0"), F.col("c_custkey"), F.concat(F.lit("n"), "c_custkey"))
    sessions = _ids(o.where("o_orderkey % 3 = 0"), F.col("o_orderkey"), F.concat(F.lit("s"), "o_orderkey"))
    old = F.concat(F.lit("in/sub-"), "o_custkey", F.lit("_ses-"), "o_orderkey", F.lit("_task-t.wav"))
    new = F.concat(F.lit("sub-n"), "o_custkey", F.lit("_ses-s"), "o_orderkey", F.lit("_task-t"))
    stems = o.select(F.when(F.col("o_orderstatus") == "P", new).otherwise(old).alias("stem"))
    stems = stems.unionByName(c.select(F.concat(F.lit("sub-"), "c_custkey", F.lit("_note")).alias("stem"))).unionByName(t("region").select(F.lit("plain").alias("stem")))
    return release.stems_expanded(stems, participants, sessions)


@query("remap_report", """
WITH m AS (SELECT o_custkey, CASE WHEN o_custkey % 3 = 0 THEN 'x' || o_custkey END AS new_id FROM orders)
SELECT count(*) AS n, count(*) FILTER (new_id IS NULL) AS n_unchanged, count(DISTINCT o_custkey) FILTER (new_id IS NULL) AS n_unchanged_ids, count(new_id) / count(*) AS proportion,
  (SELECT string_agg(DISTINCT CAST(o_custkey AS VARCHAR), ',' ORDER BY CAST(o_custkey AS VARCHAR)) FROM m WHERE new_id IS NULL) AS ids FROM m""")
def _(t):
    mapping = _ids(t("customer").where("c_custkey % 3 = 0"), F.col("c_custkey"), F.concat(F.lit("x"), "c_custkey"))
    return release.remap_report(t("orders").select(F.col("o_custkey").cast("string").alias("id")), mapping, "id")


@query("unchanged_ids", "SELECT CAST(o_custkey AS VARCHAR) AS id, count(*) AS n FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1")
def _(t):
    mapping = _ids(t("customer").where("c_custkey % 3 = 0"), F.col("c_custkey"), F.concat(F.lit("x"), "c_custkey"))
    return release.unchanged_ids(t("orders").select(F.col("o_custkey").cast("string").alias("id")), mapping, "id")


_FILES = "'d/sub-' || l_suppkey || '/ses-' || l_orderkey || '/audio/r' || l_linenumber"


@query("recordings_unprocessed", f"""
WITH f AS (SELECT DISTINCT {_FILES} AS stem, l_linenumber % 2 AS a, l_partkey % 3 AS b FROM lineitem)
SELECT stem || '.wav' AS path, 'features' AS missing FROM f GROUP BY stem HAVING min(a) <> 0 UNION ALL SELECT stem || '.wav', 'transcription' FROM f GROUP BY stem HAVING min(b) <> 0""")
def _(t):
    stem = F.concat(F.lit("d/sub-"), "l_suppkey", F.lit("/ses-"), "l_orderkey", F.lit("/audio/r"), "l_linenumber")
    line = t("lineitem")
    wav = line.select(F.concat(stem, F.lit(".wav")).alias("path")).distinct()
    payload = line.where("l_linenumber % 2 = 0").select(F.concat(stem, F.lit("_features.pt")).alias("path"))
    text = line.where("l_partkey % 3 = 0").select(F.concat(stem, F.lit(".txt")).alias("path"))
    return release.unprocessed(wav.unionByName(payload).unionByName(text))


@query("metrics_deidentified", """
WITH m AS (SELECT o_custkey AS p, o_orderkey AS s, CASE o_orderstatus WHEN 'F' THEN 'audio-check' ELSE lower(o_orderstatus) END AS task, o_totalprice AS metric FROM orders)
SELECT 'n' || p AS participant_id, coalesce('s' || CASE WHEN s % 2 = 0 THEN s END, CAST(s AS VARCHAR)) AS session_id, task AS task_name, metric FROM m WHERE task <> 'audio-check' AND p % 10 <> 0 AND NOT (s % 5 = 0 AND task = 'o')""")
def _(t):
    task = F.when(F.col("o_orderstatus") == "F", "Audio Check").otherwise(F.lower("o_orderstatus"))
    m = t("orders").select(F.col("o_custkey").cast("string").alias("participant_id"), F.col("o_orderkey").cast("string").alias("session_id"), task.alias("task_name"), F.col("o_totalprice").alias("metric"))
    removed = t("customer").where("c_custkey % 10 = 0").select(F.col("c_custkey").cast("string").alias("participant_id"))
    stems = t("orders").where("o_orderkey % 5 = 0").select(F.concat(F.lit("sub-"), "o_custkey", F.lit("_ses-"), "o_orderkey", F.lit("_task-O_rec-1")).alias("stem"))
    participants = _ids(t("customer"), F.col("c_custkey"), F.concat(F.lit("n"), "c_custkey"))
    sessions = _ids(t("orders").where("o_orderkey % 2 = 0"), F.col("o_orderkey"), F.concat(F.lit("s"), "o_orderkey"))
    return deidentify.metrics_deidentified(m, participants, sessions, removed, stems).select("participant_id", "session_id", "task_name", "metric")


@query("features_deidentified", """
WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS participant_id, CAST(o_orderkey AS VARCHAR) AS session_id, CASE o_orderstatus WHEN 'F' THEN 'story' WHEN 'O' THEN 'free speech' ELSE 'audio check' END AS task_name, g.g AS feature_group, g.n AS feature_name, o_totalprice AS value
  FROM orders, (VALUES ('torchaudio', 'mfcc'), ('torchaudio', 'pitch'), ('ppgs', 'ppgs'), ('sparc', 'ema'), ('sparc', 'pitch')) g(g, n))
SELECT * FROM f WHERE task_name <> 'audio check' AND CAST(participant_id AS BIGINT) % 10 <> 0 AND (task_name = 'story' OR (feature_group, feature_name) IN (('torchaudio', 'pitch'), ('sparc', 'pitch')))""")
def _(t):
    groups = _literals(t, [("torchaudio", "mfcc"), ("torchaudio", "pitch"), ("ppgs", "ppgs"), ("sparc", "ema"), ("sparc", "pitch")], "feature_group string, feature_name string")
    task = F.when(F.col("o_orderstatus") == "F", "story").when(F.col("o_orderstatus") == "O", "free speech").otherwise("audio check")
    f = t("orders").select(F.col("o_custkey").cast("string").alias("participant_id"), F.col("o_orderkey").cast("string").alias("session_id"), task.alias("task_name"), F.col("o_totalprice").alias("value"))
    f = f.withColumn("g", F.explode(F.array(*(F.struct(F.lit(r[0]).alias("feature_group"), F.lit(r[1]).alias("feature_name")) for r in groups.collect())))).select("*", "g.*").drop("g")
    removed = t("customer").where("c_custkey % 10 = 0").select(F.col("c_custkey").cast("string").alias("participant_id"))
    return deidentify.features_deidentified(f, removed, _literals(t, [], "stem string"), ["story"]).select("participant_id", "session_id", "task_name", "feature_group", "feature_name", "value")


# --- validation ----------------------------------------------------------------------------------


@query("table_violations", """
WITH l AS (SELECT c_custkey, 'mktsegment' AS field, c_mktsegment AS value FROM customer UNION ALL SELECT c_custkey, 'height', CAST(c_custkey % 300 AS VARCHAR) FROM customer
  UNION ALL SELECT c_custkey, 'weight', CASE WHEN c_custkey % 7 = 0 THEN '70.5' ELSE '70' END FROM customer UNION ALL SELECT c_custkey, 'state_province', CASE WHEN c_custkey % 5 = 0 THEN 'Atlantis' ELSE ' ontario' END FROM customer)
SELECT c_custkey, field, value, 'choice' AS rule FROM l WHERE field = 'mktsegment' AND value NOT IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT c_custkey, field, value, 'range' FROM l WHERE field = 'height' AND CAST(value AS BIGINT) > 272 UNION ALL SELECT c_custkey, field, value, 'range' FROM l WHERE field = 'weight' AND value = '70.5'
UNION ALL SELECT c_custkey, field, value, 'known_value' FROM l WHERE value = 'Atlantis'""")
def _(t):
    k = F.col("c_custkey")
    df = t("customer").select("c_custkey", F.col("c_mktsegment").alias("mktsegment"), (k % 300).alias("height"), F.when(k % 7 == 0, "70.5").otherwise("70.0").alias("weight"), F.when(k % 5 == 0, "Atlantis").otherwise(" ontario").alias("state_province"), F.lit("Checked").alias("box"))
    choices = _literals(t, [("mktsegment", "BUILDING"), ("mktsegment", "MACHINERY"), ("box", "1")], "field string, label string")
    known = _literals(t, [("state_province", "Ontario"), ("ef_fluent_language_other", "German")], "field string, value string")
    return validate.table_violations(df, ["c_custkey"], choices, validate.ranges_table(df.sparkSession), known)


@query("body_measures", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN round_even(c_custkey * 0.393701, 0) ELSE CAST(c_custkey AS DOUBLE) END AS height, CASE WHEN c_custkey % 2 = 0 THEN round_even(c_nationkey * 2.20462, 0) ELSE CAST(c_nationkey AS DOUBLE) END AS weight FROM customer")
def _(t):
    df = t("customer").select("c_custkey", F.col("c_custkey").cast("double").alias("height"), F.col("c_nationkey").cast("double").alias("weight"), F.when(F.col("c_custkey") % 2 == 0, "Metric").otherwise("Imperial").alias("unit"))
    return validate.body_measures(df).drop("unit")


@query("forbidden_features", """
SELECT 'mfcc' AS feature_group, 'f,p' AS tasks FROM orders WHERE o_orderstatus IN ('F', 'P') HAVING count(*) > 0
UNION ALL SELECT 'ppgs', 'p' FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0""")
def _(t):
    o = t("orders")
    f = o.select(F.lit("mfcc").alias("feature_group"), F.col("o_orderstatus").alias("task_name")).unionByName(o.where("o_orderstatus <> 'F'").select(F.lit("ppgs").alias("feature_group"), F.col("o_orderstatus").alias("task_name")))
    return validate.forbidden_features(f, _literals(t, [("O",)], "task_name string")).withColumn("tasks", F.array_join("tasks", ","))


@query("feature_report", """
WITH r AS (SELECT o_orderkey AS k, o_custkey || '_' || o_orderkey || '_t' AS stem FROM orders)
SELECT 'no_payload' AS status, '' AS feature, count(*) AS n, min(stem) AS sample FROM r WHERE k % 5 = 0 HAVING count(*) > 0
UNION ALL SELECT 'several_payloads', '', count(*), min(stem) FROM r WHERE k % 5 = 1 HAVING count(*) > 0
UNION ALL SELECT 'missing', 'sparc.pitch', count(*), min(stem) FROM r WHERE k % 5 <> 0 HAVING count(*) > 0
UNION ALL SELECT 'nan', 'ppgs.ppgs', count(*), min(stem) FROM r WHERE k % 5 <> 0 AND k % 3 = 0 HAVING count(*) > 0""")
def _(t):
    k = F.col("o_orderkey")
    r = t("orders").select(F.col("o_custkey").cast("string").alias("participant_id"), k.cast("string").alias("session_id"), F.lit("t").alias("task_name"), k.alias("k"))
    value = F.when(k % 3 == 0, F.lit(float("nan"))).otherwise(F.lit(1.0)).cast("float")
    p = r.where("k % 5 <> 0").withColumn("o_orderkey", F.col("k")).select("participant_id", "session_id", "task_name", F.lit("ppgs").alias("feature_group"), F.lit("ppgs").alias("feature_name"), F.array(F.array(value)).alias("data"), F.when(F.col("k") % 5 == 1, 2).otherwise(1).alias("n_payloads"))
    return validate.feature_report(r.drop("k"), p, [("ppgs", "ppgs"), ("sparc", "pitch")])


@query("recordings_without_file", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(t):
    files = t("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return validate.recordings_without_file(t("orders").select("o_orderkey", "o_custkey"), files, "o_orderkey")


@query("column_report", """
WITH e AS (SELECT DISTINCT 'q' || user_id AS c, user_id AS k FROM events), m AS (SELECT 'q' || c_custkey AS c, c_nationkey = 3 AS gone FROM customer)
SELECT 'total' AS what, count(*) AS n FROM e UNION ALL SELECT 'included', count(*) FROM e JOIN m USING (c) WHERE NOT gone UNION ALL SELECT 'deleted', count(*) FROM e JOIN m USING (c) WHERE gone
UNION ALL SELECT 'only_in_table', count(*) FROM e ANTI JOIN m USING (c) UNION ALL SELECT 'only_in_mapping', count(*) FROM (SELECT * FROM m WHERE NOT gone) ANTI JOIN e USING (c)""")
def _(t):
    """A registry's columns (customers) against those that answers come under (users of events)."""
    q = lambda c: F.concat(F.lit("q"), c).alias("column")
    mapping = t("customer").select(q("c_custkey"), (F.col("c_nationkey") == 3).alias("deleted"))
    return validate.column_counts(mapping, t("events").select(q("user_id")))


# --- selection -----------------------------------------------------------------------------------


@query("empty_columns_dropped", "SELECT event_id, event_type FROM events")
def _(t):
    return select.without_empty_columns(t("events").select("event_id", "event_type", F.lit(None).cast("string").alias("never"), F.when(F.col("event_id") < 0, 1).alias("nowhere")))


@query("bare_rows_dropped", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value END AS a, CASE WHEN event_id % 4 = 0 THEN event_type END AS b FROM events WHERE event_id % 3 = 0 OR event_id % 4 = 0")
def _(t):
    df = t("events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("a"), F.when(F.col("event_id") % 4 == 0, F.col("event_type")).alias("b"))
    return select.without_bare_rows(df, ["event_id"])


@query("header_verdicts", """
WITH h AS (SELECT o_custkey AS header, o_orderpriority AS c FROM orders), k AS (SELECT header, count(*) AS n, count(*) FILTER (c LIKE '1%' OR c LIKE '2%' OR c LIKE '5%') AS coded, count(*) FILTER (c LIKE '3%' OR c LIKE '4%') AS labels FROM h GROUP BY 1)
SELECT header, CASE WHEN coded = n THEN 'ok' WHEN coded = 0 OR 2 * labels > n THEN 'error' ELSE 'warn' END AS verdict FROM k""")
def _(t):
    """A customer's orders as one header: priorities 1, 2 and 5 are coded names, 3 and 4 labels."""
    names = t("orders").select(F.col("o_orderpriority").alias("c")).distinct()
    kind = names.select("c", F.col("c").rlike("^[125]").alias("coded"), F.col("c").rlike("^[34]").alias("label"))
    return select.header_verdicts(t("orders").select(F.col("o_custkey").alias("header"), F.col("o_orderpriority").alias("c")), kind)


@query("flags_dates_literals", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS mass, CASE WHEN o_orderkey % 2 = 0 THEN date_trunc('day', o_orderdate) END AS visit_date,
  CASE o_orderstatus WHEN 'F' THEN '12' WHEN 'O' THEN 'noAnswer now' ELSE 'P' END AS level FROM orders""")
def _(t):
    s = F.col("o_orderstatus")
    df = t("orders").select("o_orderkey", F.when(s == "F", " YES ").when(s == "O", "no").alias("mass"), F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("soon").alias("visit_date"), F.when(s == "F", "none").when(s == "O", "preferNotToAnswer now").otherwise(s).alias("level"))
    df = select.dates_parsed(select.flags_as_numbers(df, ["mass", "absent"]))
    return select.literals_replaced(df, {"level": {"none": "12"}}, {"preferNotToAnswer": "noAnswer"})


@query("rows_united", """
WITH e AS (SELECT user_id AS record_id, event_type AS kind, min(event_id) AS row_id, max(CASE WHEN event_type = 'click' AND user_id % 2 = 0 THEN value END) AS a, max(CASE WHEN event_type <> 'click' OR user_id % 3 = 0 THEN value END) AS b FROM events GROUP BY 1, 2)
SELECT x.record_id, '' AS kind, least(x.row_id, y.row_id) AS row_id, coalesce(x.a, y.a) AS a, coalesce(x.b, y.b) AS b FROM e x JOIN e y ON x.record_id = y.record_id AND x.kind = 'click' AND y.kind = 'view'
UNION ALL SELECT * FROM e WHERE kind NOT IN ('click', 'view')""")
def _(t):
    v, click, u = F.col("value"), F.col("event_type") == "click", F.col("user_id")
    e = t("events").groupBy(u.alias("record_id"), F.col("event_type").alias("kind")).agg(F.min("event_id").alias("row_id"), F.max(F.when(click & (u % 2 == 0), v)).alias("a"), F.max(F.when(~click | (u % 3 == 0), v)).alias("b"))
    return joins.rows_united(e, "click", "view", kind="kind", order="row_id")


@query("import_cells", "SELECT event_id, CASE event_id % 6 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '2' WHEN 3 THEN '7' WHEN 4 THEN 'dont' ELSE 'B' END AS cell FROM events")
def _(t):
    k = F.col("event_id") % 6
    raw = F.when(k == 0, " Checked").when(k == 1, "unchecked").when(k == 2, "Consented").when(k == 3, "7.0").when(k == 4, "don't").otherwise("b")
    return t("events").select("event_id", S.import_cell(raw, {"b": "B"}).alias("cell"))


@query("names_as_labels", """
WITH w AS (SELECT p_partkey, unnest(string_split(lower(p_type), ' ')) AS w, generate_subscripts(string_split(p_type, ' '), 1) AS i FROM part)
SELECT p_partkey, string_agg(CASE WHEN i = 1 THEN w ELSE upper(w[1]) || w[2:] END, '' ORDER BY i) AS camel, string_agg(w, '_' ORDER BY i) AS slug FROM w GROUP BY 1""")
def _(t):
    return t("part").select("p_partkey", S.camel_case("p_type").alias("camel"), S.slug("p_type").alias("slug"))


@query("answers_missing", "SELECT event_id, event_id % 6 < 3 AS nothing FROM events")
def _(t):
    k = F.col("event_id") % 6
    a, b = F.when(k == 0, "Unchecked").when(k == 1, "nan").when(k == 2, "").otherwise("x"), F.when(k == 5, "y")
    return t("events").withColumns({"a": a, "b": b}).select("event_id", S.no_answer("a", "b").alias("nothing"))


@query("subject_ids", "SELECT CASE WHEN c_custkey < 1000 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') || 'JS' ELSE CAST(c_custkey AS VARCHAR) END AS record_id FROM customer WHERE c_custkey <= 99999")
def _(t):
    k = F.col("c_custkey")
    raw = F.when(k < 1000, F.concat(k.cast("string"), F.lit(" -JS"))).otherwise(k.cast("string"))
    return survey.subject_ids_cleaned(t("customer").select(raw.alias("record_id")))


@query("questionnaire_types", "SELECT DISTINCT 'q' || n_nationkey % 5 AS questionnaire FROM nation UNION SELECT DISTINCT 's' || n_nationkey % 3 FROM nation")
def _(t):
    k = F.col("n_nationkey")
    n = t("nation")
    subject = n.select(F.concat(F.lit("d/sub-"), k, F.lit("/sub-"), k, F.lit("_q"), k % 5, F.lit(".json")).alias("path"))
    session = n.select(F.concat(F.lit("d/sub-"), k, F.lit("/ses-1/beh/sub-"), k, F.lit("_ses-1_s"), k % 3, F.lit(".json")).alias("path"))
    other = n.select(F.concat(F.lit("d/sub-"), k, F.lit("/ses-1/audio/sub-"), k, F.lit("_x.json")).alias("path"))
    return survey.questionnaire_types(subject.unionByName(session).unionByName(other))


@query("response_rows", "SELECT CAST(o_custkey AS VARCHAR) AS record, CAST(o_orderkey AS VARCHAR) AS session, 'phq' AS instrument, 'q' || o_orderkey % 4 AS item, o_orderstatus AS value, 1500 AS duration_ms FROM orders")
def _(t):
    o = t("orders").select(F.col("o_custkey").cast("string").alias("record"), F.col("o_orderkey").cast("string").alias("session"), F.lit("a/b/phq").alias("activity"), F.concat(F.lit("items/q"), F.col("o_orderkey") % 4).alias("is_about"), F.array("o_orderstatus").alias("values"), F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T10:00:00.250Z")).alias("started"), F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T10:00:01.750Z")).alias("ended"))
    return survey.response_rows(o).select("record", "session", "instrument", "item", F.get("values", F.lit(0)).alias("value"), "duration_ms")


@query("sex_by_gender_named", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' WHEN 2 THEN 'Other' END AS gender_identity, CASE WHEN c_custkey % 3 <> 0 THEN CASE c_custkey % 4 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' END END AS sex_at_birth FROM customer")
def _(t):
    k = F.col("c_custkey")
    gender = F.when(k % 4 == 0, "Female").when(k % 4 == 1, "Male").when(k % 4 == 2, "Other")
    return select.sex_from_gender(t("customer").select("c_custkey", gender.alias("gender_identity"), F.when(k % 3 != 0, "given").alias("specify_gender_identity")))


# --- phenotype -----------------------------------------------------------------------------------


@query("data_elements", "SELECT p_brand AS schema, p_name AS column, coalesce(CASE WHEN p_partkey % 3 = 0 THEN p_type END, CASE WHEN p_partkey % 3 = 1 THEN p_name END, 'Question') AS description, 'Question' AS question_en FROM part")
def _(t):
    k = F.col("p_partkey")
    items = t("part").select(F.col("p_brand").alias("schema"), F.col("p_name").alias("column"), F.when(k % 3 == 0, F.col("p_type")).otherwise("").alias("mapped_description"), F.when(k % 3 == 1, F.col("p_name")).alias("description"), F.lit("Question").alias("question_en"))
    return nested.data_elements(items)


@query("checkbox_elements", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'box___' || p_partkey % 3 + 1 ELSE 'plain' END AS column, CASE WHEN p_partkey % 2 = 0 THEN 'xsd:integer' ELSE 'xsd:string' END AS datatype, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey % 3 + 1 AS VARCHAR) ELSE '1,2,3' END AS options FROM part")
def _(t):
    k = F.col("p_partkey")
    choices = F.array(*(F.struct(F.lit(str(i)).alias("value"), F.lit(f"l{i}").alias("label")) for i in (1, 2, 3)))
    e = t("part").select("p_partkey", F.when(k % 2 == 0, F.concat(F.lit("box___"), k % 3 + 1)).otherwise("plain").alias("column"), F.lit("xsd:string").alias("datatype"), choices.alias("choices"))
    return nested.checkbox_elements(e).withColumn("options", F.array_join("choices.value", ",")).drop("choices")


@query("dictionary_built", """
SELECT DISTINCT 'target' AS schema, 'c' || n_nationkey AS column, CASE n_nationkey % 3 WHEN 0 THEN 'mapped' WHEN 1 THEN n_name ELSE 'asked' END AS description, 'xsd:string' AS datatype FROM nation WHERE n_nationkey % 5 <> 4""")
def _(t):
    k = F.col("n_nationkey")
    n = t("nation")
    name = F.concat(F.lit("c"), k)
    mapping = n.select(F.lit("source").alias("schema_name_source"), name.alias("column_name_source"), F.lit("target").alias("schema_name"), name.alias("column_name"), F.when(k % 3 == 0, "mapped").alias("description"), F.when(k % 5 == 4, "yes").alias("delete"))
    elements = n.select(F.lit("source").alias("schema"), name.alias("column"), F.when(k % 3 == 1, F.col("n_name")).alias("description"), F.lit("asked").alias("question_en"), F.lit("xsd:string").alias("datatype"), F.array(F.struct(F.lit("1").alias("value"), F.lit("x").alias("label"))).alias("choices"))
    return phenotype.dictionary(mapping, elements).select("schema", "column", "description", "datatype")


@query("unique_choices", "SELECT p_partkey, CAST(v AS VARCHAR) AS value, 'a' || v AS label FROM part, (VALUES (1), (2)) x(v)")
def _(t):
    choice = lambda v, label: F.struct(F.lit(v).alias("value"), F.lit(label).alias("label"))
    df = t("part").select("p_partkey", F.array(choice("1", "a1"), choice("2", "a2"), choice("1", "later")).alias("choices"))
    return nested.unique_choices(df, ["p_partkey"])


@query("hidden_items", "SELECT 'a' || n_nationkey AS activity, 'items/h' AS item FROM nation UNION ALL SELECT 'a' || n_nationkey, 'c' FROM nation WHERE n_nationkey % 2 = 0")
def _(t):
    k = F.col("n_nationkey")
    p = t("nation").select(F.concat(F.lit("a"), k).alias("activity"), F.array(F.lit("items/s")).alias("order"), F.array(F.lit("items/s"), F.lit("items/h")).alias("properties"), F.when(k % 2 == 0, F.array(F.lit("c"))).alias("compute"))
    return phenotype.hidden_items(p)


@query("short_names", "WITH s AS (SELECT DISTINCT CASE WHEN n_regionkey < 2 THEN 'p' ELSE 'q' END || n_regionkey || '_n' || n_nationkey % 12 AS schema FROM nation), x AS (SELECT schema, regexp_replace(schema, '^[^_]*_', '') AS short FROM s) SELECT schema, CASE WHEN count(*) OVER (PARTITION BY short) > 1 THEN schema ELSE short END AS name FROM x")
def _(t):
    k = F.col("n_regionkey")
    return phenotype.short_names(t("nation").select(F.concat(F.when(k < 2, "p").otherwise("q"), k, F.lit("_n"), F.col("n_nationkey") % 12).alias("schema")))


@query("dictionary_first", "SELECT event_type AS variable, min(event_id) AS row_id FROM events GROUP BY 1")
def _(t):
    rows = t("events").select(F.concat(F.lit(" "), "event_type").alias("variable"), F.col("event_id").alias("row_id"))
    return phenotype.dictionary_first(rows, order="row_id")


@query("binary_questions", "SELECT 'a' AS question UNION ALL SELECT 'c'")
def _(t):
    s = F.col("o_orderstatus")
    df = t("orders").select(F.when(s == "F", "Yes").otherwise("No").alias("a"), s.alias("b"), F.when(s == "F", "Checked").alias("c"))
    return _literals(t, [(q,) for q in phenotype.binary_questions(df, ["a", "b", "c"])], "question string")


_PROPS = "SELECT event_id, json_extract_string(props, '$.k') AS k, event_type AS e, event_id % 3 AS r FROM events"


def _props(t):
    """Events' properties, and the same with other keys, other values and nested ones for some."""
    e = t("events").select("event_id", "props", "event_type")
    r, k = F.col("event_id") % 3, F.get_json_object("props", "$.k")
    nest = F.concat(F.lit('{"k": '), k, F.lit(', "more": {"e/f": ["'), "event_type", F.lit('", {}], "n": '), k, F.lit("}}"))
    other = F.when(r == 0, F.col("props")).when(r == 1, nest).otherwise(F.concat(F.lit('{"j": '), k, F.lit("}")))
    return e.select("event_id", F.col("props").alias("json")), e.select("event_id", other.alias("json"))


@query("key_differences", f"WITH p AS ({_PROPS}) SELECT event_id, 'more' AS name, 'b' AS only_in FROM p WHERE r = 1 UNION ALL SELECT event_id, 'k', 'a' FROM p WHERE r = 2 UNION ALL SELECT event_id, 'j', 'b' FROM p WHERE r = 2")
def _(t):
    return documents.key_differences(*_props(t), "event_id")


@query("document_differences", f"""
WITH p AS ({_PROPS}) SELECT event_id, '/more/e~1f/0' AS path, NULL AS in_a, '"' || e || '"' AS in_b FROM p WHERE r = 1 UNION ALL SELECT event_id, '/more/e~1f/1', NULL, '{{}}' FROM p WHERE r = 1
UNION ALL SELECT event_id, '/more/n', NULL, k FROM p WHERE r = 1 UNION ALL SELECT event_id, '/k', k, NULL FROM p WHERE r = 2 UNION ALL SELECT event_id, '/j', NULL, k FROM p WHERE r = 2""")
def _(t):
    return documents.differences(*_props(t), "event_id")


@query("dictionary_forms", f"""
WITH p AS ({_PROPS}), f AS (SELECT event_id, CASE r WHEN 0 THEN ['k'] WHEN 1 THEN ['k', 'more'] ELSE ['j'] END AS names, k, e, r FROM p)
SELECT event_id, array_to_string(names, chr(9)) AS header, '{{' || array_to_string(list_transform(names, lambda n: '"' || n || '":{{"description":""}}'), ',') || '}}' AS described,
  CASE r WHEN 0 THEN '{{"k":' || k || '}}' WHEN 1 THEN '{{"more":{{"e/f":["' || e || '",{{}}],"n":' || k || '}},"k":' || k || '}}' ELSE '{{}}' END AS sorted,
  CASE r WHEN 0 THEN '{{"k":"new"}}' WHEN 1 THEN '{{"k":"new","more":[1]}}' ELSE '{{"j":' || k || '}}' END AS updated FROM f""")
def _(t):
    """Headers, empty descriptions, keys in a given order and values by reference."""
    _, df = _props(t)
    reference = _literals(t, [("k", '"new"'), ("more", "[1]"), ("unused", "0")], "name string, value string")
    updated = documents.updated(df, reference, "event_id", strict=False).withColumnRenamed("json", "updated")
    order = F.array(*(F.lit(x) for x in ("more", "gone", "k")))
    forms = df.select("event_id", documents.header("json").alias("header"), documents.described(F.json_object_keys("json")).alias("described"), documents.sorted_like("json", order).alias("sorted"))
    return forms.join(updated, "event_id")


# --- catalogue and dashboards --------------------------------------------------------------------


@query("catalogue_files", "SELECT 'ns' AS id_namespace, doc_id || '.json' AS local_id, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS size_in_bytes, sha256(coalesce(text, '')) AS sha256, md5(coalesce(text, '')) AS md5, 'format:3464' AS file_format FROM documents")
def _(t):
    content = F.coalesce("text", F.lit("")).cast("binary")
    return catalogue.file_table(t("documents").select(F.concat(F.lit("d/"), "doc_id", F.lit(".json")).alias("path"), content.alias("content"), F.length(content).alias("length")), "ns")


_SAMPLES = "SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS anon_id, o_orderkey AS session_id, lower(o_orderstatus) AS task FROM orders JOIN customer ON o_custkey = c_custkey"


def _samples(t):
    ids = t("customer").select(F.col("c_custkey").cast("string").alias("participant_id"), F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("anon_id"))
    r = t("orders").select(F.col("o_custkey").cast("string").alias("participant_id"), F.col("o_orderkey").cast("string").alias("session_id"), F.concat("o_orderstatus", F.lit("-1")).alias("task_name"))
    return catalogue.biosamples(r, ids, _literals(t, [("f", "OBI:1")], "task string, term string")), ids


@query("biosample_diseases", f"SELECT anon_id || '_' || session_id || '_' || task AS biosample_local_id, 'cfde_disease_association_type:1' AS association_type, 'asthma' AS disease FROM ({_SAMPLES}) WHERE CAST(anon_id AS BIGINT) % 4 = 0")
def _(t):
    samples, ids = _samples(t)
    k = F.col("c_custkey")
    diagnoses = t("customer").select(k.cast("string").alias("participant_id"), F.lit("asthma").alias("disease"), F.when(k % 4 == 0, "Yes").when(k % 4 == 1, "No").alias("value"))
    return catalogue.biosample_diseases(samples, diagnoses, ids)


@query("files_described", f"SELECT 'sub-' || CAST(anon_id AS BIGINT) || '_ses-' || session_id || '_task-' || upper(task) || '-2.wav' AS file_local_id, anon_id || '_' || session_id || '_' || task AS biosample_local_id FROM ({_SAMPLES})")
def _(t):
    samples, ids = _samples(t)
    name = F.concat(F.lit("sub-"), "o_custkey", F.lit("_ses-"), "o_orderkey", F.lit("_task-"), "o_orderstatus", F.lit("-2.wav"))
    return catalogue.described(t("orders").select(name.alias("local_id")), samples, ids)


@query("catalogue_subjects", """
WITH a AS (SELECT user_id, event_type AS sex, min(event_id) AS seen FROM events GROUP BY 1, 2), g AS (SELECT user_id, arg_max(sex, seen) AS sex FROM a GROUP BY 1),
b AS (SELECT user_id, CASE WHEN value > 50 THEN '90 and above' ELSE 'younger' END AS age, min(event_id) AS seen FROM events GROUP BY 1, 2), h AS (SELECT user_id, CASE WHEN count(*) = 1 AND min(age) = '90 and above' THEN NULL ELSE arg_max(age, seen) END AS age FROM b GROUP BY 1)
SELECT CAST(user_id AS VARCHAR) AS participant_id, 'a' || user_id AS anon_id, sex, CAST(NULL AS VARCHAR) AS ethnicity, age FROM g JOIN h USING (user_id)""")
def _(t):
    e = t("events").select(F.col("user_id").cast("string").alias("participant_id"), F.col("event_id").alias("_row_id"), "event_type", F.when(F.col("value") > 50, "90 and above").otherwise("younger").alias("age"))
    answers = e.select("participant_id", "_row_id", F.lit("sex").alias("field"), F.col("event_type").alias("value")).unionByName(e.select("participant_id", "_row_id", F.lit("age").alias("field"), F.col("age").alias("value")))
    ids = e.select("participant_id", F.concat(F.lit("a"), "participant_id").alias("anon_id")).distinct()
    return catalogue.subjects(answers, ids)


@query("controlled_files", """
WITH r AS (SELECT 'd/' || o_orderkey AS path, CASE WHEN o_orderkey % 7 = 0 THEN 'notes.json' ELSE 'sub-' || o_custkey || '_ses-' || o_orderkey % 3 || '_task-t.wav' END AS name, o_orderkey % 7 = 0 AS other, o_custkey AS p, o_orderkey % 3 AS s FROM orders),
i AS (SELECT DISTINCT CAST(p AS VARCHAR) AS p, CAST(s AS VARCHAR) AS s FROM r WHERE NOT other AND p % 2 = 1), h AS (SELECT DISTINCT CAST(p AS VARCHAR) AS p, CAST(s AS VARCHAR) AS s, 'h' || p || '_' || s AS anon FROM r WHERE NOT other AND p % 2 = 0),
m AS (SELECT p, s, anon FROM h UNION ALL SELECT p, s, lpad(CAST((SELECT count(*) FROM h) + row_number() OVER (ORDER BY p, s) AS VARCHAR), 6, '0') FROM i),
l AS (SELECT 'proj/' || coalesce(m.anon || '_t.wav', path) AS local_id, m.anon || '_t' AS biosample_local_id FROM r LEFT JOIN m ON NOT other AND m.p = CAST(r.p AS VARCHAR) AND m.s = CAST(r.s AS VARCHAR))
SELECT DISTINCT local_id, biosample_local_id, biosample_local_id IS NOT NULL AS new_biosample FROM l""")
def _(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    name = F.when(k % 7 == 0, "notes.json").otherwise(F.concat(F.lit("sub-"), c, F.lit("_ses-"), k % 3, F.lit("_task-t.wav")))
    records = t("orders").select(F.concat(F.lit("d/"), k).alias("path"), name.alias("name"), F.lit("m").alias("md5"), F.lit(1).alias("size"))
    held = t("orders").where("o_orderkey % 7 <> 0 and o_custkey % 2 = 0").select(c.cast("string").alias("participant_id"), (k % 3).cast("string").alias("session_id")).distinct()
    ids = held.withColumn("anon_id", F.concat(F.lit("h"), "participant_id", F.lit("_"), "session_id"))
    files, _, _ = catalogue.controlled(records, ids, _literals(t, [], "local_id string"), "proj")
    return files.select("local_id", "biosample_local_id", "new_biosample")


@query("sidecar_paths", "SELECT DISTINCT 'out/sub-' || o_custkey || '/ses-' || o_orderkey || '/audio/sub-' || o_custkey || '_ses-' || o_orderkey || '_task-a-b-' || o_orderstatus || '_recording-metadata.json' AS path, '{\"task_name\":\"a b_' || o_orderstatus || '\"}' AS text FROM orders")
def _(t):
    r = t("orders").select(F.col("o_custkey").alias("participant_id"), F.col("o_orderkey").alias("session_id"), F.concat(F.lit("a b_"), "o_orderstatus").alias("task_name"))
    return sinks.sidecars(r, "out", ["task_name"])


@query("session_files", "SELECT 'out/sub-' || o_custkey || '/sessions.tsv' AS path, 'record_id' || chr(9) || 'session_id' || chr(9) || 'status' || chr(10) || string_agg(o_custkey || chr(9) || o_orderkey || chr(9) || o_orderstatus, chr(10) ORDER BY CAST(o_orderkey AS VARCHAR)) || chr(10) AS text FROM orders GROUP BY o_custkey")
def _(t):
    s = t("orders").select(F.col("o_custkey").alias("record_id"), F.col("o_orderkey").alias("session_id"), F.col("o_orderstatus").alias("status"))
    return sinks.session_files(s, "out")


@query("copy_errors", "SELECT 'PermissionError' AS kind, (SELECT count(*) FROM nation WHERE n_nationkey % 3 = 1) AS n, string_agg(path, ',' ORDER BY path) AS files FROM (SELECT 'f' || n_nationkey AS path FROM nation WHERE n_nationkey % 3 = 1 ORDER BY 1 LIMIT 5) UNION ALL SELECT 'OSError', (SELECT count(*) FROM nation WHERE n_nationkey % 3 = 2), string_agg(path, ',' ORDER BY path) FROM (SELECT 'f' || n_nationkey AS path FROM nation WHERE n_nationkey % 3 = 2 ORDER BY 1 LIMIT 5)")
def _(t):
    k = F.col("n_nationkey")
    done = t("nation").select(F.concat(F.lit("f"), k).alias("source"), F.when(k % 3 == 1, "PermissionError: no").when(k % 3 == 2, "OSError: full").alias("error"))
    return sinks.error_summary(done).withColumn("files", F.array_join("files", ","))


@query("recordings_loaded", "SELECT o_orderkey AS recording_id, max(CASE WHEN l_returnflag = 'R' THEN 'd/' || l_linenumber || '.wav' END) AS path, max(CASE WHEN l_returnflag = 'R' THEN 1 END) IS NULL AS missing FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 2 = 0 GROUP BY 1")
def _(t):
    recordings = t("orders").select(F.col("o_orderkey").alias("recording_id"))
    files = t("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("recording_id"), F.concat(F.lit("d/"), "l_linenumber", F.lit(".wav")).alias("path"))
    return dashboards.recordings_loaded(recordings, files, recordings.where("recording_id % 2 = 0"))


@query("questionnaire_loaded", "SELECT CAST(c_custkey AS VARCHAR) AS participant_id, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS q1, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS q2 FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def _(t):
    k = F.col("c_custkey")
    df = t("customer").select(k.cast("string").alias("participant_id"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("q1"), F.when(k % 3 == 0, F.col("c_name")).alias("q2"), F.lit("z").alias("other"))
    return dashboards.questionnaire(df, ["q1", "q2", "absent"])


@query("race_counts", "SELECT 'click' AS race, count(*) AS n FROM events WHERE event_type = 'click' HAVING count(*) > 0 UNION ALL SELECT 'view', count(*) FROM events WHERE event_type = 'view' HAVING count(*) > 0")
def _(t):
    e = F.col("event_type")
    return dashboards.races(t("events").select(F.when(e == "click", e).alias("race___1"), F.when(e == "view", e).alias("race___2"), F.lit(None).cast("string").alias("race___3")))


@query("auto_bins", "WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 30)), 29) AS BIGINT) AS bin, count(*) AS n FROM orders, s GROUP BY 1")
def _(t):
    return aggregates.auto_bins(t("orders"), "o_totalprice")


@query("files_by_size", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(t):
    """Ascending by size; a range-partitioned sort."""
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity").orderBy("l_quantity", "l_orderkey", "l_linenumber")


@query("rows_shuffled", "SELECT o_orderkey FROM orders")
def _(t):
    """All rows in random order, the same for the same seed and input."""
    return t("orders").select("o_orderkey").orderBy(F.xxhash64("o_orderkey", F.lit(42)))


@query("reference_order", "SELECT c_name, c_custkey, c_acctbal FROM customer")
def _(t):
    """Columns as a reference orders them, rows by their original position."""
    return select.project_present(t("customer"), ["c_name", "absent", "c_custkey", "c_acctbal"]).orderBy("c_custkey")
