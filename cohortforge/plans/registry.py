"""Registered queries by name, each with its DuckDB twin where SQL can express it.

The operators run over the driver's tables in these roles: customer = participant, orders = session,
lineitem = recording, part = task, nation and region = site, events = repeat-instrument rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortforge.functions import scalars as S
from cohortforge.functions import tensors as T
from cohortforge.operators import aggregates, joins, nested, select, windows
from cohortforge.plans import catalogue, deidentify, features, survey, validate
from cohortforge.sources import sinks
from cohortforge.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
KEY = b"a fixed key for tests, never for data"


def query(name: str, sql: str | None = None):
    def add(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return function

    return add


def participants(t) -> DataFrame:
    return t("customer").select(F.col("c_custkey").cast("string").alias("participant_id"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


# --- selection -----------------------------------------------------------------------------------


@query("instrument_select", "SELECT event_id, user_id, value, CAST(NULL AS VARCHAR) AS absent FROM events WHERE event_type = 'click'")
def _(t):
    return select.select_instrument(t("events"), "click", ["event_id", "user_id", "value", "absent"], "event_type")


@query("recordings_for_task", """
SELECT o_orderkey AS recording_id, coalesce(n.n_name, CAST(o_custkey AS VARCHAR)) AS participant_id,
  trim(regexp_replace(lower(trim(o_orderpriority)), '[^a-z0-9]+', '-', 'g'), '-') AS task_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation n ON o_custkey = n.n_nationkey
WHERE o_orderpriority = '1-URGENT' AND c_nationkey <> 3""")
def _(t):
    recordings = t("orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("participant_id"), F.col("o_orderpriority").alias("recording_acoustic_task_id"))
    tasks = t("orders").select(F.col("o_orderpriority").alias("acoustic_task_id"), F.col("o_orderpriority").alias("acoustic_task_name")).distinct()
    of_task = joins.recordings_of_task(recordings, tasks, "1-URGENT")
    removed = participants(t).where("c_nationkey = 3")
    kept = joins.excluded(of_task, removed, "participant_id").join(participants(t).select("participant_id", "c_mktsegment"), "participant_id")
    ids = t("nation").select(F.col("n_nationkey").cast("string").alias("old_id"), F.col("n_name").alias("new_id"))
    named = joins.remapped(kept, ids, "participant_id")
    return named.select(F.col("o_orderkey").alias("recording_id"), "participant_id", S.normalize_label("acoustic_task_name").alias("task_name"), "c_mktsegment").orderBy("participant_id", "recording_id")


@query("rename_and_project", "SELECT c_custkey AS participant_id, c_name AS name FROM customer WHERE c_acctbal > 0")
def _(t):
    df = select.renamed(t("customer").where("c_acctbal > 0"), {"c_custkey": "participant_id", "c_name": "name"})
    return select.project_present(df, ["participant_id", "name", "not_there"])


@query("blank_rows", "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS a, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_mktsegment END AS b FROM customer WHERE NOT (c_custkey % 3 = 0 AND c_custkey % 2 = 0)")
def _(t):
    df = t("customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("a"), F.when(F.col("c_custkey") % 2 != 0, F.col("c_mktsegment")).alias("b"))
    return select.without_blank_rows(df, ["id"])


def _boxes(t):
    c = F.col("l_linenumber")
    return t("lineitem").select("l_orderkey", "l_linenumber", F.when(c % 2 == 0, "Checked").otherwise("Unchecked").alias("q___a_b"), F.when(c % 3 == 0, "Checked").otherwise("Unchecked").alias("q___c"), F.when(c % 5 == 0, "x").alias("q___other"))


@query("checkbox_collapse", "SELECT l_orderkey, l_linenumber, concat_ws(', ', CASE WHEN l_linenumber % 2 = 0 THEN 'a b' END, CASE WHEN l_linenumber % 3 = 0 THEN 'c' END) AS q FROM lineitem")
def _(t):
    return select.checkboxes_collapsed(_boxes(t), "q")


@query("checkbox_binarise", "SELECT l_orderkey, l_linenumber, CAST(1 AS TINYINT) AS q___a_b, CAST(1 AS TINYINT) AS q___c, CASE WHEN l_linenumber % 5 = 0 THEN CAST(1 AS TINYINT) END AS q___other FROM lineitem")
def _(t):
    return select.checkboxes_binary(_boxes(t))


@query("one_hot_merge", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'x' WHEN c_custkey % 2 = 0 THEN 'y' END AS race FROM customer")
def _(t):
    k = F.col("c_custkey")
    return select.one_hot_merged(t("customer").select("c_custkey", F.when(k % 3 == 0, "x").alias("race___1"), F.when(k % 2 == 0, "y").alias("race___2")), "race")


@query("sex_from_gender", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Female gender' ELSE 'Male gender' END AS gender_identity, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS sex_at_birth FROM customer")
def _(t):
    k = F.col("c_custkey")
    df = t("customer").select("c_custkey", F.when(k % 2 == 0, "Female gender").otherwise("Male gender").alias("gender_identity"), F.when(k % 3 != 0, "x").alias("specify_gender_identity"))
    return deidentify.phenotype_cleaned(df)


@query("rows_slice", "SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) WHERE n > 100 AND n <= 200")
def _(t):
    return select.rows_between(t("orders").select("o_orderkey", "o_totalprice"), 100, 200, "o_orderkey")


# --- joins ---------------------------------------------------------------------------------------


@query("anti_join_removal", "SELECT c_custkey, nullif(c_nationkey, 7) AS site FROM customer WHERE nullif(c_nationkey, 7) IS NULL OR c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def _(t):
    df = t("customer").select("c_custkey", F.nullif("c_nationkey", F.lit(7)).alias("site"))
    return joins.excluded(df, t("nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("site")), "site")


@query("semi_join_include", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 10)")
def _(t):
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.included(lines, t("part").where("p_size < 10").select(F.col("p_partkey").alias("l_partkey")), "l_partkey")


@query("label_include", "SELECT p_partkey, p_type FROM part WHERE trim(regexp_replace(lower(trim(p_type)), '[^a-z0-9]+', '-', 'g'), '-') LIKE '%' || (SELECT trim(regexp_replace(lower(min(p_type)), '[^a-z0-9]+', '-', 'g'), '-') FROM part) || '%'")
def _(t):
    part = t("part").select("p_partkey", "p_type")
    return joins.label_matches(part, part.agg(F.min("p_type").alias("label")), "p_type")


@query("prefix_join", "SELECT s_suppkey, n_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey AND starts_with(s_name, 'Supplier#' || CAST(n_regionkey AS VARCHAR))")
def _(t):
    right = t("nation").select("n_nationkey", F.col("n_nationkey").alias("k"), F.concat(F.lit("Supplier#"), "n_regionkey").alias("prefix"))
    left = t("supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("k"))
    return joins.prefix_join(left, right, "s_name", "prefix", "k").select("s_suppkey", "n_nationkey")


@query("id_remap_coalesce", "SELECT o_orderkey, coalesce(n_name, CAST(o_custkey AS VARCHAR)) AS participant_id FROM orders LEFT JOIN nation ON o_custkey = n_nationkey")
def _(t):
    df = t("orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("participant_id"))
    return joins.remapped(df, t("nation").select(F.col("n_nationkey").cast("string").alias("old_id"), F.col("n_name").alias("new_id")), "participant_id")


@query("entity_hierarchy", "SELECT c_custkey AS record_id, count(DISTINCT o_orderkey) AS n_sessions, count(DISTINCT CASE WHEN l_orderkey IS NOT NULL THEN l_orderkey || '-' || l_linenumber || l_returnflag END) AS n_recordings FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def _(t):
    sessions = t("orders").select(F.col("o_custkey").alias("record_id"), F.col("o_orderkey").alias("session_id"))
    tasks = t("lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("acoustic_task_id"), F.col("l_orderkey").alias("acoustic_task_session_id"), F.col("l_returnflag").alias("acoustic_task_name"))
    recordings = t("lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("recording_acoustic_task_id"), F.col("l_linenumber").alias("recording_id")).distinct()
    tree = joins.hierarchy(t("customer").select(F.col("c_custkey").alias("record_id")), sessions, tasks.distinct(), recordings)
    n = F.aggregate("sessions", F.lit(0), lambda s, x: s + F.aggregate(x["tasks"], F.lit(0), lambda a, y: a + F.size(y["recordings"])))
    return tree.select("record_id", F.size("sessions").cast("long").alias("n_sessions"), n.cast("long").alias("n_recordings"))


@query("full_outer_diff", """
WITH a AS (SELECT o_orderkey AS path, md5(o_orderstatus) AS md5 FROM orders WHERE o_orderstatus <> 'P'),
b AS (SELECT o_orderkey AS path, CASE WHEN o_orderkey % 6 = 0 THEN '' WHEN o_orderkey % 4 = 0 THEN 'other' ELSE md5(o_orderstatus) END AS md5 FROM orders WHERE o_orderpriority <> '1-URGENT')
SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'only_local' WHEN a.path IS NULL THEN 'only_remote' WHEN b.md5 <> '' AND a.md5 <> b.md5 THEN 'changed' ELSE 'same' END AS status
FROM a FULL JOIN b ON a.path = b.path""")
def _(t):
    o = t("orders")
    k = F.col("o_orderkey")
    a = o.where("o_orderstatus <> 'P'").select(k.alias("path"), F.md5("o_orderstatus").alias("md5"))
    b = o.where("o_orderpriority <> '1-URGENT'").select(k.alias("path"), F.when(k % 6 == 0, "").when(k % 4 == 0, "other").otherwise(F.md5("o_orderstatus")).alias("md5"))
    return joins.listings_compared(a, b)


@query("path_reconstruct", """
SELECT 'r' || r_regionkey AS id, r_name AS path FROM region
UNION ALL SELECT 'n' || n_nationkey, r_name || '/' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 's' || s_suppkey, r_name || '/' || n_name || '/' || s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    r = t("region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent"))
    n = t("nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("name"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    s = t("supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_name").alias("name"), F.concat(F.lit("n"), "s_nationkey").alias("parent"))
    return joins.full_paths(aggregates.union_all([r, n, s]))


# --- scalars -------------------------------------------------------------------------------------


@query("normalize_label", "SELECT p_partkey, trim(regexp_replace(lower(trim(p_type)), '[^a-z0-9]+', '-', 'g'), '-') AS label, regexp_replace(regexp_replace(lower(p_brand || ' (' || p_type || ')-12-3'), '(-[0-9]+)+$', ''), ' ', '-', 'g') AS task FROM part")
def _(t):
    raw = F.concat("p_brand", F.lit(" ("), "p_type", F.lit(")-12-3"))
    return t("part").select("p_partkey", S.normalize_label("p_type").alias("label"), F.replace(F.lower(S.strip_counters(raw)), F.lit(" "), F.lit("-")).alias("task"))


@query("path_entities", "SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR) AS participant, CAST(l_orderkey AS VARCHAR) AS session, lower(l_returnflag) || '-' || l_linenumber AS task, 'wav' AS extension FROM lineitem")
def _(t):
    name = F.concat(F.lit("sub-"), "l_suppkey", F.lit("_ses-"), "l_orderkey", F.lit("_task-"), F.lower("l_returnflag"), F.lit("-"), "l_linenumber", F.lit(".wav"))
    df = t("lineitem").withColumn("path", F.concat(F.lit("/data/sub-"), "l_suppkey", F.lit("/ses-"), "l_orderkey", F.lit("/audio/"), name)).withColumn("p", S.recording_parts(name))
    return df.select("l_orderkey", "l_linenumber", S.path_entity("path", "sub").alias("participant"), S.path_entity("path", "ses").alias("session"), F.col("p.task").alias("task"), F.col("p.extension").alias("extension"))


@query("id_shorten_collision", """
WITH d AS (SELECT DISTINCT md5(CAST(o_custkey AS VARCHAR)) AS id FROM orders), s AS (SELECT id, substr(id, 1, 3) AS a, count(*) OVER (PARTITION BY substr(id, 1, 3)) AS n FROM d)
SELECT id, CASE WHEN n > 1 THEN substr(id, 1, 16) ELSE a END AS short_id FROM s""")
def _(t):
    ids = t("orders").select(F.md5(F.col("o_custkey").cast("string").cast("binary")).alias("id")).distinct()
    clash = F.count(F.lit(1)).over(Window.partitionBy(S.reduce_id("id", 3))) > 1
    return ids.select("id", F.when(clash, S.reduce_id("id", 16)).otherwise(S.reduce_id("id", 3)).alias("short_id"))


@query("session_ids_shortened", "SELECT DISTINCT md5(CAST(o_orderkey AS VARCHAR)) AS session_id, substr(md5(CAST(o_orderkey AS VARCHAR)), 1, CASE WHEN count(*) OVER (PARTITION BY substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) > 1 THEN 16 ELSE 8 END) AS short_id FROM orders")
def _(t):
    return windows.shortened_ids(t("orders").select(F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("session_id")), "session_id")


_PADDED = KEY.ljust(64, b"\0")
_INNER, _OUTER = (bytes(b ^ x for b in _PADDED).hex() for x in (0x36, 0x5C))


@query("hmac_pseudonym", f"""
WITH h AS (SELECT c_custkey, sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || encode(CAST(c_custkey AS VARCHAR))))) AS h FROM customer)
SELECT c_custkey, lpad(CAST(CAST('0x' || substr(h, 1, 12) AS BIGINT) % 1000000 AS VARCHAR), 6, '0') AS pseudonym FROM h""")
def _(t):
    return t("customer").select("c_custkey", S.pseudonym(F.col("c_custkey").cast("string"), KEY).alias("pseudonym"))


def _pseudonym_sql(rounds: int = 8) -> str:
    """Rounds of proposals: each number goes to the first id that wants it, the others try their next candidate."""

    def number(text: str) -> str:
        digest = f"sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || encode({text}))))"
        return f"lpad(CAST(CAST('0x' || substr({digest}, 1, 12) AS BIGINT) % 1000000 AS VARCHAR), 6, '0')"

    steps = [f"r0 AS MATERIALIZED (SELECT id, 0 AS tries, {number('id')} AS pseudonym FROM (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer))"]
    for k in range(rounds):
        steps.append(f"w{k} AS (SELECT id, tries + CASE WHEN row_number() OVER (PARTITION BY pseudonym ORDER BY id) > 1 THEN 1 ELSE 0 END AS tries FROM r{k})")
        salted = "id || CASE WHEN tries > 0 THEN CAST(tries AS VARCHAR) ELSE '' END"
        steps.append(f"r{k + 1} AS MATERIALIZED (SELECT id, tries, {number(salted)} AS pseudonym FROM w{k})")
    return "WITH " + ", ".join(steps) + f" SELECT id, pseudonym FROM r{rounds}"


@query("pseudonym_table", _pseudonym_sql())
def _(t):
    return windows.pseudonyms(t("customer").select(F.col("c_custkey").cast("string").alias("id")), KEY)


@query("unit_convert", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN round_even(p_size * 0.393701, 0) ELSE CAST(p_size AS DOUBLE) END AS height FROM part")
def _(t):
    df = t("part").select("p_partkey", F.col("p_size").cast("double").alias("height"), F.when(F.col("p_size") % 2 == 0, "Metric").otherwise("Imperial").alias("unit"))
    return df.select("p_partkey", S.imperial("height", S.INCHES_PER_CENTIMETRE, "unit").alias("height"))


@query("try_coerce", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, TRY_CAST(event_type AS BIGINT) AS bad FROM events")
def _(t):
    return t("events").select("event_id", S.whole_number(F.get_json_object("props", "$.k")).alias("k"), S.whole_number("event_type").alias("bad"))


@query("clean_values", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE c_name END AS v FROM customer")
def _(t):
    raw = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))).otherwise(F.concat(F.lit("'"), "c_name", F.lit("'")))
    return t("customer").select("c_custkey", S.clean_value(raw).alias("v"))


@query("answer_normalise", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' ELSE 'a-b' END AS a, upper(substr(o_orderpriority, 3, 1)) || lower(substr(o_orderpriority, 4)) AS label FROM orders")
def _(t):
    raw = F.when(F.col("o_orderstatus") == "F", "Checked").when(F.col("o_orderstatus") == "O", "Unchecked").otherwise("a_b")
    return t("orders").select("o_orderkey", S.normalized_answer(raw).alias("a"), S.capitalized(F.substring("o_orderpriority", 3, 100)).alias("label"))


@query("ts_duration", "SELECT user_id, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS seconds FROM events GROUP BY user_id")
def _(t):
    return aggregates.durations(t("events"), "user_id", "ts", "ts")


@query("elapsed_subsecond", "SELECT event_id, ((epoch_us(ts) - epoch_us(TIMESTAMP '2000-01-01')) % 1000000) // 1000 AS part_ms, (epoch_us(ts) - epoch_us(TIMESTAMP '2000-01-01')) // 1000 AS all_ms FROM events")
def _(t):
    zero = F.lit("2000-01-01").cast("timestamp")
    return t("events").select("event_id", S.elapsed_ms(zero, F.col("ts").cast("timestamp"), True).alias("part_ms"), S.elapsed_ms(zero, F.col("ts").cast("timestamp")).alias("all_ms"))


@query("income_rank", """
WITH i AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(floor(c_acctbal / 1000) AS BIGINT) * 1000 END AS amount FROM customer),
r AS (SELECT c_nationkey, amount, dense_rank() OVER (PARTITION BY c_nationkey ORDER BY amount) AS d FROM (SELECT DISTINCT c_nationkey, amount FROM i WHERE amount IS NOT NULL))
SELECT c_custkey, coalesce(d, -1) AS rank FROM i LEFT JOIN r ON i.c_nationkey = r.c_nationkey AND i.amount = r.amount""")
def _(t):
    amount = F.when(F.col("c_custkey") % 4 != 0, F.floor(F.col("c_acctbal") / 1000) * 1000)
    return windows.dense_ranked(t("customer").select("c_custkey", "c_nationkey", amount.alias("amount")), "amount", "c_nationkey").select("c_custkey", F.col("rank").cast("long").alias("rank"))


# --- aggregates ----------------------------------------------------------------------------------


@query("sessions_histogram", "SELECT n AS n_sessions, count(*) AS n_participants FROM (SELECT o_custkey, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1) GROUP BY 1")
def _(t):
    return aggregates.session_histogram(t("orders"), "o_custkey", "o_orderkey")


@query("participants_over", "SELECT o_custkey, count(DISTINCT o_orderkey) AS n_sessions FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderkey) > 12")
def _(t):
    return aggregates.participants_over(t("orders"), "o_custkey", "o_orderkey", 12)


@query("overview", """
SELECT count(*) AS n_participants, CAST(sum(s) AS BIGINT) AS n_sessions, count(*) FILTER (s > 1) AS n_repeated, round(count(*) FILTER (s > 1) * 100.0 / count(*), 1) AS percent_repeated, max(s) AS most_sessions, CAST(sum(r) AS BIGINT) AS n_recordings
FROM (SELECT o_custkey, count(DISTINCT o_orderkey) AS s, count(l_linenumber) AS r FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)""")
def _(t):
    return aggregates.overview(t("orders").join(t("lineitem"), F.col("l_orderkey") == F.col("o_orderkey")), "o_custkey", "o_orderkey", "l_linenumber")


@query("table_check", "SELECT count(*) AS n_rows, 3 AS n_columns, count(*) FILTER (event_id % 7 = 0) AS n_missing, (SELECT count(*) FROM (SELECT user_id, event_type FROM events GROUP BY 1, 2 HAVING count(*) > 1)) AS n_repeated_keys FROM events")
def _(t):
    df = t("events").select("user_id", "event_type", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("v"))
    return aggregates.table_check(df, ["user_id", "event_type"])


@query("value_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return aggregates.value_counts(t("orders"), "o_orderpriority")


@query("crosstab", "SELECT c_mktsegment, count(*) FILTER (r_name = (SELECT min(r_name) FROM region)) AS a, count(*) FILTER (r_name <> (SELECT min(r_name) FROM region)) AS b FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def _(t):
    low = t("region").agg(F.min("r_name").alias("low"))
    sites = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).crossJoin(F.broadcast(low))
    sites = sites.select("n_nationkey", F.when(F.col("r_name") == F.col("low"), "a").otherwise("b").alias("country"))
    return aggregates.crosstab(t("customer").join(sites, F.col("c_nationkey") == F.col("n_nationkey")), "c_mktsegment", "country", ["a", "b"])


@query("onehot_sums", "SELECT 'is_a' AS name, count(*) FILTER (l_returnflag = 'A') AS total FROM lineitem UNION ALL SELECT 'is_r', count(*) FILTER (l_returnflag = 'R') FROM lineitem")
def _(t):
    df = t("lineitem").select(*((F.col("l_returnflag") == x).cast("int").alias(f"is_{x.lower()}") for x in "AR"))
    return aggregates.column_sums(df, ["is_a", "is_r"])


@query("binary_mean", "SELECT o_orderpriority, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) * 100, 1) AS percent FROM orders GROUP BY 1")
def _(t):
    return t("orders").groupBy("o_orderpriority").agg(aggregates.percent_true(F.col("o_orderstatus") == "F").alias("percent"))


@query("percentile_cut", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice <= (SELECT quantile_cont(l_extendedprice, 0.1) FROM lineitem)")
def _(t):
    return aggregates.size_cut(t("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", 10)


@query("fixed_bins", "SELECT floor(o_totalprice / 15000) * 15000 AS bin_start, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return aggregates.fixed_bins(t("orders"), "o_totalprice", 15000)


@query("multiset_difference", "SELECT l_returnflag, l_linestatus FROM lineitem WHERE l_linenumber < 5 EXCEPT ALL SELECT l_returnflag, l_linestatus FROM lineitem WHERE l_linenumber < 4")
def _(t):
    cols = ["l_returnflag", "l_linestatus"]
    return t("lineitem").where("l_linenumber < 5").select(*cols).exceptAll(t("lineitem").where("l_linenumber < 4").select(*cols))


@query("latest_answer", """
WITH s AS (SELECT user_id, event_type, min(event_id) AS seen FROM events GROUP BY 1, 2)
SELECT user_id, CASE WHEN count(*) = 1 AND max_by(event_type, seen) = 'view' THEN NULL ELSE max_by(event_type, seen) END AS latest, count(*) AS n_values FROM s GROUP BY 1""")
def _(t):
    return aggregates.latest_answer(t("events"), "user_id", "event_type", "event_id", "view")


@query("bundle_stats", """
WITH u AS (SELECT 'early' AS output, l_suppkey, l_orderkey, l_partkey FROM lineitem WHERE l_linenumber <= 3 UNION ALL SELECT 'late', l_suppkey, l_orderkey, l_partkey FROM lineitem WHERE l_linenumber >= 3)
SELECT output, count(*) AS n_rows, count(DISTINCT l_suppkey) AS n_participants, count(DISTINCT l_partkey) AS n_tasks, count(DISTINCT (l_suppkey, l_orderkey, l_partkey)) AS n_recordings FROM u GROUP BY 1
UNION ALL SELECT 'all', count(*), count(DISTINCT l_suppkey), count(DISTINCT l_partkey), count(DISTINCT (l_suppkey, l_orderkey, l_partkey)) FROM u""")
def _(t):
    return aggregates.bundle_statistics({"early": t("lineitem").where("l_linenumber <= 3"), "late": t("lineitem").where("l_linenumber >= 3")}, "l_suppkey", "l_orderkey", "l_partkey")


# --- windows, order, sets ------------------------------------------------------------------------


@query("ffill_bfill", """
WITH e AS (SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN value END AS v FROM events)
SELECT event_id, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v FROM e""")
def _(t):
    df = t("events").select("event_id", "user_id", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("v"))
    return windows.filled(df, "user_id", ["v"], "event_id").select("event_id", "v")


@query("cumcount", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders")
def _(t):
    return windows.counted(t("orders"), "o_custkey", "o_orderkey").select("o_orderkey", F.col("n").cast("long").alias("n"))


@query("gaps_islands", """
WITH a AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
b AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM a)
SELECT event_id, row_number() OVER (PARTITION BY user_id, island ORDER BY event_id) AS repetition FROM b""")
def _(t):
    return windows.repetitions(t("events"), "user_id", "event_type", "event_id").select("event_id", F.col("repetition").cast("long").alias("repetition"))


@query("mint_ids", """
WITH h AS (SELECT CAST(c_custkey AS VARCHAR) AS participant_id, lpad(CAST(row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) AS VARCHAR), 6, '0') AS anon_id FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT * FROM h UNION ALL SELECT CAST(c_custkey AS VARCHAR), lpad(CAST((SELECT count(*) FROM h) + row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) AS VARCHAR), 6, '0') FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def _(t):
    first = catalogue.anonymous_ids(participants(t).where("c_mktsegment = 'BUILDING'"))
    return catalogue.anonymous_ids(participants(t), first)


@query("first_wins", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def _(t):
    return windows.first_of(t("events"), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


@query("second_of_two", "SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n, count(*) OVER (PARTITION BY user_id, event_type) AS c FROM events) WHERE n = 2 AND c = 2")
def _(t):
    df = t("events").withColumn("k", F.concat_ws("|", "user_id", "event_type"))
    return windows.second_of_two(df, "k", "event_id").select("user_id", "event_id")


@query("duplicated_keys", "SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type) > 1 AS repeated FROM events")
def _(t):
    return t("events").select("event_id", windows.duplicated("user_id", "event_type").alias("repeated"))


@query("custom_order", "SELECT 'd/' || p_type || '/' || CASE p_size % 3 WHEN 0 THEN 'passage' WHEN 1 THEN 'long_sounds' ELSE '' END || '_' || p_partkey AS path, CASE p_size % 3 WHEN 0 THEN 15 WHEN 1 THEN 10 ELSE 17 END AS rank FROM part")
def _(t):
    """Recordings in the order of a protocol's parts."""
    name = F.when(F.col("p_size") % 3 == 0, "passage").when(F.col("p_size") % 3 == 1, "long_sounds").otherwise("")
    p = t("part").select(F.concat(F.lit("d/"), "p_type", F.lit("/"), name, F.lit("_"), "p_partkey").alias("path"))
    return p.select("path", survey.protocol_rank("path").alias("rank")).orderBy("rank", "path")


@query("union_by_name", "SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS price FROM customer UNION ALL SELECT p_partkey, p_name, p_retailprice FROM part")
def _(t):
    return aggregates.union_all([t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), t("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))])


@query("distinct_union", "SELECT c_nationkey AS site FROM customer UNION SELECT s_nationkey FROM supplier")
def _(t):
    return t("customer").select(F.col("c_nationkey").alias("site")).union(t("supplier").select("s_nationkey")).distinct()


@query("except_subset", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders")
def _(t):
    return t("customer").select("c_custkey").subtract(t("orders").select("o_custkey"))


@query("intersect_ids", "SELECT c_custkey AS id FROM customer INTERSECT SELECT o_custkey FROM orders")
def _(t):
    return t("customer").select(F.col("c_custkey").alias("id")).intersect(t("orders").select("o_custkey"))


@query("chunk_ids", "SELECT (row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 1) // 10 AS chunk, CAST(c_custkey AS VARCHAR) AS id FROM customer")
def _(t):
    return sinks.id_chunks(t("customer"), "c_custkey", 10)


# --- nested and tensors --------------------------------------------------------------------------


@query("unpivot", "SELECT p_partkey, 'p_brand' AS name, p_brand AS value FROM part UNION ALL SELECT p_partkey, 'p_type', p_type FROM part")
def _(t):
    return nested.melted(t("part").select("p_partkey", "p_brand", "p_type"), ["p_partkey"], ["p_brand", "p_type"])


@query("pivot_long_wide", "SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS q1, max(CASE WHEN l_linenumber = 2 THEN l_quantity END) AS q2 FROM lineitem GROUP BY 1")
def _(t):
    df = t("lineitem").where("l_linenumber <= 7").groupBy("l_orderkey", F.concat(F.lit("q"), "l_linenumber").alias("name")).agg(F.max("l_quantity").alias("v"))
    return nested.wide(df, ["l_orderkey"], "name", "v", ["q1", "q2"])


@query("json_items_explode", "SELECT event_id, 'k' AS link_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS answer FROM events")
def _(t):
    answer = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('[{"valueString":"'), "event_type", F.lit('"}]'))).otherwise("[]")
    df = t("events").select("event_id", F.concat(F.lit('{"item":[{"linkId":"k","answer":'), answer, F.lit("}]}")).alias("response"))
    return nested.questionnaire_long(df, "event_id")


@query("checkbox_expand", """
WITH r AS (SELECT o_orderkey AS record, o_orderkey % 3 + 1 AS v, o_orderkey % 4 AS kind, o_orderstatus AS s FROM orders)
SELECT record, 'i' AS instrument, 'q___' || k AS "column", CASE WHEN v = k THEN 'Checked' ELSE 'Unchecked' END AS value FROM r, (SELECT unnest([1, 2, 3]) AS k) WHERE kind < 2
UNION ALL SELECT record, 'i', 'one', CASE s WHEN 'F' THEN 'Fulfilled' ELSE s END FROM r WHERE kind = 2
UNION ALL SELECT record, 'i', 'free', s || ';' || v FROM r WHERE kind = 3""")
def _(t):
    """Answers to be checked off, single ones with a label or without, and free lists."""
    k, v = F.col("o_orderkey") % 4, (F.col("o_orderkey") % 3 + 1).cast("string")
    item = F.when(k < 2, "q").when(k == 2, "one").otherwise("free")
    values = F.when(k < 2, F.array(v)).when(k == 2, F.array("o_orderstatus")).otherwise(F.array("o_orderstatus", v))
    r = t("orders").select(F.col("o_orderkey").alias("record"), F.lit("i").alias("instrument"), item.alias("item"), values.alias("values"))
    rows = [*(("q", str(i), f"option {i}", True, 3) for i in (1, 2, 3)), ("one", "F", "fulfilled", False, None), ("free", "-", "-", True, None)]
    return nested.survey_rows(r, r.sparkSession.createDataFrame(rows, "item string, value string, label string, multiple boolean, n_options int"))


def _matrix(t):
    e = F.transform(F.slice("embedding", 1, 8), lambda x: F.abs(x))
    return t("embeddings").select("vec_id", F.array(F.slice(e, 1, 4), F.slice(e, 5, 4)).alias("m"))


@query("db_scale", """
WITH m AS (SELECT vec_id, [list_transform(embedding[1:4], lambda x: 10 * log10(greatest(abs(CAST(x AS DOUBLE)), 1e-10))), list_transform(embedding[5:8], lambda x: 10 * log10(greatest(abs(CAST(x AS DOUBLE)), 1e-10)))] AS m FROM embeddings),
c AS (SELECT vec_id, m, list_max(flatten(m)) - 80 AS least FROM m)
SELECT vec_id, i AS row, round(list_sum(list_transform(m[i], lambda x: greatest(x, least))), 4) AS total FROM c, (SELECT unnest([1, 2]) AS i)""")
def _(t):
    df = _matrix(t).withColumn("d", T.decibels("m")).withColumn("d", T.with_dynamic_range("d"))
    rows = df.select("vec_id", F.posexplode("d").alias("i", "r"))
    return rows.select("vec_id", (F.col("i") + 1).alias("row"), F.round(F.aggregate("r", F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


@query("stride_rows", "SELECT vec_id, round(abs(CAST(embedding[1] AS DOUBLE)) + abs(CAST(embedding[3] AS DOUBLE)), 5) AS first_row, 2 AS n_frames FROM embeddings")
def _(t):
    df = _matrix(t).where(T.has_values("m")).withColumn("s", T.every("m"))
    return df.select("vec_id", F.round(F.aggregate(F.col("s")[0], F.lit(0.0), lambda s, x: s + x.cast("double")), 5).alias("first_row"), T.n_frames("s").alias("n_frames"))


@query("transpose", "SELECT vec_id, round(abs(CAST(embedding[2] AS DOUBLE)), 6) AS a, round(abs(CAST(embedding[6] AS DOUBLE)), 6) AS b FROM embeddings")
def _(t):
    m = _matrix(t).withColumn("x", T.transposed("m"))
    return m.select("vec_id", F.round(F.col("x")[1][0].cast("double"), 6).alias("a"), F.round(F.col("x")[1][1].cast("double"), 6).alias("b"))


@query("topk_similarity", """
WITH q AS (SELECT embedding AS q FROM embeddings ORDER BY vec_id LIMIT 1)
SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(q AS DOUBLE[])) / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) / sqrt(list_dot_product(CAST(q AS DOUBLE[]), CAST(q AS DOUBLE[]))), 6) AS similarity
FROM embeddings, q ORDER BY 2 DESC, 1 LIMIT 20""")
def _(t):
    q = t("embeddings").orderBy("vec_id").select("embedding").first()[0]
    return features.searched(t("embeddings"), q, 20, -2.0).select("vec_id", F.round("similarity", 6).alias("similarity"))


# --- plans ---------------------------------------------------------------------------------------


@query("choice_validation", "SELECT c_custkey, 'c_mktsegment' AS field, c_mktsegment AS value, 'choice' AS rule FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def _(t):
    long = validate.cells(t("customer"), ["c_custkey"], ["c_mktsegment"])
    choices = long.sparkSession.createDataFrame([("c_mktsegment", "BUILDING"), ("c_mktsegment", "MACHINERY")], "field string, label string")
    return validate.choice_violations(long, choices).select("c_custkey", "field", "value", "rule")


@query("range_validation", "SELECT l_orderkey, l_linenumber, 'l_quantity' AS field, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS value, 'range' AS rule FROM lineitem WHERE l_quantity > 45")
def _(t):
    long = validate.cells(t("lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity"])
    ranges = long.sparkSession.createDataFrame([("l_quantity", 0, 45)], "field string, least int, most int")
    return validate.range_violations(long, ranges).select("l_orderkey", "l_linenumber", "field", "value", "rule")


@query("deid_table", """
SELECT coalesce(n_name, CAST(c_custkey AS VARCHAR)) AS participant_id, CASE WHEN c_nationkey % 2 = 0 THEN 's' || c_nationkey ELSE CAST(c_nationkey AS VARCHAR) END AS session_id, trim(regexp_replace(lower(c_mktsegment), '[^a-z0-9]+', '-', 'g'), '-') AS task_name
FROM customer LEFT JOIN nation ON c_custkey = n_nationkey WHERE c_nationkey <> 5""")
def _(t):
    df = t("customer").select(F.col("c_custkey").cast("string").alias("record_id"), F.col("c_nationkey").cast("string").alias("session_id"), F.col("c_mktsegment").alias("task_name"), "c_name")
    ids = t("nation").select(F.col("n_nationkey").cast("string").alias("old_id"), F.col("n_name").alias("new_id"))
    sessions = ids.where("old_id % 2 = 0").select("old_id", F.concat(F.lit("s"), "old_id").alias("new_id"))
    removed = t("customer").where("c_nationkey = 5").select(F.col("c_custkey").cast("string"))
    return deidentify.phenotype_deidentified(df, ids, sessions, removed, ["c_name"], "task_name")


@query("deid_files", """
WITH f AS (SELECT *, CASE WHEN l_suppkey % 3 = 0 THEN 'n' || l_suppkey ELSE CAST(l_suppkey AS VARCHAR) END AS p, CASE WHEN l_orderkey % 2 = 0 THEN 's' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END AS s FROM lineitem)
SELECT p AS participant_id, s AS session_id, 'sub-' || p || '/ses-' || s || '/audio/sub-' || p || '_ses-' || s || '_task-' || lower(l_returnflag) || '-' || l_linenumber || '.wav' AS new_path
FROM f WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 1) AND l_linenumber <> 2 AND l_returnflag <> 'N'""")
def _(t):
    stem = F.concat(F.lit("sub-"), "l_suppkey", F.lit("_ses-"), "l_orderkey", F.lit("_task-"), "l_returnflag", F.lit(" "), "l_linenumber")
    files = t("lineitem").select(F.concat(F.lit("sub-"), "l_suppkey", F.lit("/ses-"), "l_orderkey", F.lit("/audio/"), stem, F.lit(".wav")).alias("path"))
    ids = lambda df, key, letter: df.select(F.col(key).cast("string").alias("old_id"), F.concat(F.lit(letter), key).alias("new_id"))
    participants, sessions = ids(t("supplier").where("s_suppkey % 3 = 0"), "s_suppkey", "n"), ids(t("orders").where("o_orderkey % 2 = 0"), "o_orderkey", "s")
    removed = t("supplier").where("s_nationkey = 1").select(F.col("s_suppkey").cast("string"))
    stems = t("lineitem").where("l_linenumber = 2").select(stem.alias("stem"))
    return deidentify.files_deidentified(files, participants, sessions, removed, stems, ["task-a", "task-r"]).select("participant_id", "session_id", "new_path")


@query("session_numbers", "SELECT CAST(o_custkey AS VARCHAR) AS participant_id, CAST(o_orderkey AS VARCHAR) AS old_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderkey AS VARCHAR)) AS VARCHAR) AS new_id FROM orders")
def _(t):
    return deidentify.session_numbers(t("orders").select(F.col("o_custkey").cast("string").alias("participant_id"), F.col("o_orderkey").cast("string").alias("session_id")))


@query("release_issues", """
SELECT 'removed_participant' AS rule, 'features' AS "table", count(DISTINCT l_suppkey) AS n FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12)
UNION ALL SELECT 'unexpected_task', 'features', count(DISTINCT l_returnflag) FROM lineitem WHERE l_returnflag <> 'A'
UNION ALL SELECT 'unknown_session', 'features', count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def _(t):
    features_ = t("lineitem").select(F.col("l_suppkey").alias("participant_id"), F.col("l_orderkey").alias("session_id"), F.col("l_returnflag").alias("task_name"))
    sessions = t("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("session_id"))
    removed, original = t("supplier").where("s_nationkey < 12").select("s_suppkey"), t("supplier").where("s_suppkey < 0").select("s_suppkey")
    return deidentify.release_issues({"features": features_, "sessions": sessions}, removed, original, ["a"], "sessions")


@query("biosamples", """
WITH ids AS (SELECT s_suppkey, lpad(CAST(row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) AS VARCHAR), 6, '0') AS anon_id FROM supplier)
SELECT DISTINCT anon_id || '_' || l_orderkey || '_' || lower(l_returnflag) AS local_id, anon_id, CAST(l_orderkey AS VARCHAR) AS session_id, lower(l_returnflag) AS task, CASE WHEN l_returnflag = 'A' THEN 'OBI:1' END AS assay_type, 'UBERON:0001737' AS anatomy
FROM lineitem JOIN ids ON l_suppkey = s_suppkey""")
def _(t):
    rows = t("lineitem").select(F.col("l_suppkey").cast("string").alias("participant_id"), F.col("l_orderkey").cast("string").alias("session_id"), F.concat("l_returnflag", F.lit("-"), "l_linenumber").alias("task_name"))
    ids = catalogue.anonymous_ids(t("supplier").select(F.col("s_suppkey").cast("string").alias("participant_id")))
    terms = rows.sparkSession.createDataFrame([("a", "OBI:1")], "task string, term string")
    return catalogue.biosamples(rows, ids, terms)


@query("features_missing", "SELECT event_id // 3 AS participant_id, 's' AS session_id, 't' AS task_name, list_sort(list_filter(['click', 'purchase', 'view'], lambda x: NOT list_contains(list(DISTINCT event_type), x))) AS needed FROM events GROUP BY 1 HAVING len(list_filter(['click', 'purchase', 'view'], lambda x: NOT list_contains(list(DISTINCT event_type), x))) > 0")
def _(t):
    held = t("events").select(F.floor(F.col("event_id") / 3).alias("participant_id"), F.lit("s").alias("session_id"), F.lit("t").alias("task_name"), F.col("event_type").alias("feature_group"))
    return features.missing(held.drop("feature_group").distinct(), held, ["click", "purchase", "view"])


@query("audio_inventory", "SELECT CAST(l_suppkey AS VARCHAR) AS record_id, CAST(l_orderkey AS VARCHAR) AS session_id, 'picture_' || lower(l_returnflag) AS acoustic_task_name, sum(l_quantity) AS acoustic_task_duration FROM lineitem GROUP BY 1, 2, 3")
def _(t):
    uuid = F.regexp_replace(F.md5(F.concat_ws("-", "l_orderkey", "l_linenumber").cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    path = F.concat(F.lit("/in/"), "l_suppkey", F.lit("/"), "l_orderkey", F.lit("-/picture_"), F.lower("l_returnflag"), F.lit("_task_"), "l_linenumber", F.lit("-"), uuid, F.lit(".wav"))
    tasks, _ = survey.audio_rows(t("lineitem").select(path.alias("path"), F.col("l_quantity").alias("duration")))
    return tasks.select("record_id", "session_id", "acoustic_task_name", "acoustic_task_duration")


@query("event_windows", "SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def _(t):
    return incremental.event_counts(t("events")).select("window_start", "event_type", "n", F.round("total", 4).alias("total"))


@query("event_sessions", """
WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS starts FROM events),
s AS (SELECT user_id, ts, sum(starts) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, count(*) AS n FROM s GROUP BY user_id, k""")
def _(t):
    return incremental.sessions(t("events"))


# --- phenotype and dashboards --------------------------------------------------------------------


@query("phenotype_table", """
WITH e AS (SELECT event_id, user_id AS record_id, CASE WHEN event_id % 4 = 0 THEN event_type END AS answer FROM events WHERE event_type IN ('click', 'view')),
f AS (SELECT event_id, record_id, coalesce(last_value(answer IGNORE NULLS) OVER (PARTITION BY record_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(answer IGNORE NULLS) OVER (PARTITION BY record_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS answer FROM e WHERE answer IS NOT NULL)
SELECT record_id, answer, count(*) AS n FROM f GROUP BY 1, 2""")
def _(t):
    from cohortforge.plans import phenotype

    spark = t("events").sparkSession
    wide = t("events").select(F.col("event_id").alias("_row_id"), F.col("user_id").alias("record_id"), F.col("event_type").alias("redcap_repeat_instrument"), F.when(F.col("event_id") % 4 == 0, F.col("event_type")).alias("q1"))
    instruments = spark.createDataFrame([("click", "s_click", 1), ("view", "s_view", 2)], "text string, schema_name string, _row_id int")
    mapping = spark.createDataFrame([("s_click", "q1", "answers", "answer", None), ("s_view", "q2", "answers", "other", "yes")], "schema_name_source string, column_name_source string, schema_name string, column_name string, delete string")
    mapping = mapping.union(spark.createDataFrame([("s_view", "q3", "answers", "third", None)], mapping.schema))
    table = phenotype.tables(wide, instruments, mapping)["answers"]
    return table.groupBy("record_id", "answer").agg(F.count("*").alias("n"))


@query("schema_of_column", "SELECT event_type AS \"column\", max_by(CAST(user_id AS VARCHAR), event_id) AS schema FROM events GROUP BY 1")
def _(t):
    from cohortforge.plans import phenotype

    return phenotype.schema_of_column(t("events").select(F.col("event_type").alias("column"), F.col("user_id").cast("string").alias("schema"), F.col("event_id").alias("_row_id")))


@query("protocol_items", """
WITH o AS (SELECT o_orderkey AS activity, o_orderkey % 3 AS k, ['items/' || o_orderstatus, 'items/b'] AS a FROM orders)
SELECT activity, unnest(CASE k WHEN 0 THEN [a[1], a[2], 'items/c'] ELSE a END) AS item, unnest(CASE k WHEN 0 THEN [0, 1, 2] ELSE [0, 1] END) AS at FROM o""")
def _(t):
    from cohortforge.plans import phenotype

    own = F.concat(F.lit("items/"), "o_orderstatus")
    more = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("items/b"), F.lit("items/c"), F.lit("other"))).otherwise(F.array(F.lit("other"), own))
    return phenotype.protocol_items(t("orders").select(F.col("o_orderkey").alias("activity"), F.array(own, F.lit("items/b")).alias("order"), more.alias("properties")))


@query("site_counts", "SELECT n_regionkey, count(DISTINCT c_custkey) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(t):
    from cohortforge.plans import dashboards

    return dashboards.site_counts(t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")), "c_custkey", "n_regionkey")


@query("income_brackets", """
WITH c AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN 'Missing' WHEN c_custkey % 2 = 0 THEN 'Canada' ELSE 'USA' END AS country,
  CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'Prefer not to answer' ELSE '$' || (c_nationkey + 1) || ',000' END AS income, c_nationkey AS k FROM customer),
g AS (SELECT country, income, count(*) AS n, max(CASE WHEN income LIKE '$%' THEN k END) AS k FROM c GROUP BY 1, 2)
SELECT country, income, CASE WHEN income LIKE 'P%' THEN 0 WHEN income IS NULL THEN -1 ELSE dense_rank() OVER (PARTITION BY country, k IS NULL ORDER BY k) END AS rank, n FROM g""")
def _(t):
    from cohortforge.plans import dashboards

    k = F.col("c_custkey")
    bracket = F.when(k % 5 == 0, None).when(k % 7 == 0, "Prefer not to answer").otherwise(F.concat(F.lit("$"), (F.col("c_nationkey") + 1).cast("string"), F.lit(",000")))
    return dashboards.incomes(t("customer").select(F.when(k % 2 == 1, bracket).alias("us"), F.when(k % 2 == 0, bracket).alias("ca")), "us", "ca")


@query("yes_no_answers", "SELECT 'q1' AS question, count(*) AS n, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) * 100, 1) AS percent FROM orders UNION ALL SELECT 'q2', count(*) FILTER (o_orderkey % 2 = 0), round(avg(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) FILTER (o_orderkey % 2 = 0) * 100, 1) FROM orders")
def _(t):
    from cohortforge.plans import dashboards

    s = F.col("o_orderstatus")
    df = t("orders").select(F.when(s == "F", "Yes").otherwise("No").alias("q1"), F.when(F.col("o_orderkey") % 2 == 0, F.when(s == "O", "Checked").otherwise("Unchecked")).alias("q2"))
    return dashboards.answers(df, ["q1", "q2"])


@query("recording_summary", "SELECT l_returnflag AS task_name, count(*) AS n_recordings, count(DISTINCT l_suppkey) AS n_participants FROM lineitem GROUP BY 1")
def _(t):
    from cohortforge.plans import dashboards

    path = F.concat(F.lit("d/sub-"), "l_suppkey", F.lit("/ses-"), "l_orderkey", F.lit("/audio/sub-"), "l_suppkey", F.lit("_ses-"), "l_orderkey", F.lit("_task-"), "l_returnflag", F.lit(".wav"))
    return dashboards.recording_summary(t("lineitem").select(path.alias("path")))


@query("releases_compared", "SELECT 'registered' AS side, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING' OR c_nationkey % 3 = 0 UNION ALL SELECT 'controlled', count(*) FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_nationkey % 3 = 0")
def _(t):
    """One release lacks rows of the other and has some with another value."""
    from cohortforge.plans import phenotype

    name = F.when(F.col("c_nationkey") % 3 == 0, F.concat("c_name", F.lit("'"))).otherwise(F.col("c_name"))
    return phenotype.compared(t("customer"), t("customer").where("c_mktsegment <> 'BUILDING'").withColumn("c_name", name))


@query("subject_races", """
WITH r AS (SELECT user_id, event_type FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id < 500 AND event_type = 'error'))
SELECT DISTINCT 'p' || user_id AS anon_id, event_type AS race FROM r WHERE event_type <> 'error'""")
def _(t):
    e = t("events")
    race = F.when((F.col("event_id") < 500) & (F.col("event_type") == "error"), "Prefer not to answer").otherwise(F.col("event_type"))
    answers = e.select(F.col("user_id").cast("string").alias("participant_id"), F.lit("race").alias("field"), race.alias("value"))
    ids = answers.select("participant_id", F.concat(F.lit("p"), "participant_id").alias("anon_id")).distinct()
    return catalogue.subject_races(answers, ids).where("race <> 'error'")
