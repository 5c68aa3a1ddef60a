"""Releases: stems under old and new ids, what remapping left as it was, whole folders written once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortforge.operators.tables import kept_once
from cohortforge.plans import deidentify
from cohortforge.sources import sinks
from cohortforge.sources.files import exists

STEM = r"^sub-([^_]+)(?:_ses-([^_]+))?(.*)$"


def stems_expanded(stems: DataFrame, participants: DataFrame, sessions: DataFrame, stem: str = "stem") -> DataFrame:
    """stem: listed recording stems as they are, with ids mapped to new ones and with ids mapped back, each once.

    ``participants`` and ``sessions`` are (old_id, new_id); an id without a partner stays.  Where several old ids have one new
    id the largest is taken back.  Extensions are cut off, null stems left out; stems of another form stay alone.
    """
    clean = F.regexp_replace(F.element_at(F.split(stem, "/"), -1), r"(?<=.)\.[^.]*$", "")
    s = stems.where(F.col(stem).isNotNull()).select(clean.alias("_stem")).distinct()
    part = lambda i: F.regexp_extract("_stem", STEM, i)
    s = s.select("_stem", part(1).alias("_sub"), F.nullif(part(2), F.lit("")).alias("_ses"), part(3).alias("_rest"))
    for name, ids in (("sub", participants), ("ses", sessions)):
        forth = ids.groupBy(F.col("old_id").alias(f"_{name}")).agg(F.max("new_id").alias(f"_{name}_forth"))
        back = ids.groupBy(F.col("new_id").alias(f"_{name}")).agg(F.max("old_id").alias(f"_{name}_back"))
        s = s.join(forth, f"_{name}", "left").join(back, f"_{name}", "left")

    def mapped(way: str):
        ses = F.coalesce(f"_ses_{way}", "_ses")
        return F.concat(F.lit("sub-"), F.coalesce(f"_sub_{way}", "_sub"), F.coalesce(F.concat(F.lit("_ses-"), ses), F.lit("")), "_rest")

    forms = F.when(F.col("_sub") == "", F.array("_stem")).otherwise(F.array("_stem", mapped("forth"), mapped("back")))
    return s.select(F.explode(forms).alias("stem")).distinct()


def remap_report(before: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """n, n_unchanged, n_unchanged_ids, proportion (remapped) of an id column, and ids: the unchanged ones as text, in order, joined by commas.

    An id mapped to itself counts as unchanged; nulls count as rows, neither remapped nor unchanged; without unchanged ids, ids is null.
    Tasks sort and join ranges of ids; ids is one value, so all of them have 2 GB at most (``unchanged_ids`` has them as rows).
    """
    joined, same = _remapped_ids(before, mapping, column)
    total, unchanged = F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(F.when(same, F.col("_n"))), F.lit(0))
    remapped = F.coalesce(F.sum(F.when(~same & F.col("_id").isNotNull(), F.col("_n"))), F.lit(0))
    counted = joined.agg(total.alias("n"), unchanged.alias("n_unchanged"), F.count_if(same).alias("n_unchanged_ids"), F.coalesce(F.try_divide(remapped, total), F.lit(0.0)).alias("proportion"))
    ranges = joined.where(same).select(F.col("_id").cast("string").alias("id")).repartitionByRange("id").withColumn("_range", F.spark_partition_id())
    texts = ranges.groupBy("_range").agg(F.min("id").alias("first"), F.array_join(F.sort_array(F.collect_set("id")), ",").alias("text"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("first", "text"))), lambda x: x["text"])
    return counted.crossJoin(texts.agg(F.when(F.count("*") > 0, F.array_join(in_order, ",")).alias("ids")))


def unchanged_ids(before: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """id, n of the ids that a mapping leaves as they are, with their rows."""
    joined, same = _remapped_ids(before, mapping, column)
    return joined.where(same).select(F.col("_id").cast("string").alias("id"), F.col("_n").alias("n"))


def _remapped_ids(before: DataFrame, mapping: DataFrame, column: str):
    ids = before.groupBy(F.col(column).alias("_id")).agg(F.count("*").alias("_n"))
    joined = ids.join(mapping.select(F.col("old_id").alias("_id"), "new_id"), "_id", "left")
    return joined, F.col("_id").isNotNull() & (F.coalesce("new_id", "_id") == F.col("_id"))


def refuse_existing(spark: SparkSession, path: str) -> None:
    if exists(spark, path):
        raise FileExistsError(f"{path} is there already; a release is written once")


def released(
    spark: SparkSession,
    out: str,
    phenotype: Mapping[str, DataFrame],
    features: Mapping[str, DataFrame] | None,
    files: DataFrame | None,
    participants: DataFrame,
    sessions: DataFrame,
    removed: DataFrame,
    stems: DataFrame,
    tasks: Sequence[str] | None = None,
    private: Sequence[str] = (),
    static: Sequence[str] = (),
) -> dict[str, int]:
    """A de-identified release below ``out``, which must not be there yet; rows written of each part, each computed once.

    All is written below ``<out>.part`` and renamed at the end, so a run that fails leaves no release and can be run again.

    ``phenotype``: tables by name, to phenotype/<name>.  ``features``: long features by name, to features/<name>.
    ``files``: (path, ...) rows, to files (old and new paths, for ``sinks.copies``).  ``static``: files that go along as they are.
    ``participants`` and ``sessions`` map old_id to new_id; stems are given under old or new ids.
    """
    refuse_existing(spark, out)
    made = f"{out}.part"
    sinks.removed_path(spark, made)  # of a run that failed
    listed = kept_once(stems_expanded(stems, participants, sessions))
    n = {}
    for name, df in phenotype.items():
        held = deidentify.phenotype_deidentified(df, participants, sessions, removed, private)
        seen = Observation(f"rows {name}")
        sinks.delimited(held.observe(seen, F.count(F.lit(1)).alias("n")), f"{made}/phenotype/{name}")
        n[f"phenotype/{name}"] = seen.get["n"]
    for name, df in (features or {}).items():
        held = deidentify.features_deidentified(df, removed, listed, list(tasks or ()))
        sinks.feature_parquet(held, f"{made}/features/{name}")
        n[f"features/{name}"] = spark.read.parquet(f"{made}/features/{name}").count()  # from the files' footers
    if files is not None:
        held = deidentify.files_deidentified(files, participants, sessions, removed, listed, tasks)
        held.select("path", "new_path").write.parquet(f"{made}/files")
        n["files"] = spark.read.parquet(f"{made}/files").count()
    if static:
        pairs = spark.createDataFrame([(path, f"{made}/{path.rsplit('/', 1)[-1]}") for path in static], "source string, target string")
        failed = sinks.copies(pairs).where("error is not null").collect()  # as many as static files were named
        if failed:
            raise OSError("; ".join(r.error for r in failed))
        n["static"] = len(static)
    sinks.renamed_path(spark, made, out)
    return n


def unprocessed(files: DataFrame, path: str = "path") -> DataFrame:
    """path, missing of recordings (.wav) without a feature payload (.pt) or transcription (.txt) that begins with their stem beside them.

    What begins with a stem begins with its sub- and ses- entities too, so names meet by folder and entities; stems without
    them meet all names of their folder.
    """
    whole = F.regexp_extract_all(path, F.lit(r"^(.*/)?([^/]*)$"), F.lit(1))
    f = files.select(F.col(path).alias("path"), F.get(whole, F.lit(0)).alias("folder"), F.element_at(F.split(path, "/"), -1).alias("name"))
    f = f.withColumns({"entities": F.regexp_extract("name", r"^sub-[^_]+_ses-[^_]+_", 0), "kind": F.lower(F.right("name", F.lit(4)))})
    wav = f.where("kind = '.wav'").select("path", "folder", "entities", F.regexp_replace("name", r"\.[^.]*$", "").alias("stem"))
    out = None
    for kind, ending in (("features", ".pt"), ("transcription", ".txt")):
        some = f.where(F.col("kind").endswith(ending)).select("folder", "name", F.explode(F.array_distinct(F.array("entities", F.lit("")))).alias("entities")).alias("h")
        w = wav.alias("w")
        beside = (F.col("w.folder") == F.col("h.folder")) & (F.col("w.entities") == F.col("h.entities")) & F.col("h.name").startswith(F.col("w.stem"))
        part = w.join(some, beside, "left_anti").select("path", F.lit(kind).alias("missing"))
        out = part if out is None else out.unionByName(part)
    return out
