"""Joins with the null rules of survey data: exclusion keeps null keys, remapping keeps unknown ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions.scalars import canonical_stem, normalize_label


def recordings_of_task(recordings: DataFrame, tasks: DataFrame, name: str) -> DataFrame:
    """Recordings of one named task with the task's columns."""
    chosen = tasks.where(F.col("acoustic_task_name") == name)
    return recordings.join(chosen, recordings["recording_acoustic_task_id"] == chosen["acoustic_task_id"], "inner")


def excluded(df: DataFrame, removed: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key isn't listed; null keys stay."""
    return df.join(removed.select(*([on] if isinstance(on, str) else on)).distinct(), on, "left_anti")


def included(df: DataFrame, kept: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(kept.select(*([on] if isinstance(on, str) else on)).distinct(), on, "left_semi")


def excluded_stems(files: DataFrame, stems: DataFrame, path_stem: str = "stem") -> DataFrame:
    """Files whose canonical stem (up to the task) isn't listed."""
    listed = stems.select(canonical_stem("stem").alias("_stem")).distinct()
    return files.withColumn("_stem", canonical_stem(path_stem)).join(listed, "_stem", "left_anti").drop("_stem")


def label_matches(df: DataFrame, labels: DataFrame, column: str, label: str = "label", keep: bool = True) -> DataFrame:
    """Rows whose normalised label contains a listed one (or none of them); the list is a small dimension.

    The list is read to the driver and must be small (at most 10 000 labels), then it is one expression.
    """
    listed = [r[0] for r in labels.select(normalize_label(label)).distinct().limit(10_001).collect() if r[0]]
    if len(listed) > 10_000:
        raise ValueError("too many labels for a list of patterns")
    hit = F.lit(False)
    for x in sorted(listed):
        hit = hit | normalize_label(column).contains(x)
    return df.where(F.coalesce(hit, F.lit(False)) == F.lit(keep))


def remapped(df: DataFrame, mapping: DataFrame, column: str, old: str = "old_id", new: str = "new_id") -> DataFrame:
    """Ids replaced where the mapping has them, in place."""
    m = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    joined = df.join(m, df[column] == m["_old"], "left")
    return joined.select(*(F.coalesce("_new", F.col(column)).alias(c) if c == column else F.col(c) for c in df.columns))


def remapped_like(df: DataFrame, mapping: DataFrame, part: str = "session_id") -> DataFrame:
    """Every column whose name contains ``part`` is remapped."""
    for c in [c for c in df.columns if part in c]:
        df = remapped(df, mapping, c)
    return df


def prefix_join(left: DataFrame, right: DataFrame, text: str, prefix: str, key: str) -> DataFrame:
    """Rows with an equal key whose text starts with the other side's prefix."""
    return left.join(right, key).where(F.col(text).startswith(F.col(prefix)))


def hierarchy(participants: DataFrame, sessions: DataFrame, tasks: DataFrame, recordings: DataFrame) -> DataFrame:
    """Participants with nested sessions, tasks and recordings; participants without sessions stay, lists are sorted.

    A row holds one participant's whole tree, so it grows with the recordings of one person, not with the table.
    """
    r = recordings.groupBy("recording_acoustic_task_id").agg(F.sort_array(F.collect_list(F.struct("recording_id"))).alias("recordings"))
    t = tasks.join(r, tasks["acoustic_task_id"] == r["recording_acoustic_task_id"], "left")
    t = t.groupBy("acoustic_task_session_id").agg(F.sort_array(F.collect_list(F.struct("acoustic_task_id", "acoustic_task_name", F.coalesce("recordings", F.array()).alias("recordings")))).alias("tasks"))
    s = sessions.join(t, sessions["session_id"] == t["acoustic_task_session_id"], "left")
    s = s.groupBy("record_id").agg(F.sort_array(F.collect_list(F.struct("session_id", F.coalesce("tasks", F.array()).alias("tasks")))).alias("sessions"))
    return participants.join(s, "record_id", "left").withColumn("sessions", F.coalesce("sessions", F.array()))


def rows_united(df: DataFrame, first: str, second: str, key: str = "record_id", kind: str = "redcap_repeat_instrument", order: str = "_row_id", into: str = "") -> DataFrame:
    """Rows of two kinds made one for each key: the first kind's values, the second's where those are missing, at the earlier row's place.

    Keys that have only one of the kinds lose their rows, others' rows stay; several rows of a kind give all pairs of that key.
    """
    rest = [c for c in df.columns if c not in (key, kind, order)]
    side = lambda value, mark: df.where(F.col(kind) == value).select(key, *(F.col(c).alias(f"{mark}{c}") for c in [*rest, order]))
    least = df.where(F.col(kind).isin(first, second)).groupBy(key).agg(F.min(order).alias(order))
    both = side(first, "_a_").join(side(second, "_b_"), key).join(least, key)
    made = both.select(key, F.lit(into).alias(kind), order, *(F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in rest))
    return made.unionByName(df.where(~F.coalesce(F.col(kind).isin(first, second), F.lit(False))).select(*made.columns))


def listings_compared(local: DataFrame, remote: DataFrame, path: str = "path", digest: str = "md5") -> DataFrame:
    """path, status (same, changed, only_local, only_remote); a missing remote digest is no change."""
    a = local.select(path, F.col(digest).alias("a"), F.lit(1).alias("_l"))
    b = remote.select(path, F.nullif(digest, F.lit("")).alias("b"), F.lit(1).alias("_r"))
    status = F.when(F.col("_r").isNull(), "only_local").when(F.col("_l").isNull(), "only_remote").when(F.col("b").isNotNull() & ~F.col("a").eqNullSafe(F.col("b")), "changed").otherwise("same")
    return a.join(b, path, "full_outer").select(path, status.alias("status"))


def full_paths(folders: DataFrame, id_col: str = "id", name: str = "name", parent: str = "parent") -> DataFrame:
    """id, path from (id, name, parent), ids being unique; broken or circular chains give null.

    Paths are doubled: a round joins each node's piece with that of the node above it, so the rounds go with the logarithm of
    the depth, and each is stored.  A circle never comes to an end: when no further node has, what is left is one.
    """
    from cohortforge.operators.tables import kept_once

    now = kept_once(folders.select(F.col(id_col).alias("id"), F.col(name).alias("path"), F.col(parent).alias("up"), F.lit(False).alias("bad")))
    left = now.where("up is not null").count()
    while left:
        above = now.select(F.col("id").alias("_id"), F.col("path").alias("_path"), F.col("up").alias("_up"), F.col("bad").alias("_bad"))
        open_ = F.col("up").isNotNull()
        found = open_ & F.col("_id").isNotNull()
        step = now.join(above, now["up"] == above["_id"], "left").select(
            "id",
            F.when(found, F.concat_ws("/", "_path", "path")).otherwise(F.col("path")).alias("path"),
            F.when(found, F.col("_up")).alias("up"),
            (F.col("bad") | (open_ & F.col("_id").isNull()) | F.coalesce("_bad", F.lit(False))).alias("bad"),
        )
        # pieces of circles would double with each round: those that are as open as before are circles
        now = kept_once(step)
        still = now.where("up is not null").count()
        if still == left:
            break
        left = still
    return now.select("id", F.when(~F.col("bad") & F.col("up").isNull(), F.col("path")).alias("path"))
