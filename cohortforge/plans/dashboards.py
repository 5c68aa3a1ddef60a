"""The tables behind dashboards: demographics, questionnaires, recordings, site counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortforge.functions.scalars import path_entity, upper_amount
from cohortforge.operators import aggregates, select


def site_counts(df: DataFrame, participant: str, site: str) -> DataFrame:
    return df.select(participant, site).distinct().groupBy(site).agg(F.count("*").alias("n"))


def duration_bins(df: DataFrame, seconds: str, minutes: int = 15) -> DataFrame:
    return aggregates.fixed_bins(df.withColumn("_m", F.col(seconds) / 60), "_m", minutes)


def incomes(df: DataFrame, us: str, ca: str) -> DataFrame:
    """country, income, rank, n: brackets ranked by their upper amount within a country.

    No answer ranks -1, "Prefer not to answer" 0; the country is Canada if its bracket is given, else USA if that is.
    """
    country = F.when(F.col(ca).isNotNull(), "Canada").when(F.col(us).isNotNull(), "USA").otherwise("Missing")
    bracket = F.coalesce(ca, us)
    counts = df.select(country.alias("country"), bracket.alias("income")).groupBy("country", "income").agg(F.count("*").alias("n"))
    amount = upper_amount("income")
    place = F.dense_rank().over(Window.partitionBy("country", amount.isNull()).orderBy(amount))
    rank = F.when(F.col("income") == "Prefer not to answer", 0).when(amount.isNull(), -1).otherwise(place)
    return counts.select("country", "income", rank.cast("long").alias("rank"), "n")


def answers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """question, n, percent of yes among the answers of yes/no questions, in one pass."""
    yes = lambda c: F.col(c).isin("Yes", "Checked").cast("int")
    one = df.agg(*(F.struct(F.count(c).alias("n"), F.round(F.avg(F.when(F.col(c).isNotNull(), yes(c))) * 100, 1).alias("percent")).alias(c) for c in columns))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("question"), F.col(f"{c}.n").alias("n"), F.col(f"{c}.percent").alias("percent")) for c in columns))).alias("x")).select("x.*")


def races(df: DataFrame, base: str = "race") -> DataFrame:
    """race, n of base___option columns, each named by its own value."""
    boxes = select.checkbox_groups(df.columns)[base]
    one = df.agg(*(F.struct(F.max(c).alias("race"), F.count(c).alias("n")).alias(c) for c in boxes))
    return one.select(F.explode(F.array(*(F.col(c) for c in boxes))).alias("x")).select("x.*").where("race is not null")


def recordings_loaded(recordings: DataFrame, files: DataFrame, ids: DataFrame | None = None, key: str = "recording_id") -> DataFrame:
    """Recordings (all, or those of the given ids) with their file's path; ``missing`` where there is none."""
    wanted = recordings if ids is None else recordings.join(ids.select(key).distinct(), key, "left_semi")
    newest = files.groupBy(key).agg(F.max("path").alias("path"))
    return wanted.join(newest, key, "left").withColumn("missing", F.col("path").isNull())


def questionnaire(participants: DataFrame, columns: Sequence[str], key: str = "participant_id") -> DataFrame:
    """One questionnaire's columns of the participants table, without participants who answered none of them."""
    held = [c for c in columns if c in participants.columns and c != key]
    return select.without_blank_rows(participants.select(key, *held), [key])


def recording_summary(files: DataFrame) -> DataFrame:
    """task, recordings, participants from file paths."""
    return files.select(path_entity("path", "task").alias("task_name"), path_entity("path", "sub").alias("participant_id")).groupBy("task_name").agg(F.count("*").alias("n_recordings"), F.countDistinct("participant_id").alias("n_participants"))
