"""Counts, summaries, crosstabs, bins and table comparisons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    return (df.where(F.col(column).isNotNull()) if dropna else df).groupBy(column).agg(F.count("*").alias("n"))


def session_histogram(df: DataFrame, participant: str, session: str) -> DataFrame:
    """How many participants have how many distinct sessions."""
    per = df.where(F.col(participant).isNotNull()).groupBy(participant).agg(F.countDistinct(session).alias("n_sessions"))
    return per.groupBy("n_sessions").agg(F.count("*").alias("n_participants"))


def participants_over(df: DataFrame, participant: str, session: str, most: int) -> DataFrame:
    return df.groupBy(participant).agg(F.countDistinct(session).alias("n_sessions")).where(F.col("n_sessions") > most)


def overview(df: DataFrame, participant: str, session: str, recording: str) -> DataFrame:
    """One row: participants, sessions, participants with several and their percentage, most sessions, recordings."""
    per = df.groupBy(participant).agg(F.countDistinct(session).alias("s"), F.count(recording).alias("r"))
    several = F.count_if(F.col("s") > 1)
    return per.agg(
        F.count("*").alias("n_participants"),
        F.sum("s").alias("n_sessions"),
        several.alias("n_repeated"),
        F.round(several * 100.0 / F.count("*"), 1).alias("percent_repeated"),
        F.max("s").alias("most_sessions"),
        F.sum("r").alias("n_recordings"),
    )


def table_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, columns, missing cells, key groups that repeat."""
    cells = reduce(lambda a, b: a + b, (F.count_if(F.col(c).isNull()) for c in df.columns))
    repeats = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("n_repeated_keys"))
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"), cells.alias("n_missing")).crossJoin(F.broadcast(repeats))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def offenders(df: DataFrame, key: str) -> DataFrame:
    """key, n, problem of values that a unique key holds more than once; nulls don't count."""
    return repeated_keys(df, [key]).select(key, "n", F.lit("not unique").alias("problem"))


def unique_or_raise(df: DataFrame, key: str, named: int = 10) -> DataFrame:
    """The rows with a key, each once; ValueError with the first few keys that repeat."""
    bad = [r[0] for r in offenders(df, key).orderBy(key).limit(named).collect()]
    if bad:
        raise ValueError(f"{key} is not unique: {', '.join(map(str, bad))}")
    return df.where(F.col(key).isNotNull())


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    return df.groupBy(row).agg(*(F.count_if(F.col(column) == v).alias(v) for v in values))


def column_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """name, total of each 0/1 column."""
    one = df.agg(*(F.sum(c).alias(c) for c in columns))
    return one.unpivot([], list(columns), "name", "total")


def percent_true(column: Column) -> Column:
    return F.round(F.avg(column.cast("int")) * 100, 1)


def exact_percentile(df: DataFrame, column: str, share: float, most_values: int = 10_000) -> float | None:
    """The percentile of a column (linear interpolation; null without values), its range narrowed by approximate quantiles.

    Only when at most ``most_values`` different values are left do they come to the driver, with their counts.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    size = values.count()
    if not size:
        return None
    rank = share * (size - 1)
    k, part = int(rank), rank - int(rank)
    below, held, held_size = 0, values, size
    while True:
        kinds = held.groupBy("v").count()
        if held_size <= most_values or kinds.count() <= most_values:
            break
        wanted = [max((k - below) / held_size - 0.001, 0.0), min((k + 2 - below) / held_size + 0.001, 1.0)]
        least, largest = held.approxQuantile("v", wanted, 0.0001)
        before = held.where(F.col("v") < least).count()
        narrow = held.where(F.col("v").between(least, largest))
        narrow_size = narrow.count()
        if narrow_size == held_size:
            break  # nothing more to cut off
        below, held, held_size = below + before, narrow, narrow_size
    at, got = below, []
    for value, n in sorted(kinds.collect()):
        while len(got) < 2 and k + len(got) < at + n:
            got.append(value)
        at += n
    low, high = got[0], got[-1]
    return low if low == high else low * (1 - part) + high * part


def size_cut(df: DataFrame, column: str, percent: float) -> DataFrame:
    """Rows at most as large as a percentile (linear interpolation)."""
    cut = exact_percentile(df, column, percent / 100)
    return df.where(F.col(column) <= F.lit(cut).cast("double"))


def fixed_bins(df: DataFrame, column: str, width: float) -> DataFrame:
    start = F.floor(F.col(column) / width) * width
    return df.where(F.col(column).isNotNull()).groupBy(start.cast("double").alias("bin_start")).agg(F.count("*").alias("n"))


def auto_bins(df: DataFrame, column: str, most: int = 30) -> DataFrame:
    """Equal bins between least and most; the last one is closed."""
    span = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    wide = (F.col("_hi") - F.col("_lo")) / most
    at = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(F.least(F.floor((F.col(column) - F.col("_lo")) / wide), F.lit(most - 1)))
    return df.crossJoin(F.broadcast(span)).where(F.col(column).isNotNull()).groupBy(at.cast("long").alias("bin")).agg(F.count("*").alias("n"))


def durations(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Seconds from the first start to the last end of each key."""
    micros = F.unix_micros(F.max(F.col(end).cast("timestamp"))) - F.unix_micros(F.min(F.col(start).cast("timestamp")))
    return df.groupBy(key).agg((micros / 1e6).alias("seconds"))


def latest_answer(df: DataFrame, key: str, value: str, order: str, null_alone: str | None = None) -> DataFrame:
    """Per key the value seen first last (the last of the distinct values in order of appearance) and how many there are.

    ``null_alone``: a value that counts as missing where it is the only one.
    """
    seen = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.min(order).alias("_at"))
    out = seen.groupBy(key).agg(F.max_by(value, "_at").alias("latest"), F.count("*").alias("n_values"))
    if null_alone is not None:
        out = out.withColumn("latest", F.when((F.col("n_values") == 1) & (F.col("latest") == null_alone), None).otherwise(F.col("latest")))
    return out


def bundle_statistics(outputs: dict[str, DataFrame], participant: str, session: str, task: str) -> DataFrame:
    """Per output: rows, participants, tasks; "all": distinct recordings over all of them."""
    parts = [df.select(F.lit(name).alias("output"), participant, session, task) for name, df in outputs.items()]
    every = reduce(DataFrame.unionByName, parts)
    triple = F.countDistinct(F.struct(participant, session, task))
    each = every.groupBy("output").agg(F.count("*").alias("n_rows"), F.countDistinct(participant).alias("n_participants"), F.countDistinct(task).alias("n_tasks"), triple.alias("n_recordings"))
    whole = every.agg(F.lit("all").alias("output"), F.count("*").alias("n_rows"), F.countDistinct(participant).alias("n_participants"), F.countDistinct(task).alias("n_tasks"), triple.alias("n_recordings"))
    return each.unionByName(whole)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows as often."""
    cols = sorted(a.columns)
    if cols != sorted(b.columns):
        return False
    return a.select(*cols).exceptAll(b.select(*cols)).isEmpty() and b.select(*cols).exceptAll(a.select(*cols)).isEmpty()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; what a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
