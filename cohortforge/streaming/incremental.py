"""Incremental forms: windowed event counts, growing id maps, skipping what is done."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from cohortforge.operators import windows
from cohortforge.sources.files import exists


def event_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and type; works on streams (with a watermark) and on tables."""
    df = events.withWatermark("ts", late) if events.isStreaming else events
    return df.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    df = events.withWatermark("ts", late) if events.isStreaming else events
    return df.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def without_repeats(events: DataFrame, late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else events.dropDuplicates(["event_id"])


#: The columns of files as a stream; contents are read only where they are used.
FILES = "path string, modificationTime timestamp, length long, content binary"


def file_stream(spark: SparkSession, root: str, pattern: str = "*.wav") -> DataFrame:
    """Files below a folder as a stream: each trigger sees those that weren't there before."""
    return spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)


def written_once(stream: DataFrame, work: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """What ``work`` makes of all rows that are new, each batch in a folder of its own below ``target``; one run over what is there.

    The checkpoint fixes which rows a batch has before it runs.  A batch that was written but not marked as done runs again under
    its number and takes the place of what it had written, so no row is there twice and none is missing.
    """
    return _written(stream, lambda batch, _: work(batch), target, checkpoint)


def _written(stream: DataFrame, work: Callable[[DataFrame, int], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    def write(batch: DataFrame, number: int) -> None:
        work(batch, number).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class _Seen(StatefulProcessor):
    """Ids of one bucket when they come for the first time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "id string", "at int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh = sorted({i for part in rows for i in part["id"].unique() if not self.seen.containsKey((i,))})
        for i in fresh:
            self.seen.updateValue((i,), (0,))
        yield pd.DataFrame({"id": pd.Series(fresh, dtype="object")})

    def close(self) -> None:
        pass


def fresh_ids(stream: DataFrame, key: str, buckets: int = 256) -> DataFrame:
    """id: each when it is first seen; the ids seen so far live in the state store, by bucket of their hash.

    No trigger reads what others have found.  Null ids are left out; repeats within a task go before the shuffle.
    """

    def once(batches):
        for part in batches:
            yield part.drop_duplicates()

    ids = stream.select(F.col(key).cast("string").alias("id")).where("id is not null").mapInPandas(once, "id string")
    grouped = ids.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets))).groupBy("bucket")
    return grouped.transformWithStateInPandas(_Seen(), "id string", "append", "None")


def growing_ids(stream: DataFrame, path: str, checkpoint: str, key: str = "participant_id", buckets: int = 256, width: int = 6) -> StreamingQuery:
    """A query that keeps an id table at ``path`` (key, anon_id, batch): each trigger numbers ids not seen before, in their order.

    Numbers go on from those of the batches before, of which only the row counts in file footers are read.  The result is that of
    ``windows.minted`` called trigger by trigger.  The session's state store is set to RocksDB's.
    """
    keyed_state(stream.sparkSession)

    def number(batch: DataFrame, at: int) -> DataFrame:
        spark = batch.sparkSession
        before = spark.read.parquet(path).where(F.col("batch") < at).count() if exists(spark, path) else 0
        made = windows.numbered(batch, ["id"])
        return made.select(F.col("id").alias(key), windows.padded(F.col("_number") + before, width).alias("anon_id"))

    return _written(fresh_ids(stream, key, buckets), number, path, checkpoint)


def keyed_state(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def not_done(files: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Rows of a table whose key isn't in another one; for streams the checkpoint of ``written_once`` knows."""
    return files.join(done.select(key).distinct(), key, "left_anti")
