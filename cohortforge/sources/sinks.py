"""Sinks: delimited tables, feature Parquet, chunked id lists, JSON reports, file copies."""

from __future__ import annotations

import itertools
import json
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortforge.operators import windows
from cohortforge.operators.tables import kept_once
from cohortforge.sources import audio, filesystems

#: Elements of one schema's dictionary that may be on the driver.
MOST_ELEMENTS = 100_000


def delimited(df: DataFrame, path: str, sep: str = "\t", partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite").options(header=True, sep=sep)
    (writer.partitionBy(partition_by) if partition_by else writer).csv(path)


def single_file(df: DataFrame, path: str, sep: str = "\t") -> None:
    """One file with a header at exactly ``path``; for tables small enough for one task."""
    spark = df.sparkSession
    df.coalesce(1).write.mode("overwrite").options(header=True, sep=sep).csv(f"{path}.parts")
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    folder = fs_path(f"{path}.parts")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    fs.delete(fs_path(path), True)
    fs.rename(part, fs_path(path))
    fs.delete(folder, True)


def feature_parquet(df: DataFrame, path: str) -> None:
    """Sorted rows, zstd level 3, 1 MiB pages, dictionaries for the ids."""
    writer = df.sortWithinPartitions("participant_id", "task_name").write.mode("overwrite")
    for key, value in {"compression": "zstd", "parquet.compression.codec.zstd.level": "3", "parquet.page.size": "1048576"}.items():
        writer = writer.option(key, value)
    for c in df.columns:
        writer = writer.option(f"parquet.enable.dictionary#{c}", str(c in ("participant_id", "session_id", "task_name")).lower())
    writer.parquet(path)


def removed_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def renamed_path(spark: SparkSession, path: str, to: str) -> None:
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (path, to))
    if not a.getFileSystem(spark._jsc.hadoopConfiguration()).rename(a, b):
        raise OSError(f"{path} can't be renamed to {to}")


def feature_bundle(df: DataFrame, path: str, files: int, ids: Sequence[str] = ("participant_id", "session_id", "task_name"), split_floats: bool = False) -> DataFrame:
    """file, n_rows, n_bytes of a bundle laid out for pruning: each participant's rows are in one file, in order, and files
    follow one another by participant.

    zstd level 3, pages of 1 MiB with an index, dictionaries for the ids.  ``split_floats``: floats outside of spectrograms are split by
    bytes, for readers on Arrow; Spark's vectorised reader doesn't know that encoding.  A participant with more than twice a file's
    share of all rows goes over several files, by task.  Files are written under another name and moved when they are whole, so a
    task that runs twice leaves one.
    """
    who, task = ids[0], ids[-1]
    sizes = kept_once(df.groupBy(who).agg(F.count("*").alias("_n")))
    share = (sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0] or 0) / max(1, files)
    large = sizes.where(F.col("_n") > 2 * share).select(F.col(who).alias("_who"), F.lit(True).alias("_large"))  # fewer than half as many as files
    dealt = df.join(F.broadcast(large), df[who].eqNullSafe(F.col("_who")), "left").withColumn("_by", F.when(F.col("_large"), F.col(task)))
    placed = dealt.repartitionByRange(files, who, "_by").sortWithinPartitions(who, task).select(*df.columns)
    floats = [f.name for f in df.schema.fields if f.name not in ids and "spectrogram" not in f.name]
    names = df.columns

    def run(batches):
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        first = next(batches, None)
        if first is None:
            return
        columns = _parquet_columns(first.schema)
        split = [c.path for c in columns if split_floats and c.physical_type in ("FLOAT", "DOUBLE") and c.path.split(".")[0] in floats]
        order = [pq.SortingColumn(names.index(c)) for c in (who, task)]
        name, n = f"{path}/part-{TaskContext.get().partitionId():05d}.parquet", 0
        with filesystems.whole(name) as sink:
            options = {"compression": "zstd", "compression_level": 3, "data_page_size": 1 << 20, "write_page_index": True, "sorting_columns": order}
            with pq.ParquetWriter(sink, first.schema, use_dictionary=list(ids), use_byte_stream_split=split or False, **options) as out:
                for batch in itertools.chain([first], batches):
                    out.write_batch(batch)
                    n += batch.num_rows
            size = sink.tell()
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n]), pa.array([size])], names=["file", "n_rows", "n_bytes"])

    return kept_once(placed.mapInArrow(run, "file string, n_rows long, n_bytes long"))


def _parquet_columns(schema) -> list:
    """The Parquet columns of an Arrow schema."""
    import pyarrow.parquet as pq

    sink = pa.BufferOutputStream()
    pq.write_table(schema.empty_table(), sink)
    found = pq.read_metadata(pa.BufferReader(sink.getvalue())).schema
    return [found.column(i) for i in range(len(found))]


def appended(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def id_chunks(df: DataFrame, column: str, size: int) -> DataFrame:
    """chunk, id: distinct ids in order, ``size`` to a chunk."""
    ids = df.select(F.col(column).cast("string").alias("id")).where("id is not null").distinct()
    return windows.numbered(ids, ["id"]).select(F.floor((F.col("_number") - 1) / size).cast("long").alias("chunk"), "id")


def json_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def dictionary_json(spark: SparkSession, elements: DataFrame, path: str, most: int = MOST_ELEMENTS) -> str:
    """The data dictionary of one schema as JSON text, written and returned; more than ``most`` elements raise ValueError."""
    rows = elements.limit(most + 1).toPandas().to_dict("records")
    if len(rows) > most:
        raise ValueError(f"a dictionary of more than {most} elements isn't made on the driver")
    text = json.dumps({"data_elements": {r.pop("column"): r for r in rows}}, indent=2, default=str)
    single = spark.createDataFrame([(text,)], "value string").coalesce(1)
    single.write.mode("overwrite").text(path)
    return text


def _each(df: DataFrame, columns: list[str], work) -> DataFrame:
    """The columns (text), n_bytes, sha256 and error of work on each row; what fails is an error of its row."""

    def run(batches):
        for batch in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    rows.append((*work(*row), None))
                except (OSError, ValueError, TypeError, AttributeError) as failure:
                    rows.append((None, None, f"{type(failure).__name__}: {failure}"))
            made = list(zip(*rows)) or [[]] * 3
            kinds = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(columns.index(c)) for c in keys), *(pa.array(c, k) for c, k in zip(made, kinds))], names=[*keys, "n_bytes", "sha256", "error"])

    keys = [c for c in columns if c != "text"]
    return df.select(*(F.col(c).cast("string") for c in columns)).mapInArrow(run, ", ".join(f"{c} string" for c in keys) + ", n_bytes long, sha256 string, error string")


def texts_written(df: DataFrame) -> DataFrame:
    """path, n_bytes, sha256, error of (path, text) rows, each written whole as one file on a file system that all executors share."""
    return _each(df, ["path", "text"], lambda path, text: filesystems.written(path, [text.encode()]))


def sidecars(recordings: DataFrame, root: str, fields: list[str]) -> DataFrame:
    """path, text of one JSON sidecar for each recording: sub-<p>/ses-<s>/audio/sub-<p>_ses-<s>_task-<label>_recording-metadata.json; blanks and underscores of a label become hyphens."""
    label = F.regexp_replace("task_name", "[ _]", "-")
    stem = F.concat(F.lit("sub-"), "participant_id", F.lit("_ses-"), "session_id", F.lit("_task-"), label)
    folder = F.concat(F.lit(f"{root}/sub-"), "participant_id", F.lit("/ses-"), "session_id", F.lit("/audio/"))
    return recordings.select(F.concat(folder, stem, F.lit("_recording-metadata.json")).alias("path"), F.to_json(F.struct(*fields)).alias("text"))


def session_files(sessions: DataFrame, root: str) -> DataFrame:
    """path, text of one sessions.tsv for each participant, rows in session order (a participant's sessions are one row here)."""
    columns = ["record_id", *(c for c in sessions.columns if c not in ("record_id", "participant_id"))]
    df = sessions if "record_id" in sessions.columns else sessions.withColumn("record_id", F.col("participant_id"))
    line = F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    order = F.coalesce(F.col("session_id").cast("string"), F.lit(""))
    grouped = df.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), line.alias("l")))).alias("rows"))
    body = F.array_join(F.concat(F.array(F.lit("\t".join(columns))), F.transform("rows", lambda r: r["l"])), "\n")
    return grouped.select(F.concat(F.lit(f"{root}/sub-"), "record_id", F.lit("/sessions.tsv")).alias("path"), F.concat(body, F.lit("\n")).alias("text"))


def failed_raise(done: DataFrame, most: int = 5) -> None:
    """OSError with the first few errors of written files, if there are any."""
    failed = [r.error for r in done.where("error is not null").limit(most).collect()]
    if failed:
        raise OSError("; ".join(failed))


def error_summary(done: DataFrame, most_files: int = 5, most_kinds: int = 3) -> DataFrame:
    """kind, n, files of failed copies: the most frequent kinds of error, each with its first few files (the report's own size)."""
    failed = done.where("error is not null").select(F.regexp_extract("error", "^([^:]*)", 1).alias("kind"), done.columns[0])
    counts = failed.groupBy("kind").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind").limit(most_kinds)
    place = F.row_number().over(Window.partitionBy("kind").orderBy(done.columns[0]))
    first = failed.join(F.broadcast(counts), "kind").withColumn("_n", place).where(F.col("_n") <= most_files)
    return first.groupBy("kind", "n").agg(F.array_sort(F.collect_list(done.columns[0])).alias("files"))


def copies(df: DataFrame) -> DataFrame:
    """source, target, n_bytes, sha256, error of (source, target) pairs, on file systems that all executors share.

    Files are copied in pieces under another name, read back, and moved when they are whole, so a lost task leaves none half.
    """
    return _each(df, ["source", "target"], filesystems.copied)


def recoded(df: DataFrame, rate: int = 16_000) -> DataFrame:
    """As ``copies``, but recordings become mono 16-bit files at the given rate."""

    def one(source: str, target: str):
        fs, path = filesystems.located(source)
        with fs.open_input_stream(path) as handle:
            x, own = audio.decoded(handle.read(), rate)
        return filesystems.written(target, [audio.encoded(x, own)])

    return _each(df, ["source", "target"], one)
