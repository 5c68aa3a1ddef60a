"""Where intermediate tables go, and small plan helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortforge.plans.workers import importable


#: Bytes of rows that go to a Python worker at once; the session's own setting counts where it is less.
BATCH_BYTES = 4 << 20


def prepared(spark: SparkSession) -> None:
    """Workers find this package, and batches for them are of a bounded size."""
    importable(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name, "64m").lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30}.get(held[-1:], 0)
    if int(held.rstrip("kmg") or 0) << unit > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; one of our own only where that is unset."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cohortforge-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_cleaned: set[str] = set()


def _own_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder; it goes when the application ends."""
    path = f"{shared_dir(spark)}/cohortforge/{spark.sparkContext.applicationId}"
    if path not in _cleaned:
        _cleaned.add(path)
        atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:
        return  # stopped before; the folder is left to whoever keeps the shared one
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def own_folder(spark: SparkSession) -> str:
    """The name of a new folder in this application's part of the shared one."""
    return f"{_own_dir(spark)}/{uuid.uuid4().hex}"


def stored(df: DataFrame, gather: bool = False) -> DataFrame:
    """The frame written to the shared folder and read again: a cut lineage that survives lost executors.

    ``gather``: many small parts go into few files first.
    """
    spark = df.sparkSession
    df = df.hint("rebalance") if gather else df
    prepared(spark)
    path = own_folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Tables that ``stored`` wrote and that nothing reads any more, and shuffle files of frames that are gone."""
    for frame in frames:
        if path := getattr(frame, "_stored_at", None):
            _remove(frame.sparkSession, path)
    if frames:
        tidy(frames[0].sparkSession)


def tidy(spark: SparkSession) -> None:
    """Let Spark drop shuffle files of frames that are gone."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh(names, base: str = "_own") -> str:
    """A column name that is none of the names."""
    taken, name, k = {n.lower() for n in names}, base, 0
    while name.lower() in taken:
        name, k = f"{base}{k}", k + 1
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
