"""Lineage cuts that outlive lost executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir or the folder set on the context; a temporary one only on a local master."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cohortforge-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
        atexit.register(_gone, spark, sc.getCheckpointDir())  # a folder of this application's own
    return root


def kept_once(df: DataFrame) -> DataFrame:
    """The frame checkpointed to the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder as Parquet and read again, for loops that join their last round with itself.

    The planner takes its size from the files; that of a checkpoint comes from the plan it cuts, so a join in each round squares it, and
    after some thirty rounds the number alone fills the driver.
    """
    path = own_folder(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discarded(df: DataFrame) -> None:
    """The files of a frame that ``stored`` wrote and that nothing reads any more."""
    _gone(df.sparkSession, df._stored_at)


def _gone(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session ended before; whoever keeps the folder clears it
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def own_folder(spark: SparkSession) -> str:
    """A new folder's name in the shared one; it goes when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/cohortforge-{uuid.uuid4().hex}"
    atexit.register(_gone, spark, path)
    return path
