"""Makes this package importable in Python workers that a session starts."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Workers on this machine find the package here; on a cluster it is shipped with --py-files as usual."""
    environment = spark.sparkContext.environment
    held = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in held:
        environment["PYTHONPATH"] = os.pathsep.join([x for x in held if x] + [ROOT])
