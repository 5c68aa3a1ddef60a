"""Connected components of a link table, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.shared import discard, stored


def _starred(pairs: DataFrame, small: bool) -> DataFrame:
    """Every node's neighbours tied to the least of them (small: only smaller neighbours are tied, and the node too)."""
    if small:
        near = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        tied = near.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = tied.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        near = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = near.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return stored(out.where("a <> b").distinct())


def components(pairs: DataFrame) -> DataFrame:
    """node, root (the component's least node) for all nodes of the links (a, b), the roots left out.

    Alternates large and small stars until each node hangs on its root; nulls and loops are ignored.
    """
    now = stored(pairs.select("a", "b").where("a <> b").distinct())
    before = None
    while True:
        last, middle = now, _starred(now, False)
        now = _starred(middle, True)
        discard(last, middle)
        state = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
