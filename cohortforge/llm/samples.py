"""A bounded sample of labelled rows, joined to their texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLDS = 5
MAX_TRAINING_ROWS = 20_000


def fold(id_col, folds: int = FOLDS):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def labelled(docs: DataFrame, labels: DataFrame, label: str, *, most: int = MAX_TRAINING_ROWS) -> DataFrame:
    """text, y and doc_id of at most ``most`` labelled documents outside fold 0, chosen by a hash of their ids.

    Rows without id or label are left out.  The sample of labels is what is broadcast; its bound is ``most``.
    """
    chosen = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("y").isNotNull() & (fold("doc_id") != 0))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y", "doc_id")
