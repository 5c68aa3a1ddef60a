"""The corpus pipeline: quality filter, near and exact dedup, decontamination, token counts.

Each stage takes (spark, docs, sf_dir) and gives a frame that is written as
Parquet and read again as the next stage's documents.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge.llm import bpe, decontam, jaccard, quality, suffixdedup
from cohortforge.llm.shared import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, trained on the labelled ones among them, doesn't reject."""
    model = quality.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return quality.keep(_documents(docs), model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near copies."""
    return jaccard.deduplicated(_documents(docs))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of long strings that occur more than once; n_chars counts what is left.

    Bytes of a character that a cut splits go too; a null text stays null.
    """
    done = suffixdedup.removed(_documents(docs).withColumn("_was", F.col("text").isNull()), keep_text=True, length=suffixdedup.PASSAGE)
    left = F.when(F.col("_was"), F.lit(None)).otherwise(F.col("kept")).alias("text")
    return done.select("doc_id", left, "lang", "source", "n_chars", "n_removed").select("doc_id", "text", "lang", "source", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontam.cut_out(_documents(docs), table(spark, sf_dir, "benchmark").select("item_id", "text"))


def count_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id with its token count and the digests of ids and decoded bytes."""
    import public_tokenizers

    return bpe.digest(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_benchmark),
    ("tokens", count_tokens),
]

#: No stage but the lookup of windows can be put in SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = stored(docs)
    return docs
