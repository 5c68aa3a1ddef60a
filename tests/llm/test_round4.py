"""Workers' memory, trusted texts without a sample."""

import gc

import pyarrow as pa
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm import rules
from cohortforge.llm.shared import prepared


def test_each_small_task_gives_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(B, "give_back", lambda: calls.append(1))
    monkeypatch.setattr(B, "_settled", True, raising=False)
    small = pa.RecordBatch.from_arrays([pa.array(["a"])], names=["text"])
    through = B.trimmed(lambda batches: batches)
    for n in (1, 2, 3):
        assert [b.num_rows for b in through(iter([small]))] == [1]
        assert len(calls) == n


def test_collections_leave_imports_out(spark):
    prepared(spark)

    def run(batches):
        list(batches)
        yield pa.RecordBatch.from_arrays([pa.array([len(gc.get_objects())])], names=["n"])

    assert max(r.n for r in spark.range(0, 4, 1, 2).mapInArrow(B.trimmed(run), "n long").collect()) < 15_000


def test_all_trusted_texts_count(spark, tmp_path, monkeypatch):
    n = 150_000
    spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text")).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.range(10, n + 20).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    labels = labels.unionByName(labels.limit(5)).unionByName(spark.createDataFrame([(None, 1), (3, 0)], "doc_id long, quality int"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    seen = []
    judged = rules.judged

    def looked(df, trusted):
        seen.append(trusted.agg(F.count("*"), F.countDistinct("doc_id"), F.min("doc_id"), F.max("doc_id")).first())
        return judged(df, trusted)

    monkeypatch.setattr(rules, "judged", looked)
    assert rules.query(spark, str(tmp_path)).count() == n
    assert tuple(seen[0]) == (n - 10, n - 10, 10, n - 1)
