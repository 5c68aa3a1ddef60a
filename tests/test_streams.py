"""Streams over files and growing ids: restarts, and equality with the batch result."""

import pytest
from pyspark.sql import functions as F

from cohortforge.operators import windows
from cohortforge.streaming import incremental


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in/sub-1").mkdir(parents=True)
    return tmp_path


def run(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def test_files_are_done_once(spark, folder):
    source, target, checkpoint = (str(folder / n) for n in ("in", "out", "check"))
    seen = lambda: sorted(r.path.rsplit("/", 1)[-1] for r in spark.read.parquet(target).collect())
    stream = lambda: incremental.file_stream(spark, source)
    work = lambda df: df.select("path", "length")
    for name in ("a.wav", "sub-1/b.wav", "c.txt"):
        (folder / "in" / name).write_bytes(b"x")
    run(incremental.written_once(stream(), work, target, checkpoint))
    assert seen() == ["a.wav", "b.wav"]
    (folder / "in/d.wav").write_bytes(b"yy")

    # the batch is written, but the run ends before it is marked as done
    def dies(batch, number):
        work(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")
        raise RuntimeError("killed")

    query = stream().writeStream.foreachBatch(dies).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="killed"):
        query.awaitTermination()
    assert seen() == ["a.wav", "b.wav", "d.wav"]
    (folder / "in/e.wav").write_bytes(b"zzz")  # comes after the batch that died; has a later one
    for _ in range(2):
        run(incremental.written_once(stream(), work, target, checkpoint))
        assert seen() == ["a.wav", "b.wav", "d.wav", "e.wav"]


def test_ids_by_state_equal_the_batch_result(spark, folder):
    source, target, checkpoint = (str(folder / n) for n in ("ids", "table", "check"))
    schema = "participant_id string, x int"
    triggers = [["p3", "p1", None, "p1"] * 20, ["p2", "p3", "p9"], [], ["p1", "p0", "p9", "q"] + [f"r{i}" for i in range(40)]]
    held = spark.createDataFrame([], "participant_id string, anon_id string")
    for ids in triggers:
        new = spark.createDataFrame([(i, 0) for i in ids], schema)
        new.write.mode("append").parquet(source)
        for _ in range(2):  # the second run finds nothing new
            run(incremental.growing_ids(spark.readStream.schema(schema).parquet(source), target, checkpoint, buckets=4))
        held = spark.createDataFrame(windows.minted(new, held, "participant_id").collect(), held.schema)
        got = spark.read.parquet(target)
        assert sorted(map(tuple, got.drop("batch").collect())) == sorted(map(tuple, held.collect()))
    assert len(held.collect()) == 46


def test_long_numbers_stay_whole(spark):
    df = spark.createDataFrame([(7,), (1234567,)], "n long").select(windows.padded(F.col("n")).alias("t"))
    assert [r.t for r in df.collect()] == ["000007", "1234567"]
