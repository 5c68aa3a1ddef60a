"""The pipeline's stages, each against a brute-force version on its own input."""

import hashlib
import struct

import pytest

import corpus_pipeline
from cohortforge.llm import bpe, quality, suffixdedup
from tests.llm.test_operators import SCHEMA, awkward, groups_by_force, key, removed_by_force


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(awkward(), SCHEMA).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(i, i % 3 and 1, 0) for i in range(1, 17)], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame([(1, "one two three four five six seven"), (2, None)], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder)


def kept_by_force(texts, length):
    """The bytes of each text that no string of the length that starts elsewhere too covers."""
    raw = [(t or "").encode() for t in texts]
    places = {}
    for k, b in enumerate(raw):
        for i in range(len(b) - length + 1):
            places.setdefault(b[i : i + length], []).append((k, i))
    gone = [bytearray(len(b)) for b in raw]
    for found in places.values():
        if len(found) > 1:
            for k, i in found:
                gone[k][i : i + length] = b"\1" * length
    return [bytes(c for c, g in zip(b, flags) if not g) for b, flags in zip(raw, gone)]


def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})


def rows(df):
    return sorted(map(tuple, df.collect()), key=key)


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_copies", "suffix_dedup", "decontamination", "tokens"]
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.select(*corpus_pipeline.COLUMNS)

    model = quality.train(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    kept = quality.score(columns, model).where("score >= 0.3").select(*corpus_pipeline.COLUMNS)
    assert rows(stages["quality"](spark, docs, tables)) == rows(kept)

    near = stages["near_copies"](spark, docs, tables)
    assert near.columns == corpus_pipeline.COLUMNS
    first = {d for d, _, c in groups_by_force([(r.doc_id, r.text) for r in docs.collect()]) if d == c}
    assert rows(near) == rows(columns.where(columns.doc_id.isin(*[d for d in first if d is not None]) | columns.doc_id.isNull() & columns.text.isNull()).distinct())

    cut = stages["suffix_dedup"](spark, docs, tables)
    assert cut.columns == corpus_pipeline.COLUMNS
    held = docs.collect()
    wanted = []
    for r, left in zip(held, kept_by_force([r.text for r in held], suffixdedup.PASSAGE)):
        text = None if r.text is None else left.decode(errors="ignore")
        cut_at_all = left != (r.text or "").encode()
        wanted.append((r.doc_id, text, r.lang, r.source, len(text) if cut_at_all else r.n_chars))
    assert any(t is not None and len(t) < len(r.text) for (_, t, *_), r in zip(wanted, held))
    assert rows(cut) == sorted(wanted, key=key)

    clean = stages["decontamination"](spark, docs, tables)
    assert rows(clean) == rows(columns.where("doc_id is null or doc_id not in (14, 15)"))
    wanted = []
    encoding = tiktoken_encoding()
    for r in held:
        raw = (r.text or "").encode()
        ids = encoding.encode_ordinary(raw.decode())
        wanted.append((r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(raw).hexdigest()))
    assert rows(stages["tokens"](spark, docs, tables)) == sorted(wanted, key=key)


def test_whole_pipeline_and_empty_tables(spark, tables):
    out = corpus_pipeline.run(spark, tables)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < out.count() < len(awkward())
    none = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, tables).count() == 0
