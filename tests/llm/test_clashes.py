"""Given columns with names of a result's own are replaced; helper columns' names are free."""

import pytest
from pyspark.sql import functions as F

from cohortforge.llm import bpe, decontam, jaccard, jpeg, licences, lm, periodic, quality, rules, suffixdedup, toxicity, vectorcodes
from cohortforge.llm.shared import fresh

import public_tokenizers

TEXT = "Red fox runs over the hill and takes the long way home. " * 9
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
NAMES = ["_ranges", "_own", "_c0", "_0", "_quality", "_h", "_l", "_s", "k", "n", "cuts", "h", "class", "rep", "bucket", "DOC"]


@pytest.fixture(scope="module")
def base(spark):
    rows = [(i, None if i == 3 else TEXT + str(i % 4)) for i in range(8)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="module")
def items(spark, base):
    return spark.createDataFrame([(1, TEXT)], "item_id long, text string")




RESULTS = {
    "suffixdedup.removed": (lambda df, _: suffixdedup.removed(df, length=50), ["n_bytes", "n_removed", "n_spans", "kept"]),
    "suffixdedup.removed also": (lambda df, _: suffixdedup.removed(df, length=80, also=50), ["n_bytes", "n_removed", "n_spans", "n_repeated_50", "kept"]),
    "decontam.scan": (decontam.scan, ["n_words", "n_hit", "hit_items", "hit_spans"]),
    "toxicity.score": (lambda df, _: toxicity.score(df, toxicity.Model(share=0.5)), ["score"]),
    "quality.score": (lambda df, _: quality.score(df, quality.train(df.limit(0), df.limit(0).withColumn("quality", F.lit(1)))), ["score"]),
    "jpeg.encode_column": (lambda df, _: jpeg.encode_column(df), ["n_bytes", "media"]),
    "jpeg.round_trip": (lambda df, _: jpeg.round_trip(df), ["n_bytes", *(n for n, *_ in jpeg._OUT)]),
    "bpe.encode": (lambda df, _: bpe.encode(df, PATH, public_tokenizers.PATTERN), ["ids"]),
    "bpe.decode": (lambda df, _: bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH), ["decoded"]),
    "licences.scan": (lambda df, _: licences.scan(df), [n for n, _ in licences._OUT]),
    "periodic.scan": (lambda df, _: periodic.scan(df), list(periodic._NEW)),
    "rules.judged": (lambda df, _: rules.judged(df, df), [*rules._NEW, "base_failed", "kept"]),
}


@pytest.mark.parametrize("name", RESULTS)
def test_names_of_results_and_helpers(spark, base, items, name):
    made, own = RESULTS[name]
    plain = made(base, items)
    extra = base.withColumns({c: F.lit("given") for c in [*own, *NAMES]})
    got = made(extra, items)
    assert len({c.lower() for c in got.columns}) == len(got.columns)
    assert set(got.columns) == {*plain.columns, *NAMES}
    assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert {tuple(r) for r in got.select(*NAMES).distinct().collect()} == {("given",) * len(NAMES)}


@pytest.mark.parametrize("name", ["cut_out", "deduplicated", "keep"])
def test_filters_return_the_given_columns(spark, base, items, name):
    extra = base.withColumns({c: F.lit("given") for c in [*NAMES, "n_words", "n_hit", "hit_items", "hit_spans", "score", "n_shingles", "component_id"]})
    if name == "cut_out":
        got, ids = decontam.cut_out(extra, items), {3}
    elif name == "deduplicated":
        got, ids = jaccard.deduplicated(extra), {0, 3}
    else:  # labels of one kind reject nothing
        labels = base.select("doc_id", F.lit(0).alias("quality"))
        got, ids = quality.keep(extra, quality.train(base, labels)), set(range(8))
    assert got.columns == extra.columns
    rows = got.collect()
    assert {r.doc_id for r in rows} == ids
    assert all(r._ranges == r.n_hit == r._quality == r._h == "given" for r in rows)


def test_vector_codes(spark):
    rows = [(i, [float(i)] * 4, i % 2, "a", "b", "c", "d", "e", "f") for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string, error string, label_error string, _l string, _s string, _d string")
    for most in (1 << 20, 0):
        got = vectorcodes.with_label_error(vectorcodes.encoded(df, vectorcodes.trained(df)), most=most)
        assert sorted(got.columns) == sorted([c for c in df.columns if c != "embedding"])
        assert {(r._l, r._s, r._d) for r in got.collect()} == {("d", "e", "f")}


def test_scores_of_a_language_model(spark, base):
    extra = base.withColumns({c: F.lit("given") for c in NAMES})
    model = lm.train(base)
    assert sorted(map(str, lm.score(extra, model).collect())) == sorted(map(str, lm.score(base, model).collect()))


def test_fresh():
    assert fresh(["a", "_own", "_OWN0"]) == "_own1" and fresh([], "x") == "x"
