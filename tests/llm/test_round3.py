"""Periodic runs, quality rules and vector codes against brute force on small, awkward tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from cohortforge.llm import periodic, rules, vectorcodes

from .test_operators import awkward, docs, empty, text  # noqa: F401


def words_of(s):
    return re.findall(r"[^\x20\x09-\x0D]+", s or "")


# --- 11 ------------------------------------------------------------------------------------------


def runs_by_force(words, least, times):
    n, least_period = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                least_period.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted((a, n, q) for (a, n), q in least_period.items())


def labelled(texts):
    labels, sizes, base = [], [], 0
    for words in texts:
        first = {}
        labels += [first.setdefault(w, base + i) for i, w in enumerate(words)] + [-1]
        sizes += [len(words)] * (len(words) + 1)
        base += len(words) + 1
    return np.array(labels, np.int64), np.array(sizes, np.int64)


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (4, 3), (7, 5)])
def test_runs_of_random_words(least, times):
    random = np.random.default_rng(times)
    for _ in range(150):
        texts = []
        for _ in range(random.integers(1, 5)):
            n = int(random.integers(0, 70))
            words = random.integers(0, random.choice([1, 2, 3, 9]), n).tolist()
            if n and random.random() < 0.6:
                a = int(random.integers(n))
                p = 1 + (n - a) // int(random.integers(2, 9))
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            texts.append(words)
        got = list(zip(*(x.tolist() for x in periodic.runs(*labelled(texts), least, times))))
        wanted, base = [], 0
        for words in texts:
            wanted += [(base + a, n, q) for a, n, q in runs_by_force(words, least, times)]
            base += len(words) + 1
        assert got == sorted(wanted, key=lambda r: (r[0], r[2]))


def test_smaller_half_moves_few_positions(monkeypatch):
    """Positions looked at stay under n log2 n, also for words that repeat in blocks of blocks."""
    seen = Counter()
    refine = periodic.Classes.refine

    def counted(self):
        seen["n"] += len(self.small)
        refine(self)

    monkeypatch.setattr(periodic.Classes, "refine", counted)
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 4000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for words in (list(fibonacci[-1]), ["x"] * 4000, [str(i % 37) for i in range(4000)], list("ab" * 1000 + "ba" * 1000)):
        seen.clear()
        labels, sizes = labelled([words])
        periodic.runs(labels, sizes)
        assert seen["n"] <= 3 * len(words) * math.log2(len(words))


def test_squares_need_two_periods():
    with pytest.raises(ValueError):
        periodic.runs(*labelled([[1, 1, 1]]), 2, 1)


def test_scan_on_awkward_table(spark, docs):  # noqa: F811
    frame = docs.withColumnsRenamed({"k": "runs", "n": "_own", "cuts": "collapsed"})
    got = periodic.scan(frame)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "_own", "_ranges", "n_words", "runs", "collapsed"]
    rows = got.collect()
    assert len(rows) == len(awkward())
    for r in rows:
        words = words_of(r.text)
        runs = runs_by_force(words, 6, 4)
        assert r.n_words == len(words)
        assert sorted((x.start, x.length, x.period) for x in r.runs) == runs
        kept = [w for i, w in enumerate(words) if not any(a + q <= i < a + n for a, n, q in runs)]
        assert r.collapsed == " ".join(kept)


def test_scan_of_no_rows(spark, empty):  # noqa: F811
    got = periodic.scan(empty, id_col="doc_id", rewrite=periodic.tail_repeated)
    assert got.count() == 0 and got.columns[-3:] == ["n_words", "runs", "collapsed"]


def test_words_in_pieces(monkeypatch):
    monkeypatch.setattr(periodic, "PIECE_BYTES", 7)
    s = ("aé b\tcc \n" * 40 + "x" * 50 + " b").encode()
    words = periodic.Words(s)
    first = {}
    assert words.codes.tolist() == [first.setdefault(w, i) for i, w in enumerate(s.split())]
    assert words.text(words.codes) == b" ".join(s.split())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small copy of the tables that the queries read, with texts that repeat themselves."""
    path = tmp_path_factory.mktemp("sf")
    rows = [(r[0], r[1]) for r in awkward()[:16]]
    rows += [(100 + i, text(i, 30 + i) + " " + " ".join(text(i, 3 + i % 7).split() * 6) + "\n" + text(i, 9)) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 3 > 0), 0) for i in range(100, 160)] + [(1, None, 1), (None, 1, 0), (100, 1, 0), (101, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def twin(folder, name, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    found = con.execute(sql)
    return [c[0] for c in found.description], sorted(found.fetchall())


def test_periodic_query(spark, folder):
    names, wanted = twin(folder, "documents", periodic.ORACLE)
    got = periodic.query(spark, folder)
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == wanted
    assert sum(r[1] > 0 for r in wanted) > 30


def test_tail_repeated():
    assert periodic.tail_repeated(None, 5) is None and periodic.tail_repeated("1", 0) is None
    hit = next(str(i) for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    n, g = 50, zlib.crc32(hit.encode()) // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    assert periodic.tail_repeated(hit, n).tolist() == [i if i < a else a + (i - a) % p for i in range(n)]


# --- 12 ------------------------------------------------------------------------------------------


def base_by_force(s):
    s = s or ""
    words = words_of(s)
    lines = [x for x in s.split("\n") if words_of(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in s), len(lines) - len(set(lines)), len(inside)


def judged_by_force(texts, trusted, deviations):
    """n-grams, log ratio and verdict of each text; trusted: (id, text)."""

    def grams(s):
        b = np.frombuffer((s or "").encode(), np.uint8)
        return rules.ngrams(b, np.array([0, len(b)]))[0].tolist()

    out = [t for i, t in trusted if i is not None and zlib.crc32(str(i).encode()) % 5 == 0]
    inside = Counter(g for i, t in trusted if i is None or zlib.crc32(str(i).encode()) % 5 for g in grams(t))
    raw = Counter(g for t in texts for g in grams(t))
    there, all_ = sum(inside.values()), sum(raw.values())

    def weight(g):
        if not there or not all_:
            return 0
        base = (raw[g] + 1) / (all_ + rules.BUCKETS)
        return round(math.log((inside[g] / base + rules.PRIOR) / (there + rules.PRIOR)) * 10**6)

    scores = [sum(map(weight, grams(t))) / len(grams(t)) for t in out if grams(t)]
    line = None
    if scores:
        scores = [round(s) for s in scores]
        mean = sum(scores) / len(scores)
        line = math.floor(mean - deviations * math.sqrt(max(0, sum(s * s for s in scores) / len(scores) - mean * mean)))
    for t in texts:
        own = grams(t)
        total = sum(map(weight, own))
        n, *_, repeated = base_by_force(t)
        failed = n < 50 or 100 * repeated > 50 * n
        yield len(own), total, failed, not failed and (line is None or total >= line * len(own))


@pytest.mark.parametrize("deviations", [0.0, 1.0, 4.0])
def test_rules_by_force(spark, folder, deviations):
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    trusted = frame.where("doc_id between 100 and 140 or doc_id in (1, 4)")
    rows = rules.judged(frame, trusted, deviations=deviations).collect()
    wanted = judged_by_force([r.text for r in rows], [tuple(r) for r in trusted.collect()], deviations)
    kept = 0
    for r, (n, total, failed, keep) in zip(rows, wanted):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_by_force(r.text)
        assert (r.n_ngrams, r.base_failed, r.kept) == (n, failed, keep)
        assert abs(r.log_ratio - total) <= n
        kept += r.kept
    assert 0 < kept < len(rows)


def test_rules_on_awkward_table(spark, docs, empty):  # noqa: F811
    frame = docs.withColumnsRenamed({"k": "kept", "n": "n_words", "cuts": "log_ratio"})
    got = rules.judged(frame, docs.limit(0))
    assert len(set(got.columns)) == len(got.columns) and got.columns[:6] == ["doc_id", "text", "lang", "source", "n_chars", "_ranges"]
    rows = got.collect()
    assert len(rows) == len(awkward())
    assert all(r.kept != r.base_failed and r.log_ratio == 0 for r in rows)
    assert rules.judged(empty, docs).count() == 0
    equal = defaultdict(set)
    for r in rules.judged(docs, docs).collect():
        equal[r.text].add((r.n_words, r.log_ratio, r.kept))
    assert all(len(x) == 1 for x in equal.values())


def test_rules_query_keeps_good_ones():
    import pyarrow.parquet as pq
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    sf = "/root/testdata/sf0.01"
    got = rules.query(spark, sf)
    assert got.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    verdict = {r.doc_id: r for r in got.collect()}
    labels = [(x["doc_id"], x["quality"]) for x in pq.read_table(f"{sf}/labels.parquet").to_pylist()]
    long_ = [(q, verdict[i].kept) for i, q in labels if not verdict[i].base_failed]
    good, bad = ([k for q, k in long_ if q == which] for which in (1, 0))
    assert sum(good) == len(good)
    assert sum(bad) < 0.5 * len(bad)
    texts = {x["doc_id"]: x["text"] for x in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    for i, r in verdict.items():
        assert tuple(r)[1:6] == base_by_force(texts[i])


def test_chosen_ids(spark):
    ids = spark.range(5000).select("id").unionByName(spark.range(100)).unionByName(spark.createDataFrame([(None,)], "id long"))
    assert rules.chosen(ids).count() == 5000
    some = rules.chosen(ids, 1000)
    assert 850 < some.count() < 1150
    assert sorted(some.collect()) == sorted(rules.chosen(ids.repartition(7), 1000).collect())


# --- 13 ------------------------------------------------------------------------------------------


def test_nearest_is_exact():
    random = np.random.default_rng(0)
    counts = {}
    for t in range(200):
        m, n, k, most = int(random.integers(1, 20)), int(random.integers(1, 60)), int(random.integers(1, 40)), int(10 ** random.uniform(0, 8))
        x, entries = random.integers(-most, most + 1, (n, m)), random.integers(-most, most + 1, (k, m))
        if t % 3 == 1:  # far from zero and near one another: float32 can't tell them apart
            x, entries = most - random.integers(0, 3, (n, m)), most - random.integers(0, 3, (k, m))
        entries[-1] = entries[0]
        index, distance = vectorcodes.nearest(x, entries, counts=counts)
        all_ = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()
    assert counts["screened"] > 1000 and counts["again"] > 1000


def vectors(n, size=8):
    random = np.random.default_rng(5)
    rows = [(int(i), [float(np.float32(x)) for x in random.normal(0, 0.3, size)], int(i % 4) if i % 5 else None) for i in random.permutation(n)]
    rows += [(n + i, rows[i][1], 1) for i in range(6)]  # copies
    rows += [(-1, None, 1), (-2, [float("nan")] * size, 2), (-3, [0.0] * (size - 1) + [None], 2), (-4, [0.5] * (size - 1) + [float("inf")], 3), (-5, [-float("inf")] * size, 3)]
    return rows


@pytest.fixture(scope="module", params=[9, 400])
def vector_folder(spark, tmp_path_factory, request):
    path = tmp_path_factory.mktemp("v")
    spark.createDataFrame(vectors(request.param), "vec_id long, embedding array<float>, label int").repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_vector_codes_query(spark, vector_folder):
    names, wanted = twin(vector_folder, "embeddings", vectorcodes.ORACLE)
    got = vectorcodes.query(spark, vector_folder)
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == wanted


def test_vector_codes_on_awkward_tables(spark):
    schema = "vec_id long, code string, v array<float>, error int, label int, label_error int, _l int"
    rows = [(3, "a", [1.0, 2.0, 3.0, 4.0, 5.0], 1, None, 1, 1), (3, "a", [0.0], 1, None, 1, 1), (None, "a", [-9.0, 7.0], 1, 2, 1, 1), (1, "b", [], 1, 2, 1, 1), (1, "b", None, 1, 2, 1, 1), (2, "c", [1.0, 2.0, 3.0, 4.0, 5.0], 1, 7, 1, 1)]
    frame = spark.createDataFrame(rows, schema)
    books = vectorcodes.trained(frame, vector_col="v", rounds=0)
    # the vectors of ids 1, 2, 3, 3, in this order, padded to eight components; a null id starts no entry
    whole = [[0] * 8, [1024, 2048, 3072, 4096, 5120, 0, 0, 0], [0] * 8, [1024, 2048, 3072, 4096, 5120, 0, 0, 0]]
    assert books.tolist() == np.stack(np.split(np.array(whole), 4, axis=1)).tolist()
    coded = vectorcodes.encoded(frame, books, vector_col="v")
    assert coded.columns == ["vec_id", "label", "label_error", "_l", "code", "error"] and coded.count() == 5
    plain = sorted(vectorcodes.with_label_error(coded).collect(), key=str)
    assert plain == sorted(vectorcodes.with_label_error(coded, most=0, salts=3).collect(), key=str)
    totals = defaultdict(int)
    for r in plain:
        totals[r.label] += r.error
    assert all(r.label_error == totals[r.label] for r in plain) and totals[2] > 0
    none = frame.limit(0)
    assert vectorcodes.encoded(none, vectorcodes.trained(none, vector_col="v"), vector_col="v").count() == 0
    assert vectorcodes.digest(np.zeros((4, 0, 0), np.int64)) == hashlib.sha256(b"").hexdigest()
    back = vectorcodes.decoded(np.frombuffer(plain[0].code, np.uint8)[None], books)
    assert back.shape == (1, 8)


def test_too_large_components_raise(spark):
    import pyarrow as pa

    with pytest.raises(ValueError):
        vectorcodes.whole(pa.array([[1e9, 0.0, 0.0, 0.0]], pa.list_(pa.float32())), 4)
