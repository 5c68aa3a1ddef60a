"""Held-out accuracy of the queries of op3 and op7, op9's labels and scores, base columns of op9 and op10 against SQL."""

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from cohortforge.llm import licences, lm, oracles, quality, toxicity

SF, SMALL = "/root/testdata/sf0.1", "/root/testdata/sf0.001"


def held_out(df, label, sf):
    marks = {x["doc_id"]: x[label] for x in pq.read_table(f"{sf}/labels.parquet").to_pylist() if x[label] is not None}
    rows = [r for r in df.collect() if r.held_out and r.doc_id in marks]
    score, y, said = (np.array(x) for x in zip(*((r.score, marks[r.doc_id], r.predicted) for r in rows)))
    good, bad = score[y == 1], score[y == 0]
    auc = (good[:, None] > bad[None, :]).mean() + (good[:, None] == bad[None, :]).mean() / 2
    return auc, (said == y).mean(), said[y == 1].mean()


def test_toxicity_held_out(spark):
    auc, right, found = held_out(toxicity.query(spark, SF), "toxic", SF)
    assert auc > 0.9 and right > 0.95 and found > 0.75


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    auc, right, _ = held_out(quality.query(spark, sf), "quality", sf)
    assert auc > 0.98 and right > 0.95


# --- licences ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scanner():
    return licences.Scanner()


def occurrences(words, templates):
    """Template, end of each place of a word sequence."""
    k = len(words)
    return {(number, i + k) for number, t in enumerate(templates) for i in range(len(t) - k + 1) if t[i : i + k] == words}


def matches_by_force(words, templates, known, least):
    out = []
    best = []
    for i in range(len(words)):
        n = 0
        while i - n >= 0 and words[i - n] in known and occurrences(words[i - n : i + 1], templates):
            n += 1
        best.append(n)
    for i, n in enumerate(best):
        if n >= least and (i + 1 == len(words) or best[i + 1] <= n):
            out += [(number, end - n, i + 1 - n, n) for number, end in occurrences(words[i + 1 - n : i + 1], templates)]
    return sorted(out, key=lambda m: (m[0], m[2], m[1]))


def test_matches_by_force():
    templates = {"x": ["a b c d e f a b c d g", "q a b c d"], "y": ["e f a b z z z z z"]}
    small = licences.Scanner(templates, {"c d": "base"}, min_match=3)
    random = np.random.default_rng(1)
    lists = [t.split() for texts in templates.values() for t in texts]
    for _ in range(60):
        words = [("abcdefgzq?")[k] for k in random.integers(0, 10, 40)]
        for part in range(0, 40, 13):
            words[part : part + 9] = lists[int(random.integers(3))][:9]
        words = words[:45]
        coded = small.runs([w.encode() for w in words])
        assert small.matches(coded) == matches_by_force(words, lists, set("abcdefgzq"), 3)


LONG = [(label, k) for label, texts in licences.TEMPLATES.items() for k, t in enumerate(texts) if len(t.split()) >= 30]


@pytest.mark.parametrize("label, k", LONG)
def test_share_of_a_template_decides(scanner, label, k):
    """The first part of a template, and nothing else, scores its share and is labelled from the least share on.

    Where other templates hold the same words too (a notice inside a whole text), the label is one of theirs.
    """
    words = licences.TEMPLATES[label][k].encode().translate(licences.B.NON_WORD).split()
    for share in (0.4, 0.7, 1.0):
        n = round(share * len(words))
        part = b" " + b" ".join(words[:n]) + b" "
        count, _, labels, score, spans = scanner.scan(b"unknownword" + part + b"otherunknown")
        assert count == n + 2 and min(1.0, n / len(words)) - 1e-9 <= score <= 1
        holding = {x for x, t in zip(scanner.labels, scanner.templates) if part in b" " + b" ".join(t) + b" " and n / len(t) >= licences.LEAST_SHARE}
        if share > licences.LEAST_SHARE:
            assert label in holding and holding & set(labels)
            assert any((a, b) == (1, n + 1) and x in holding for a, b, x in spans)
        else:
            assert all(b - a < n or x in holding for a, b, x in spans)


def test_whole_long_licences_are_labelled(scanner):
    for name, label in licences.FILES.items():
        text = licences.pkgutil.get_data("cohortforge.llm", f"licence_files/{name}.txt")
        *_, labels, score, _ = scanner.scan(b"some code here\n" + text + b"\nmore code")
        assert label in labels and score == 1.0
        half = text[: len(text) * 3 // 10]
        *_, spans = scanner.scan(half)
        assert all(x != label or b - a < len(half.split()) * 0.9 for a, b, x in spans)


def frame(sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    return sorted(con.execute(sql).fetchall())


def test_base_columns_of_licences_in_sql(spark):
    phrases = " UNION ALL ".join(f"SELECT {p.split()!r} AS p, '{label}' AS label" for p, label in licences.BASE.items())
    sql = f"""
WITH d AS (SELECT doc_id, {oracles.WORDS} AS w FROM documents), p AS ({phrases}),
h AS (SELECT doc_id, i - 1 AS i, label FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) JOIN p ON w[i:i + len(p) - 1] = p)
SELECT d.doc_id, len(w), count(i), min(i), max(i), coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') FROM d LEFT JOIN h USING (doc_id) GROUP BY 1, 2"""
    got = licences.query(spark, SMALL).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert sorted(map(tuple, got)) == frame(sql)
    assert sum(r.n_base for r in got) > 0


def test_base_columns_of_the_language_model_in_sql(spark):
    from cohortforge.llm.periodic import _CRC

    sql = f"""
WITH d AS (SELECT doc_id, {_CRC} % 10 = 0 AS out, list_append({oracles.TOKENS}, '\n') AS t FROM documents),
x AS (SELECT doc_id, out, unnest(t) AS t FROM d),
c AS (SELECT t, count(*) AS c FROM x WHERE NOT out GROUP BY 1), n AS (SELECT sum(c) AS n, count(*) AS v FROM c)
SELECT doc_id, out, count(*), count(c), CAST(n AS BIGINT), sum(log10((coalesce(c, 0) + 0.1) / (n + 0.1 * (v + 1)))) FROM x LEFT JOIN c USING (t), n GROUP BY 1, 2, n"""
    got = sorted(map(tuple, lm.query(spark, SMALL).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score").collect()))
    wanted = frame(sql)
    assert [r[:5] for r in got] == [r[:5] for r in wanted]
    assert all(abs(a[5] - b[5]) < 1e-6 * max(1, abs(b[5])) for a, b in zip(got, wanted))
