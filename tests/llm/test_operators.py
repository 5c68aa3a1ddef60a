"""The training-data operators against brute-force versions on small, awkward tables."""

import hashlib
import io
import math
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortforge.llm import bpe, components, decontam, jaccard, jpeg, licences, lm, quality, suffixdedup, toxicity, transforms, warc

WORDS = "the of lorem ipsum dolor sit amet consectetur über naïve élan 中文 x1 b2".split()


def text(seed: int, n: int) -> str:
    random = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j % 97}" for j, i in enumerate(random.integers(0, len(WORDS), n)))


def awkward() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, k, n, cuts, _ranges): nulls, empties, copies, long and periodic texts."""
    long_, part = text(1, 300), text(2, 120)
    texts = {
        1: long_,
        2: long_,
        3: long_.replace("lorem5", "LOREM"),
        4: part + " tail " + text(3, 40),
        5: text(4, 30) + " " + part + " " + text(5, 10),
        6: "",
        7: None,
        8: "one two",
        9: "one  TWO",
        10: "a" * 3000,
        11: "ab" * 700 + text(6, 900),
        12: " \t\n ",
        13: "x" + "\N{GRINNING FACE}" * 210 + "\n" + "é" * 500,
        14: "one two three four five six seven",
        15: "one two three four five six seven eight",
        16: "!!! *** ### LICENSED under the mit license, and the Apache License. General Public License!",
    }
    rows = [(k, v, "en", "s", None if v is None else len(v), 1, "n", "c", 0) for k, v in texts.items()]
    return [*rows, rows[0], rows[5], (None, long_, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k long, n string, cuts string, _ranges int"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "t")
    spark.createDataFrame(awkward(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "t")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def lowered(s: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def key(row):
    return str(row)


# --- 1 -------------------------------------------------------------------------------------------


def removed_by_force(texts: list[str | None], length: int):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1)), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("most", [250, 2])
def test_suffix_dedup(docs, most, monkeypatch):
    monkeypatch.setattr(suffixdedup, "MOST", most)
    rows = docs.select("doc_id", "text").collect()
    texts = [r.text for r in rows]
    for length, *also in ((400, 256), (50,)):
        shorter = [[x[1] for x in removed_by_force(texts, n)] for n in also]
        expected = sorted(((r.doc_id, *x, *more) for r, x, *more in zip(rows, removed_by_force(texts, length), *shorter)), key=key)
        got = suffixdedup.removed(docs, length=length, also=sum(also) or None).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept", *(f"n_repeated_{n}" for n in also)).collect()
        assert sorted(map(tuple, got), key=key) == expected


def test_suffix_dedup_keeps_clashing_columns(docs, empty):
    assert suffixdedup.removed(docs).columns[:8] == ["doc_id", "lang", "source", "n_chars", "k", "n", "cuts", "_ranges"]
    assert suffixdedup.removed(empty).count() == 0


def test_suffix_dedup_of_a_text_of_several_pieces(spark):
    """A string across the pieces' border, one that a text repeats in another piece, and a hot string in many texts."""
    random = np.random.default_rng(5)
    long_ = bytes(random.integers(97, 123, 5 << 20).astype(np.uint8)).decode()
    border = suffixdedup.FIND_BYTES
    long_ = long_[: border + 70_000] + long_[1000:1500] + long_[border + 70_500 :]
    shared = bytes(random.integers(97, 123, 700).astype(np.uint8)).decode()
    rows = [(0, long_), (1, "head " + long_[border - 250 : border + 250]), *((k, f"{k} " * k + shared + f" {k * k}" * k) for k in range(2, 302))]
    got = {r.doc_id: r for r in suffixdedup.removed(spark.createDataFrame(rows, "doc_id int, text string"), also=256).collect()}
    assert (got[0].n_removed, got[0].n_spans, got[0].n_repeated_256) == (1500, 3, 1500)
    assert (got[1].n_removed, got[1].n_repeated_256) == (500, 500)
    assert all(got[k].n_removed >= 700 and got[k].n_spans == 1 for k in range(2, 302))


def test_merged_transforms_equal_one_sort():
    """Transform, order and common prefixes equal a plain sort of all suffixes; a merge sees transforms alone."""
    random = np.random.default_rng(7)
    for trial in range(120):
        letters = random.integers(1, 4) if trial % 3 else 256
        strings = [bytes(random.integers(0, letters, random.integers(0, 40)).astype(np.uint8)) for _ in range(random.integers(2, 7))]
        strings = [*strings, *(s[: len(s) // 2] for s in strings), *strings] if trial % 4 == 0 else strings
        of = transforms.Strings(strings, (9, 20))
        half = len(strings) // 2
        whole = of.shard(0, len(strings))
        parts = [transforms.Shard(x.transform, x.origin, x.common) for x in (of.shard(0, half), of.shard(half, len(strings)))]
        depths, bits = of.depths, of.bits
        many = transforms.merged(of, int(random.integers(1, 60)))
        of.symbols[:] = 0  # no text to look at
        two = transforms.merge(*parts, depths, bits)
        codes = {b: i for i, b in enumerate(sorted(set(b"".join(strings))), 1)}
        base = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])])
        suffixes = sorted((s[i:], n, int(base[n]) + i, codes[s[i - 1]] if i else 0) for n, s in enumerate(strings) for i in range(len(s) + 1))
        for shard in (whole, two, many):
            assert shard.origin.tolist() == [x[2] for x in suffixes]
            assert shard.transform.tolist() == [x[3] for x in suffixes]
        steps = [0, *([4] if bits == 16 else []), *depths]
        for (a, *_), (b, *_), common in zip(suffixes, suffixes[1:], two.common[1:].tolist()):
            shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common == (depths[-1] if a == b else max(d for d in steps if d <= shared))


# --- 2 -------------------------------------------------------------------------------------------


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame([(1, text(2, 120)[100:300]), (2, "Two"), (3, "..."), (4, None), (10, "one TWO three four five six seven eight"), (10, "one TWO three four five six seven eight")], "item_id long, text string")
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    split = lambda s: word.findall(lowered(s or ""))
    windows = {}
    for r in items.collect():
        w = split(r.text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(r.item_id)
    expected = []
    for r in docs.collect():
        w, hit, found = split(r.text), set(), set()
        for i in range(len(w)):
            for k in {len(x) for x in windows}:
                if tuple(w[i : i + k]) in windows and i + k <= len(w):
                    hit |= set(range(i, i + k))
                    found |= windows[tuple(w[i : i + k])]
        expected.append((r.doc_id, len(w), len(hit), sorted(found)))
    got = [(r.doc_id, r.n_words, r.n_hit, r.hit_items) for r in decontam.scan(docs, items).collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert decontam.scan(docs, items.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.scan(empty, items).count() == 0
    nameless = decontam.scan(docs, spark.createDataFrame([(None, text(2, 120)[100:300])], "item_id long, text string")).where("n_hit > 0")
    assert sorted(r.doc_id for r in nameless.collect()) == [4, 5] and nameless.where("size(hit_items) > 0").count() == 0
    span = decontam.scan(spark.createDataFrame([("é! one, TWO! é",)], "text string"), items).first().hit_spans[0]
    assert "é! one, TWO! é".encode()[span.first : span.last] == b"TWO"


def test_decontamination_in_groups(spark, docs, monkeypatch):
    items = spark.createDataFrame([(1, text(2, 40)), (2, text(2, 120)[150:400])], "item_id long, text string")
    whole = decontam.scan(docs, items).collect()
    monkeypatch.setattr(decontam, "MAX_PATTERN_BYTES", 8000)
    assert sorted(decontam.scan(docs, items).collect(), key=key) == sorted(whole, key=key)


# --- 3 and 7 -------------------------------------------------------------------------------------


@pytest.mark.parametrize("module", [toxicity, quality])
def test_classifiers_on_awkward_tables(spark, docs, empty, module):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 16)] * 2 + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.where("toxic = 1"), labels.limit(0)):
        model = module.train(docs, some)
        rows = module.score(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        same = {}
        for r in rows:
            assert same.setdefault(r.text or "", r.score) == r.score
        assert module.score(empty, model).count() == 0


def test_toxicity_learns(spark):
    random = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(600):
        words = [f"w{x}" for x in random.integers(0, 3000, 60)]
        toxic = i % 6 == 0
        if toxic:
            words[5], words[40], words[20] = f"vile{random.integers(99)}", "awful", "wretch"
        elif i % 5 == 0:
            words[7] = "awful"
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 6 == 0) for i in held]) > 0.95


def test_label_model_finds_accuracies_and_copies():
    random = np.random.default_rng(1)
    y = random.random(4000) < 0.3
    votes = np.stack([np.where(random.random(4000) < a, np.where(y, 1, -1), np.where(y, -1, 1)) for a in (0.95, 0.9, 0.85, 0.8)], axis=1).astype(np.int8)
    votes = np.concatenate([votes, votes[:, :1]], axis=1)
    model = toxicity.LabelModel(votes, 0.3)
    assert model.correlation[0, 4] > 0.9 and model.weight[0] < 0.6 < model.weight[2]
    assert np.mean((model.labels > 0.5) == y) > 0.9


def test_additive_model_uses_pairs():
    random = np.random.default_rng(2)
    x = random.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.AdditiveModel(x[:2000], y[:2000])
    assert np.mean((model.predict(x[2000:]) > 0.5) == y[2000:]) > 0.9


# --- 4 -------------------------------------------------------------------------------------------


def test_jpeg_round_trip(docs, empty):
    for r in jpeg.round_trip(docs).collect():
        assert r.payload_bytes % 192 == 0 and r.payload_bytes - r.n_bytes <= 192
    both = jpeg.feature_columns(jpeg.encode_column(docs)).select("doc_id", "payload_sha256", "tail_crc32", "feature").collect()
    assert sorted(map(tuple, both), key=key) == sorted(map(tuple, jpeg.round_trip(docs).select("doc_id", "payload_sha256", "tail_crc32", "feature").collect()), key=key)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.where("doc_id is not null").collect()}
    for r in jpeg.round_trip(docs).where("doc_id is not null").collect():
        payload = texts[r.doc_id] + b" " * (-len(texts[r.doc_id]) % 192 or (0 if texts[r.doc_id] else 192))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-16:])
    assert jpeg.round_trip(empty).count() == 0


def test_jpeg_general_reader_agrees():
    random = np.random.default_rng(3)
    for n in (1, 2, 9):
        data = random.integers(0, 256, 192 * n, np.uint8).tobytes()
        fast, slow = jpeg.read(jpeg.store(data)), jpeg.read(jpeg.store(data), general=True)
        assert all((a.blocks == b.blocks).all() for a, b in zip(fast.components, slow.components))
        assert jpeg.payload(slow) == data
    with pytest.raises(ValueError):
        jpeg.read(b"nothing")


def test_jpeg_runs_restarts_and_sampling():
    """A hand-made file: 2x2 luma, DC with a restart after each unit, an AC scan with an end-of-band run and a refinement."""
    segment, bits = jpeg._segment, lambda s: np.packbits([int(b) for b in s + "1" * (-len(s) % 8)]).tobytes()
    dc_table = bytes([0, 2, *[0] * 14]) + b"\x00\x03"  # 00: size 0, 01: size 3
    ac_table = bytes([0, 2, 1, *[0] * 13]) + b"\x00\x02\x11"  # 00: end of band, 01: size 2, 100: a zero, then size 1
    unit = "01" + "100" + "00" * 3 + "00" + "00"  # luma 4, three times no difference; both chroma 0
    frame = b"\x08\x00\x10\x00\x20\x03" + b"\x01\x22\x00" + b"\x02\x11\x00" + b"\x03\x11\x00"
    first = "01" + "11" + "00" + "00" * 7  # first block: coefficient 1 is 3, then ends; the others end
    refine = "00" + "1" + "00" * 7
    data = b"".join([
        b"\xff\xd8", segment(0xDB, b"\x00" + b"\x02" * 64), segment(0xC2, frame), segment(0xC4, b"\x00" + dc_table), segment(0xC4, b"\x10" + ac_table), segment(0xDD, b"\x00\x01"),
        segment(0xDA, b"\x03\x01\x00\x02\x00\x03\x00\x00\x00\x00"), bits(unit), b"\xff\xd0", bits(unit), segment(0xDD, b"\x00\x00"),
        segment(0xDA, b"\x01\x01\x00\x01\x02\x01"), bits(first), segment(0xDA, b"\x01\x01\x00\x01\x02\x10"), bits(refine), b"\xff\xd9",
    ])
    image = jpeg.read(data)
    luma = image.components[0]
    assert luma.blocks[:, 0].tolist() == [4] * 8 and luma.blocks[0, 1] == 7 and not luma.blocks[1:, 1].any()
    tensor = jpeg.pixels(image)
    assert tensor.shape == (16, 32, 3) and (tensor[8:, 8:] == 129).all()


def test_stored_tensors(docs, tmp_path):
    media = jpeg.encode_column(docs.select("doc_id", "text"))
    jpeg.tensor_column(media.withColumn("media", F.when(F.coalesce("doc_id", F.lit(0)) != 6, F.col("media")))).write.parquet(str(tmp_path / "t"))
    stored = docs.sparkSession.read.parquet(str(tmp_path / "t"))
    assert {r.tensor for r in stored.where("doc_id = 6").collect()} == {None}
    assert all(len(r.tensor.data) == r.tensor.height * r.tensor.width * 3 for r in stored.where("doc_id <> 6").collect())
    rows = lambda df: sorted(map(tuple, df.where("doc_id <> 6").select("doc_id", "feature").collect()), key=key)
    assert rows(jpeg.described(stored)) == rows(jpeg.feature_columns(media))


# --- 5 -------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    tokenizers = pytest.importorskip("public_tokenizers")
    return bpe.PrefixEncoder(bpe.read_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken")), tokenizers.PATTERN)


def test_bpe_equals_library(docs, empty, encoder):
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    for r in bpe.decode(bpe.encode(docs, path, P.PATTERN), path).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == own.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    expected = []
    for r in docs.select("doc_id", "text").collect():
        ids = own.encode_ordinary(r.text or "")
        expected.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = bpe.digest(docs, path, P.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    assert bpe.digest(empty, path, P.PATTERN).count() == 0


def test_bpe_appends_and_edits(encoder):
    random = np.random.default_rng(4)
    for _ in range(200):
        word = "".join(random.choice(list("abcdeinorstu "), random.integers(1, 90))).encode()
        last = encoder.extend(word, [])
        more = b"ing the" if random.random() < 0.5 else b"x"
        grown, state = encoder.append(word, last, more)
        assert state == encoder.extend(grown, [])
        a, b = sorted(random.integers(0, len(word) + 1, 2).tolist())
        edited, state = encoder.replace(word, last, a, b, more)
        assert state == encoder.extend(edited, []) and encoder.decode(encoder.tokens(state)) == edited


# --- 6 -------------------------------------------------------------------------------------------


def groups_by_force(rows):
    sets = []
    for doc, body in rows:
        w = re.findall("[^\x20\x09-\x0d]+", lowered(body or ""))
        sets.append((doc, frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])))
    group = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (doc, _) in zip(group, sets):
        if doc is not None:
            least[g] = min(least.get(g, doc), doc)
    return sorted(((doc, len(s), least.get(g, doc)) for g, (doc, s) in zip(group, sets)), key=key)


def test_jaccard_join(docs, empty):
    got = sorted(map(tuple, jaccard.grouped(docs).collect()), key=key)
    expected = groups_by_force([(r.doc_id, r.text) for r in docs.collect()])
    # rows without id and set stay alone, with no id to name
    assert got == expected
    assert jaccard.grouped(empty).count() == 0


@pytest.mark.parametrize("star, common", [(128, 64), (3, 2)])
def test_jaccard_clusters(spark, tmp_path, monkeypatch, star, common):
    monkeypatch.setattr(jaccard, "STAR", star)
    monkeypatch.setattr(jaccard, "COMMON", common)
    random = np.random.default_rng(5)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for c in range(12):
        base = [f"w{x}" for x in random.integers(0, 10_000, random.integers(6, 260))]
        if c % 3 == 0:
            base = base[:40] + passage + base[40:]
        for _ in range(random.integers(1, 14)):
            words = list(base)
            for _ in range(random.integers(0, 1 + len(words) // 40)):
                words[random.integers(len(words))] = f"e{random.integers(10_000)}"
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + i, " ".join(f"s{x}" for x in range(n))) for i, n in enumerate((1, 4, 5, 9, 10, 11, 12, 13, 14))]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    assert sorted(map(tuple, jaccard.grouped(docs).collect()), key=key) == groups_by_force(rows)


def test_jaccard_family_with_one_short_of_low_tokens(spark):
    """All but one have as many low tokens as their prefix; the shared ones are too common for lists."""

    def low(words):
        text = " ".join(words).encode()
        tokens, sizes, _ = jaccard.sets_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        return int((tokens < jaccard._CUT).sum()), int(sizes[0])

    bases = ([f"b{k}x{i}" for i in range(27)] for k in range(1000))
    base = next(b for b in bases if low(b) == (jaccard.prefix_length(24) - 1, 23))
    ends = [f"e{i}" for i in range(400)]
    full = [e for e in ends if low([*base, e])[0] == jaccard.prefix_length(24)][: jaccard.COMMON + 6]
    short = next(e for e in ends if low([*base, e])[0] < jaccard.prefix_length(24))
    rows = [(i, " ".join([*base, e])) for i, e in enumerate([*full, short])]
    assert {r.component_id for r in jaccard.grouped(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0}


def hot_rows():
    """Texts that all hold one passage, some of them near or exact copies of others."""
    random = np.random.default_rng(11)
    passage = " ".join(f"hot{i}" for i in range(12))
    rows = []
    for i in range(300):
        words = [f"w{x}" for x in random.integers(0, 5000, 40)]
        rows.append((len(rows), " ".join([*words[:20], passage, *words[20:]])))
        if i % 5 == 0:
            words[3 if i % 2 else 39] = "edit"
            rows += [(len(rows) + k, " ".join([*words[:20], passage, *words[20:]])) for k in range(2)]
    return rows


def test_jaccard_with_a_shingle_in_every_text(spark):
    rows = hot_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert sorted(map(tuple, jaccard.grouped(docs).collect()), key=key) == groups_by_force(rows)


def hot_short_texts(n):
    """Texts of 11 words that share five, whose shingle has a hash above the low part; each third has a near copy."""

    def token(phrase):
        b = phrase.encode()
        return jaccard.sets_of(np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0][0]

    phrase = next(p for p in (f"a{k} b c d e" for k in range(999)) if jaccard._CUT < token(p) < np.uint64(int(0.37 * 2**64)))
    rows = []
    for i in range(n):
        words = [f"{c}{i}" for c in "uvwxyz"]
        rows.append((len(rows), " ".join([*words[:3], phrase, *words[3:]])))
        if i % 3 == 0:
            rows.append((len(rows), " ".join(["more", *words[:3], phrase, *words[3:]])))
    return rows


def test_jaccard_with_a_hot_token_of_the_rest(spark, monkeypatch):
    rows = hot_short_texts(900)
    stars = []
    without_covered = jaccard._without_covered
    monkeypatch.setattr(jaccard, "LARGEST_SMALL", 0)  # lists, not subsets
    monkeypatch.setattr(jaccard, "_without_covered", lambda df: stars.append(df.groupBy("leader").count().agg(F.max("count")).first()[0]) or without_covered(df))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert sorted(map(tuple, jaccard.grouped(docs).collect()), key=key) == groups_by_force(rows)
    assert stars[0] < 8


def test_a_hot_token_of_the_rest_does_not_gather():
    import pyarrow as pa

    rows = []
    for _, t in hot_short_texts(900):
        b = t.encode()
        tokens, sizes, classes = jaccard.sets_of(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        rows.append((int(classes[0]), int(sizes[0]), int((tokens < jaccard._CUT).sum()), tokens[tokens >= jaccard._CUT].tobytes()))
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["class", "size", "low", "tokens"])
    sent = [r for b in jaccard._ship_rest(128)(iter([batch])) for r in b.to_pylist()]
    counted = Counter(t for r in sent if r["bucket"] < 128 for t in np.frombuffer(r["tokens"], "<u8").tolist())
    told = Counter(t for r in sent if r["bucket"] >= 128 for t in np.frombuffer(r["classes"], jaccard._RECORD)["token"].tolist())
    assert max(counted.values()) == jaccard.COMMON + 1
    assert max(counted[t] + told[t] for t in told) == len(rows)


def test_bitmap_of_many_tasks(spark):
    ids = spark.range(0, 60_000, 1, 7).select((F.col("id") * 3).alias("id"))
    held = jaccard.Bitmap(ids.unionByName(ids), 60_000)
    hashes = [r.h for r in spark.range(0, 180_000).select(F.xxhash64("id").alias("h")).collect()]
    got = held.has(__import__("pyarrow").array(hashes))
    assert got[::3].all() and got.mean() < 0.4
    assert not jaccard.Bitmap(ids.limit(0), 0).data.any()


def test_a_hot_token_does_not_gather():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_arrays([pa.array([t for _, t in hot_rows()[a : a + 100]])], names=["text"]) for a in (0, 100, 200, 300)]
    sent = [r for b in jaccard._ship(128, 0)(iter(batches)) for r in b.to_pylist()]
    counted = Counter(t for r in sent if r["bucket"] < 128 for t in np.frombuffer(r["tokens"], "<u8").tolist())
    told = Counter(t for r in sent if r["bucket"] >= 128 for t in np.frombuffer(r["classes"], jaccard._RECORD)["token"].tolist())
    assert told and max(counted[t] for t in told) == jaccard.COMMON + 1
    assert all(counted[t] + told[t] >= 300 for t in told)


def test_stars_that_cover_each_other(spark):
    stars = [(1, 2), (2, 1), (5, 6), (5, 7), (6, 7)]
    assert sorted(map(tuple, jaccard._without_covered(spark.createDataFrame(stars, "leader long, member long")).collect())) == [(1, 2), (5, 6), (5, 7)]


def test_subset_sizes_cover_all_pairs():
    for boundary in range(13):
        for n in range(1, boundary + 1):
            for m in range(n, boundary + 1):
                for overlap in range(n + 1):
                    if jaccard.similar(overlap, n, m):
                        k = jaccard.least_overlap(n, m)
                        assert overlap >= k and k in jaccard.subset_sizes(n, boundary) and k in jaccard.subset_sizes(m, boundary)
    for n in range(1, 3000):
        assert abs(int(jaccard.band_of(n)) - int(jaccard.band_of(5 * n // 4))) <= 1


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (5, 5)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 8 -------------------------------------------------------------------------------------------


def test_warc(spark, tmp_path):
    same, short = "<p>é" * 50, "tiny"
    rows = [(5, "u5", same, 1), (3, "u\r\n3", same, 2), (9, None, same, 3), (3, "u3", same, 4), (1, "u1", short, 5), (2, "u2", short, 6), (7, "u7", None, 7), (None, "u", same, 8), (None, "u", "other" * 40, 9), (8, "u8", "\r\n\r\n" * 40, 10)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest long")
    packages = warc.write(pages)
    got = sorted(map(tuple, warc.read(packages, True).drop("url").collect()), key=key)
    expected = []
    for page, _, html, _ in rows:
        raw = (html or "").encode()
        revisit = html == same and page != 3
        expected.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None, None if revisit else bytearray(raw)))
    assert got == sorted(expected, key=key)
    content = packages.first().content
    names = zipfile.ZipFile(io.BytesIO(bytes(content))).namelist()
    assert names == [warc.DATA, warc.INDEX, warc.ABOUT]
    assert warc.read(warc.write(pages.limit(0))).count() == 0
    for folder in (str(tmp_path / "a"), f"file://{tmp_path}/b"):
        files = warc.write_files(pages, folder)
        assert sorted(map(tuple, warc.read_files(files, True).drop("url").collect()), key=key) == got
        assert all(zipfile.ZipFile(r.path.removeprefix("file://")).testzip() is None for r in files.collect())
    assert warc.read_files(warc.write_files(pages.limit(0), str(tmp_path / "c"))).count() == 0
    named = pages.select(F.concat(F.lit("p \n:"), "page_id").alias("page_id"), "url", "html")
    texts = {r.page_id: r.refers_to for r in warc.read_files(warc.write_files(named, str(tmp_path / "d")), kind="string").collect()}
    assert texts["p \n:5"] == "p \n:3" and set(texts) == {r.page_id for r in named.collect()}


def test_ranges_alone_are_read():
    content = warc.bundle([(f"page{i}", warc.record(i, "u", b"x" * 3000, "d", None)) for i in range(1000)])
    asked = []

    class Counted(warc.RangeSource):
        def range(self, start, length):
            asked.append(length)
            return super().range(start, length)

    assert sum(1 for _ in warc.records_of(Counted(io.BytesIO(content)))) == 1000
    assert max(asked) <= warc.RANGE_BYTES and len(asked) < 20


def test_zip_reader(tmp_path):
    plain, wide = warc.package({"a": b"123", "é": b""}, zip64=False), warc.package({"a": b"123", "é": b""})
    for data in (plain, wide):
        archive = warc.ZipArchive(warc.RangeSource(data))
        assert archive.read("a") == b"123" and archive.read("é") == b"" and zipfile.ZipFile(io.BytesIO(data)).read("a") == b"123"
    path = tmp_path / "z.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.comment = b"PK\x05\x06 a comment"
        z.writestr("s", b"stored")
        z.writestr(zipfile.ZipInfo("d"), b"x" * 100, zipfile.ZIP_DEFLATED)
    with open(path, "rb") as file:
        archive = warc.ZipArchive(warc.RangeSource(file))
        assert archive.read("s") == b"stored"
        with pytest.raises(ValueError):
            archive.read("d")
    damaged = bytearray(plain)
    damaged[31] ^= 1
    with pytest.raises(ValueError):
        warc.ZipArchive(warc.RangeSource(bytes(damaged))).read("a")
    with pytest.raises(ValueError):
        warc.ZipArchive(warc.RangeSource(b"nothing"))


# --- 9 -------------------------------------------------------------------------------------------


def test_licences(docs, empty):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    for r in licences.scan(docs).collect():
        w = word.findall(lowered(r.text or ""))
        places = sorted((i, label) for p, label in licences.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert licences.scan(empty).count() == 0


def test_suffix_automaton():
    random = np.random.default_rng(6)
    for _ in range(100):
        sequences = [random.integers(0, 3, random.integers(1, 15)).tolist() for _ in range(3)]
        tokens = random.integers(0, 4, 30).tolist()
        automaton = licences.SuffixAutomaton(sequences)
        held = {tuple(s[i:j]): None for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        for i, (state, length) in enumerate(automaton.statistics(tokens)):
            best = max((k for k in range(1, i + 2) if tuple(tokens[i + 1 - k : i + 1]) in held), default=0)
            assert length == best
            ends = {(n, j) for n, s in enumerate(sequences) for j in range(length, len(s) + 1) if s[j - length : j] == tokens[i + 1 - length : i + 1]}
            assert not length or automaton.ends[state] == ends


def test_licence_chains():
    scanner = licences.Scanner()
    notice = licences.TEMPLATES["mit"][0].split()
    n, places, labels, score, spans = scanner.scan(" ".join(["foo", *notice[:20], "changed", *notice[22:], "bar"]).encode())
    assert labels == ["mit"] and not places and 0.8 < score < 1 and spans[0][:2] == (1, len(notice))
    assert scanner.scan(b"Licensed under CC BY-NC 4.0.")[2] == ["cc-by-nc"] and scanner.scan(b"licensed under cc by 4.0")[2] == ["cc-by"]
    assert scanner.scan(b"the software and the work")[2] == []


def test_whole_licence_texts(spark, tmp_path):
    scanner = licences.Scanner()
    for label, texts in licences.licence_texts.WHOLE.items():
        for body in texts:
            n, _, labels, score, spans = scanner.scan(f"Copyright 2020 somebody\n\n{body}\n\nint main() {{}}".encode())
            assert label in labels and score == 1.0 and len(spans) == 1 and spans[0][0] <= 3 and spans[0][1] >= n - 3, label
    (tmp_path / "LONG-1").write_text("A very long licence\nof many words.\n" + " ".join(f"clause{i}" for i in range(500)))
    (tmp_path / "other").write_text("not asked for")
    templates = licences.templates_from(spark, str(tmp_path), {"LONG-1": "long"})
    assert set(templates) == {*licences.TEMPLATES, "long"}
    docs = spark.createDataFrame([("x " + " ".join(f"clause{i}" for i in range(400)),)], "text string")
    assert licences.scan(docs, templates=templates).first().labels == "long"
    with pytest.raises(ValueError):
        licences.templates_from(spark, str(tmp_path), {"LONG-1": "long"}, 100)


# --- 10 ------------------------------------------------------------------------------------------


def test_lm_base_scores(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    tokens = {i: [*re.findall("[^\x20\x09-\x0d]+", lowered(t or "")), None] for i, (_, t) in enumerate(rows)}
    held = {i: d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for i, (d, _) in enumerate(rows)}
    counts = Counter(x for i, t in tokens.items() if not held[i] for x in t)
    n, v = sum(counts.values()), len(counts)
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    model = lm.train(docs.where(~F.coalesce(out, F.lit(False))))
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in lm.score(docs, model).collect()), key=key)
    expected = [(d, len(tokens[i]), sum(counts[x] > 0 for x in tokens[i]), n, round(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens[i]), 6)) for i, (d, _) in enumerate(rows)]
    assert got == sorted(expected, key=key)
    none = lm.train(empty)
    assert lm.score(empty, none).count() == 0 and lm.score(docs, none).count() == len(rows)


def test_lm_scores_by_force(spark, docs):
    """Scores token by token, with each level asked of the filter's stored segments directly."""
    model = lm.train(docs.where("doc_id % 3 <> 0"))
    stored = {r.bucket: bytes(r["keys"]) for r in model.counts.where(F.col("kind") == lm.FILTER).collect()}
    held = lm.LogFrequencyFilter([stored.get(b, bytes(8)) for b in range(model.n_buckets)])
    count = lambda k: float(held.counts(np.array([k], np.uint64))[0])
    spread = model.tokens + lm.ALPHA * (model.distinct + 1)
    expected = []
    for r in docs.where("length(text) < 4000 or text is null").select("doc_id", "text").collect():
        raw = np.frombuffer((r.text or "").encode(), np.uint8)
        tokens, _ = lm.token_hashes(raw, np.array([0, len(raw)]))
        pairs, _ = lm.pair_hashes(tokens)
        total, before = 0.0, lm.END
        for token, pair in zip(tokens, pairs):
            c1, c2 = count(before), count(pair)
            total += math.log10((min(c2, c1) + lm.PRIOR * (count(token) + lm.ALPHA) / spread) / (c1 + lm.PRIOR))
            before = token
        expected.append((r.doc_id, round(total, 6)))
    got = [(r.doc_id, round(r.score, 6)) for r in lm.score(docs.where("length(text) < 4000 or text is null"), model).collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_filter_holds_all_counts():
    random = np.random.default_rng(7)
    keys = np.unique(random.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2))
    counts = random.integers(1, 500, len(keys))
    buckets = lm.bucket_of(keys, 4)
    held = lm.LogFrequencyFilter([lm.segment(keys[buckets == b], counts[buckets == b], 1 << 20) for b in range(4)])
    assert (held.counts(keys) >= 1.5 * 2.0 ** (lm.levels_of(counts) - 1) - 0.5).all()
    assert np.mean(held.counts(lm.B.mix(keys)) > 0) < 0.1


def test_filter_grows_with_its_entries():
    n = 1024
    keys = np.arange(200_000, dtype=np.uint64) << np.uint64(16)
    sent = lm._rows([(0, lm.PAIRS, lm._low5(keys), np.ones(len(keys), "<u4").tobytes(), len(keys), 0)], lm._ARROW)
    (out,) = lm._sum_buckets(n)([sent])
    bits = next(r["keys"] for r in out.to_pylist() if r["kind"] == lm.FILTER)
    assert len(bits) * 8 >= lm.BITS_PER_KEY * len(keys)
    assert np.mean(lm.LogFrequencyFilter([bits]).counts(keys + (np.uint64(1) << np.uint64(40))) > 0) < 0.05
    with pytest.raises(ValueError):
        lm.segment(keys, np.ones(len(keys), np.int64), 1 << 20)
    assert (lm.LogFrequencyFilter([b"\xff" * 8]).levels(keys[:3]) == lm.MAX_LEVEL).all()


def test_lm_sends_nothing_that_grows_through_the_driver(spark, docs, monkeypatch):
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda *_: pytest.fail("a broadcast"))
    model = lm.train(docs)
    got = {(r.doc_id, r.n_tokens, r.score) for r in lm.score(docs, model).collect()}
    assert got and all(math.isfinite(x) and x < 0 for *_, x in got)
