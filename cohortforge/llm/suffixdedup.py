"""Suffix-array dedup: repeated long byte strings by merging Burrows-Wheeler transforms.

A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else, in the same text or another.
Bytes that repeat at a shorter length (``also``) can be counted too, by a call of its own cost: then the longer repeats are
looked for in runs of the shorter ones only, which hold them all.

*Routing.*  Every string of the length is ruled by the least of its gram hashes (the leftmost of equal ones).
Equal strings have equal rulers, so strings need comparing only with those of the same ruler.  Strings with neighbouring
starts and one ruler make a context.  Contexts are counted first, in their
own text and then in all, by hash: equal contexts of several places repeat as a whole, and a ruler with one context in one
place has no repeats; both are settled without moving text.  For other rulers one copy of each context is cut from its text.
A text of more than ``FIND_BYTES`` is gone through in overlapping pieces, so its size is bounded by what a row may hold.

*Merging.*  A task cuts its contexts into shards, sorts each shard's suffixes once and goes on with Burrows-Wheeler
transforms alone (``transforms``): they are merged two by two by refining their interleave, which derives the common
prefixes of neighbours.  Intervals of two or more suffixes that share the length's bytes are the repeats.

*Hot rulers.*  A ruler with more than ``MOST`` different contexts is split: its starts go to bands by their distance from the
ruler (``BANDS`` wide, narrower at each round), keyed by a hash of the bytes that all strings of a band share.  Equal
band contexts are again settled by counting; at width one counting is everything.

A whole-corpus transform merged in one place is not attempted: its last merge would gather all text in one task.

*Equality by hash.*  Contexts are taken for equal by their ruler's and their own 64-bit hash: of w different contexts of one
ruler two are confused with a chance of at most w * w / 2**65 (of a million of one ruler: 3e-8).  Texts are one if length and
64-bit hash agree: of 10**9 texts of one length two are confused with a chance of 3 %, and then share cuts.

Null texts are empty; texts under the length lose nothing; equal texts get equal results; other columns stay as they are,
whatever their names, but for those named as the result's own, which are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm import transforms
from cohortforge.llm.jaccard import Bitmap
from cohortforge.llm.shared import discard, partitions, stored, table, tidy

LENGTH = 400
#: Bytes that 50 words hardly stay under: passages of more are found whole.
PASSAGE = 256
MOST = 250
BANDS = (48, 8, 1)
SHARD_BYTES = 512 << 10
BATCH_BYTES = 1 << 20
FIND_BYTES = 2 << 20
_PLACE_BITS = 25


# --- rulers and contexts -------------------------------------------------------------------------


def contexts(buf: np.ndarray, off: np.ndarray, length: int = LENGTH, starts: int | None = None):
    """Row, first start, last start, ruler place (all in the buffer), ruler hash and context hash of each context.

    ``starts``: only so many starts of each row are taken (its pieces overlap).
    """
    size = np.diff(off)
    n, gram = len(buf), max(1, length * 2 // 5)
    none = np.zeros(0, np.int64)
    if n < length or not (size >= length).any():
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hasher = B.Hasher(buf)
    at = np.arange(n - gram + 1)
    grams = B.mix(hasher.raw(at, at + gram))
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    keys = (grams & ~mask) | at.astype(np.uint64)
    wide = length - gram + 1
    padded = np.full(-(-len(keys) // wide) * wide, ~np.uint64(0), np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    least = np.minimum(ahead[: n - length + 1], behind[wide - 1 : wide - 1 + n - length + 1])
    valid = np.zeros(n + 1, np.int8)
    long_ = size >= length
    np.add.at(valid, off[:-1][long_], 1)
    stop = off[1:][long_] - length + 1
    np.add.at(valid, stop if starts is None else np.minimum(stop, off[:-1][long_] + starts), -1)
    starts = np.flatnonzero(np.cumsum(valid[: n - length + 1]))
    ruler = (least[starts] & mask).astype(np.int64)
    first = np.flatnonzero(np.append(True, ruler[1:] != ruler[:-1]))
    lo, hi, place = starts[first], starts[np.append(first[1:], len(starts)) - 1], ruler[first]
    row = np.searchsorted(off, lo, "right") - 1
    c = B.mix(hasher.raw(lo, hi + length) + ((place - lo) * 1315423911 + (hi - lo)).astype(np.uint64))
    return row, lo, hi, place, B.mix(grams[place] + np.uint64(1)), c


def _pieces(off: np.ndarray, length: int):
    """Rows a to b, where in the buffer their bytes to look at begin and end, and how many starts count, in bounded pieces."""
    for a, b in B.chunks(off, FIND_BYTES):
        if off[b] - off[a] <= FIND_BYTES + length:
            yield a, b, int(off[a]), int(off[b]), None
        else:  # one long text
            for at in range(int(off[a]), int(off[b]), FIND_BYTES):
                yield a, b, at, min(at + FIND_BYTES + length, int(off[b])), FIND_BYTES


def _find(length: int):
    """Each text's different contexts (m: how many places), and, with h null, its runs of contexts that it repeats itself."""
    names = ["doc_id", "k", "n", "lo", "hi", "at", "m", "h", "c"]

    def run(batches):
        for batch in batches:
            buf, off = B.utf8(batch.column(3))
            for a, b, base, to, starts in _pieces(off, length):
                inner = np.array([0, to - base]) if starts else off[a : b + 1] - base
                row, lo, hi, at, h, c = contexts(buf[base:to], inner, length, starts)
                if not len(row):
                    continue
                _, first, back, count = np.unique(B.mix(h + c * np.uint64(7) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_inverse=True, return_counts=True)
                own = np.flatnonzero(count[back] > 1)
                new = np.append(True, (row[own][1:] != row[own][:-1]) | (lo[own][1:] > hi[own][:-1] + length)) if len(own) else np.zeros(0, bool)
                heads = own[new]
                tails = own[np.append(np.flatnonzero(new)[1:] - 1, len(own) - 1)] if len(own) else own
                for where, low, high, m, marked in ((first, lo[first], hi[first], count, True), (heads, lo[heads], hi[tails], np.full(len(heads), 2), False)):
                    start = off[a:b][row[where]] - base  # of the text, seen from the piece
                    ids = [batch.column(i).slice(a, b - a).take(pa.array(row[where])) for i in range(3)]
                    hashes = [pa.array(x[where].view(np.int64), mask=None if marked else np.ones(len(where), bool)) for x in (h, c)]
                    yield pa.RecordBatch.from_arrays([*ids, *(pa.array((x - start).astype(np.int32)) for x in (low, high, at[where])), pa.array(m.astype(np.int64)), *hashes], names=names)

    return run


def repeated_starts(strings: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each string, which of its starts (of whole strings of the length) occur again among all."""
    if not strings:
        return []
    of = transforms.Strings(strings, [length])
    shard = transforms.merged(of, SHARD_BYTES)
    same = shard.common >= length
    same[:-1] |= same[1:]
    flags = np.zeros(len(of.symbols), bool)
    flags[shard.origin[same]] = True
    return [flags[a : max(a, b - length)] for a, b in zip(of.start[:-1], of.start[1:])]


# --- tables --------------------------------------------------------------------------------------

#: key: a ruler, or a band of one; c: context hash; m: places; k, n: the text's key and bytes.
_ROW = "key long, c long, m long, k long, n int, lo int, hi int, at int, body binary"
_SPAN = "k long, n int, first int, last int"
_ROW_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
_ROW_NAMES = ["key", "c", "m", "k", "n", "lo", "hi", "at", "body"]


def _cut(length: int):
    """Contexts with their bytes, from texts with lists of cuts."""

    def run(batches):
        for batch in batches:
            rows = []
            for k, n, cuts, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), B.texts_of(batch.column(3))):
                rows += [(x["h"], x["c"], x["m"], k, n, x["lo"], x["hi"], x["at"], text[x["lo"] : x["hi"] + length]) for x in cuts]
                if len(rows) > 4000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return run


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ROW_TYPES)], names=_ROW_NAMES)


def _bands(width: int, length: int):
    """Contexts cut into bands of starts by their distance from the ruler."""

    def run(batches):
        for batch in batches:
            rows = []
            for key, _, m, k, n, lo, hi, at, body in zip(*(c.to_pylist() for c in batch.columns)):
                start = lo
                while start <= hi:
                    band = (at - start) // width  # starts at - (band + 1) * width + 1 to at - band * width
                    low, high = at - (band + 1) * width + 1, at - band * width
                    a, b = start, min(high, hi)
                    own = body[a - lo : b - lo + length]
                    core = body[high - lo : low - lo + length]
                    tag = hashlib.blake2b(b"%d %d " % (key, band) + core, digest_size=8).digest()
                    c = hashlib.blake2b(b"%d %d " % (at - a, at - b) + own, digest_size=8).digest()
                    rows.append((int.from_bytes(tag, "little", signed=True), int.from_bytes(c, "little", signed=True), m, k, n, a, b, at, own))
                    start = b + 1
                if len(rows) > 4000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return run


def _merge_rows(length: int):
    """Spans of repeats in contexts that occur once, from the contexts of this task's rulers, ruler by ruler."""

    def spans_of(meta, bodies):
        rows = []
        for (_, m, k, n, lo), flags in zip(meta, repeated_starts(bodies, length)):
            if m == 1 and flags.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
                rows += [(k, n, lo + a, lo + b - 1 + length) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
        cols = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), *(pa.int32(),) * 3))], names=["k", "n", "first", "last"])

    def run(batches):
        # rows come by key; equal strings have equal keys, so batches of whole keys are enough
        meta, bodies, seen, size = [], [], set(), 0
        for batch in batches:
            for key, c, m, k, n, lo, _, _, body in zip(*(x.to_pylist() for x in batch.columns)):
                if meta and key != meta[-1][0]:
                    seen = set()
                    if size >= BATCH_BYTES:
                        yield spans_of(meta, bodies)
                        meta, bodies, size = [], [], 0
                if c not in seen:
                    seen.add(c)
                    meta.append((key, m, k, n, lo))
                    bodies.append(body)
                    size += len(body)
        if meta:
            yield spans_of(meta, bodies)

    return run


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    body = F.coalesce(text_col, F.lit(""))
    return df.select(F.col(id_col).alias("doc_id"), F.xxhash64(body).alias("k"), F.octet_length(body).alias("n"), body.alias("text"))


def spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """k, n and all (overlapping) spans of repeated bytes of the texts (doc_id, k, n, text); ``length``: from 8 on."""
    spark = texts.sparkSession
    p = partitions(spark)
    kind = dict(texts.dtypes)["doc_id"]
    found = texts.where(F.col("n") >= length).mapInArrow(B.trimmed(_find(length)), f"doc_id {kind}, k long, n int, lo int, hi int, at int, m long, h long, c long")
    found = found.persist(StorageLevel.DISK_ONLY)  # a lost part is found anew from its texts
    places = found.where("h is not null")
    # all the firsts are of one row; which one is fixed by storing it
    place = ["doc_id", "k", "n", "lo", "hi", "at"]
    counted = stored(places.groupBy("h", "c").agg(F.sum("m").alias("m"), *(F.first(c).alias(c) for c in place)))
    rulers = stored(counted.groupBy("h").agg(F.count("*").alias("kinds"), F.sum("m").alias("total")).where("total > 1").select("h", "kinds"))
    ruled = stored(counted.join(rulers, "h"))
    again = ruled.where("m > 1").select("h", "c")
    ends = (F.col("hi") + length).alias("last")
    whole = places.where("m = 1").select("h", "c", "k", "n", "lo", "hi").join(again, ["h", "c"]).select("k", "n", F.col("lo").alias("first"), ends)
    whole = stored(whole.unionByName(found.where("h is null").select("k", "n", F.col("lo").alias("first"), ends)))
    found.unpersist()
    tidy(spark)
    # one copy of each context of rulers with several
    wanted = ruled.where("kinds > 1").select("doc_id", "k", "n", F.struct("h", "c", "m", "lo", "hi", "at").alias("cut"))
    wanted = stored(wanted.groupBy("doc_id", "k", "n").agg(F.collect_list("cut").alias("cuts")))
    near = texts.where(_among(wanted.select("doc_id"), F.xxhash64("doc_id")))
    joined = near.join(wanted, near["doc_id"].eqNullSafe(wanted["doc_id"]) & (near["k"] == wanted["k"]) & (near["n"] == wanted["n"]))
    rows = stored(joined.select(near["k"], near["n"], "cuts", "text").mapInArrow(B.trimmed(_cut(length)), _ROW).dropDuplicates(["key", "c"]))
    discard(counted, rulers, ruled, wanted)
    out = [whole]
    for width in (*BANDS, 0):
        kinds = stored(rows.groupBy("key").agg(F.count("*").alias("kinds")))
        hot = kinds.where(F.col("kinds") > MOST).select("key")
        cool = rows.join(kinds.where((F.col("kinds") <= MOST) & (F.col("kinds") > 1)).select("key"), "key") if width else rows
        out.append(stored(cool.select(*_ROW_NAMES).repartition(p, "key").sortWithinPartitions("key").mapInArrow(B.trimmed(_merge_rows(length)), _SPAN), gather=True))
        if not width or hot.isEmpty():
            break
        parts = stored(rows.join(hot, "key").select(*_ROW_NAMES).mapInArrow(B.trimmed(_bands(width, length)), _ROW))
        many = stored(parts.groupBy("key", "c").agg(F.sum("m").alias("m"), F.count("*").alias("rows")))
        both = parts.drop("m").join(many, ["key", "c"])
        out.append(stored(both.where("m > 1").select("k", "n", F.col("lo").alias("first"), ends)))
        if width == 1:
            break
        spent = rows, kinds, many
        rows = stored(both.where("m = 1 or rows = 1").select(*_ROW_NAMES).unionByName(_one_each(both.where("m > 1 and rows > 1"))))
        discard(parts, *spent)
    discard(rows, kinds)
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def _among(ids: DataFrame, hashes):
    """Whether a hash is (or may be) that of one of the ids; only the hashes go to Python."""
    held = ids.sparkSession.sparkContext.broadcast(Bitmap(ids, ids.count()))

    @F.arrow_udf("boolean")
    def has(h: pa.Array) -> pa.Array:
        return pa.array(held.value.has(h))

    return has(hashes)


def _one_each(df: DataFrame) -> DataFrame:
    """One row of each context."""
    rest = [c for c in _ROW_NAMES if c not in ("key", "c")]
    return df.groupBy("key", "c").agg(F.min(F.struct(*rest)).alias("r")).select("key", "c", *(f"r.{c}" for c in rest)).select(*_ROW_NAMES)


def _joined_runs(cuts) -> list[list[int]]:
    runs: list[list[int]] = []
    for first, last in sorted(cuts):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last)
        else:
            runs.append([first, last])
    return runs


def _segments(length: int):
    """Runs of at least the length, from texts with lists of spans: text key and bytes, where in it, and the run's own bytes."""

    def run(batches):
        for batch in batches:
            rows = []
            for k, n, cuts, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), B.texts_of(batch.column(3))):
                rows += [(k, n, a, text[a:b]) for a, b in _joined_runs((x["first"], x["last"]) for x in cuts) if b - a >= length]
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["k", "n", "from", "body"])

    return run


def _united(names, keep_text: bool, also: bool):
    """Removed runs and what is left of each text; how many bytes repeat at the other length."""

    def run(batches):
        for batch in batches:
            rows = []
            for cuts, text in zip(batch.column(names.index("cuts")).to_pylist(), B.texts_of(batch.column(names.index("text")))):
                runs, others = (_joined_runs((x["first"], x["last"]) for x in cuts or () if x["also"] == which) for which in (False, True))
                kept, at = [], 0
                for a, b in runs:
                    kept.append(text[at:a])
                    at = b
                kept = b"".join([*kept, text[at:]])
                more = [sum(b - a for a, b in others)] if also else []
                rows.append((len(text), len(text) - len(kept), len(runs), *more, kept.decode(errors="ignore") if keep_text else hashlib.sha256(kept).hexdigest()))
            rest = [batch.column(i) for i, c in enumerate(names) if c not in ("cuts", "text")]
            cols = list(zip(*rows)) or [[]] * (4 + also)
            made = [*(pa.array(c, pa.int64()) for c in cols[:-1]), pa.array(cols[-1], pa.string())]
            yield pa.RecordBatch.from_arrays([*rest, *made], names=[*(c for c in names if c not in ("cuts", "text")), *(f"r{i}" for i in range(len(made)))])

    return run


def removed(df: DataFrame, *, id_col="doc_id", text_col="text", keep_text=False, length: int = LENGTH, also: int | None = None) -> DataFrame:
    """The other columns of ``df`` with n_bytes, n_removed, n_spans, n_repeated_<also> if that shorter length is given, and
    kept: the rest's sha256, or, if asked for, the rest as text, without bytes of characters that a cut has split."""
    texts = _texts(df, id_col, text_col)
    cut = lambda frame, other: frame.select("k", "n", F.struct(F.lit(other).alias("also"), "first", "last").alias("cut"))
    if also:
        shorter = stored(spans(texts, also))
        lists = stored(shorter.groupBy("k", "n").agg(F.collect_set(F.struct("first", "last")).alias("cuts")))
        near = texts.where(_among(lists.select("k"), F.xxhash64("k")))
        runs = near.join(lists, ["k", "n"]).select("k", "n", "cuts", "text").mapInArrow(B.trimmed(_segments(length)), "k long, n int, from int, body binary")
        body = F.col("body").cast("string")
        runs = stored(runs.select("k", "n", "from", F.xxhash64(body).alias("own_k"), F.octet_length(body).alias("own_n"), body.alias("text")))
        within = spans(runs.select(F.col("k").alias("doc_id"), F.col("own_k").alias("k"), F.col("own_n").alias("n"), "text"), length)
        within = within.select(F.col("k").alias("own_k"), F.col("n").alias("own_n"), "first", "last")
        placed = runs.select("k", "n", "from", "own_k", "own_n").distinct().join(within, ["own_k", "own_n"])
        longer = placed.select("k", "n", (F.col("from") + F.col("first")).alias("first"), (F.col("from") + F.col("last")).alias("last"))
        found = cut(longer, False).unionByName(cut(shorter, True))
    else:
        found = cut(spans(texts, length), False)
    cuts = stored(found.groupBy("k", "n").agg(F.collect_set("cut").alias("cuts")))
    if also:
        discard(shorter, lists, runs)
    body = F.coalesce(text_col, F.lit(""))
    made = ["n_bytes", "n_removed", "n_spans", *([f"n_repeated_{also}"] if also else [])]
    others = [c for c in df.columns if c not in (text_col, *made, "kept")]
    inner = {c: f"_{i}" for i, c in enumerate(others)}
    keyed = df.select(*(F.col(c).alias(inner[c]) for c in others), body.alias("text"), F.xxhash64(body).alias("k"), F.octet_length(body).alias("n"))
    has = _among(cuts.select("k"), F.xxhash64("k"))  # only texts that may have cuts move
    held = keyed.where(has).join(cuts, ["k", "n"], "left").select(*inner.values(), "text", "cuts")
    staying = keyed.where(~has).select(*inner.values(), "text", F.lit(None).cast(cuts.schema["cuts"].dataType).alias("cuts"))
    full = held.unionByName(staying)
    schema = full.select(*inner.values(), *(F.lit(0).cast("long").alias(f"r{i}") for i in range(len(made))), F.lit(None).cast("string").alias(f"r{len(made)}")).schema
    done = full.mapInArrow(B.trimmed(_united(full.columns, keep_text, bool(also))), schema)
    return done.select(*(F.col(inner[c]).alias(c) for c in others), *(F.col(f"r{i}").alias(c) for i, c in enumerate([*made, "kept"])))


def query(spark, sf_dir) -> DataFrame:
    done = removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))
