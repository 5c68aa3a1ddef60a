"""N-gram Jaccard join: size-aware, with subsets for small sets and inverted lists for large ones.

A text's set holds the hashes of its distinct ``SHINGLE``-word sequences.  Equal
sets are one class; classes, not texts, are joined.

Small sets (at most the boundary) are enumerated: two of them that are similar
share a subset of the size that their sizes demand, so each emits its subsets of
those sizes.  Large sets use inverted lists over the first tokens of a common
order (prefixes): n // 5 + 1 tokens suffice.  The boundary is the one with the
least cost, counted over all sets: subsets emitted against list entries scanned.

The order puts rare tokens first without a sort of all tokens: tokens in the
lowest ``RANGE`` part of the hash space (*low* ones) whose list holds at most
``COMMON`` classes, by hash; then such tokens of the rest of the space, by hash;
then the other low tokens; then the others of the rest.  Counts come from packed
exchanges.  Low tokens of all sets are counted first.  Sets with more low tokens of
their own than similar sets may differ in leave here.  Sets whose rare low tokens
don't fill their prefix are read again, and the rest of their tokens is counted
among them; other sets' prefixes hold no such token.

Each list is split by size and ties its members to one leader (the one with the
most common tokens).
A leader and its members are compared in one place by an overlap matrix.  Stars
of more than ``STAR`` members are dealt out, the leader to each part.  There each
member is also written as its difference from the leader (a bit for each of the
leader's tokens, and the tokens beyond them).  Members that didn't join the
leader's component are dealt into blocks of ``BLOCK`` and compared with their
star's members by these differences, which give exact overlaps.  Links go through
distributed components; no group is gathered.

Null and empty texts have no set and link with nothing.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm.components import components
from cohortforge.llm.shared import discard, partitions, stored, table, tidy

SHINGLE = 5
RANGE = 0.35
COMMON = 64
STAR = 128
BLOCK = 512
SCAN_COST = 4.0
LARGEST_SMALL = 12
BITMAP_BITS = 1 << 27
SHIP_BYTES = 2 << 20
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_CUT = np.uint64(int(RANGE * 2**64))


def prefix_length(n):
    """Two sets of similarity 0.8 share a token within this many first tokens of each, in any common order."""
    return n // 5 + 1


def least_overlap(n: int, m: int) -> int:
    return -(-4 * (n + m) // 9)


def similar(overlap, n, m):
    return 100 * overlap >= 80 * (n + m - overlap)


def sets_of(buf: np.ndarray, off: np.ndarray):
    """All sets of a buffer's texts, one after another, each sorted: tokens, sizes, class ids (as signed)."""
    text = B.translated(buf, B.SPACES)
    starts, ends, rows = B.word_spans(text, off)
    n_rows = len(off) - 1
    words = B.Hasher(text).spans(starts, ends)
    count = np.bincount(rows, minlength=n_rows)
    m = max(len(words) - SHINGLE + 1, 0)
    whole = rows[:m] == rows[SHINGLE - 1 :] if m else np.zeros(0, bool)
    hashes = np.zeros(m, np.uint64)
    for k in range(SHINGLE):
        hashes += words[k : k + m] * _MULT[k]
    tokens, of = B.mix(hashes[whole]), rows[:m][whole]
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        at = np.searchsorted(rows, short)
        own = [B.mix((words[a : a + c] * _MULT[:c]).sum(keepdims=True) + np.uint64(c)) for a, c in zip(at, count[short])]
        tokens, of = np.concatenate([tokens, *own]), np.concatenate([of, short])
    order = np.lexsort((tokens, of))
    tokens, of = tokens[order], of[order]
    if len(tokens):
        first = np.ones(len(tokens), bool)
        first[1:] = (tokens[1:] != tokens[:-1]) | (of[1:] != of[:-1])
        tokens, of = tokens[first], of[first]
    sizes = np.bincount(of, minlength=n_rows)
    total = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(B.mix(tokens + _MULT[0]), out=total[1:])
    cut = np.concatenate([[0], np.cumsum(sizes)])
    classes = B.mix((total[cut[1:]] - total[cut[:-1]]) * _MULT[1] + sizes.astype(np.uint64)).view(np.int64)
    return tokens, sizes, classes


def _chunked_sets(column, limit=B.CHUNK_BYTES):
    buf, off = B.utf8(column)
    for a, b in B.chunks(off, limit):
        yield a, b, *sets_of(buf[off[a] : off[b]], off[a : b + 1] - off[a])


def membership(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """id_col, n_shingles, class (null for empty sets)."""

    def run(batches):
        for batch in batches:
            for a, b, _, sizes, classes in _chunked_sets(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sizes.astype(np.int64)), pa.array(classes, mask=sizes == 0)], names=[id_col, "n_shingles", "class"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(B.trimmed(run), f"{id_col} {kind}, n_shingles long, class long")


def subset_sizes(n: int, boundary: int) -> list[int]:
    return sorted({least_overlap(n, m) for m in range(-(-4 * n // 5), min(boundary, 5 * n // 4) + 1)})


def boundary_by_cost(counts: dict[int, int]) -> int:
    """The largest size to enumerate subsets for, given how many sets have each small size."""

    def cost(boundary):
        subsets = sum(c * comb(n, k) for n, c in counts.items() if n <= boundary for k in subset_sizes(n, boundary))
        return subsets + SCAN_COST * sum(c * prefix_length(n) for n, c in counts.items() if 5 * n >= 4 * (boundary + 1))

    return min(range(LARGEST_SMALL + 1), key=lambda b: (cost(b), b))


# --- packed postings -----------------------------------------------------------------------------

_SHIPPED = "bucket int, classes binary, sizes binary, counts binary, tokens binary, places binary"
_RECORD = np.dtype([("class", "<i8"), ("token", "<u8"), ("place", "<u4"), ("size", "<u4"), ("low", "<u4"), ("common", "u1")])
_POSTING = np.dtype([("token", "<u8"), ("class", "<i8"), ("rank", "<u2"), ("band", "u1")])


def _band_starts() -> np.ndarray:
    """Sizes of similar sets are in the same band or in neighbouring ones."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 5 // 4 + 1)
    return np.array(out)


BAND_STARTS = _band_starts()


def band_of(sizes) -> np.ndarray:
    return np.searchsorted(BAND_STARTS, sizes, "right")
_PACKED = "bucket int, data binary"
#: The place of a record that stands for a class and no token of it.
_MARK = (1 << 32) - 1


def _packed_rows(buckets: np.ndarray, records: np.ndarray, n: int):
    order, cut = B.pack_ranges(buckets, n)
    records = records[order]
    full = np.flatnonzero(np.diff(cut))
    return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([records[cut[b] : cut[b + 1]].tobytes() for b in full.tolist()], pa.binary())], names=["bucket", "data"])


def _unpacked(batches, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(x for batch in batches for x in batch.column(1).to_pylist()), dtype)


def _certified(known: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens need no counting, as this task has COMMON + 1 classes of them elsewhere already; and all such tokens, in order."""
    done = np.zeros(len(tokens), bool)
    if not len(tokens):
        return done, known
    if len(known):
        near = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        done[known[near] == tokens] = True
    own = np.flatnonzero(~done)
    order = own[np.argsort(tokens[own], kind="stable")]
    new = np.flatnonzero(np.append(True, tokens[order][1:] != tokens[order][:-1])) if len(order) else order
    count = np.diff(np.append(new, len(order)))
    if (hot := count > COMMON).any():
        place = np.arange(len(order)) - np.repeat(new, count)
        done[order[(place > COMMON) & np.repeat(hot, count)]] = True
        known = np.union1d(known, tokens[order][new[hot]])
    return done, known


def _class_rows(n_buckets: int, records: np.ndarray) -> list[tuple]:
    """Records that go to the buckets of their classes (from n_buckets on) without being counted."""
    packed = _packed_rows(records["class"] & (n_buckets - 1), records, n_buckets)
    return [(b + n_buckets, data, b"", b"", b"", b"") for b, data in zip(*(c.to_pylist() for c in packed.columns))]


def _dealt(n_buckets: int, known, tokens, owner, place, classes, sizes, low) -> tuple[list[tuple], np.ndarray]:
    """Rows of ``_SHIPPED`` of tokens (each with its owner's number and its place in the owner's set), by token bucket.

    Of a token that more than COMMON classes of a task have, COMMON + 1 go to the token's bucket, enough to tell there that it is
    common; the others, being told already, go with their classes, so no bucket gathers a hot token.
    """
    told, known = _certified(known, tokens)
    rows = []
    if told.any():
        records = np.empty(int(told.sum()), _RECORD)
        records["class"], records["token"], records["place"] = classes[owner[told]], tokens[told], place[told]
        records["size"], records["low"], records["common"] = sizes[owner[told]], low[owner[told]], 1
        rows += _class_rows(n_buckets, records)
        tokens, owner, place = tokens[~told], owner[~told], place[~told]
    order, at = B.pack_ranges((tokens & np.uint64(n_buckets - 1)).astype(np.int64), n_buckets)
    tokens, owner, place = tokens[order], owner[order], place[order]
    for b in np.flatnonzero(np.diff(at)).tolist():
        part = slice(at[b], at[b + 1])
        own = owner[part]
        start = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        who = own[start]
        counts = np.diff(np.append(start, len(own)))
        rows.append((b, classes[who].tobytes(), np.stack([sizes[who], low[who]]).astype("<u4").tobytes(), counts.astype("<u4").tobytes(), tokens[part].tobytes(), place[part].astype("<u4").tobytes()))
    return rows, known


def _shipped_batch(rows: list[tuple]):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))], names=["bucket", "classes", "sizes", "counts", "tokens", "places"])


def _ship(n_buckets: int, boundary: int):
    """Each large class's low tokens by token bucket, and a mark of each class with too few of them."""

    def run(batches):
        known = np.zeros(0, np.uint64)
        for batch in batches:
            for _, _, tokens, sizes, classes in _chunked_sets(batch.column(0), SHIP_BYTES):
                cut = np.concatenate([[0], np.cumsum(sizes)])
                low = np.add.reduceat(np.append(tokens < _CUT, False), cut[:-1]) if len(sizes) else np.zeros(0, np.int64)
                low = np.where(sizes > 0, low, 0)
                _, firsts = np.unique(classes, return_index=True)
                sent = np.zeros(len(sizes), bool)
                sent[firsts] = True
                sent &= 5 * sizes >= 4 * (boundary + 1)
                of = np.repeat(np.arange(len(sizes)), sizes)
                place = np.arange(len(tokens)) - cut[of]
                keep = place < (low * sent)[of]
                rows, known = _dealt(n_buckets, known, tokens[keep], of[keep], place[keep], classes, sizes, low)
                short = np.flatnonzero(sent & (low < prefix_length(sizes)) & (sizes > low))
                if len(short):
                    marks = np.zeros(len(short), _RECORD)
                    marks["class"], marks["size"], marks["low"], marks["place"] = classes[short], sizes[short], low[short], _MARK
                    rows += _class_rows(n_buckets, marks)
                if rows:
                    yield _shipped_batch(rows)

    return run


def _ship_rest(n_buckets: int):
    """Tokens of the rest (rows class, size, low, tokens) by token bucket."""

    def run(batches):
        known = np.zeros(0, np.uint64)
        for batch in batches:
            held = batch.column(3).to_pylist()
            for a in range(0, len(held), 1024):
                sets = [np.frombuffer(x, "<u8") for x in held[a : a + 1024]]
                classes, sizes, low = (batch.column(i).slice(a, len(sets)).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
                length = np.array([len(x) for x in sets])
                owner = np.repeat(np.arange(len(sets)), length)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length) + low[owner]
                rows, known = _dealt(n_buckets, known, np.concatenate(sets), owner, place, classes, sizes, low)
                if rows:
                    yield _shipped_batch(rows)

    return run


def _count_lists(n_buckets: int):
    """Tokens of two or more classes, sent on to the buckets of their classes."""

    def run(batches):
        parts = []
        for batch in batches:
            for bucket, classes, sizes, counts, tokens, places in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket >= n_buckets:  # told already
                    yield pa.RecordBatch.from_arrays([pa.array([bucket - n_buckets], pa.int32()), pa.array([classes], pa.binary())], names=["bucket", "data"])
                    continue
                c = np.frombuffer(counts, "<u4")
                size, low = np.frombuffer(sizes, "<u4").reshape(2, -1)
                part = np.empty(len(tokens) // 8, _RECORD)
                part["class"], part["token"], part["place"] = np.repeat(np.frombuffer(classes, "<i8"), c), np.frombuffer(tokens, "<u8"), np.frombuffer(places, "<u4")
                part["size"], part["low"], part["common"] = np.repeat(size, c), np.repeat(low, c), 0
                parts.append(part)
        if not parts:
            return
        all_ = np.concatenate(parts)
        del parts
        order = np.lexsort((all_["class"], all_["token"]))
        token, cls = all_["token"][order], all_["class"][order]
        new_token = np.append(True, token[1:] != token[:-1])
        fresh = new_token | np.append(True, cls[1:] != cls[:-1])
        order, group = order[fresh], np.cumsum(new_token)[fresh] - 1
        count = np.bincount(group)[group]
        use = count >= 2
        kept = all_[order[use]]
        kept["common"] = count[use] > COMMON
        if len(kept):
            kept = kept[np.lexsort((kept["place"], kept["class"]))]
            yield _packed_rows(kept["class"] & (n_buckets - 1), kept, n_buckets)

    return run


def _by_class(r: np.ndarray):
    """Records by class and place, each once, and for each its class's number and how many common ones stand before it."""
    r = r[np.lexsort((r["place"], r["class"]))]
    # a class of several texts may have been told of a token more than once
    r = r[np.append(True, (r["class"][1:] != r["class"][:-1]) | (r["place"][1:] != r["place"][:-1]))]
    new = np.append(True, r["class"][1:] != r["class"][:-1])
    group, first = np.cumsum(new) - 1, np.flatnonzero(new)
    common = r["common"].astype(np.int64)
    before = np.cumsum(common) - common
    return r, group, first, common, before - before[first][group]


def _posting_rows(n_buckets: int, r: np.ndarray, use: np.ndarray, rare: np.ndarray, low: np.ndarray, size: np.ndarray):
    out = np.empty(len(use), _POSTING)
    out["token"], out["class"], out["band"] = r["token"][use], r["class"][use], band_of(size[use])
    out["rank"] = (rare * 65535 // np.maximum(low, 1))[use]  # a class with more common low tokens leads more
    return _packed_rows((out["token"] & np.uint64(n_buckets - 1)).astype(np.int64), out, n_buckets)


def _prefixes(n_buckets: int):
    """Low tokens of prefixes as postings by token bucket.

    Of classes that need more, a mark and the common low tokens, in buckets from -1 down.
    """

    def run(batches):
        r = _unpacked(batches, _RECORD)
        if not len(r):
            return
        r, group, first, common, before = _by_class(r)
        total = np.bincount(group, common).astype(np.int64)[group]
        size, low, place = (r[k].astype(np.int64) for k in ("size", "low", "place"))
        prefix = prefix_length(size)
        rank = np.where(common > 0, size - total + before, place - before)
        # low tokens that no other class has: with more of them than a similar pair may differ in, a class links with nothing
        alone = low - np.bincount(group, place < low).astype(np.int64)[group]
        able = alone <= size - (4 * size + 4) // 5
        lacks = able & (low - total < prefix) & (size > low)
        use = np.flatnonzero(able & (rank < prefix) & ~(lacks & (common > 0)))
        if len(use):
            yield _posting_rows(n_buckets, r, use, low - total, low, size)
        if lacks.any():
            marks = r[first[lacks[first]]]
            marks["place"], marks["common"] = _MARK, 0
            onward = np.concatenate([marks, r[lacks & (common > 0)]])
            packed = _packed_rows(onward["class"] & (n_buckets - 1), onward, n_buckets)
            yield packed.set_column(0, "bucket", pa.array((-1 - packed.column(0).to_numpy()).astype(np.int32)))

    return run


def _rest_prefixes(n_buckets: int):
    """What the prefixes of classes short of rare low tokens hold besides, as postings by token bucket."""

    def run(batches):
        r = _unpacked(batches, _RECORD)
        if not len(r):
            return
        r, group, _, common, before = _by_class(r)
        size, low, place = (r[k].astype(np.int64) for k in ("size", "low", "place"))
        is_low = place < low
        low_common = np.bincount(group, is_low).astype(np.int64)[group]
        rest_common = np.bincount(group, common * ~is_low).astype(np.int64)[group]
        rare = low - low_common
        rest_rare = size - low - rest_common
        rest_before = before - low_common  # low places come first
        rank = np.where(is_low, rare + rest_rare + before, np.where(common > 0, size - rest_common + rest_before, rare + place - low - rest_before))
        use = np.flatnonzero((rank < prefix_length(size)) & (place != _MARK))
        if len(use):
            yield _posting_rows(n_buckets, r, use, rare, low, size)

    return run


def _leaders(batches):
    """leader, member of each list with two or more classes; a list holds what two neighbouring size bands have of a token."""
    p = _unpacked(batches, _POSTING)
    if not len(p):
        return
    upper = p.copy()
    upper["band"] += 1
    p = np.concatenate([p, upper])
    p = p[np.lexsort((p["class"], p["rank"], p["band"], p["token"]))]
    new = np.append(True, (p["token"][1:] != p["token"][:-1]) | (p["band"][1:] != p["band"][:-1]))
    leader = p["class"][np.flatnonzero(new)][np.cumsum(new) - 1]
    pairs = np.unique(np.stack([leader, p["class"]], axis=1)[leader != p["class"]], axis=0)
    for a in range(0, len(pairs), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(pairs[a : a + (1 << 16), 0]), pa.array(pairs[a : a + (1 << 16), 1])], names=["leader", "member"])


def _subset_postings(n_buckets: int, boundary: int):
    """Postings of the subsets of small sets; sizes salt the keys, so each key means one size."""

    def run(batches):
        for batch in batches:
            for _, _, tokens, sizes, classes in _chunked_sets(batch.column(0)):
                cut = np.concatenate([[0], np.cumsum(sizes)])
                keys, owners, bands = [], [], []
                for i in np.flatnonzero((sizes > 0) & (sizes <= boundary)).tolist():
                    mixed = [int(x) for x in B.mix(tokens[cut[i] : cut[i + 1]] + _MULT[2])]
                    for k in subset_sizes(int(sizes[i]), boundary):
                        keys += [(sum(c) + k * 0x9E3779B97F4A7C15) & (1 << 64) - 1 for c in combinations(mixed, k)]
                        owners += [int(classes[i])] * comb(int(sizes[i]), k)
                        bands += [int(band_of(sizes[i]))] * comb(int(sizes[i]), k)
                if keys:
                    out = np.empty(len(keys), _POSTING)
                    out["token"], out["class"], out["rank"], out["band"] = B.mix(np.array(keys, np.uint64)), owners, 0, bands
                    out = np.unique(out)
                    yield _packed_rows((out["token"] & np.uint64(n_buckets - 1)).astype(np.int64), out, n_buckets)

    return run


# --- reading some texts again --------------------------------------------------------------------


class Bitmap:
    """A set of ids of bounded size; ids outside may seem inside, never the reverse."""

    def __init__(self, ids: DataFrame, count: int):
        self.bits = 1 << 20
        while self.bits < 32 * count and self.bits < BITMAP_BITS:
            self.bits *= 2
        wide, bits = 1 << 16, self.bits
        names = ["segment", "places", "bits"]

        def row(segment: int, flags: np.ndarray):
            # whichever is shorter
            at = np.flatnonzero(flags).astype("<u2").tobytes()
            return (segment, at, b"") if len(at) < wide // 8 else (segment, b"", np.packbits(flags).tobytes())

        def found(batches):
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                at = Bitmap.place(batch.column(0), bits)
                for s in np.unique(at // wide).tolist():
                    held.setdefault(s, np.zeros(wide, bool))[at[at // wide == s] % wide] = True
            rows = list(zip(*(row(s, x) for s, x in held.items()))) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(rows)], names=names)

        def united(batches):
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for s, at, packed in zip(*(c.to_pylist() for c in batch.columns)):
                    flags = held.setdefault(s, np.zeros(wide, bool))
                    flags |= np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool) if packed else False
                    flags[np.frombuffer(at, "<u2")] = True
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([np.packbits(x).tobytes() for x in held.values()], pa.binary())], names=["segment", "bits"])

        name = ids.columns[0]
        parts = ids.select(F.xxhash64(name).alias("h")).mapInArrow(B.trimmed(found), "segment int, places binary, bits binary")
        whole = parts.repartition("segment").mapInArrow(B.trimmed(united), "segment int, bits binary")
        self.data = np.zeros(bits // 8, np.uint8)
        for segment, packed in whole.toLocalIterator():  # one version of each segment
            self.data[segment * wide // 8 : (segment + 1) * wide // 8] = np.frombuffer(packed, np.uint8)

    @staticmethod
    def place(hashes, bits) -> np.ndarray:
        return (hashes.to_numpy(zero_copy_only=False).astype(np.int64) & (bits - 1)).astype(np.int64)

    def has(self, hashes) -> np.ndarray:
        at = Bitmap.place(hashes, self.bits)
        return (self.data[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def _sets_again(docs: DataFrame, ids: DataFrame, count: int, rest_only: bool) -> DataFrame:
    """doc_id, class and tokens of (at least) the texts with the given ids.  rest_only: without the low tokens."""
    sent = docs.sparkSession.sparkContext.broadcast(Bitmap(ids, count))

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(sent.value.has(batch.column(2))))
            for a, b, tokens, sizes, classes in _chunked_sets(batch.column(1)):
                cut = np.concatenate([[0], np.cumsum(sizes)])
                out = []
                for i in range(b - a):
                    own = tokens[cut[i] : cut[i + 1]]
                    out.append((own[own >= _CUT] if rest_only else own).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(classes), pa.array(out, pa.binary())], names=["doc_id", "class", "tokens"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(B.trimmed(run), f"doc_id {kind}, class long, tokens binary")


# --- comparing -----------------------------------------------------------------------------------


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Pairwise intersection sizes, by products of token incidence matrices."""
    n = len(sets)
    out = np.diag([len(s) for s in sets]).astype(np.int64)
    tokens = np.concatenate(sets)
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, of = tokens[order], of[order]
    new = np.append(True, tokens[1:] != tokens[:-1]) if len(tokens) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    shared = np.bincount(group)[group] > 1
    group, of = np.unique(group[shared], return_inverse=True)[1], of[shared]
    total = np.zeros((n, n))
    step = 4096
    for a in range(0, int(group.max(initial=-1)) + 1, step):
        at = slice(*np.searchsorted(group, [a, a + step]))
        x = np.zeros((n, step), np.float32)
        x[of[at], group[at] - a] = 1
        total += x @ x.T
    np.fill_diagonal(total, 0)
    return out + total.astype(np.int64)


def compare_star(classes: np.ndarray, sets: list[np.ndarray]):
    """The first set is the leader's.  Links that join what is similar, and whether each is joined to the leader."""
    size = np.array([len(s) for s in sets])
    near = similar(overlaps(sets), size[:, None], size[None, :])
    root = np.full(len(sets), -1)
    links = []
    for start in range(len(sets)):
        if root[start] >= 0:
            continue
        root[start], edge = start, [start]
        while edge:
            i = edge.pop()
            for j in np.flatnonzero(near[i] & (root < 0)).tolist():
                root[j] = start
                links.append((int(classes[i]), int(classes[j])))
                edge.append(j)
    return links, root == 0


_FOUND_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
_FOUND = "a long, b long, leader long, member long, joined boolean, size long, bits binary, beyond binary"


def _found_batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _FOUND_TYPES)], names=[c.split()[0] for c in _FOUND.split(", ")])


def _compare(batches):
    """Rows leader, salt, parts, member, tokens to links (a, b) and, for divided stars, each member's difference from the leader."""
    stars: dict[tuple[int, int], list] = {}
    for batch in batches:
        for leader, salt, parts, member, tokens in zip(*(batch.column(i).to_pylist() for i in range(5))):
            stars.setdefault((leader, salt), []).append((member != leader, member, parts, np.frombuffer(tokens, "<u8")))
    rows = []
    for leader, salt in sorted(stars):
        star = sorted(stars.pop((leader, salt)), key=lambda x: x[:2])
        if star[0][0]:
            raise ValueError("a leader's own set is missing")
        links, joined = compare_star(np.array([m for _, m, *_ in star]), [s for *_, s in star])
        rows += [(a, b, *[None] * 6) for a, b in links]
        if star[0][2] > 1:
            lead = star[0][3]
            for (_, m, _, own), j in zip(star[1:], joined[1:]):
                held, beyond = np.isin(lead, own, assume_unique=True), own[~np.isin(own, lead, assume_unique=True)]
                rows.append((None, None, leader, m, bool(j), len(own), np.packbits(held).tobytes(), beyond.tobytes()))
        if len(rows) > 20_000:
            yield _found_batch(rows)
            rows = []
    if rows:
        yield _found_batch(rows)


def _compared(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """Stars (leader, member) with their sets, each star dealt into parts of about STAR members."""
    spark = stars.sparkSession
    size = stored(stars.groupBy("leader").agg(F.count("*").alias("n")).select("leader", F.ceil(F.col("n") / STAR).cast("int").alias("parts")))
    salted = stars.join(size, "leader").select("leader", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int").alias("salt"), "parts", "member")
    own = size.select("leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), "parts", F.col("leader").alias("member"))
    full = salted.unionByName(own).join(sets.withColumnRenamed("class", "member"), "member")
    return full.select("leader", "salt", "parts", "member", "tokens").repartition(partitions(spark), "leader", "salt").mapInArrow(B.trimmed(_compare), _FOUND)


def _shared_beyond(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of each left with each right set."""
    a, b = np.concatenate([*left, np.zeros(0, np.uint64)]), np.concatenate([*right, np.zeros(0, np.uint64)])
    both = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(both), 4096):
        part = both[start : start + 4096]
        sides = []
        for tokens, of in ((a, np.repeat(np.arange(len(left)), [len(x) for x in left])), (b, np.repeat(np.arange(len(right)), [len(x) for x in right]))):
            at = np.searchsorted(part, tokens)
            at[at == len(part)] = 0
            hit = part[at] == tokens
            x = np.zeros((int(of.max(initial=-1)) + 1, len(part)), np.float32)
            x[of[hit], at[hit]] = 1
            sides.append(x)
        out[: len(sides[0]), : len(sides[1])] += sides[0] @ sides[1].T
    return out


def compare_differences(loose: list[tuple], members: list[tuple], step: int = 2048) -> list[tuple[int, int]]:
    """Links of loose members with members of their star, all (member, joined, size, bits, beyond); one link to the joined ones is enough."""
    links, done = [], set()
    unpack = lambda rows: np.unpackbits(np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), -1), axis=1).astype(np.float32)
    arrays = lambda rows: [np.frombuffer(r[4], "<u8") for r in rows]
    x, sizes, ids = unpack(loose), np.array([r[2] for r in loose]), np.array([r[0] for r in loose])
    for start in range(0, len(members), step):
        part = members[start : start + step]
        both = x @ unpack(part).T + _shared_beyond(arrays(loose), arrays(part))
        other = np.array([r[0] for r in part])
        near = similar(both.astype(np.int64), sizes[:, None], np.array([r[2] for r in part])[None, :]) & (ids[:, None] != other[None, :])
        for i, j in zip(*np.nonzero(near)):
            if not part[j][1]:
                links.append((int(ids[i]), int(other[j])))
            elif int(ids[i]) not in done:
                done.add(int(ids[i]))
                links.append((int(ids[i]), int(other[j])))
    return links


def _compare_loose(batches):
    """Rows leader, block, is_row, member, joined, size, bits, beyond to links."""
    groups: dict[tuple[int, int], tuple[list, list]] = {}
    for batch in batches:
        for leader, block, is_row, *rest in zip(*(batch.column(i).to_pylist() for i in range(8))):
            groups.setdefault((leader, block), ([], []))[not is_row].append(tuple(rest))
    for group in sorted(groups):
        loose, members = groups.pop(group)
        links = compare_differences(loose, members) if loose else []
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])


def _loose_links(left: DataFrame) -> DataFrame:
    """Links of members of divided stars that didn't join their leader."""
    cols = ["member", "joined", "size", "bits", "beyond"]
    loose = left.where("not joined")
    blocks = stored(loose.groupBy("leader").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    rows = loose.join(blocks, "leader").select("leader", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int").alias("block"), F.lit(True).alias("is_row"), *cols)
    columns = left.join(blocks, "leader").select("leader", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("is_row"), *cols)
    return rows.unionByName(columns).repartition(partitions(left.sparkSession), "leader", "block").mapInArrow(B.trimmed(_compare_loose), "a long, b long")


def _without_covered(stars: DataFrame) -> DataFrame:
    """Stars whose leader and members all belong to the star of the leader's own least leader go: they are compared there.

    Where two leaders are each other's least, the star of the lesser stays.  Longer circles don't occur: their stars
    would be equal, so the least of their leaders would lead all others.
    """
    over = stored(stars.groupBy("member").agg(F.min("leader").alias("over")))
    asked = stars.join(over.select(F.col("member").alias("leader"), "over"), "leader").select("leader", "member", "over")
    held = stars.select(F.col("leader").alias("over"), "member").withColumn("held", F.lit(1))
    checked = asked.join(held, ["over", "member"], "left").groupBy("leader").agg(F.min(F.when((F.col("held") == 1) | (F.col("member") == F.col("over")), 1).otherwise(0)).alias("covered"))
    back = over.select(F.col("over").alias("leader"), F.col("member").alias("of"), F.lit(1).alias("back"))
    own = over.select(F.col("member").alias("leader"), F.col("over").alias("of"))
    stays = own.join(back, ["leader", "of"]).where("leader < of").select("leader")
    covered = stored(checked.where("covered = 1").select("leader").join(stays, "leader", "left_anti"))
    return stored(stars.join(covered, "leader", "left_anti"))


def links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) between classes that join all that is similar, directly or through others."""
    spark = docs.sparkSession
    p = partitions(spark)
    n = 128
    while n < 4 * p:
        n *= 2
    small = {r.n_shingles: r["count"] for r in members.where(F.col("n_shingles").between(1, 2 * LARGEST_SMALL)).groupBy("n_shingles", "class").count().groupBy("n_shingles").count().collect()}
    boundary = boundary_by_cost(small)
    classes = stored(members.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("rep")))
    texts = docs.select("text")
    shipped = texts.mapInArrow(B.trimmed(_ship(n, boundary)), _SHIPPED)
    counted = shipped.repartition(p, "bucket").mapInArrow(B.trimmed(_count_lists(n)), _PACKED)
    postings = stored(counted.repartition(p, "bucket").mapInArrow(B.trimmed(_prefixes(n)), _PACKED))
    tidy(spark)
    short = postings.where("bucket < 0")
    poor = stored(short.mapInArrow(B.trimmed(_marks), "class long, size int, low int").join(classes, "class"), gather=True)
    count = poor.count()
    lists = postings.where("bucket >= 0")
    if count:
        again = _sets_again(docs, poor.select("rep"), count, True).join(poor, "class").where(F.col("doc_id").eqNullSafe(F.col("rep")))
        again = again.select("class", "size", "low", "tokens").mapInArrow(B.trimmed(_ship_rest(n)), _SHIPPED)
        again = again.repartition(p, "bucket").mapInArrow(B.trimmed(_count_lists(n)), _PACKED)
        again = again.unionByName(short.select((-1 - F.col("bucket")).alias("bucket"), "data"))
        lists = lists.unionByName(again.repartition(p, "bucket").mapInArrow(B.trimmed(_rest_prefixes(n)), _PACKED))
    if boundary:
        lists = lists.unionByName(texts.mapInArrow(B.trimmed(_subset_postings(n, boundary)), _PACKED))
    every = stored(lists.repartition(p, "bucket").mapInArrow(B.trimmed(_leaders), "leader long, member long").distinct())
    stars = _without_covered(every)
    discard(postings, poor, every)
    wanted = stored(stars.select(F.col("leader").alias("class")).unionByName(stars.select(F.col("member").alias("class"))).distinct().join(classes, "class"))
    sets = _sets_again(docs, wanted.select("rep"), wanted.count(), False).join(wanted, "class").where(F.col("doc_id").eqNullSafe(F.col("rep")))
    sets = stored(sets.select("class", "tokens").dropDuplicates(["class"]))
    tidy(spark)
    found = stored(_compared(stars, sets), gather=True)
    left = found.where("leader is not null")
    out = found.where("a is not null").select("a", "b")
    discard(stars, wanted, sets, classes)
    return out if left.where("not joined").isEmpty() else out.unionByName(stored(_loose_links(left), gather=True))


def _marks(batches):
    r = _unpacked(batches, _RECORD)
    r = r[r["place"] == _MARK]
    yield pa.RecordBatch.from_arrays([pa.array(r["class"]), *(pa.array(r[k].astype(np.int32)) for k in ("size", "low"))], names=["class", "size", "low"])


def grouped(docs: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """id_col, n_shingles, component_id (the least id reachable by links) of each row; the frame's other columns go."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    members = stored(membership(docs), gather=True)
    roots = components(links(docs, members))
    least = members.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    rooted = stored(least.join(roots, F.col("class") == F.col("node"), "left").select("class", F.coalesce("root", "class").alias("root"), "least"))
    whole = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    by_class = stored(rooted.join(whole, "root").select("class", "component_id"))
    out = members.join(by_class, "class", "left")
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` (with doc_id and text) with one document of each group: the one with the least id.

    Rows of equal id and text are one document.  A missing id is larger than any other.
    """
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    keyed = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", hashed.alias("h")).alias("_id"), "text")
    chosen = stored(grouped(keyed, id_col="_id").where("_id = component_id").groupBy("_id").agg(F.count("*").alias("rows")).select("_id.doc_id", "_id.h", "rows"))
    out = docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["doc_id"]) & (hashed == chosen["h"]), "left_semi")
    if chosen.where("rows > 1").isEmpty():
        return out
    one = out.withColumn("_h", hashed).dropDuplicates(["doc_id", "_h"])
    return one.select(*docs.columns)


def query(spark, sf_dir) -> DataFrame:
    return grouped(table(spark, sf_dir, "documents").select("doc_id", "text"))
