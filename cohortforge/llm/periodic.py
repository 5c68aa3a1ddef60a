"""Periodic runs of words by Crochemore's partition refinement.

Positions of a text (and of all texts of a batch at once) are parted into classes of equal factors: first of one word, then
of two, and so on.  A class of factors of l words splits where the factors one word further on fell apart at the step before.
Only the smaller parts of what fell apart are looked at (*smaller half*: all children of a class but one largest), so each
position is moved a logarithmic number of times.  Members of each class are linked in the order of their positions.  If two
neighbours of a class for length l stand l words apart, a square of period l begins at the first, and its root is primitive:
any shorter period would put another member between them.  Squares of one period at consecutive positions are one run, and
l is its smallest period.

Runs of at least ``times`` periods are asked for, so every square of theirs has a class of ``times - 1`` members or more (2 at
least); smaller classes are dropped, and so are, one step later, the positions before theirs.

A text's words are bytes between ASCII white space.  Null and empty texts have no words and no runs; equal texts have equal
results; ids may be null or repeat; other columns stay, but for those with a name of the result's own, which are replaced.
Arrays of a task grow with the words of one Arrow batch, or of one text where that is longer.
"""

from __future__ import annotations

import zlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm.shared import fresh, table

LEAST, TIMES = 6, 4
#: Bytes of one text that become words at once.
PIECE_BYTES = 1 << 20
BATCH_WORDS = 1 << 20
_BLANKS = bytes(32 if b in (9, 10, 11, 12, 13) else b for b in range(256))
_NONE = np.zeros(0, np.int64)


# --- classes of equal factors --------------------------------------------------------------------


def _edges(*keys: np.ndarray) -> np.ndarray:
    """Where a new group begins in sorted keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each range, one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


class Classes:
    """Positions in classes of equal factors of ``level`` labels; a negative label ends every factor before it."""

    def __init__(self, labels: np.ndarray, members: int):
        n = len(labels)
        self.level, self.members = 1, members
        self.of = np.full(n, -1, np.int64)
        self.after, self.before = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        at = np.flatnonzero(labels >= 0)
        at = at[np.argsort(labels[at], kind="stable")]
        first = _edges(labels[at])
        size = np.diff(np.append(first, len(at)))
        kept = np.repeat(size >= members, size)
        self.order = at[kept]  # members of a class side by side
        size = size[size >= members]
        self.number = len(size)
        self.first, self.size = np.zeros(2 * n + 1, np.int64), np.zeros(2 * n + 1, np.int64)
        self.size[: self.number] = size
        self.first[: self.number] = np.cumsum(size) - size
        self.where = np.zeros(n, np.int64)
        self.where[self.order] = np.arange(len(self.order))
        self.of[self.order] = np.repeat(np.arange(self.number), size)
        self._link(self.order, self.of[self.order])
        self._marked = np.zeros(n, bool)
        self.moved = self.order
        # all positions were one class of each stretch between negative labels; its largest part need not be looked at
        stretch = np.cumsum(labels < 0)[self.order[self.first[: self.number]]]
        most = np.lexsort((size, stretch))
        most = most[np.append(stretch[most][1:] != stretch[most][:-1], True)] if len(most) else most
        small = np.ones(n, bool)
        small[self.order[_ranges(self.first[most], self.size[most])]] = False
        self.small = np.flatnonzero(small)

    def _link(self, at: np.ndarray, group: np.ndarray) -> None:
        same = group[1:] == group[:-1]
        self.after[at] = np.append(np.where(same, at[1:], -1), -1)[: len(at)]
        self.before[at] = np.append(-1, np.where(same, at[:-1], -1))[: len(at)]

    def refine(self) -> None:
        """Classes of factors one label longer.  ``moved``: positions that may have got another neighbour."""
        self.level += 1
        at = self.small - 1
        at, onward = at[at >= 0], self.small[at >= 0]
        alive = self.of[at] >= 0
        at, by = at[alive], self.of[onward[alive]]
        self.small = self.moved = _NONE
        if not len(at):
            return
        key = self.of[at] * (self.number + 1) + by + 1
        sort = np.lexsort((at, key))
        at, by, of = at[sort], by[sort], self.of[at[sort]]
        start = _edges(of, by)
        size, parent, cause = np.diff(np.append(start, len(at))), of[start], by[start]
        head = _edges(parent)
        groups = np.diff(np.append(head, len(parent)))
        whole = (np.add.reduceat(size, head) == self.size[parent[head]]) & (groups == 1) & (cause[head] >= 0)
        if whole.any():  # the whole class goes on as it is
            keep = ~np.repeat(whole, groups)
            at = at[np.repeat(keep, size)]
            size, parent, cause = size[keep], parent[keep], cause[keep]
            if not len(at):
                return
            head = _edges(parent)
            groups = np.diff(np.append(head, len(parent)))
        self._split(at, size, parent, cause, head, groups)

    def _split(self, at, size, parent, cause, head, groups) -> None:
        """Groups of positions (``at``, by parent and cause) leave their parents' classes."""
        classes = parent[head]
        taken = np.add.reduceat(size, head)
        rest, first = self.size[classes] - taken, self.first[classes]
        # out of the parents' chains
        out = at[np.lexsort((at, np.repeat(parent, size)))]
        follows = self.after[out[:-1]] == out[1:]
        left, right = self.before[out[np.append(True, ~follows)]], self.after[out[np.append(~follows, True)]]
        self.after[left[left >= 0]] = right[left >= 0]
        self.before[right[right >= 0]] = left[right >= 0]
        # to the ends of the parents' ranges; whoever stood there takes the places that became free
        slots = _ranges(first + rest, taken)
        self._marked[at] = True
        stood = self.order[slots]
        displaced = stood[~self._marked[stood]]
        self._marked[at] = False
        old = self.where[at]
        free = old[old < np.repeat(first + rest, taken)]
        self.order[free], self.where[displaced] = displaced, free
        self.order[slots], self.where[at] = at, slots
        self.size[classes] = rest
        # new classes
        lives = (cause >= 0) & (size >= self.members)
        name = np.full(len(size), -1, np.int64)
        name[lives] = np.arange(self.number, self.number + lives.sum())
        self.first[name[lives]], self.size[name[lives]] = slots[np.cumsum(size) - size][lives], size[lives]
        self.number += int(lives.sum())
        self.of[at] = np.repeat(name, size)
        self._link(at, np.repeat(np.arange(len(size)), size))
        # all parts but a largest one are looked at next; parts that are too small, always
        living = np.where(lives, size, 0)
        most = np.maximum.reduceat(living, head)
        rest_lives = rest >= self.members
        rest_most = rest_lives & (rest >= most)
        candidate = np.flatnonzero(lives & (living == np.repeat(most, groups)) & ~np.repeat(rest_most, groups))
        candidate = candidate[_edges(parent[candidate])] if len(candidate) else candidate
        seen = np.ones(len(size), bool)
        seen[candidate] = False
        look = ~rest_most & (rest > 0)
        others = self.order[_ranges(first[look], rest[look])]
        gone = self.order[_ranges(first[~rest_lives], rest[~rest_lives])]
        self.of[gone] = -1
        self.size[classes[~rest_lives]] = 0
        self.small = np.concatenate([at[np.repeat(seen, size)], others])
        self.moved = np.concatenate([left[(left >= 0) & (right >= 0)], at[np.repeat(lives, size)]])


class _Waiting:
    """Positions by the distance to their neighbour, until the level gets there."""

    def __init__(self, classes: Classes, most: np.ndarray):
        self.classes, self.most = classes, most
        self.gaps = self.at = self.new_gaps = self.new = _NONE

    def add(self, at: np.ndarray) -> None:
        gap = self.classes.after[at] - at
        near = (gap >= self.classes.level) & (gap <= self.most[at])
        if near.any():
            self.new_gaps, self.new = np.append(self.new_gaps, gap[near]), np.append(self.new, at[near])
        if len(self.new) > max(4096, len(self.at) // 2):
            self.sort()

    def sort(self) -> None:
        gaps, at = np.append(self.gaps, self.new_gaps), np.append(self.at, self.new)
        held = (gaps >= self.classes.level) & (self.classes.after[at] - at == gaps) & (self.classes.of[at] >= 0)
        gaps, at = gaps[held], at[held]
        sort = np.argsort(gaps, kind="stable")
        self.gaps, self.at = gaps[sort], at[sort]
        self.new_gaps = self.new = _NONE

    def take(self) -> np.ndarray:
        """Positions whose neighbour is as far as the level is long, in order."""
        level = self.classes.level
        a, b = np.searchsorted(self.gaps, [level, level + 1])
        at = np.append(self.at[a:b], self.new[self.new_gaps == level])
        if not len(at):
            return at
        at = at[(self.classes.after[at] - at == level) & (self.classes.of[at] >= 0)]
        return np.unique(at)


def runs(labels: np.ndarray, stretch: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every maximal run of at least ``times`` periods and ``least`` labels.

    ``labels``: equal where words are equal, negative between texts; texts share no label.  ``stretch``: for each position,
    the words of its text.
    """
    if times < 2:
        raise ValueError("runs of fewer than two periods are no squares")
    most = stretch // times
    last = int(most.max(initial=0))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if last:
        classes = Classes(labels, max(2, times - 1))
        waiting = _Waiting(classes, most)
        while classes.level <= last:
            waiting.add(classes.moved)
            at = waiting.take()
            if len(at):
                lead = np.flatnonzero(np.append(True, at[1:] != at[:-1] + 1))
                length = np.diff(np.append(lead, len(at))) - 1 + 2 * classes.level
                long_ = length >= max(least, times * classes.level)
                found.append((at[lead[long_]], length[long_], np.full(int(long_.sum()), classes.level)))
            if not len(classes.small):  # no class will split again
                classes.level += 1
                classes.moved = _NONE
                waiting.sort()
                if not len(waiting.gaps):
                    break
                classes.level = int(waiting.gaps[0])
                continue
            classes.refine()
    start, length, period = (np.concatenate(x) for x in zip(*found)) if found else (_NONE,) * 3
    sort = np.lexsort((period, start))
    return start[sort], length[sort], period[sort]


# --- texts ---------------------------------------------------------------------------------------


class Words:
    """A text's words as codes: the place where a word stands first."""

    def __init__(self, text: bytes):
        flat, first, number, parts, at = text.translate(_BLANKS), {}, count(), [], 0
        while at < len(flat):
            to = flat.find(b" ", at + PIECE_BYTES)
            to = len(flat) if to < 0 else to
            words = flat[at:to].split()
            parts.append(np.fromiter(map(first.setdefault, words, number), np.int64, len(words)))
            at = to
        self.codes = np.concatenate(parts) if parts else _NONE
        self.word = {code: word for word, code in first.items()}

    def text(self, codes: np.ndarray) -> bytes:
        return b" ".join(map(self.word.__getitem__, codes.tolist()))


def collapsed(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words stay: all but those of a run behind its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:n]) == 0


def tail_repeated(doc_id: str | None, n: int) -> np.ndarray | None:
    """The contract's rewriting of the words of each tenth text: from word a on, the first p of them again and again."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(doc_id.encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_NEW = {"n_words": "long", "runs": "array<struct<start:bigint,length:bigint,period:bigint>>", "collapsed": "string"}


def _scan_texts(texts, ids, rewrite, least, times):
    """Words, runs and collapsed text of each text of a batch."""
    held, labels, sizes, base = [], [], [], 0
    for text, own in zip(texts, ids):
        words = Words(text)
        at = rewrite(own, len(words.codes)) if rewrite else None
        if at is not None:
            words.codes = words.codes[at]
        held.append(words)
        labels += [words.codes + base, np.array([-1])]
        sizes.append(len(words.codes))
        base += len(words.codes) + 1
    sizes = np.array(sizes, np.int64)
    start, length, period = runs(np.concatenate(labels), np.repeat(sizes, sizes + 1), least, times)
    first = np.cumsum(sizes + 1) - sizes - 1
    row = np.searchsorted(first, start, "right") - 1
    cut = np.searchsorted(row, np.arange(len(sizes) + 1))
    for i, words in enumerate(held):
        s, k, p = (x[cut[i] : cut[i + 1]] for x in (start - first[row], length, period))
        codes = words.codes[collapsed(len(words.codes), s, k, p)] if len(s) else words.codes
        yield len(words.codes), [{"start": a, "length": b, "period": c} for a, b, c in zip(s.tolist(), k.tolist(), p.tolist())], words.text(codes).decode()


def scan(df: DataFrame, *, text_col="text", id_col: str | None = None, rewrite=None, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``df`` with n_words, runs (start, length, period; by start, then period) and collapsed (the words no run repeats).

    ``rewrite``: takes a row's id as text and its number of words and gives the words' new order by index, or None.
    """
    kept = df.drop(*_NEW)
    names = kept.columns
    own = fresh(names)
    sent = kept.withColumn(own, F.col(id_col).cast("string") if id_col else F.lit(None).cast("string"))
    schema = kept.withColumns({n: F.lit(None).cast(t) for n, t in _NEW.items()}).schema

    def run(batches):
        for batch in batches:
            column, ids = batch.column(names.index(text_col)), batch.column(len(names))
            _, off = B.utf8(column)
            for a, b in B.chunks(off, 4 << 20):
                rows = list(zip(*_scan_texts(B.texts_of(column.slice(a, b - a)), ids.slice(a, b - a).to_pylist(), rewrite, least, times)))
                made = [pa.array(rows[0], pa.int64()), pa.array(rows[1], _RUNS), pa.array(rows[2], pa.string())]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[: len(names)]), *made], names=[*names, *_NEW])

    return sent.mapInArrow(B.trimmed(run), schema)


def longest(runs_col="runs"):
    """The run of greatest length; of equal ones that with the smallest start, then period; null without runs."""
    keyed = F.transform(runs_col, lambda r: F.struct((-r["length"]).alias("a"), r["start"].alias("b"), r["period"].alias("c"), r["length"].alias("n")))
    return F.array_min(keyed)


def query(spark, sf_dir) -> DataFrame:
    done = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), id_col="doc_id", rewrite=tail_repeated)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    return done.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest().alias("r"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")).select(
        "doc_id",
        "n_runs",
        F.col("r.b").alias("start"),
        F.col("r.n").alias("length"),
        F.col("r.c").alias("period"),
        F.floor(F.col("r.n") * 1000 / F.col("r.c")).cast("long").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


_CRC = """xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, len(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::UBIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda j: 0::UBIGINT)), lambda y, z: xor(y >> 1, 3988292384::UBIGINT * (y & 1)))))"""

#: Pairs of equal words of one text, their islands for each distance, and the least distance of each stretch.
ORACLE = rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_CRC}::BIGINT AS h FROM documents),
g AS (SELECT doc_id, w, len(w)::BIGINT AS n, h % 10 = 0 AND len(w) > 0 AS again, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a FROM t),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g),
d AS (SELECT doc_id, n, CASE WHEN again THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM p),
i AS (SELECT doc_id, n, unnest(w) AS w, unnest(range(n)) AS i FROM d),
e AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM i x JOIN i y ON x.doc_id = y.doc_id AND x.w = y.w AND x.i < y.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e) GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest({LEAST}, {TIMES} * q) GROUP BY 1, 2, 3),
f AS (SELECT doc_id, count(*) AS n_runs, arg_max({{'start': start, 'length': length, 'period': period}}, [length, -start, -period]) AS b, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256 FROM r GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
c AS (SELECT doc_id, sha256(string_agg(w, ' ' ORDER BY i)) AS collapsed_sha256 FROM i ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.start AS start, b.length AS length, b.period AS period, (1000 * b.length) // b.period AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256, coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
FROM d LEFT JOIN f USING (doc_id) LEFT JOIN c USING (doc_id)
"""
