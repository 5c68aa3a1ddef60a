"""Quality classifier: a generalised additive model with pairwise interactions.

Texts become a row of statistics (``FEATURES``), each cut into at most ``BINS``
bins at quantiles of the training sample.  Boosting goes round the features,
fitting one shallow tree to one feature's histogram at a time, so each feature
ends up with a lookup table; then the pairs that most reduce the rest get
two-way tables in the same way.  A score is the logistic of one table entry for
each feature and pair, added up.

Training takes a bounded sample (``samples.MAX_TRAINING_ROWS``) outside fold 0.
Null and empty texts have statistics like any other.  Without labelled rows of
both kinds every score is the share of good ones (0.5 if there are none).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm.samples import MAX_TRAINING_ROWS, fold, labelled
from cohortforge.llm.shared import fresh, table

FEATURES = ["log_bytes", "log_words", "word_length", "upper", "digits", "punctuation", "symbols", "exclamations", "bars", "line_breaks", "distinct_words", "same_as_before", "bare_words", "high_bytes", "longest_word", "distinct_pairs", "stops", "short_words", "distinct_lines", "commonest_word"]
BINS, ROUNDS, RATE, PAIRS, PAIR_BINS, PAIR_ROUNDS = 48, 150, 0.15, 10, 12, 60
THRESHOLD = 0.3


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _LOWER, _DIGIT = (_class(bytes(range(a, b))) for a, b in ((65, 91), (97, 123), (48, 58)))
_HIGH = _class(bytes(range(128, 256)))
_PUNCTUATION = _class(b".,;:?'\"()-")
_SYMBOL = _class(b"#$%&*@~^<>{}[]\\=_+/`")


def _rows_sum(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def _distinct(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row, how many distinct hashes, and the count of its commonest."""
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    first = np.ones(len(r), bool)
    first[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(first)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, r[at], np.diff(np.append(at, len(r))))
    return np.bincount(r[at], minlength=n), most


def statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text of a buffer."""
    n = len(off) - 1
    size = np.diff(off)
    text = B.translated(buf, B.SPACES)
    starts, ends, rows = B.word_spans(text, off)
    hasher = B.Hasher(text)
    words = hasher.spans(starts, ends)
    length = ends - starts
    count = np.bincount(rows, minlength=n)
    some, w = np.maximum(size, 1), np.maximum(count, 1)
    upper, lower = _rows_sum(_UPPER[buf], off), _rows_sum(_LOWER[buf], off)
    same_row = rows[1:] == rows[:-1]
    pair_rows, pairs = rows[1:][same_row], (words[1:] * np.uint64(3) + words[:-1])[same_row]
    distinct, most = _distinct(rows, words, n)
    distinct_pairs, _ = _distinct(pair_rows, pairs, n)
    letters = np.zeros(len(text) + 1, np.int64)
    np.cumsum((_LOWER | _DIGIT | _HIGH)[text], out=letters[1:])
    bare = letters[ends] == letters[starts]
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, rows, length)
    breaks = buf == 10
    lines, line_ends, line_rows = B.word_spans(np.where(breaks, np.uint8(32), np.uint8(1)), off)
    n_lines = np.bincount(line_rows, minlength=n)
    distinct_lines, _ = _distinct(line_rows, hasher.spans(lines, line_ends), n)
    return np.stack(
        [
            np.log2(size + 1),
            np.log2(count + 1),
            np.bincount(rows, length, n) / w,
            upper / np.maximum(upper + lower, 1),
            _rows_sum(_DIGIT[buf], off) / some,
            _rows_sum(_PUNCTUATION[buf], off) / some,
            _rows_sum(_SYMBOL[buf], off) / some,
            _rows_sum(buf == 33, off) / some,
            _rows_sum(buf == 124, off) / some,
            _rows_sum(breaks, off) / w,
            distinct / w,
            np.bincount(pair_rows, (words[1:] == words[:-1])[same_row], n) / w,
            np.bincount(rows, bare, n) / w,
            _rows_sum(_HIGH[buf], off) / some,
            np.log2(longest + 1),
            distinct_pairs / w,
            _rows_sum(buf == 46, off) / w,
            np.bincount(rows, length <= 3, n) / w,
            distinct_lines / np.maximum(n_lines, 1),
            most / w,
        ],
        axis=1,
    )


# --- the model -----------------------------------------------------------------------------------


def _step_tree(grad: np.ndarray, hess: np.ndarray, l2: float = 1.0) -> np.ndarray:
    """A tree of up to four leaves over ordered bins: the best cut, then the best cut of each side."""

    def value(a, b):
        return grad[a:b].sum() / (hess[a:b].sum() + l2)

    def cut(a, b):
        g, h = np.cumsum(grad[a:b]), np.cumsum(hess[a:b])
        if b - a < 2:
            return None
        gain = g[:-1] ** 2 / (h[:-1] + l2) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + l2) - g[-1] ** 2 / (h[-1] + l2)
        i = int(np.argmax(gain))
        return a + i + 1 if gain[i] > 1e-9 else None

    out, n = np.zeros(len(grad)), len(grad)
    middle = cut(0, n)
    for a, b in [(0, middle), (middle, n)] if middle else [(0, n)]:
        at = cut(a, b)
        for x, y in [(a, at), (at, b)] if at else [(a, b)]:
            out[x:y] = value(x, y)
    return out


def _quad_tree(grad: np.ndarray, hess: np.ndarray, l2: float = 2.0) -> tuple[np.ndarray, float]:
    """The best pair of cuts of a two-way histogram: four values, and the gain."""
    g, h = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)

    def parts(x):
        a, right, below, all_ = x[:-1, :-1], x[:-1, -1:], x[-1:, :-1], x[-1, -1]
        return a, right - a, below - a, all_ - right - below + a

    gs, hs = parts(g), parts(h)
    gain = sum(a**2 / (b + l2) for a, b in zip(gs, hs))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = [a[i, j] / (b[i, j] + l2) for a, b in zip(gs, hs)]
    out = np.empty(grad.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = values
    return out, float(gain[i, j] - g[-1, -1] ** 2 / (h[-1, -1] + l2))


class AdditiveModel:
    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges: list[np.ndarray] = []
        self.tables: list[np.ndarray] = []
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        share = y.mean() if len(y) else 0.5
        if len(y) < 2 or share in (0, 1):
            self.start, self.usable = share, False
            return
        self.usable, self.start = True, float(np.log(share / (1 - share)))
        for column in x.T:
            self.edges.append(np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])))
        self._coarse()
        bins = self._bins(x)
        f = np.full(len(y), self.start)
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        for _ in range(ROUNDS):
            for k, table_ in enumerate(self.tables):
                grad, hess = self._slopes(y, f)
                n = len(table_)
                step = RATE * _step_tree(np.bincount(bins[k], grad, n), np.bincount(bins[k], hess, n))
                table_ += step
                f += step[bins[k]]
        small = [c[b] for c, b in zip(self.coarse, bins)]

        def histogram(a, b, values):
            m = self.sizes[b]
            return np.bincount(small[a] * m + small[b], values, self.sizes[a] * m).reshape(self.sizes[a], m)

        grad, hess = self._slopes(y, f)
        options = [(a, b) for a in range(len(bins)) for b in range(a) if min(self.sizes[a], self.sizes[b]) > 1]
        ranked = sorted(options, key=lambda p: -_quad_tree(histogram(*p, grad), histogram(*p, hess))[1])[:PAIRS]
        self.pairs = [(a, b, np.zeros((self.sizes[a], self.sizes[b]))) for a, b in ranked]
        for _ in range(PAIR_ROUNDS):
            for a, b, table_ in self.pairs:
                grad, hess = self._slopes(y, f)
                step = RATE * _quad_tree(histogram(a, b, grad), histogram(a, b, hess))[0]
                table_ += step
                f += step[small[a], small[b]]

    @staticmethod
    def _slopes(y, f):
        p = 1 / (1 + np.exp(-f))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    def _coarse(self):
        """Each fine bin's coarse bin, for pairs."""
        self.coarse = [np.arange(len(e) + 1) * PAIR_BINS // max(len(e) + 1, PAIR_BINS) for e in self.edges]
        self.sizes = [int(c.max()) + 1 for c in self.coarse]

    def _bins(self, x):
        return [np.searchsorted(e, column, "left") for e, column in zip(self.edges, x.T)]

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not self.usable:
            return np.full(len(x), float(self.start))
        bins = self._bins(x)
        f = np.full(len(x), self.start)
        for b, table_ in zip(bins, self.tables):
            f += table_[b]
        small = [c[b] for c, b in zip(self.coarse, bins)]
        for a, b, table_ in self.pairs:
            f += table_[small[a], small[b]]
        return 1 / (1 + np.exp(-f))


def _statistics_part(batches):
    for batch in batches:
        buf, off = B.utf8(batch.column(0))
        for a, b in B.chunks(off):
            x = statistics(buf[off[a] : off[b]], off[a : b + 1] - off[a])
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.array([r.tobytes() for r in x.astype("<f8")], pa.binary())], names=["y", "x"])


def train(docs: DataFrame, labels: DataFrame, *, label="quality", most: int = MAX_TRAINING_ROWS) -> AdditiveModel:
    rows = labelled(docs, labels, label, most=most).mapInArrow(B.trimmed(_statistics_part), "y int, x binary").toArrow()
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), "<f8").reshape(-1, len(FEATURES))
    y = rows["y"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # the same model however the rows arrive
    return AdditiveModel(x[order], y[order])


def score(df: DataFrame, model: AdditiveModel, *, text_col="text", score_col="score") -> DataFrame:
    """``df`` with ``score_col``."""
    names = [c for c in df.columns if c != score_col]
    kept = df.select(*names)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            buf, off = B.utf8(batch.column(names.index(text_col)))
            for a, b in B.chunks(off):
                x = statistics(buf[off[a] : off[b]], off[a : b + 1] - off[a])
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), pa.array(sent.value.predict(x))], names=[*names, score_col])

    return kept.mapInArrow(B.trimmed(run), kept.withColumn(score_col, F.lit(None).cast("double")).schema)


def keep(df: DataFrame, model: AdditiveModel, *, text_col="text", threshold=THRESHOLD) -> DataFrame:
    """``df`` without the rows that score under the threshold; all of it if labels of one kind alone (or none) were there to learn from."""
    if not model.usable:
        return df
    own = fresh(df.columns, "_quality")
    return score(df, model, text_col=text_col, score_col=own).where(F.col(own) >= threshold).select(*df.columns)


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    done = score(docs, model).drop("text")
    return done.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
