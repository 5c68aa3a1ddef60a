"""Quality rules: surface counts, and a hashed n-gram log-likelihood ratio between trusted texts and the raw corpus.

Words and pairs of neighbouring words of a text are hashed to ``BUCKETS`` buckets.  Spark counts the buckets twice, over all
raw texts and over all trusted ones; each count makes a multinomial.  The trusted one is smoothed by ``PRIOR`` draws from the
raw one, so a bucket that few trusted words fell in costs no more than the evidence says.  A text's score is the sum over
its n-grams of the log of the two probabilities' ratio, divided by their number.

*Threshold.*  Every ``FOLDS``-th trusted text (by crc32 of its id) is kept out of the counts.  The mean and the deviation of
these texts' own scores give the threshold, ``DEVIATIONS`` under the mean: a text is rejected if it is less like the trusted
texts than these are among themselves.  Logs are rounded to whole millionths, so sums don't depend on the order of rows or
on how they are dealt to tasks, and every text is decided by comparing integers; ties are kept.

Two words may share a bucket; this bounds the model (8 bytes a bucket, broadcast), not the texts.  Null and empty texts have
no n-grams and score 0.  Without trusted texts, or with none kept out, every text that passes the base rules is kept.  Ids may
be null (then a text is never kept out) or repeat.  Columns of the given frame with names of the result's own are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm.samples import FOLDS, fold
from cohortforge.llm.shared import discard, stored, table
from cohortforge.llm.suffixdedup import _among

BUCKETS = 1 << 16
PRIOR = 1 << 16
DEVIATIONS = 4.0
UNIT = 1_000_000
WINDOW = 3
LEAST_WORDS, MOST_REPEATED = 50, 50  # words; percent of words

# The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_BLANKS = bytes(32 if b in (9, 10, 11, 12, 13) else b for b in range(256))


def _row_sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def _equal_before(keys: list[bytes]) -> int:
    """How many are equal to an earlier one."""
    return len(keys) - len(set(keys))


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    if b"\n" not in text:
        return 0
    return _equal_before([line for line in text.split(b"\n") if line.translate(_BLANKS).strip()])


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of so many words that the text holds twice or more."""
    n = len(words)
    if n <= window:
        return 0
    first: dict[bytes, int] = {}
    codes = np.fromiter(map(first.setdefault, words, range(n)), np.int64, n)
    keys = codes[: n - window + 1]
    for k in range(1, window):  # numbers of pairs, then of triples: no two windows share one
        _, keys = np.unique(keys * n + codes[k : n - window + 1 + k], return_inverse=True)
    twice = np.bincount(keys)[keys] > 1
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.flatnonzero(twice), 1)
    np.add.at(change, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(change[:n]) > 0).sum())


def ngrams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of each word and each pair of neighbouring words, A-Z lower-cased."""
    text = B.translated(buf, B.SPACES)
    starts, ends, rows = B.word_spans(text, off)
    words = B.Hasher(text).spans(starts, ends)
    same = rows[1:] == rows[:-1]
    pairs = B.mix(words[:-1] * np.uint64(3) + words[1:])[same]
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    return (np.concatenate([words, pairs]) >> shift).astype(np.int64), np.concatenate([rows, rows[1:][same]])


# --- the two multinomials ------------------------------------------------------------------------


def counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many n-grams of all texts fall in each bucket.  Each task sends one row for each bucket it met."""

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            buf, off = B.utf8(batch.column(0))
            for a, b in B.chunks(off):
                total += np.bincount(ngrams(buf[off[a] : off[b]], off[a : b + 1] - off[a])[0], minlength=BUCKETS)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], names=["bucket", "n"])

    rows = texts.select(text_col).mapInArrow(B.trimmed(run), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)  # at most BUCKETS rows
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def log_ratios(trusted: np.ndarray, raw: np.ndarray, prior: int = PRIOR) -> np.ndarray:
    """For each bucket, the log of trusted over raw probability in whole millionths; 0 where neither was met."""
    there, all_ = int(trusted.sum()), int(raw.sum())
    if not there or not all_:
        return np.zeros(len(raw), np.int64)
    base = (raw + 1.0) / (all_ + len(raw))
    ratio = (trusted / base + prior) / (there + prior)
    return np.round(np.log(ratio) * UNIT).astype(np.int64)


def threshold(n: int, mean: float | None, deviation: float | None, deviations: float = DEVIATIONS) -> int | None:
    """Whole millionths for each n-gram under which a text is rejected; None: nothing is."""
    return math.floor(mean - deviations * (deviation or 0.0)) if n else None


# --- texts ---------------------------------------------------------------------------------------

_NEW = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "n_ngrams": "long", "log_ratio": "long"}


def measured(df: DataFrame, ratios: np.ndarray, text_col: str = "text") -> DataFrame:
    """``df`` with the surface counts, n_ngrams and log_ratio: the sum over n-grams, in millionths."""
    kept = df.drop(*_NEW)
    names = kept.columns
    sent = df.sparkSession.sparkContext.broadcast(ratios)
    schema = kept.withColumns({n: F.lit(None).cast(t) for n, t in _NEW.items()}).schema

    def run(batches):
        table_ = sent.value
        for batch in batches:
            buf, off = B.utf8(batch.column(names.index(text_col)))
            for a, b in B.chunks(off):
                part, inner, n = buf[off[a] : off[b]], off[a : b + 1] - off[a], b - a
                starts, ends, rows = B.word_spans(B.translated(part, _BLANKS), inner)
                count = np.bincount(rows, minlength=n)
                points = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
                chars = np.zeros(n, np.int64)
                np.add.at(chars, rows, points[ends] - points[starts])
                bucket, row = ngrams(part, inner)
                score = np.zeros(n, np.int64)
                np.add.at(score, row, table_[bucket])
                texts = [part[x:y].tobytes() for x, y in zip(inner[:-1].tolist(), inner[1:].tolist())]
                lines = np.array([duplicate_lines(t) for t in texts], np.int64)
                repeats = np.array([repeated_words(t.translate(_BLANKS).split()) for t in texts], np.int64)
                made = [count, chars, _row_sums(_SYMBOL[part], inner), lines, repeats, np.bincount(row, minlength=n), score]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, n) for c in batch.columns), *(pa.array(x.astype(np.int64)) for x in made)], names=[*names, *_NEW])

    return kept.mapInArrow(B.trimmed(run), schema)


def base_failed():
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judged(df: DataFrame, trusted: DataFrame, *, id_col="doc_id", text_col="text", deviations: float = DEVIATIONS) -> DataFrame:
    """``df`` with the surface counts, n_ngrams, log_ratio (millionths), base_failed and kept.

    ``trusted``: texts of the wanted kind, with columns named as in ``df``; ``df`` is the raw corpus.
    """
    own = trusted.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = F.coalesce(fold("doc_id") == 0, F.lit(False))
    ratios = log_ratios(counts(own.where(~out)), counts(df, text_col))
    held = measured(own.where(out), ratios).where("n_ngrams > 0").select((F.col("log_ratio") / F.col("n_ngrams")).alias("score"))
    # sums of whole millionths, so that the threshold is the same however rows are dealt out
    whole = F.round("score").cast("decimal(20,0)")
    n, total, squares = held.agg(F.count("*"), F.sum(whole), F.sum((whole * whole).cast("decimal(38,0)"))).first()
    mean = float(total) / n if n else None
    line = threshold(n, mean, math.sqrt(max(0.0, float(squares) / n - mean * mean)) if n else None, deviations)
    done = measured(df.drop("base_failed", "kept"), ratios, text_col).withColumn("base_failed", base_failed())
    verdict = F.lit(True) if line is None else F.col("log_ratio") >= F.lit(line) * F.col("n_ngrams")
    return done.withColumn("kept", ~F.col("base_failed") & verdict)


def chosen(ids: DataFrame, most: int | None = None) -> DataFrame:
    """The distinct ids of a frame of one column; of more than ``most``, if that is given, about so many: those whose hashes are least."""
    ids = ids.where(F.col(ids.columns[0]).isNotNull()).distinct()
    n = None if most is None else ids.count()
    return ids if most is None or n <= most else ids.where(F.xxhash64(ids.columns[0]).cast("double") < -(2.0**63) + 2.0**64 * most / n)


def of_ids(df: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """All rows with one of the ids (a column named alike, each once), however many: only rows that a bitmap of ids lets pass move."""
    may = df.where(_among(ids, F.xxhash64(id_col)))
    return may.join(ids.hint("shuffle_hash"), id_col, "left_semi")


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = stored(chosen(table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")))
    done = judged(docs, of_ids(docs, good)).drop("text", "n_ngrams", "log_ratio")
    discard(good)  # the counts and the threshold are there
    return done
