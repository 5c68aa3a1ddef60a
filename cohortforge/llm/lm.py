"""Language-model scoring with a log-frequency Bloom filter.

Counting: each task counts the words and word pairs of its training texts and
sends them to buckets by hash, packed into one row for each bucket; a bucket's
reducer adds them up.  Exact word counts stay in a stored table.  Words and
pairs also enter a Bloom filter once for each level up to 1 + floor(log2 count);
its segments, one for each bucket, are built where the counts are and take
``BITS_PER_KEY`` bits for each entry, so the error rate is the same at every size.
They stay in the stored table too: nothing that grows with the texts is broadcast
or sent to the driver.

Scoring: texts are dealt into blocks.  A block's distinct words and pairs go to
their buckets and come back with the words' exact counts and the level that the
filter knows of each, estimated by probing level after level until one is absent.
The block's texts travel along, compressed, and are scored where the answers meet.
The probability of a word after another is the pair's count with ``PRIOR``
pseudo-counts spread by the words' own probabilities.  Base scores use exact counts.

Null and empty texts hold one end token.  Rows that repeat are counted each.
The frame should give the same rows in the same order when a task runs again, as
stored tables do.  Blocks are named by their content, so if it doesn't, answers
of another order never meet: the job fails, and scores are never mixed.
Other columns than id and text are left out of the scores.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm.shared import partitions, stored, table, tidy

BITS_PER_KEY = 8
PROBES = 4
PRIOR = 20.0
MAX_LEVEL = 64
MOST_BITS = 1 << 32
BLOCK_BYTES = 4 << 20
PROBED_AT_ONCE = 1_000_000
FLUSH_TOKENS = 3_000_000
ALPHA = 0.1
END = np.uint64(0x5DEECE66D1234567)
WORDS, PAIRS, FILTER, ASKED, TEXTS = range(5)
CHANGED = "a block's texts and answers don't belong together: the rows came in another order when a task ran again; store them first"


def token_hashes(buf, off) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and row numbers of the words of each text, with an end token after each."""
    text = B.translated(buf, B.SPACES)
    starts, ends, rows = B.word_spans(text, off)
    n = len(off) - 1
    hashes = B.Hasher(text).spans(starts, ends)
    at = np.searchsorted(rows, np.arange(n), "right")
    return np.insert(hashes, at, END), np.insert(rows, at, np.arange(n))


def pair_hashes(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token with the one before; a text's first token follows the end of another."""
    before = np.empty_like(tokens)
    if len(tokens):
        before[0], before[1:] = END, tokens[:-1]
    return B.mix(before * np.uint64(0x9E3779B97F4A7C15) + B.mix(tokens)), before


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (keys >> np.uint64(64 - (n.bit_length() - 1))).astype(np.int64)


def _low5(keys: np.ndarray) -> bytes:
    return (keys >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from5(raw: bytes, bucket: int, n: int) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    top = np.uint64(bucket) << np.uint64(64 - (n.bit_length() - 1))
    mask = np.uint64((1 << (64 - (n.bit_length() - 1))) - 1)
    return (out.view("<u8").ravel() << np.uint64(16) & mask) | top


# --- the filter ----------------------------------------------------------------------------------


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(counts)).astype(np.int64) + 1


def _positions(keys: np.ndarray, level: int, bits) -> list[np.ndarray]:
    """Bit numbers in a segment of ``bits`` bits; only 48 bits of a key count."""
    h = B.mix((keys >> np.uint64(16)) + np.uint64(level * 0x632BE59BD9B4E019 & (1 << 64) - 1))
    one, two, low = h >> np.uint64(32), h & np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF)
    m = np.asarray(bits, np.uint64)
    return [((one + np.uint64(i) * two & low) * m >> np.uint64(32)).astype(np.int64) for i in range(PROBES)]


def segment(keys: np.ndarray, counts: np.ndarray, largest: int = MOST_BITS) -> bytes:
    """The filter's part for one bucket; more than ``largest`` bits are refused, never shortened."""
    levels = levels_of(counts)
    bits = max(64, int(levels.sum()) * BITS_PER_KEY)
    if bits > largest:
        raise ValueError(f"a bucket's filter needs {bits} bits, over {largest}: more shuffle partitions make smaller buckets")
    out = np.zeros(-(-bits // 8), np.uint8)  # eight bits a byte from the start
    for level in range(1, int(levels.max(initial=0)) + 1):
        for at in _positions(keys[levels >= level], level, bits):
            np.bitwise_or.at(out, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
    return out.tobytes()


class LogFrequencyFilter:
    def __init__(self, segments: list[bytes]):
        sizes = np.array([len(s) for s in segments], np.int64) * 8
        self.n, self.bits, self.start = len(segments), sizes.astype(np.uint64), np.concatenate([[0], np.cumsum(sizes)])[:-1]
        self.data = np.frombuffer(b"".join(segments), np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level up to which all are present, by probing level after level; 0: absent."""
        out = np.zeros(len(keys), np.uint8)
        left, level = np.arange(len(keys)), 1
        while len(left) and level <= MAX_LEVEL:
            b = bucket_of(keys[left], self.n)
            held = np.ones(len(left), bool)
            for at in _positions(keys[left], level, self.bits[b]):
                at = at + self.start[b]
                held &= (self.data[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            left = left[held]
            out[left] = level
            level += 1
        return out

    def counts(self, keys: np.ndarray) -> np.ndarray:
        return expected(self.levels(keys))


def expected(levels: np.ndarray) -> np.ndarray:
    """Expected counts at these levels."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels.astype(float) - 1) - 0.5, 0.0)


# --- counting ------------------------------------------------------------------------------------

_PACKED = "bucket int, kind int, keys binary, numbers binary, n_keys long, total long"
_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("numbers", pa.binary()), ("n_keys", pa.int64()), ("total", pa.int64())])


def _rows(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema) if rows else pa.RecordBatch.from_pylist([], schema=schema)


def _count_part(text_at: int, n_buckets: int):
    def flush(held):
        tokens = np.concatenate(held)
        for kind, keys in ((WORDS, tokens), (PAIRS, np.concatenate([pair_hashes(t)[0] for t in held]))):
            keys, counts = np.unique(keys, return_counts=True)
            cut = np.searchsorted(bucket_of(keys, n_buckets), np.arange(n_buckets + 1))
            counts = counts.astype("<u4")
            rows = []
            for b in np.flatnonzero(np.diff(cut)).tolist():
                part = keys[cut[b] : cut[b + 1]]
                rows.append((b, kind, part.astype("<u8").tobytes() if kind == WORDS else _low5(part), counts[cut[b] : cut[b + 1]].tobytes(), len(part), 0))
            yield _rows(rows, _ARROW)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            buf, off = B.utf8(batch.column(text_at))
            for a, b in B.chunks(off):
                tokens, _ = token_hashes(buf[off[a] : off[b]], off[a : b + 1] - off[a])
                held.append(tokens)
                size += len(tokens)
                if size >= FLUSH_TOKENS:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run


def _summed(keys: np.ndarray, counts: np.ndarray):
    keys, back = np.unique(keys, return_inverse=True)
    return keys, np.bincount(back, counts, len(keys)).astype(np.int64)


def _sum_buckets(n_buckets: int):
    def run(batches):
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for bucket, kind, keys, numbers in zip(*(batch.column(i).to_pylist() for i in range(4))):
                held.setdefault((bucket, kind), []).append((keys, numbers))
        for bucket in sorted({b for b, _ in held}):
            both = []
            for kind in (WORDS, PAIRS):
                parts = held.pop((bucket, kind), [])
                keys = [np.frombuffer(k, "<u8") if kind == WORDS else _from5(k, bucket, n_buckets) for k, _ in parts]
                counts = [np.frombuffer(c, "<u4") for _, c in parts]
                both.append(_summed(np.concatenate(keys), np.concatenate(counts)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            (words, counts), pairs = both
            entries = np.concatenate([words, pairs[0]]), np.concatenate([counts, pairs[1]])
            bits = segment(*entries)
            yield _rows(
                [
                    (bucket, WORDS, words.astype("<u8").tobytes(), counts.astype("<i8").tobytes(), len(words), int(counts.sum())),
                    (bucket, FILTER, bits, b"", len(entries[0]), 0),
                ],
                _ARROW,
            )

    return run


class Model:
    """Stored word counts and filter segments, N and V."""

    def __init__(self, counts: DataFrame, n_buckets: int):
        self.counts, self.n_buckets = counts, n_buckets
        total = counts.where(F.col("kind") == WORDS).agg(F.sum("total"), F.sum("n_keys")).first()
        self.tokens, self.distinct = total[0] or 0, total[1] or 0


def train(df: DataFrame, *, text_col="text") -> Model:
    """Counts over all rows of ``df``."""
    spark = df.sparkSession
    n = 256
    while n < 4 * partitions(spark):
        n *= 2
    parts = df.select(text_col).mapInArrow(_count_part(0, n), _PACKED)
    model = Model(stored(parts.repartition(partitions(spark), "bucket").mapInArrow(_sum_buckets(n), _PACKED)), n)
    del parts
    tidy(spark)
    return model


# --- scoring -------------------------------------------------------------------------------------

_MOVED = "bucket int, kind int, block string, words binary, pairs binary"
_MOVED_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("block", pa.string()), ("words", pa.binary()), ("pairs", pa.binary())])


def _log_base(counts, tokens, distinct):
    return np.log10((counts + ALPHA) / (tokens + ALPHA * (distinct + 1)))


def _planes(numbers: np.ndarray) -> bytes:
    """Bytes of the same weight together, which compresses better."""
    return np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _distinct(buf, off):
    """Tokens and rows of texts, and the distinct words and pairs with the place of each token's, in order of their buckets."""
    keys, rows = token_hashes(buf, off)
    return keys, rows, np.unique(keys, return_inverse=True), np.unique(pair_hashes(keys)[0], return_inverse=True)


def _ask_part(n_buckets: int):
    """Each block's texts, and its distinct words and pairs by bucket."""

    def run(batches):
        number = 0
        for batch in batches:
            buf, off = B.utf8(batch.column(1))
            ids = batch.column(0)
            for a, b in B.chunks(off, BLOCK_BYTES):
                own, own_off = buf[off[a] : off[b]], off[a : b + 1] - off[a]
                held = _ids(ids.slice(a, b - a))
                content = hashlib.blake2b(own.tobytes() + own_off.tobytes() + held, digest_size=8).hexdigest()
                block = f"{TaskContext.get().partitionId()}-{number}-{content}"
                number += 1
                _, _, (words, _), (pairs, _) = _distinct(own, own_off)
                out = [(int(sum(map(ord, block)) * 2654435761 % n_buckets), TEXTS, block, held, _text(own, own_off))]
                of_words, of_pairs = (np.searchsorted(bucket_of(x, n_buckets), np.arange(n_buckets + 1)) for x in (words, pairs))
                for k in range(n_buckets):
                    w, x = words[of_words[k] : of_words[k + 1]], pairs[of_pairs[k] : of_pairs[k + 1]]
                    if len(w) or len(x):
                        out.append((k, ASKED, block, w.astype("<u8").tobytes(), _low5(x)))
                yield _rows(out, _MOVED_ARROW)

    return run


def _text(buf: np.ndarray, off: np.ndarray) -> bytes:
    text = pa.array([buf.tobytes()], pa.large_binary())
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.array([np.diff(off).astype("<i8").tobytes()], pa.large_binary()), text], names=["sizes", "text"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_text(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    held = pa.ipc.open_stream(raw).read_all()
    sizes, text = (held.column(i)[0].as_py() for i in range(2))
    return np.frombuffer(text, np.uint8), np.concatenate([[0], np.cumsum(np.frombuffer(sizes, "<i8"))]).astype(np.int64)


def _ids(column) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("id", column.type)])) as writer:
        writer.write_batch(pa.RecordBatch.from_arrays([column], names=["id"]))
    return sink.getvalue().to_pybytes()


def _answer(n_buckets: int):
    """Rows sorted by bucket and kind: a bucket's counts and filter come before what is asked of them."""

    def run(batches):
        at, counts, held, asked, size = None, None, None, [], 0

        def answers():
            words = np.frombuffer(b"".join(w for _, w, _ in asked), "<u8")
            pairs = _from5(b"".join(x for *_, x in asked), at, n_buckets)
            place = np.searchsorted(counts[0], words)
            place[place == len(counts[0])] = 0
            exact = np.where(counts[0][place] == words, counts[1][place], 0) if len(counts[0]) else np.zeros(len(words), np.int64)
            levels = held.levels(np.concatenate([words, pairs]))
            w = x = 0
            out = []
            for block, own_words, own_pairs in asked:
                n, m = len(own_words) // 8, len(own_pairs) // 5
                out.append((at, ASKED, block, _planes(exact[w : w + n]) + levels[w : w + n].tobytes(), levels[len(words) + x : len(words) + x + m].tobytes()))
                w, x = w + n, x + m
            return _rows(out, _MOVED_ARROW)

        for batch in batches:
            for bucket, kind, block, words, pairs in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if bucket != at:
                    if asked:
                        yield answers()
                    at, counts, held, asked, size = bucket, (np.zeros(0, np.uint64), np.zeros(0, np.int64)), LogFrequencyFilter([bytes(8)]), [], 0
                if kind == WORDS:
                    counts = np.frombuffer(words, "<u8"), np.frombuffer(pairs, "<i8")
                elif kind == FILTER:
                    held = LogFrequencyFilter([words])
                elif kind == TEXTS:
                    yield _rows([(bucket, kind, block, words, pairs)], _MOVED_ARROW)
                else:
                    asked.append((block, words, pairs))
                    size += len(words) // 8 + len(pairs) // 5
                    if size >= PROBED_AT_ONCE:
                        yield answers()
                        asked, size = [], 0
        if asked:
            yield answers()

    return run


def _gather(id_type: pa.DataType, tokens: int, distinct: int):
    """Rows sorted by block, bucket and kind to the scores of the block's texts."""

    def scored(texts, answers):
        buf, off = _from_text(texts[1])
        keys, rows, (words, at), (_, pair_at) = _distinct(buf, off)
        n = len(off) - 1
        exact, levels, pair_levels = [], [], []
        for own_words, own_pairs in answers:
            k = len(own_words) // 9 * 8
            exact.append(_from_planes(own_words[:k]))
            levels.append(np.frombuffer(own_words[k:], np.uint8))
            pair_levels.append(np.frombuffer(own_pairs, np.uint8))
        if sum(map(len, levels)) != len(words) or sum(map(len, pair_levels)) != int(pair_at.max(initial=-1)) + 1:
            raise RuntimeError(CHANGED)
        exact, estimate = np.concatenate(exact), expected(np.concatenate(levels))
        uni = (estimate + ALPHA) / (tokens + ALPHA * (distinct + 1))
        c2 = expected(np.concatenate(pair_levels))[pair_at]
        c1 = np.empty(len(keys))
        c1[0], c1[1:] = estimate[np.searchsorted(words, END)], estimate[at[:-1]]
        p = (np.minimum(c2, c1) + PRIOR * uni[at]) / (c1 + PRIOR)
        column = pa.ipc.open_stream(texts[0]).read_all().column(0).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [
                column.cast(id_type),
                pa.array(np.bincount(rows, minlength=n).astype(np.int64)),
                pa.array(np.bincount(rows, exact[at] > 0, n).astype(np.int64)),
                pa.array(np.full(n, tokens, np.int64)),
                pa.array(np.bincount(rows, _log_base(exact, tokens, distinct)[at], n)),
                pa.array(np.bincount(rows, np.log10(p), n)),
            ],
            names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def run(batches):
        now, texts, answers = None, None, []
        for batch in batches:
            for _, kind, block, words, pairs in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if block != now:
                    if texts:
                        yield scored(texts, answers)
                    elif answers:
                        raise RuntimeError(CHANGED)
                    now, texts, answers = block, None, []
                if kind == TEXTS:
                    texts = words, pairs
                else:
                    answers.append((words, pairs))
        if texts:
            yield scored(texts, answers)
        elif answers:
            raise RuntimeError(CHANGED)

    return run


def score(df: DataFrame, model: Model, *, id_col="doc_id", text_col="text") -> DataFrame:
    """id_col, n_tokens, n_known, train_tokens, base_score and score of each row."""
    p = partitions(df.sparkSession)
    kind = dict(df.dtypes)[id_col]
    asked = df.select(id_col, text_col).mapInArrow(_ask_part(model.n_buckets), _MOVED)
    known = model.counts.select("bucket", "kind", F.lit("").alias("block"), F.col("keys").alias("words"), F.col("numbers").alias("pairs"))
    met = asked.unionByName(known).repartition(p, "bucket").sortWithinPartitions("bucket", "kind")
    answers = met.mapInArrow(_answer(model.n_buckets), _MOVED).repartition(p, "block").sortWithinPartitions("block", "bucket", "kind")
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(df.schema[id_col].dataType)
    done = answers.mapInArrow(_gather(id_type, model.tokens, model.distinct), f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return done.withColumnRenamed("id", id_col)


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    model = train(docs.where(~F.coalesce(held_out, F.lit(False))))
    done = score(docs, model)
    return done.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
