"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

Every window of ``window`` words of an item (the whole item if it is shorter)
is a pattern.  A text is normalised once (A-Z lower-cased, whatever is no word
turned into one space), scanned once, and each match is mapped back to bytes of
the original text.  The automaton is built from the benchmark alone.  Its patterns are made and made distinct by Spark; if
they take more than ``MAX_PATTERN_BYTES``, they are dealt into groups of about that size by hash, and the texts are scanned once
for each group, one group at a time on the driver and in the workers, with the state so far stored between them.

Null or empty texts have no words and no hits; repeated items and rows are treated alike; an empty benchmark hits nothing.
Windows of items without an id hit like others, but name no item.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm.shared import discard, fresh, stored, table

WINDOW = 10
MAX_PATTERN_BYTES = 32 << 20


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(B.NON_WORD).split()


def patterns(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """pattern, k (words in it), items (sorted ids): the distinct windows of all items."""
    kind = dict(items.dtypes)[id_col]

    def run(batches):
        for batch in batches:
            ids, keys, sizes = [], [], []
            for row, text in enumerate(B.texts_of(batch.column(1))):
                words = normal_words(text)
                k = min(window, len(words))
                for i in range(len(words) - k + 1 if words else 0):
                    ids.append(row)
                    keys.append(b" " + b" ".join(words[i : i + k]) + b" ")
                    sizes.append(k)
                    if len(keys) == 20_000:
                        yield made(batch, ids, keys, sizes)
                        ids, keys, sizes = [], [], []
            yield made(batch, ids, keys, sizes)

    def made(batch, ids, keys, sizes):
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32())], names=["item", "pattern", "k"])

    found = items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text")).mapInArrow(B.trimmed(run), f"item {kind}, pattern binary, k int")
    return found.groupBy("pattern").agg(F.max("k").alias("k"), F.array_sort(F.collect_set("item")).alias("items"))


def automaton(patterns):
    import ahocorasick

    found = ahocorasick.Automaton()
    for pattern, k, ids in patterns:
        found.add_word(bytes(pattern).decode("latin-1"), (k, tuple(ids)))
    if patterns:
        found.make_automaton()
    return found


def scan_text(found, text: bytes) -> tuple[int, list[tuple[int, int]], set]:
    """Word count, maximal hit word ranges and item ids of one text."""
    words = normal_words(text)
    if not words or not len(found):
        return len(words), [], set()
    line = b" " + b" ".join(words) + b" "
    hits, items = [], set()
    for end, (k, ids) in found.iter(line.decode("latin-1")):
        hits.append((end, k))
        items.update(ids)
    if not hits:
        return len(words), [], items
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    to = np.searchsorted(spaces, [e for e, _ in hits])
    return len(words), merged(sorted(zip((to - [k for _, k in hits]).tolist(), to.tolist()))), items


def merged(ranges) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in ranges:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scan(df: DataFrame, items: DataFrame, *, id_col="item_id", item_text="text", text_col="text", window=WINDOW) -> DataFrame:
    """``df`` with n_words, n_hit, hit_items (ids) and hit_spans (byte ranges of the original UTF-8 text).

    Columns of ``df`` with these names are replaced.
    """
    base = df.drop("n_words", "n_hit", "hit_items", "hit_spans")
    ranges = fresh(base.columns, "_ranges")
    kind = dict(items.dtypes)[id_col]
    span = "array<struct<first:bigint,last:bigint>>"
    out = base.withColumns({"n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long"), "hit_items": F.array().cast(f"array<{kind}>"), "hit_spans": F.array().cast(span), ranges: F.array().cast(span)})
    schema = out.schema
    # a pattern and its ids, each id at most in as many patterns as its item has words
    all_ = stored(patterns(items, id_col, item_text, window))
    size = all_.agg(F.coalesce(F.sum(F.octet_length("pattern") + 64 + 8 * F.size("items")), F.lit(0))).first()[0]
    n = max(1, -(-int(size) // MAX_PATTERN_BYTES))
    held = None
    for group in range(n):
        own = all_ if n == 1 else all_.where(F.pmod(F.xxhash64("pattern"), F.lit(n)) == group)
        sent = df.sparkSession.sparkContext.broadcast([tuple(r) for r in own.toLocalIterator()])
        out = out.mapInArrow(B.trimmed(_scanner(sent, text_col, ranges, uuid.uuid4().hex)), schema)
        if n > 1:  # the next group's patterns take this one's place
            last, held = held, stored(out)
            out = held
            if last is not None:  # nothing reads the copy before this one any more
                discard(last)
            sent.destroy()
    discard(all_)
    return out.drop(ranges)


_automata: dict = {}


def _automaton_of(sent, token: str):
    """The automaton of a broadcast, kept by the worker from task to task."""
    B.only("automata")
    kept = B.keeping("automata", _automata)
    if token not in kept:
        kept.clear()
        kept[token] = automaton(sent.value)
    return kept[token]


def _scanner(sent, text_col, ranges_col, token):
    def run(batches):
        found = _automaton_of(sent, token)
        for batch in batches:
            names = batch.schema.names
            cols = {n: [] for n in ("n_words", "n_hit", "hit_items", "hit_spans", ranges_col)}
            was = {n: batch.column(names.index(n)) for n in ("hit_items", ranges_col)}
            for row, text in enumerate(B.texts_of(batch.column(names.index(text_col)))):
                n, ranges, items = scan_text(found, text)
                if len(was[ranges_col][row]):
                    ranges = merged(sorted(ranges + [(x["first"], x["last"]) for x in was[ranges_col][row].as_py()]))
                    items |= set(was["hit_items"][row].as_py())
                spans = []
                if ranges:
                    mask = np.frombuffer(text.translate(B.NON_WORD), np.uint8)
                    starts, ends, _ = B.word_spans(mask, np.array([0, len(mask)]))
                    spans = [{"first": int(starts[a]), "last": int(ends[b - 1])} for a, b in ranges]
                for name, value in zip(cols, (n, sum(b - a for a, b in ranges), sorted(items), spans, [{"first": a, "last": b} for a, b in ranges])):
                    cols[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(cols[n], batch.schema.field(n).type) if n in cols else batch.column(i) for i, n in enumerate(names)], schema=batch.schema)

    return run


def cut_out(df: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``df``, whatever its columns' names, without the texts that contain a benchmark window."""
    text_col = options.pop("text_col", "text")
    inner = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    kept = scan(df.select(*(F.col(c).alias(inner[c]) for c in df.columns)), items, text_col=inner[text_col], **options).where(F.col("n_hit") == 0)
    return kept.select(*(F.col(inner[c]).alias(c) for c in df.columns))


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = scan(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    ids = F.array_sort(F.transform("hit_items", lambda x: x.cast("string")))
    return done.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
