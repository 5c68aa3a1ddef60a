"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece of text exactly one token can be the last of that
prefix's encoding.  ``last[i]`` holds it; the encoding of a whole piece is read
backwards through ``last``.  A candidate (a token that ends at i) is valid if it
and the last token of the prefix before it stand side by side under the merges,
which is decided by walking both tokens' merge trees along the common border.
An Aho-Corasick automaton names the tokens that end at each byte.
Appending bytes only adds entries, and an edit recomputes entries from the edit
on until they agree with the old ones again.

The pattern splits text first; pieces recur, so encodings of short pieces are
remembered (``CACHE`` entries, then the memory starts anew).  Null texts are
empty; empty texts have no tokens.
"""

from __future__ import annotations

import base64
import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm.shared import table

CACHE = 400_000
CACHED_BYTES = 48


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}


class PrefixEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern)
        self.token = {v: k for k, v in ranks.items()}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.longest = max(map(len, ranks), default=1)
        for text, rank in sorted(ranks.items(), key=lambda x: x[1]):
            self.parts[rank] = self._parts(text, rank)
        #: Tokens that merging can reach, by their bytes.
        self.reached = {t: r for t, r in ranks.items() if len(t) == 1 or self.parts[r] is not None}
        self.memory: dict[tuple[int, int], bool] = {}
        self.found = ahocorasick.Automaton()
        for text, rank in self.reached.items():
            self.found.add_word(text.decode("latin-1"), (rank, len(text)))
        self.found.make_automaton()

    def _parts(self, text: bytes, rank: int):
        """The two tokens whose merge makes this one, or None if merging never gets there."""
        cut = [bytes([b]) for b in text]
        while len(cut) > 2:
            options = [(r, i) for i in range(len(cut) - 1) if (r := self.ranks.get(cut[i] + cut[i + 1])) is not None and r < rank]
            if not options:
                return None
            _, i = min(options)
            cut[i : i + 2] = [cut[i] + cut[i + 1]]
        if len(cut) < 2 or cut[0] not in self.ranks or cut[1] not in self.ranks:
            return None
        return self.ranks[cut[0]], self.ranks[cut[1]]

    def beside(self, a: int, b: int) -> bool:
        """Whether the encoding of the two tokens' bytes is just these two tokens.

        A merge over the border would join some right edge part of ``a`` with some left edge part of ``b``
        at a time when both exist.  Edge parts exist from the rank that makes them to the rank that uses
        them up; the walk goes backwards in time through the pairs of edge parts that exist together.
        """
        known = self.memory.get((a, b))
        if known is None:
            if len(self.memory) > 500_000:
                self.memory.clear()
            known = self.memory[a, b] = self._beside(a, b)
        return known

    def _beside(self, a: int, b: int) -> bool:
        # until_*: the rank at which that part is used up; of equal ranks the leftmost merge comes first
        left, right, until_left, until_right = a, b, 1 << 40, 1 << 40
        token, ranks, parts = self.token, self.ranks, self.parts
        while True:
            joint = ranks.get(token[left] + token[right])
            if joint is not None and joint < until_left and joint <= until_right:
                return False
            born_left = left if parts.get(left) else -1
            born_right = right if parts.get(right) else -1
            if born_left < 0 and born_right < 0:
                return True
            if born_left > born_right:
                until_left, left = left, parts[left][1]
            else:
                until_right, right = right, parts[right][0]

    def extend(self, text: bytes, last: list[int], stop=None) -> list[int]:
        """Adds to ``last`` (the last tokens of prefixes 1, 2, ...) what is missing for ``text``."""
        beside, begin = self.beside, max(0, len(last) + 1 - self.longest)
        filled = len(last)
        for at, (rank, size) in self.found.iter(text[begin:].decode("latin-1")):
            end = begin + at + 1
            if end <= filled:
                continue
            while filled < end - 1:
                last.append(-1)
                filled += 1
            start = end - size
            if start == 0 or last[start - 1] >= 0 and beside(last[start - 1], rank):
                last.append(rank)
                filled = end
                if stop is not None and stop(end, last):
                    break
        return last

    def tokens(self, last: list[int]) -> list[int]:
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.token[out[-1]])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.tokens(self.extend(piece, []))

    def append(self, text: bytes, last: list[int], more: bytes) -> tuple[bytes, list[int]]:
        """An unsplit text and its state, with bytes added; ``last`` is not changed."""
        return text + more, self.extend(text + more, last[:])

    def replace(self, text: bytes, last: list[int], start: int, stop: int, by: bytes) -> tuple[bytes, list[int]]:
        """An unsplit text and its state, with text[start:stop] replaced.

        Entries before the edit stay; entries after it are copied as soon as the last ``longest`` of them
        equal the old ones, for what follows depends on no more than that.
        """
        new, shift = text[:start] + by + text[stop:], start + len(by) - stop
        done = start + len(by)

        def same(end, out):
            return end >= done + self.longest and out[end - self.longest : end] == last[end - shift - self.longest : end - shift]

        out = self.extend(new, last[:start], same)
        return new, out + last[len(out) - shift :]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class _Pieces(dict):
    """Pieces of text to their ids as little-endian bytes."""

    def __init__(self, encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        ids = np.array(self.encoder.encode_piece(raw), "<u4").tobytes()
        if len(raw) <= CACHED_BYTES:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = ids
        return ids


_ready: dict[tuple[str, str], tuple] = B.keeping("bpe", {})


def _worker(path: str, pattern: str):
    B.only("bpe")
    key = (path, pattern)
    if key not in _ready:
        encoder = PrefixEncoder(read_ranks(path), pattern)
        _ready[key] = (encoder, _Pieces(encoder))
    return _ready[key]


def _encoder(names, path, pattern, text_col, ids_col):
    def run(batches):
        encoder, pieces = _worker(path, pattern)
        findall, get = encoder.split.findall, pieces.__getitem__
        for batch in batches:
            column = batch.column(names.index(text_col))
            _, off = B.utf8(column)
            for a, b in B.chunks(off):
                out = [b"".join(map(get, findall(t.decode()))) for t in B.texts_of(column.slice(a, b - a))]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), pa.array(out, pa.binary())], names=[*names, ids_col])

    return run


def encode(df: DataFrame, path: str, pattern: str, *, text_col="text", ids_col="ids") -> DataFrame:
    """``df`` with ``ids_col``: the ids as little-endian unsigned 32-bit integers, binary."""
    names = [c for c in df.columns if c != ids_col]
    kept = df.select(*names)
    return kept.mapInArrow(B.trimmed(_encoder(names, path, pattern, text_col, ids_col)), kept.withColumn(ids_col, F.lit(None).cast("binary")).schema)


def _decoder(names, path, ids_col, bytes_col):
    def run(batches):
        token = {v: k for k, v in read_ranks(path).items()}.__getitem__
        for batch in batches:
            column = batch.column(names.index(ids_col))
            _, off = B.utf8(column)
            for a, b in B.chunks(off, 8 << 20):
                out = [b"".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in B.texts_of(column.slice(a, b - a))]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), pa.array(out, pa.binary())], names=[*names, bytes_col])

    return run


def decode(df: DataFrame, path: str, *, ids_col="ids", bytes_col="decoded") -> DataFrame:
    """``df`` with ``bytes_col``: the bytes that the ids stand for."""
    names = [c for c in df.columns if c != bytes_col]
    kept = df.select(*names)
    return kept.mapInArrow(B.trimmed(_decoder(names, path, ids_col, bytes_col)), kept.withColumn(bytes_col, F.lit(None).cast("binary")).schema)


def _digests(batches):
    for batch in batches:
        ids, decoded = (list(B.texts_of(batch.column(batch.schema.names.index(c)))) for c in ("ids", "decoded"))
        sha = [[hashlib.sha256(x).hexdigest() for x in column] for column in (ids, decoded)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), *map(pa.array, sha)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id with the token count and the digests of encoded and decoded texts, in one pass."""
    encoder = _encoder(["doc_id", "text"], path, pattern, "text", "ids")
    decoder = _decoder(["doc_id", "text", "ids"], path, "ids", "decoded")
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(B.trimmed(lambda batches: _digests(decoder(encoder(batches)))), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark, sf_dir, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers

    path = vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digest(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
