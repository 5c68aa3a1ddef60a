"""Vectorised helpers over Arrow batches of UTF-8 text.

Texts of a batch are handled as one byte buffer with offsets, so tokenising
and hashing cost a few numpy passes instead of one Python call for each word.
A null text counts as an empty one everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _table(separators) -> tuple[bytes, np.ndarray]:
    lowered = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    is_separator = np.zeros(256, bool)
    is_separator[list(separators)] = True
    return bytes(32 if is_separator[b] and is_separator[lowered[b]] else lowered[b] for b in range(256)), is_separator


#: Bytes to their lower case; what stands between words becomes a space.
SPACES, _SPACE_SET = _table([0x20, *range(0x09, 0x0E)])
NON_WORD, _ = _table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, joined, and len + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row is a range of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def texts_of(column) -> Iterator[bytes]:
    """Each row's UTF-8 bytes."""
    buf, off = utf8(column)
    whole = memoryview(buf)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        yield bytes(whole[a:b])


def translated(buf: np.ndarray, table: bytes) -> np.ndarray:
    return np.frombuffer(buf.tobytes().translate(table), np.uint8)


def word_spans(text: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words of translated text; words never cross rows."""
    if not len(text):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = text != 32
    first = np.zeros(len(text) + 1, bool)
    first[off] = True
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | first[:-1]))
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | first[1:])) + 1
    rows = np.searchsorted(off, starts, "right") - 1
    return starts, ends, rows


_powers: dict[str, np.ndarray] = {}
#: What a worker keeps between tasks, by the operators that use it.
_kept: dict[str, dict] = {"hashes": _powers}


def keeping(name: str, cache: dict) -> dict:
    """A cache to be kept from task to task while operators of one kind run in this worker."""
    return _kept.setdefault(name, cache)


def only(name: str) -> None:
    """Other operators' caches go, and their memory goes back, for workers outlive queries."""
    others = [c for k, c in _kept.items() if k != name and c]
    if others:
        for cache in others:
            cache.clear()
        give_back()


def give_back() -> None:
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not this C library; memory stays with the process


_settled = False


def _settle() -> None:
    """Collections leave out what the worker has imported: going through that takes 20 ms, and Spark collects after each task too."""
    global _settled
    if not _settled:
        import gc

        gc.freeze()
        _settled = True


def trimmed(run):
    """A worker function that gives memory back when a task is through; workers stay, and so would what they hold."""

    def through(batches):
        _settle()
        yield from run(batches)
        give_back()

    return through


def _power(kind: str, n: int) -> np.ndarray:
    only("hashes")
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        base = np.uint64(_BASE if kind == "up" else _INVERSE)
        out = np.full(size, base, np.uint64)
        out[0] = 1
        have = _powers[kind] = np.cumprod(out)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Hasher:
    """64-bit hashes of any spans of one buffer, from one prefix sum."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _power("up", n), out=self.prefix[1:])
        self.inverse = _power("down", n + 1)

    def raw(self, starts, ends) -> np.ndarray:
        return (self.prefix[ends] - self.prefix[starts]) * self.inverse[starts]

    def spans(self, starts, ends) -> np.ndarray:
        return mix(self.raw(starts, ends) + (ends - starts).astype(np.uint64))


def crc_fold(ids, folds: int) -> np.ndarray:
    """crc32 of each id written as text, modulo ``folds``."""
    import zlib

    return np.array([zlib.crc32(str(i).encode()) % folds for i in ids.to_pylist()], np.int64)


def pack_ranges(buckets: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by bucket, and each bucket's start in it."""
    order = np.argsort(buckets, kind="stable")
    return order, np.searchsorted(buckets[order], np.arange(n_buckets + 1))
