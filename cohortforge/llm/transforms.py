"""Burrows-Wheeler transforms of string shards, and their merge by interleave refinement.

A shard of strings is sorted once and then is only its transform: for every suffix, in order, the symbol before it.
Two transforms merge without a look at the text and without sorting suffixes: each side's own order stays, and what is
refined is the interleave of the two.

*Going on.*  The j-th suffix that starts with a symbol is the one behind the j-th place of that symbol in the transform,
so the transform gives, for each suffix, the suffix one symbol further on; composing this with itself gives any distance.

*Refinement.*  To depth d, suffixes of both sides lie in blocks that agree in d symbols.  Within a block, those of either
side are in order already; merging them by the blocks of the suffixes d further on (two runs in order) gives depth 2d.
A block of suffixes of one side only is final: its order is that side's.  The depth at which neighbours of two sides part
is their common prefix (rounded down to a depth of refinement); neighbours of one side keep theirs.

Symbols are the ranks of the bytes present, from one on; zero ends each string and stands before its start.  Suffixes
that are equal to their end are in the order of their strings.
"""

from __future__ import annotations

import numpy as np


def schedule(lengths, longest: int) -> list[int]:
    """Depths of refinement: doubling from 8 on, with each of the lengths, until the longest string."""
    depths = [8]
    while depths[-1] < longest:
        depths.append(min([2 * depths[-1], *(n for n in lengths if n > depths[-1])]))
    return depths


class Shard:
    """A transform in order; ``origin``: each suffix's place; ``common``: the depth to which it agrees with the one before."""

    def __init__(self, transform: np.ndarray, origin: np.ndarray, common: np.ndarray):
        self.transform, self.origin, self.common = transform, origin, common


# --- one shard from its text ---------------------------------------------------------------------


class Strings:
    """Strings as coded symbols, each with its end."""

    def __init__(self, strings: list[bytes], lengths):
        sizes = np.array([len(s) for s in strings], np.int64)
        self.start = np.concatenate([[0], np.cumsum(sizes + 1)])
        raw = np.frombuffer(b"".join(strings), np.uint8)
        used = np.flatnonzero(np.bincount(raw, minlength=256))
        code = np.zeros(256, np.uint16)
        code[used] = np.arange(1, len(used) + 1)
        #: bits of a symbol; so many that 8 of them, or 4, fit in a key
        self.bits = 8 if len(used) < 256 else 16
        self.symbols = np.zeros(int(self.start[-1]), np.uint16)
        inside = np.ones(len(self.symbols), bool)
        inside[self.start[1:] - 1] = False
        self.symbols[inside] = code[raw]
        self.longest = int(sizes.max(initial=0)) + 1
        self.depths = schedule(lengths, self.longest)

    def shard(self, first: int, last: int) -> Shard:
        """The transform of strings first to last - 1: suffixes sorted by doubling."""
        base, end = int(self.start[first]), int(self.start[last])
        text = self.symbols[base:end]
        n = end - base
        ends = self.start[first + 1 : last + 1] - 1 - base
        left = (np.repeat(ends, np.diff(self.start[first : last + 1])) - np.arange(n)).astype(np.int32)  # symbols up to the end
        key = text.astype(np.uint64)
        depth, wide = 1, self.bits
        while depth * self.bits < 64:
            further = np.zeros(n, np.uint64)
            further[: max(n - depth, 0)] = key[depth:]
            key = key << np.uint64(wide) | np.where(left >= depth, further, 0)
            depth, wide = 2 * depth, 2 * wide
        order = np.argsort(key).astype(np.int32)
        key = key.take(order)
        new = np.append(True, key[1:] != key[:-1])
        common = np.zeros(n, np.int32)
        live = np.arange(n)
        head = np.maximum.accumulate(np.where(new, live, 0))
        block = np.empty(n + 1, np.int32)
        block[order], block[n] = head, -1
        for to in [d for d in self.depths if d > depth] if n else []:
            several = ~(new & np.append(new[1:], True))  # in blocks of two or more
            live, new = live[several], new[several]
            if not len(live):
                break
            at = order.take(live)
            step = to - depth
            key = block.take(at) * np.int64(n + 2) + np.where(left.take(at) >= step, block.take(np.minimum(at + step, n)), -1) + 1
            by = np.argsort(key)
            at, key = at.take(by), key.take(by)
            order[live] = at
            apart = np.append(True, key[1:] != key[:-1])
            common[live[apart & ~new]] = depth
            new = apart
            block[at] = live.take(np.maximum.accumulate(np.where(new, np.arange(len(live)), 0)))
            depth = to
        alone = new & np.append(new[1:], True)
        live, new = live[~alone], new[~alone]
        at = order.take(live)  # equal to their ends: in the order of their strings
        order[live] = at[np.lexsort((at, block.take(at)))]
        common[live[~new]] = self.depths[-1]
        before = text[order - 1]
        before[order == 0] = 0
        return Shard(before, order + base, common)


# --- merging -------------------------------------------------------------------------------------


class _Side:
    """What a merge needs of one shard, all from its transform."""

    def __init__(self, transform: np.ndarray):
        n = len(transform)
        narrow = transform.astype(np.uint8) if n and transform.max() < 256 else transform
        counts = np.bincount(narrow, minlength=1)
        self.first = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)  # first symbols in order
        one = np.append(np.argsort(narrow, kind="stable"), n).astype(np.int32)
        one[: counts[0]] = n  # nothing follows an end
        self.steps = {1: one}
        self.block = np.full(n + 1, -1, np.int32)

    def further(self, at: np.ndarray | None, step: int) -> np.ndarray:
        """For suffixes (None: all) the ones so many symbols further on (the last entry where there is none).

        Whole tables are made for powers of two only, and only while that costs less than several steps for those asked.
        """
        if at is None and step in self.steps:
            return self.steps[step]
        held = max(s for s in self.steps if s <= step)
        if at is None:
            half = self.steps[held]
            self.steps[2 * held] = half.take(half)
            return self.further(None, step)
        while 2 * held <= step and len(at) * (step // held) > 2 * len(self.block):
            held *= 2
            self.further(None, held)
        while step:
            held = max(s for s in self.steps if s <= step)
            at, step = self.steps[held].take(at), step - held
        return at

    def keys(self, bits: int) -> tuple[np.ndarray, int]:
        """The first symbols of each suffix in one number, and how many."""
        key, depth = np.append(self.first, np.uint64(0)), 1
        while depth * bits < 64:
            key = key << np.uint64(bits * depth) | key.take(self.further(None, depth))
            depth *= 2
        return key[:-1], depth


def _places(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the items of two runs in order stand in their merge; of equal ones a's go first."""
    return np.arange(len(a)) + np.searchsorted(b, a, "left"), np.arange(len(b)) + np.searchsorted(a, b, "right")


def merge(a: Shard, b: Shard, depths: list[int], bits: int) -> Shard:
    """The shard of both sides' strings (a's before b's), from the two transforms."""
    na, nb = len(a.transform), len(b.transform)
    n = na + nb
    A, B = _Side(a.transform), _Side(b.transform)
    (ka, depth), (kb, _) = A.keys(bits), B.keys(bits)
    at_a, at_b = _places(ka, kb)
    live_a, live_b, slots = np.arange(na), np.arange(nb), np.arange(n)
    in_a, in_b = at_a, at_b  # of the live ones: places among the live ones
    parted = np.full(n, depths[-1], np.int32)
    rest = iter([d for d in depths if d > depth])
    before = 0
    while True:
        key = np.empty(len(slots), ka.dtype)
        key[in_a], key[in_b] = ka, kb
        apart = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
        if before:  # blocks that were apart already have their depth
            apart_before = np.append(True, np.diff(key // np.int64(n + 2)) != 0)
            parted[slots[apart & ~apart_before]] = before
        else:
            parted[slots[apart]] = 0
        heads = np.flatnonzero(apart)
        size = np.diff(np.append(heads, len(key)))
        head = np.repeat(slots[heads], size)
        A.block[live_a], B.block[live_b] = head[in_a], head[in_b]
        from_a = np.zeros(len(key), np.int64)
        from_a[in_a] = 1
        of_a = np.add.reduceat(from_a, heads) if len(heads) else heads
        mixed = np.repeat((of_a > 0) & (of_a < size), size)
        to = next(rest, None)
        if to is None or not mixed.any():
            break
        live_a, live_b, slots = live_a[mixed[in_a]], live_b[mixed[in_b]], slots[mixed]
        step, before, depth = to - depth, depth, to
        ka, kb = (s.block.take(live) * np.int64(n + 2) + s.block.take(s.further(live, step)) + 1 for s, live in ((A, live_a), (B, live_b)))
        in_a, in_b = _places(ka, kb)
        at_a[live_a], at_b[live_b] = slots[in_a], slots[in_b]
    transform, origin = np.empty(n, np.uint16), np.empty(n, np.int64)
    for shard, at in ((a, at_a), (b, at_b)):
        transform[at], origin[at] = shard.transform, shard.origin
        if len(at) > 1:  # neighbours of one side keep their common prefix
            beside = np.flatnonzero(np.diff(at) == 1) + 1
            parted[at[beside]] = shard.common[beside]
    return Shard(transform, origin, parted)


def merged(strings: Strings, shard_bytes: int) -> Shard:
    """The transform of all strings, from shards of even size and about so many bytes."""
    end = int(strings.start[-1])
    count = max(1, round(end / shard_bytes))
    cuts = np.unique(np.append(np.searchsorted(strings.start, end * np.arange(count) // count), len(strings.start) - 1)).tolist()
    shards = [strings.shard(a, b) for a, b in zip(cuts, cuts[1:])]
    while len(shards) > 1:
        shards = [merge(a, b, strings.depths, strings.bits) for a, b in zip(shards[::2], shards[1::2])] + shards[len(shards) // 2 * 2 :]
    return shards[0]
