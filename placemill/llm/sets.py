"""Sets of word shingles, their MinHash signatures, and groups of rows in sorted batches."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

from placemill.llm.words import Words, mix


@cache
def least_matches(threshold: float, tolerance: float, hashes: int) -> np.ndarray:
    """For 0 .. ``hashes`` compared hashes the fewest matches with which a pair is kept.

    Under a uniform prior the similarity after m matches of n is Beta(m + 1, n - m + 1) distributed, and exceeds t with
    the probability that a Binomial(n + 1, t) variable is at most m.
    """
    least = np.zeros(hashes + 1, np.int64)
    for n in range(hashes + 1):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        least[n] = m
    return least


def sequence_keys(words: Words) -> list[bytes | None]:
    """128 bits that agree for texts with equal words in equal order; None for a text without words."""
    counts = words.counts
    place = np.arange(len(words.hashes)) - np.repeat(words.bounds[:-1], counts)
    halves = []
    for salt in (1, 2):
        spread = mix(words.hashes + mix(place.astype(np.uint64) * np.uint64(2) + np.uint64(salt)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread)])
        halves.append(mix(sums[words.bounds[1:]] - sums[words.bounds[:-1]] + counts.astype(np.uint64)))
    both = np.ascontiguousarray(np.stack(halves, axis=1))
    return [both[k].tobytes() if counts[k] else None for k in range(len(counts))]


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles of ``size`` words, sorted within a text, and where each text's begin (and the last's end). A
    text of fewer words has them all as its only one."""
    hashes, first = words.grams(size)
    text = words.text_of()[first]
    for fewer in range(1, size):
        few = np.flatnonzero(words.counts == fewer)
        if len(few):
            whole, at = words.grams(fewer)
            hashes = np.concatenate([hashes, whole[np.searchsorted(at, words.bounds[few])]])
            text = np.concatenate([text, few])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(words.bounds)))


def minima(hashes: np.ndarray, bounds: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """One row for each text that has shingles: half as many 32-bit MinHashes as there are ``seeds``."""
    count = len(seeds) // 2
    multiply, add = seeds[:count] | np.uint64(1), seeds[count:]
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(starts), count), np.uint32)
    if len(starts):
        for k in range(count):
            hashed = ((hashes * multiply[k] + add[k]) >> np.uint64(32)).astype(np.uint32)
            out[:, k] = np.minimum.reduceat(hashed, starts)
    return out


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


def whole_groups(batches: Iterator[pa.RecordBatch], column: str, rows: int) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows, if there are as many, that end where a value of ``column`` (a number) ends."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        if sum(part.num_rows for part in waiting) < rows:
            continue
        table = pa.Table.from_batches(waiting).combine_chunks()
        values = table.column(column).to_numpy()
        change = np.flatnonzero(values[1:] != values[:-1])
        last = int(change[-1]) + 1 if len(change) else 0
        if last:
            yield table.slice(0, last)
        waiting = table.slice(last).combine_chunks().to_batches()
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin and end."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return starts, np.append(starts[1:], len(values))


def pairs_in(
    starts: np.ndarray, stops: np.ndarray, side: np.ndarray, within: np.ndarray, most: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers to compare in each run of rows, at most about ``most`` at a time: all pairs of a run of one
    block (``within``), or those of one ``side`` with the other."""
    lefts, rights, held = [], [], 0
    for start, stop in zip(starts, stops, strict=True):
        if within[start]:
            left, right = np.triu_indices(stop - start, 1)
        else:
            one, two = np.flatnonzero(~side[start:stop]), np.flatnonzero(side[start:stop])
            left, right = np.repeat(one, len(two)), np.tile(two, len(one))
        lefts.append(left + start)
        rights.append(right + start)
        held += len(left)
        if held >= most:
            yield np.concatenate(lefts), np.concatenate(rights)
            lefts, rights, held = [], [], 0
    if held:
        yield np.concatenate(lefts), np.concatenate(rights)


class Classes:
    """Union-find over row numbers."""

    def __init__(self, size: int) -> None:
        self.parent = list(range(size))

    def root(self, k: int) -> int:
        parent = self.parent
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    def join(self, a: int, b: int) -> bool:
        """Whether they were apart."""
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b
