"""Words and word n-grams of many texts at once, in numpy over UTF-8 bytes.

A word is a run of an alphabet's bytes, by default of ASCII digits, ASCII letters and bytes of other characters; A-Z are
lower-cased. Words and n-grams are represented by 64-bit hashes that depend on their bytes alone, so they agree between
tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is worked on alone.
BLOCK_BYTES = 1_000_000

_PLACE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: For 0 .. 8 bytes a mask that keeps so many of a 64-bit number's lowest.
_KEEP = np.array([(1 << 8 * count) - 1 for count in range(9)], np.uint64)


class Alphabet(NamedTuple):
    """Which bytes words are made of, and each byte with A-Z lowered."""

    inside: np.ndarray
    lowered: np.ndarray


_BYTES = np.arange(256, dtype=np.uint8)
_LOWERED = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, letters, and all bytes of other characters.
LETTERS_AND_DIGITS = Alphabet(
    ((_LOWERED >= 48) & (_LOWERED <= 57)) | ((_LOWERED >= 97) & (_LOWERED <= 122)) | (_LOWERED >= 128), _LOWERED
)
#: ``[^\x20\x09-\x0D]+``: all but ASCII white space.
UNSPACED = Alphabet((_BYTES != 32) & ((_BYTES < 9) | (_BYTES > 13)), _LOWERED)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


class Words(NamedTuple):
    """Words of a block of texts: their hashes, and where each text's words begin (one more entry than texts)."""

    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        """For each word the number of its text in the block."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words within a text, and the index of the first word of each."""
        size = len(self.hashes) - n + 1
        if size <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = self.hashes[:size].copy()
        for k in range(1, n):
            total *= _STEP
            total += self.hashes[k : k + size]
        last = np.repeat(self.bounds[1:], self.counts)[:size]
        first = np.flatnonzero(np.arange(size) + n <= last)
        return mix(total[first]), first


def blocks(texts: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive texts as (number of the first, their bytes, offsets of the texts in them); null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    content = texts.buffers()[2]
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        stop = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        stop = min(max(stop, first + 1), len(texts))
        yield first, data[offsets[first] : offsets[stop]], offsets[first : stop + 1] - offsets[first]
        first = stop


def words_of(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet = LETTERS_AND_DIGITS) -> Words:
    """Words of the texts that ``blocks`` gave."""
    # A text's end also ends its last word.
    inside = np.zeros(len(data) + 1, np.int8)
    inside[:-1] = alphabet.inside[data]
    change = np.diff(inside, prepend=np.int8(0))
    starts, ends = change == 1, change == -1
    cut = offsets[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    cut = cut[(inside[cut] == 1) & (inside[cut - 1] == 1)]
    starts[cut] = True
    ends[cut] = True
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    return Words(_hashes(alphabet.lowered[data], starts, ends), np.searchsorted(starts, offsets))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of bytes: the sum of its eight-byte pieces, each mixed with its place, mixed with its length.

    Mixing every piece before they are summed leaves no linear relation between words that would make them collide.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    sizes = ends - starts
    pieces = (sizes + 7) >> 3
    first = np.cumsum(pieces) - pieces
    owner = np.repeat(np.arange(len(starts)), pieces)
    place = np.arange(len(owner)) - first[owner]
    value = eight[starts[owner] + 8 * place] & _KEEP[np.minimum(sizes[owner] - 8 * place, 8)]
    mixed = mix(value + place.astype(np.uint64) * _PLACE)
    return mix(np.add.reduceat(mixed, first) + sizes.astype(np.uint64) * _STEP)
