"""A bidirectional FM-index over a delimited vocabulary, and the search scheme for words that differ by one character.

The words are joined, each behind a delimiter that is smaller than all characters; suffix ranks of this text, and of that
of the reversed words, tell where each pattern lies. A pattern is held as the interval of suffix ranks in both texts and
can be made longer at either end. As the words are sorted, the delimiters' ranks are the words' numbers. All steps are
taken for many patterns at once.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Characters between two rows of the table of counts.
STRIDE = 32
#: Patterns that are made longer at once, which bounds the memory of a step.
AT_ONCE = 200_000


class Words(NamedTuple):
    """Words as one array of character numbers (from 1; 0 is the delimiter) and where each begins (one more entry)."""

    chars: np.ndarray
    bounds: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def reversed(self) -> Words:
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        place = np.arange(len(self.chars)) - self.bounds[owner]
        return Words(self.chars[self.bounds[owner + 1] - 1 - place], self.bounds)


def numbered(words: list[str], alphabet: np.ndarray) -> Words:
    """Words by the places of their characters in the sorted ``alphabet``."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    bounds = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(word) for word in words], out=bounds[1:])
    return Words((np.searchsorted(alphabet, points) + 1).astype(np.int32), bounds)


def _suffix_ranks(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The delimited text, and its positions in the order of their suffixes, by doubling the ranked length.

    A delimiter is ranked by the word behind it, so suffixes differ by the next delimiter at the latest.
    """
    count, total = len(words.sizes), len(words.sizes) + len(words.chars)
    text = np.zeros(total, np.int32)
    at = words.bounds[:-1] + np.arange(count)
    letters = np.ones(total, bool)
    letters[at] = False
    text[letters] = words.chars
    rank = text.astype(np.int64) + count
    rank[at] = np.arange(count)
    reach = 1
    while True:
        ahead = np.zeros(total, np.int64)
        ahead[:-reach] = rank[reach:] + 1
        key = rank * (rank.max() + 2) + ahead
        order = np.argsort(key, kind="stable")
        new = np.ones(total, np.int64)
        new[0] = 0
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(total, np.int64)
        rank[order] = np.cumsum(new)
        reach *= 2
        if rank[order[-1]] == total - 1 or reach >= total:
            return text, order


class _Side:
    """What stands before each suffix of one text, with counts of smaller characters."""

    def __init__(self, words: Words, symbols: int) -> None:
        text, order = _suffix_ranks(words)
        self.before = text[order - 1]
        rows = -(-(len(text) + 1) // STRIDE)
        blocks = np.full(rows * STRIDE, symbols, np.int32)
        blocks[: len(text)] = self.before
        self.blocks = blocks.reshape(rows, STRIDE).astype(np.uint8 if symbols < 256 else np.int32)
        counts = np.bincount(
            np.repeat(np.arange(rows), STRIDE) * (symbols + 1) + blocks, minlength=rows * (symbols + 1)
        ).reshape(rows, symbols + 1)
        # below[r, c]: characters smaller than c before block r.
        self.below = np.zeros((rows + 1, symbols + 1), np.int32)
        np.cumsum(np.cumsum(counts, axis=1)[:, :-1], axis=0, out=self.below[1:, 1:])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])

    def smaller(self, char: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Characters smaller than ``char`` before the first ``end`` suffixes."""
        block, rest = end // STRIDE, end % STRIDE
        inside = self.blocks[block] < char[:, None].astype(self.blocks.dtype)
        inside &= np.arange(STRIDE) < rest[:, None]
        return self.below[block, char] + inside.sum(1)


class Intervals(NamedTuple):
    """Patterns: the first suffix ranks in the text and in the reversed words' text, and how many suffixes there are."""

    low: np.ndarray
    back: np.ndarray
    size: np.ndarray

    def take(self, chosen: np.ndarray) -> Intervals:
        return Intervals(self.low[chosen], self.back[chosen], self.size[chosen])


class Index:
    """Over sorted, different words."""

    def __init__(self, words: Words, symbols: int) -> None:
        self.words = words
        self.forward = _Side(words, symbols)
        turned = words.reversed()
        self.backward = _Side(_sorted(turned), symbols)

    def empty(self, count: int) -> Intervals:
        return Intervals(
            np.zeros(count, np.int64), np.zeros(count, np.int64), np.full(count, len(self.forward.before), np.int64)
        )

    def left(self, at: Intervals, char: np.ndarray) -> Intervals:
        """The patterns with a character put before each."""
        parts = [
            _extended(self.forward, at.low[k : k + AT_ONCE], at.size[k : k + AT_ONCE], char[k : k + AT_ONCE])
            for k in range(0, max(len(char), 1), AT_ONCE)
        ]
        low, skipped, size = (np.concatenate(part) for part in zip(*parts, strict=True))
        return Intervals(low, at.back + skipped, size)

    def right(self, at: Intervals, char: np.ndarray) -> Intervals:
        """The patterns with a character put behind each."""
        back, low, size = self.mirrored().left(Intervals(at.back, at.low, at.size), char)
        return Intervals(low, back, size)

    def mirrored(self) -> Index:
        """The same index of the reversed words; its left is this one's right."""
        other = object.__new__(Index)
        other.words, other.forward, other.backward = self.words, self.backward, self.forward
        return other


def _extended(side: _Side, low: np.ndarray, size: np.ndarray, char: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    high = low + size
    smaller, larger = side.smaller(char, low), side.smaller(char + 1, low)
    skipped = side.smaller(char, high) - smaller
    return side.first[char] + larger - smaller, skipped, side.smaller(char + 1, high) - larger - skipped


def _sorted(words: Words) -> Words:
    """The words in the order of their characters; by suffix ranks, whatever their lengths."""
    texts = [words.chars[a:b].astype(">i4").tobytes() for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
    texts.sort()
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(text) // 4 for text in texts], out=bounds[1:])
    return Words(np.frombuffer(b"".join(texts), ">i4").astype(np.int32), bounds)


def _children(index: Index, at: Intervals) -> tuple[np.ndarray, np.ndarray, Intervals]:
    """All characters that stand behind patterns in the text: the pattern's number, the character, the longer pattern."""
    owner = np.repeat(np.arange(len(at.size)), at.size)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(at.size) - at.size, at.size)
    symbols = np.int64(index.backward.first.size)
    key, count = np.unique(owner * symbols + index.backward.before[at.back[owner] + place], return_counts=True)
    owner, char = key // symbols, (key % symbols).astype(np.int32)
    ends = np.cumsum(count)
    start = np.searchsorted(owner, owner)
    earlier = ends - count - (ends[start] - count[start])
    low, rank = at.back[owner], np.empty(0)
    rank = np.concatenate(
        [
            index.backward.first[char[k : k + AT_ONCE]]
            + index.backward.smaller(char[k : k + AT_ONCE] + 1, low[k : k + AT_ONCE])
            - index.backward.smaller(char[k : k + AT_ONCE], low[k : k + AT_ONCE])
            for k in range(0, max(len(char), 1), AT_ONCE)
        ]
    )
    return owner, char, Intervals(at.low[owner] + earlier, rank, count)


def _search(index: Index, words: Words, half: np.ndarray, *, again: bool) -> tuple[np.ndarray, np.ndarray]:
    """Words that begin with the first ``half`` characters of a word and differ by one character behind them.

    Returns the numbers of the searched words and the first suffix ranks (in the text) of what was found, each pair once.
    Unless ``again``, what also ends like the word from its ``half`` on is left out: it begins with the first half of the
    reversed word, and so is found from there.
    """
    sizes, starts = words.sizes, words.bounds[:-1]
    char = lambda who, place: words.chars[starts[who] + place]
    # The first half exactly, from its end to the delimiter before it.
    who = np.arange(len(sizes))
    at = index.empty(len(who))
    for step in range(int(half.max(initial=0))):
        going = np.flatnonzero(half[who] > step)
        longer = index.left(at.take(going), char(who[going], half[who[going]] - 1 - step))
        for whole, part in zip(at, longer, strict=True):
            whole[going] = part
        alive = at.size > 0
        who, at = who[alive], at.take(alive)
    at = index.left(at, np.zeros(len(who), np.int32))
    found_by, found = [], []
    # First place behind the half whose character is not the first one's: up to there all are equal.
    equal = np.zeros(len(sizes), np.int64)
    place = half.copy()
    alive = at.size > 0
    who, at = who[alive], at.take(alive)
    while len(who):
        here, size = place[who], sizes[who]
        ended = here >= size
        own = np.where(ended, 0, char(who, np.minimum(here, size - 1)))
        # Reversed patterns end with a delimiter, so none begins another one: equal ranks mean equal patterns.
        key = at.back * np.int64(2**31) + at.size
        _, first, state = np.unique(key, return_index=True, return_inverse=True)
        owner, letter, longer = _children(index, at.take(first))
        begin, end = np.searchsorted(owner, state), np.searchsorted(owner, state, "right")
        # Every pattern with every character behind it.
        pattern = np.repeat(np.arange(len(who)), end - begin)
        child = np.arange(len(pattern)) - np.repeat(np.cumsum(end - begin) - (end - begin), end - begin) + begin[pattern]
        letters = letter[child]
        other = (letters != own[pattern]) & (letters != 0)
        replaced = np.flatnonzero(other & ~ended[pattern])
        put = other
        before = np.where(here > half[who], char(who, np.maximum(here - 1, 0)), 0)
        if not again:
            # Behind equal characters only, one more of them, or any right behind the half, leaves the other half whole.
            run = equal[who] == here - half[who]
            put = put & ~((here == half[who])[pattern] | (run[pattern] & (letters == before[pattern])))
        put = np.flatnonzero(put)
        # Of equal neighbours the first is left out.
        edge = char(who, np.maximum(here - 1, 0))
        left_out = np.flatnonzero(~ended & ((edge != own) | ((here == half[who]) & again)))
        branch = [
            (who[pattern[replaced]], longer.take(child[replaced]), here[pattern[replaced]] + 1),
            (who[pattern[put]], longer.take(child[put]), here[pattern[put]]),
            (who[left_out], at.take(left_out), here[left_out] + 1),
        ]
        by = np.concatenate([part[0] for part in branch])
        state = Intervals(*(np.concatenate([part[1][k] for part in branch]) for k in range(3)))
        ahead = np.concatenate([part[2] for part in branch])
        for one, low in _finish(index, words, by, state, ahead):
            found_by.append(one)
            found.append(low)
        # And on with the word's own character.
        same = np.flatnonzero((letters == own[pattern]) & ~ended[pattern])
        kept = pattern[same]
        first_char = char(who[kept], half[who[kept]])
        equal[who[kept]] += (equal[who[kept]] == here[kept] - half[who[kept]]) & (own[kept] == first_char)
        place[who[kept]] += 1
        who, at = who[kept], longer.take(child[same])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_by), np.concatenate(found)


def _finish(index: Index, words: Words, by: np.ndarray, at: Intervals, place: np.ndarray):
    """The rest of each word exactly, and the delimiter behind it."""
    sizes, starts = words.sizes, words.bounds[:-1]
    while len(by):
        ended = place > sizes[by]
        if ended.any():
            yield by[ended], at.low[ended]
            going = ~ended
            by, at, place = by[going], at.take(going), place[going]
            continue
        last = place == sizes[by]
        char = np.where(last, 0, words.chars[np.minimum(starts[by] + place, len(words.chars) - 1)]).astype(np.int32)
        at = index.right(at, char)
        alive = at.size > 0
        by, at, place = by[alive], at.take(alive), place[alive] + 1


def near_words(
    indexed: Words, symbols: int, first: Words | None, second: Words | None
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words of ``first`` those of the sorted ``indexed`` that have its first half and one error behind it; for words
    of ``second`` those that have its other half and one error before it, but not its first half too. Each as numbers of
    the searched and of the found words. Together, for one list of words, they find every near word once.
    """
    index = Index(indexed, symbols)
    out = []
    if first is not None:
        out.append(_search(index, first, first.sizes // 2, again=True))
    if second is not None:
        turned = second.reversed()
        half = second.sizes - second.sizes // 2
        by, back = _search(index.mirrored(), turned, half, again=False)
        # Ranks among the reversed words; the words' own by their order.
        order = _order_of_reversed(indexed)
        out.append((by, order[back]))
    return out


def _order_of_reversed(words: Words) -> np.ndarray:
    """For each place in the order of reversed words the word's number."""
    turned = words.reversed()
    texts = [turned.chars[a:b].astype(">i4").tobytes() for a, b in zip(turned.bounds[:-1], turned.bounds[1:], strict=True)]
    return np.array(sorted(range(len(texts)), key=texts.__getitem__), np.int64)
