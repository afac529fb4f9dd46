"""Enhanced suffix array of many strings and its common-prefix interval tree.

Strings are concatenated with an end mark that sorts before every byte, so no common prefix runs
over a string's end. Ranks come from prefix doubling over packed bytes, common prefixes from the
stored ranks; both are whole-array numpy steps. The interval tree is scanned bottom up on a stack.
"""

from __future__ import annotations

import numpy as np

_PACK = 7  # nine bits each: 0 for the end mark, byte + 1 otherwise


class SuffixArray:
    """Suffixes of the strings data[offsets[i]:offsets[i + 1]] that have ``least`` bytes or more."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, least: int):
        size = np.diff(offsets)
        n = int(len(data) + len(size))  # an end mark after every string
        self.string = np.repeat(np.arange(len(size)), size + 1)
        begin = offsets[:-1] + np.arange(len(size))
        self.offset = np.arange(n) - begin[self.string]
        self.left = size[self.string] - self.offset  # bytes up to the end mark
        self.value = np.zeros(n, dtype=np.int64)
        self.value[self.left > 0] = data.astype(np.int64) + 1
        packed = np.zeros(n, dtype=np.int64)
        for j in range(_PACK):
            ahead = np.zeros(n, dtype=np.int64)
            ahead[:max(0, n - j)] = self.value[j:]
            ahead[self.left < j] = 0
            packed = (packed << 9) | ahead
        self.ranks = [(_PACK, np.unique(packed, return_inverse=True)[1])]
        longest = int(size.max(initial=0))
        while self.ranks[-1][0] < longest:
            width, rank = self.ranks[-1]
            ahead = np.zeros(n, dtype=np.int64)
            inside = np.flatnonzero(self.left >= width)
            ahead[inside] = rank[inside + width] + 1
            self.ranks.append((width * 2, np.unique(rank * (n + 1) + ahead, return_inverse=True)[1]))
        own = np.flatnonzero(self.left >= max(1, least))
        self.order = own[np.argsort(self.ranks[-1][1][own], kind="stable")]
        self.lcp = self._common(self.order[:-1], self.order[1:])  # lcp[i]: order[i] with order[i + 1]

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        done = np.zeros(len(a), dtype=np.int64)
        top = len(self.value) - 1
        for width, rank in reversed(self.ranks):
            x, y = np.minimum(a + done, top), np.minimum(b + done, top)
            done += width * ((self.left[x] >= width) & (self.left[y] >= width) & (rank[x] == rank[y]))
        going = np.ones(len(a), dtype=bool)
        for _ in range(_PACK - 1):
            x, y = np.minimum(a + done, top), np.minimum(b + done, top)
            going &= (self.left[x] > 0) & (self.value[x] == self.value[y])
            done += going
        return done

    def intervals(self, least: int):
        """The tree's nodes with a common prefix of ``least`` bytes or more, children first.

        Yields (length, first, last, diverse): the node's suffixes are order[first..last]; it is
        diverse if they are not all preceded by one and the same byte. A diverse node's prefix is
        a maximal repeat and its suffixes are all its occurrences.
        """
        before = np.where(self.offset[self.order] > 0, self.value[self.order - 1], -1)
        differs = (before[1:] != before[:-1]) | (before[1:] < 0) | (before[:-1] < 0)
        changes = np.r_[0, np.cumsum(differs)].tolist()
        long = self.lcp >= least
        edge = np.diff(np.r_[False, long, False].astype(np.int8))
        for lo, hi in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            stack: list[tuple[int, int]] = []  # (length, first)
            for i, length in enumerate([*self.lcp[lo:hi].tolist(), 0], lo):
                first = i
                while stack and stack[-1][0] > length:
                    depth, first = stack.pop()
                    yield depth, first, i, changes[i] > changes[first]
                if length >= least and (not stack or stack[-1][0] < length):
                    stack.append((length, first))


def maximal_repeats(texts: list[bytes], least: int) -> list[tuple[bytes, list[tuple[int, int]]]]:
    """Every maximal repeat of ``least`` bytes or more with all occurrences (string, offset)."""
    if least < 1:
        raise ValueError("least must be positive")
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    array = SuffixArray(data, np.r_[0, np.cumsum([len(x) for x in texts])].astype(np.int64), least)
    out = []
    for length, first, last, diverse in array.intervals(least):
        if diverse:
            at = array.order[first:last + 1]
            places = sorted(zip(array.string[at].tolist(), array.offset[at].tolist()))
            s, o = places[0]
            out.append((texts[s][o:o + length], places))
    return sorted(out)


def later_occurrences(array: SuffixArray, least: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix position, length) of each occurrence of a maximal repeat but the first by ``rank``.

    ``rank`` orders suffix positions. A suffix is given once, with the longest repeat of which it
    is not the first occurrence: from its children's firsts a node keeps the first of all.
    """
    at, size, tree = [], [], []
    best = rank[array.order].tolist()
    for length, first, last, diverse in array.intervals(least):
        # `tree` holds the firsts of the closed nodes before this one: (node's first slot, slot of the first)
        kids = []
        while tree and tree[-1][0] >= first:
            kids.append(tree.pop())
        slots, i = [], first
        for begin, end, slot in reversed(kids):
            slots.extend(range(i, begin))
            slots.append(slot)
            i = end + 1
        slots.extend(range(i, last + 1))
        least_slot = min(slots, key=best.__getitem__)
        if diverse:
            for s in slots:
                if s != least_slot:
                    at.append(s)
                    size.append(length)
        tree.append((first, last, least_slot))
    return array.order[np.array(at, dtype=np.int64)], np.array(size, dtype=np.int64)
