"""Vectorised rolling hashes over UTF-8 bytes and words, for use inside Spark tasks.

A sequence hash is polynomial modulo 2**64 over random 64-bit values per element, so the hash of
any run of elements comes from one prefix sum; a final mix spreads the bits. Every helper works on
whole numpy arrays, never element by element.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)

# The six ASCII blanks between words.
_BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[list(_BLANKS)] = False
# Word bytes of normalised text: ASCII letters and digits and everything beyond ASCII.
ALNUM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])

_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            step = np.full(size, _BASE, dtype=np.uint64)
            back = np.full(size, _BASE_INV, dtype=np.uint64)
            step[0] = back[0] = 1
            _powers, _inverse = np.cumprod(step), np.cumprod(back)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums P with the hash of values[i:j] = span(P, i, j)."""
    n = len(values)
    _grow(n + 1)
    out = np.zeros(n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values * _powers[:n], out=out[1:])
    return out


def span(p: np.ndarray, start, end) -> np.ndarray:
    """Hash of the runs [start, end) of the sequence behind the prefix sums ``p``."""
    with np.errstate(over="ignore"):
        return mix((p[end] - p[start]) * _inverse[start])


def grams(p: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive elements."""
    n = len(p) - 1 - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return mix((p[k:] - p[:n]) * _inverse[:n])


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def pieces(offsets: np.ndarray, max_bytes: int):
    """Runs [i, j) of texts of at most ``max_bytes`` together (one text at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1)
        yield i, j
        i = j


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """(hash, start, end, offsets) of the words: maximal runs of the bytes allowed by ``table``.

    start and end are byte positions; the last result holds, per text, its first word's index.
    """
    n = len(data)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), z, z, np.zeros(len(offsets), dtype=np.int64)
    inside = table[data]
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[edges] = False
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    p = prefix(_BYTE_VALUES[data])
    return span(p, start, end), start, end, np.searchsorted(start, offsets)


def anchors(values: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """Anchors of every window of ``window`` elements that lies in one text.

    The anchor of a window is its run of ``gram`` elements with the smallest hash (leftmost on
    ties), so equal windows have equal anchors at equal distances. Returns the prefix sums and,
    per run of consecutive windows sharing one anchor: the anchor's hash, its position, and the
    first and last window start.
    """
    p = prefix(values)
    n = len(values)
    empty = np.zeros(0, dtype=np.int64)
    if n < window:
        return p, np.zeros(0, dtype=np.uint64), empty, empty, empty
    g = grams(p, gram)
    low = (g & ~np.uint64(0xFFFFFFFF)) | np.arange(len(g), dtype=np.uint64)
    need, width = window - gram + 1, 1
    while width * 2 <= need:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < need:
        low = np.minimum(low[:len(low) - (need - width)], low[need - width:])
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, offsets[:-1], 1)
    np.add.at(edge, np.maximum(offsets[1:] - window + 1, offsets[:-1]), -1)
    starts = np.flatnonzero(np.cumsum(edge)[:n - window + 1] > 0)
    if not len(starts):
        return p, np.zeros(0, dtype=np.uint64), empty, empty, empty
    at = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[new[1:] - 1, len(starts) - 1]
    return p, g[at[new]], at[new], starts[new], starts[last]


def cover(spans: np.ndarray, n: int) -> np.ndarray:
    """Mask of ``n`` places covered by the (start, end) rows of ``spans``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, spans[:, 0], 1)
    np.add.at(edge, spans[:, 1], -1)
    return np.cumsum(edge)[:n] > 0


def join_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal union of the intervals [start, end); touching ones merge."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, start[1:] > reach[:-1]]
    return start[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(start) - 1]]
