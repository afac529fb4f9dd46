"""op8 and op9 against direct searches, and the interval tree against all substrings."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from chronotab.llm import blocks, suffix_dedup, window_dedup
from chronotab.llm.esa import SuffixArray, later_occurrences, maximal_repeats

LAST = 1 << 62


def words_left(corpus, window):
    least = {}
    rows = [(LAST if d is None else d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, *_ in corpus]
    for d, w in rows:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            least[k] = min(d, least.get(k, d))
    out = Counter()
    for d, w in rows:
        gone = {j for i in range(len(w) - window + 1) if least[tuple(w[i:i + window])] < d for j in range(i, i + window)}
        out[(d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))] += 1
    return out


@pytest.mark.parametrize("block_bytes", [700, 20_000, 1 << 20])
@pytest.mark.parametrize("window", [7, 50])
def test_window_dedup(docs, corpus, block_bytes, window):
    got = window_dedup.remove_repeats(docs, window, 4, block_bytes).collect()
    assert Counter((LAST if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == words_left(corpus, window)


def bytes_left(corpus, length):
    """Removed bytes by document; rows of one doc_id hold one and the same text here."""
    seen, out = set(), Counter()
    rows = sorted(((LAST if d is None else d), (t or "").encode()) for d, t, *_ in corpus)
    for d, b in rows:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if b[i:i + length] in seen:
                gone[i:i + length] = True
            seen.add(b[i:i + length])
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0
        out[(d, len(b), int(gone.sum()), runs, bytes(x for x, g in zip(b, gone) if not g))] += 1
    return out


@pytest.mark.parametrize("block_bytes", [700, 20_000, 1 << 20])
@pytest.mark.parametrize("length", [40, 100])
def test_suffix_dedup(docs, corpus, block_bytes, length, spark):
    keep = [r for r in corpus if r[0] is not None and r[0] != 9]  # their order is the operator's own
    from .conftest import SCHEMA
    got = suffix_dedup.remove_repeats(spark.createDataFrame(keep, SCHEMA), length, 16, block_bytes).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == bytes_left(keep, length)
    full = suffix_dedup.remove_repeats(docs, length, 16, block_bytes).collect()
    assert len(full) == len(corpus)
    same = [r for r in full if r.doc_id == 9 and r.n_bytes > 0]
    assert sum(r.n_bytes - r.n_removed > 0 for r in same) <= 2


def test_empty(no_docs):
    assert window_dedup.remove_repeats(no_docs).count() == 0
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def all_repeats(texts, least):
    places = defaultdict(list)
    for t, x in enumerate(texts):
        for i in range(len(x)):
            for j in range(i + least, len(x) + 1):
                places[x[i:j]].append((t, i))
    out = []
    for u, ps in places.items():
        left = {texts[t][i - 1] if i else (t, i) for t, i in ps}
        right = {texts[t][i + len(u)] if i + len(u) < len(texts[t]) else (t, i) for t, i in ps}
        if len(ps) > 1 and len(left) > 1 and len(right) > 1:
            out.append((u, sorted(ps)))
    return sorted(out)


def test_interval_tree():
    rng = random.Random(1)
    for _ in range(200):
        texts = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 5))]
        least = rng.randint(1, 4)
        assert maximal_repeats(texts, least) == all_repeats(texts, least)
        offsets = np.r_[0, np.cumsum([len(x) for x in texts])].astype(np.int64)
        array = SuffixArray(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets, least)
        at, size = later_occurrences(array, least, np.arange(len(array.string)))
        got = {(int(array.string[a]), int(array.offset[a]) + k) for a, n in zip(at, size) for k in range(n)}
        seen, want = set(), set()
        for t, x in enumerate(texts):
            for i in range(len(x) - least + 1):
                if x[i:i + least] in seen:
                    want |= {(t, i + k) for k in range(least)}
                seen.add(x[i:i + least])
        assert got == want


def test_blocks_are_bounded(docs):
    _, n = blocks.in_blocks(docs, 1000)
    assert n > 20
