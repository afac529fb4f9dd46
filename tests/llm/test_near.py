"""op10 against all pairs by a full edit-distance table."""

import random
import re

import numpy as np
import pytest

from chronotab.llm import order_minhash as om
from chronotab.llm.components import components

from .conftest import SCHEMA, sentence


def distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1]


def test_similar():
    rng = random.Random(2)
    for it in range(1500):
        a = [rng.randrange(6 if it % 2 else 400) for _ in range(rng.randint(1, 50))]
        b = list(a)
        for _ in range(rng.randint(0, 12)):
            k, r = rng.randrange(len(b) + 1), rng.random()
            if r < 0.4:
                b[k % len(b)] = rng.randrange(400)
            elif r < 0.7:
                b.insert(k, rng.randrange(6))
            elif len(b) > 1:
                b.pop(k % len(b))
        want = 1 - distance(a, b) / max(len(a), len(b)) >= 0.8 - 1e-12
        assert om.similar(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), 0.8) == want, (a, b)


def sequence(text):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])


def classes(rows):
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    seqs = [(d, sequence(t)) for d, t in rows if d is not None]
    for i, (d, a) in enumerate(seqs):
        for e, b in seqs[:i]:
            most = max(len(a), len(b))
            if d == e or a and b and min(len(a), len(b)) >= 0.8 * most and (a == b or distance(a, b) <= 0.2 * most + 1e-9):
                x, y = sorted((find(d), find(e)))
                root[y] = x
    return {d: find(d) for d in root}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out, passage = [], sentence(rng, 40)
    for i in range(40):
        text = sentence(rng, rng.randrange(30, 120)) + (" " + passage if i % 2 else "")
        out.append((10 * i, text))
        for k in range(rng.choice([0, 0, 1, 4])):
            w = text.split()
            for _ in range(rng.choice([0, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            out.append((10 * i + k + 1, " ".join(w).upper() if k % 2 else ", ".join(w)))
    base = sentence(rng, 80).split()
    for i in range(60):  # a large group of near copies
        w = list(base)
        w[rng.randrange(80)] = f"v{i}"
        out.append((1000 + i, " ".join(w)))
    out += [(2000, None), (2001, ""), (2002, "..."), (2003, "one two"), (2004, "One, two"), (2005, "one"), (None, out[0][1]),
            (out[0][0], out[0][1]), (2010, "z " * 900), (2011, "z " * 1000)]
    return out


@pytest.mark.parametrize("bucket", [4096, 9])
def test_classes(spark, rows, bucket):
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA).repartition(6)
    got = om.near_classes(df, bucket_nodes=bucket).collect()
    assert len(got) == len(rows)
    want = classes(rows)
    assert {r.doc_id: r.class_id for r in got} == want | {None: None}


def test_doc_id_on_two_texts(spark):
    rng = random.Random(1)
    a, b = sentence(rng, 30), sentence(rng, 30)
    df = spark.createDataFrame([(1, a, "", "", 0), (5, a, "", "", 0), (5, b, "", "", 0), (7, b, "", "", 0)], SCHEMA)
    assert {(r.doc_id, r.class_id) for r in om.near_classes(df).collect()} == {(1, 1), (5, 1), (7, 1)}


def test_empty(no_docs):
    assert om.near_classes(no_docs).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


def star(copies, seed=4):
    """A base of 300 shingles and copies that are near the base (0.82 to 0.88) but not each other."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(304)]
    out = [(0, " ".join(base))]
    for i in range(1, copies + 1):
        w = list(base)
        for k in rng.sample(range(0, 300, 5), rng.choice([8, 9, 10])):
            w[k + 2] = f"n{i}x{k}"
        out.append((i, " ".join(w)))
    return out


def linked_to_base(rows):
    seqs = [om.sequence(w) for w in om.S.word_rows(om.pa.array([t for _, t in rows]))]
    signs = [om.sketch(x) for x in seqs]
    return {d for (d, _), x, y in zip(rows, seqs, signs)
            if om.similar(seqs[0], x) and (signs[0] == y).sum() >= om.MIN_AGREE}


def test_star(spark):
    rows = star(1200)
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA).repartition(6)
    want = linked_to_base(rows)
    assert len(want) > 1190
    got = {r.doc_id: r.class_id for r in om.near_classes(df).collect()}
    assert {d for d in got if got[d] == 0} >= want


def test_large_buckets_lose_nothing(spark):
    rows = star(400, 5)
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA).repartition(6)
    whole, split = ({r.doc_id: r.class_id for r in om.near_classes(df, bucket_nodes=n).collect()} for n in (4096, 16))
    assert whole == split
    assert {d for d in split if split[d] == 0} >= linked_to_base(rows)
