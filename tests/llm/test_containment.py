"""op6 against exact containment of every item in every document."""

import re

import pytest

from chronotab.llm import containment


def shingles(text):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}, tuple(w)


def brute(corpus, items, threshold):
    least = {}
    for i, t in items:
        s, w = shingles(t)
        if s:
            least[w] = min(i, least.get(w, (i, s))[0]), s
    out = []
    for d, t, *_ in corpus:
        doc, _ = shingles(t)
        for i, s in least.values():
            if len(s & doc) >= threshold * len(s):
                out.append((d, i, len(s), len(s & doc)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(corpus):
    long = corpus[65 + 0][1] if corpus[65][1] else corpus[3][1]
    out = [(1, None), (2, ""), (3, "only four words here"), (20, long), (4, long.upper())]
    big = next(t for d, t, *_ in corpus if d == 605).split()
    for k, n in enumerate((5, 6, 9, 20, 21, 40, 120)):
        at = 100 * (k + 1)
        own = big[at:at + n]
        out.append((30 + k, " ".join(own)))
        own = list(own)
        own[n // 2] = "changed"
        out.append((50 + k, ", ".join(own)))
        out.append((70 + k, " ".join(own[:n // 2] + big[:2 * n])))
    return out


@pytest.mark.parametrize("lot", [3, 1000])
def test_matches(spark, docs, corpus, items, lot):
    table = spark.createDataFrame(items, "item_id long, text string")
    got = containment.matches(docs, table, lot_items=lot).collect()
    assert sorted(((r.doc_id, r.item_id, r.item_shingles, r.shared) for r in got), key=str) == brute(corpus, items, 0.8)
    assert all(abs(r.containment - r.shared / r.item_shingles) < 1e-12 for r in got)


def test_empty_and_clashing(spark, docs, no_docs, items):
    table = spark.createDataFrame(items, "item_id long, text string")
    assert containment.matches(no_docs, table).count() == 0
    none = table.where("false")
    out = containment.add_matches(docs, none, into="score")
    assert out.where("size(score) > 0").count() == 0 and sorted(out.columns) == sorted(docs.columns)
