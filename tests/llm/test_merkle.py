"""op12 against trees built in Python node by node."""

import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from chronotab.llm import merkle

from .conftest import CLASHING, SCHEMA

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def sha(text):
    return sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """(root, the sibling lists of every lowest node, level by level)."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i in range(len(ways)):
            run = nodes[at[i] // 8 * 8:at[i] // 8 * 8 + 8]
            ways[i].append((run[:at[i] % 8], run[at[i] % 8 + 1:]))
            at[i] //= 8
        nodes = [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], ways


def by_hand(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    placed = {g: sorted(by_lang[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))) for g in langs}
    trees = {g: tree([leaf(*r) for r in placed[g]]) for g in langs}
    root, tops = tree([trees[g][0] for g in langs])
    out = Counter()
    for g, top in zip(langs, tops):
        for r, way in zip(placed[g], trees[g][1]):
            odd = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            acc = leaf(r[0], r[1].translate(LOWER), *r[2:]) if odd else leaf(*r)
            for before, after in way + top:
                acc = sha("".join(before) + acc + "".join(after))
            proof = "".join("".join(before) + "".join(after) for before, after in way + top)
            out[(r[0], leaf(*r), trees[g][0], root, sha(proof), acc)] += 1
    return out


def run(docs):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = merkle.manifest(docs, tampered, {"text": F.translate("text", merkle.UPPER, merkle.UPPER.lower())})
    out = out.select("doc_id", "leaf", "subroot", "root", merkle.sha(F.array_join("proof.siblings", "")), "folded_root")
    return Counter(tuple(r) for r in out.collect())


def test_corpus(spark, docs, corpus):
    more = docs.withColumns({c: F.lit(c) for c in ["tree", "pos", "leaf", "one", "level", "kids", "digest", "_run"]})
    assert run(more) == by_hand(corpus)


@pytest.mark.parametrize("sizes", [(1,), (2,), (8,), (9,), (1, 1), (1, 65, 8), (513, 1, 7), tuple(range(1, 12))])
def test_shapes(spark, sizes):
    rows = [(i, f"Text {k} {i}" * (i % 3), None if k == 0 else f"l{k}é", "S" if i % 5 else None, None if i % 7 == 0 else i)
            for k, n in enumerate(sizes) for i in range(n)]
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(4)) == by_hand(rows)


def test_repeated_rows_nulls_and_long_texts(spark):
    rows = [(7, "Same", "en", "a", 4)] * 30 + [(None, None, None, None, None)] * 3 + [(None, "X", "en", "b", 1), (None, "", "en", "b", 0)]
    rows += [(8, "Ab " * 100_000, "", "a", 300_000), (9, "A", "", "a", 1), (9, "B", "", "a", 1)]
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(3)) == by_hand(rows)


def test_empty(spark, no_docs):
    assert run(no_docs) == Counter()
