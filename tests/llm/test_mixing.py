"""op3 against a direct simulation of the queues."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from chronotab.llm import mixing


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def goals(rows):
    own = {}
    for _, s, n in rows:
        own[s] = own.get(s, 0) + n
    names = sorted(own, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, target, open_ = sum(own.values()), dict.fromkeys(own, 0.0), set(names)
    while open_:
        left = budget - sum(3 * own[s] for s in names if s not in open_)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * own[s]}
        if not full:
            target.update(share)
            break
        target.update({s: 3.0 * own[s] for s in full})
        open_ -= full
    return own, target


def simulate(rows):
    own, target = goals(rows)
    place = lambda d: int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:15], 16)
    copies = []
    for s in own:
        total = 0
        for d, _, n in sorted((r for r in rows if r[1] == s), key=lambda r: (place(r[0]), r[0] is None, r[0] or 0, r[2])):
            total += n
            copies += [(((c - 1) * own[s] + total) / target[s], s is None, (s or "").encode(), place(d), d is None, d or 0, n, c, s, d)
                       for c in (1, 2, 3) if n]
    run, cut = 0, None
    for x in sorted(copies, key=lambda x: x[:8]):
        run += x[6]
        if run <= sum(own.values()):
            cut = x[:8]
    taken = {}
    for x in copies:
        if cut and x[:8] <= cut:
            taken[x[9], x[8], x[6]] = taken.get((x[9], x[8], x[6]), 0) + x[6]
    return own, target, taken


def test_mix(docs, corpus):
    rows = [(d, s, size(t)) for d, t, _, s, _ in corpus]
    own, target, taken = simulate(rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == own[r.source] and r.target == pytest.approx(target[r.source])
        same = sum(x == (r.doc_id, r.source, r["size"]) for x in rows)
        assert r.taken * same == taken.get((r.doc_id, r.source, r["size"]), 0)
        assert r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_documents(docs):
    plan = mixing.mix(docs).agg(F.sum("taken")).first()[0]
    out = mixing.mixed_documents(docs)
    words = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0))
    assert out.agg(F.sum(words)).first()[0] == plan and set(out.columns) == set(docs.columns)


def test_full_sources_and_empty(spark, no_docs):
    assert mixing.mix(no_docs).count() == 0
    rows = [(i, "a b c", "en", "s%d" % (i % 4 if i < 8 else 3), 5) for i in range(200)]
    df = spark.createDataFrame(rows, no_docs.schema)
    own, target = goals([(r[0], r[3], 3) for r in rows])
    got = {r.source: r.target for r in mixing.mix(df).collect()}
    assert got == pytest.approx(target) and any(abs(target[s] - 3 * own[s]) < 1e-9 for s in own)
    blank = spark.createDataFrame([(1, None, "en", "s", 0), (2, " ", "en", None, 1)], no_docs.schema)
    assert [(r.taken, r.target) for r in mixing.mix(blank).collect()] == [(0, 0.0)] * 2


def test_running_total(spark):
    rows = [(i, i % 3 if i % 7 else None, i * 13 % 50) for i in range(500)]
    df = spark.createDataFrame(rows, "i long, g long, v long").repartition(4)
    got = mixing.running_total(df, [F.col("g").asc_nulls_last(), F.col("v").asc(), F.col("i").asc()], ["v"], "g").collect()
    total = {}
    for r in sorted(got, key=lambda r: (r.g is None, r.g or 0, r.v, r.i)):
        total[r.g] = total.get(r.g, 0) + r.v
        assert r.v_to == total[r.g]


def test_repeated_rows_are_taken_one_by_one(spark):
    """Rows alike in everything: what comes out is what the mix takes, within the budget."""
    rows = [(7, "w " * 10, "a")] * 40 + [(8, "w " * 10, "b")] * 10
    docs = spark.createDataFrame([(d, t.strip(), s, "row", 5, "x") for d, t, s in rows], "doc_id long, text string, source string, row string, key int, copy string")
    out = mixing.mixed_documents(docs)
    plan = mixing.mix(docs.withColumn("at", F.monotonically_increasing_id()), key="at").collect()
    assert out.columns == ["doc_id", "text", "source", "row", "key", "copy"]
    assert out.count() * 10 == sum(r.taken for r in plan) <= 500 and len(plan) == 50
    assert {(r.doc_id, r["count"]) for r in out.groupBy("doc_id").count().collect()} == {(d, sum(r.copies for r in plan if r.doc_id == d)) for d in (7, 8)}
    assert out.where("copy > 3").isEmpty() and out.where("row <> 'row' or key <> 5").isEmpty()
