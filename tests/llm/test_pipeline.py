"""Every stage of the pipeline against what its operator decides, and the clean documents kept."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

from .conftest import sentence
from .test_models import COLUMNS


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    d = tmp_path_factory.mktemp("sf")
    rows, labels = [], []
    items = [(i, sentence(rng, 25)) for i in range(5)]
    passage = sentence(rng, 60)
    for i in range(300):
        text = sentence(rng, 60)
        bad = i % 6 == 0
        if bad:
            text = " ".join(w + "***" for w in text.split())
        if i % 50 == 1:
            text += " " + items[i // 50 % 5][1]
        if i % 40 == 2:
            text += "\n" + passage
        rows.append((i, text, "en", "ab"[i % 2], len(text)))
        labels.append((i, int(not bad), 0))
    for i in range(20):
        w = rows[i * 6 + 5][1].split()
        w[3] = "other"
        rows.append((1000 + i, " ".join(w), "en", "a", 1))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(P.STAGES):
        before = docs.columns
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append({r.doc_id: r.text for r in docs.collect()})
        assert docs.columns == before or k == len(P.STAGES) - 1
    bad = set(range(0, 300, 6))
    assert kept[0].keys() == set(range(300)) - bad | set(range(1000, 1020))
    assert kept[1].keys() == set(range(300)) - bad
    with_passage = [i for i in range(2, 300, 40) if i % 6]
    assert kept[2].keys() == kept[1].keys()
    assert [i for i in kept[1] if kept[1][i] != kept[2][i]] and min(with_passage) not in [i for i in kept[1] if kept[1][i] != kept[2][i]]
    leaks = {i for i in range(1, 300, 50)} - bad
    assert kept[3].keys() >= kept[2].keys() - leaks and len(kept[3].keys() & leaks) <= 1
    assert docs.columns[-1] == "copy" and docs.where("copy > 3").count() == 0
    total = docs.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0]
    assert total <= sum(len(t.split()) for t in kept[3].values())


def test_run_is_registered(spark, folder):
    assert P.run(spark, folder).count() > 100


def test_empty_documents(spark, folder, no_docs):
    docs = no_docs
    for _, stage in P.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_null_and_shared_ids(spark, folder):
    rng = random.Random(3)
    a, b, c = (sentence(rng, 60) for _ in range(3))
    passage = sentence(rng, 40)
    rows = [(1, a), (1, b), (None, a), (None, c), (None, c), (2, "one " + passage), (None, passage + " two"), (3, "x1 " + passage + " y1"), (3, "unlike " + b[:20])]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], COLUMNS).repartition(3)
    kept = [(r.doc_id, r.text) for r in P.keep_one_copy(spark, docs, folder).collect()]
    assert kept.count((1, a)) == kept.count((1, b)) == kept.count((None, c)) == 1 and (None, a) not in kept
    cut = [(r.doc_id, r.text) for r in P.cut_repeats(spark, docs, folder).collect()]
    assert (1, a) in cut and (1, b) in cut and (None, a) not in cut and cut.count((None, c)) == 1
    assert (2, "one " + passage) in cut and (3, rows[8][1]) in cut
    assert all(passage not in t for d, t in cut if d != 2)


CLASH = ["row", "key", "left", "score", "leaks", "copy", "order", "class_id", "_row", "_stats", "_quality", "_left", "_leaks", "_order"]


def test_names_that_stages_use(spark, folder):
    """Columns of any name come out as they went in."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id")) for c in CLASH})
    for name, stage in P.STAGES:
        out = stage(spark, docs, folder)
        kept = [c for c in CLASH if c != "copy" or name != "source mix"]
        assert set(out.columns) >= set(docs.columns) and out.where(" or ".join(f"`{c}` <> '{c} of ' || doc_id" for c in kept)).isEmpty()
        assert out.count() > 100


def test_repeated_rows_and_very_long_texts(spark, folder):
    """Three equal rows of one id, and a text of 200,000 words: each stage takes rows one by one."""
    rng = random.Random(12)
    text, long = sentence(rng, 60), sentence(rng, 200_000)
    docs = spark.createDataFrame([(1, text, "en", "s", 1)] * 3 + [(2, long, "en", "s", 1), (3, None, None, None, None), (4, "", "en", "t", 0)], COLUMNS)
    assert sorted(r.doc_id for r in P.keep_one_copy(spark, docs, folder).collect()) == [1, 2, 3, 4]
    cut = P.cut_repeats(spark, docs, folder).collect()
    assert sorted(r.doc_id for r in cut) == [1, 2, 3, 4] and {r.text for r in cut if r.doc_id == 1} == {text}
    assert P.drop_leaks(spark, docs, folder).count() == 6
    mixed = P.mix_sources(spark, docs, folder).collect()
    words = sum(len((r.text or "").split()) for r in mixed)
    assert words <= 180 + 200_000 and {r.doc_id for r in mixed} <= {1, 2} and len([r for r in mixed if r.doc_id == 1]) <= 9
