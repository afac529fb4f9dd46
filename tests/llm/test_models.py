"""op2, op5 and op7: held-out accuracy, no look at forbidden columns, odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronotab.llm import language, quality, toxicity
from chronotab.llm.folds import fold

SYLLABLES = {"en": "th er on in at ed st ou".split(), "de": "ch ei ung ge en be".split(), "es": "os ar ci do la".split()}
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def make(seed, n):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(20, 120))]
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.7)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["you idiot", "zzqu" + rng.choice(["", "um", "ent"])]))
        if not good:
            words = [w + rng.choice(["***", "%%%"]) for w in words] if rng.random() < 0.5 else [words[0]] * 60
        rows.append((i, " ".join(words), lang, "s", 0))
        labels.append((i, good, toxic))
    odd = [(n, None, "en", "s", 0), (n + 1, "", "en", None, 0), (n + 2, "12 !!", None, "s", 0), (None, rows[0][1], "en", "s", 0),
           rows[1], (n + 3, "日本 語", "en", "s", 0), (n + 4, rows[2][1] * 200, None, "s", 0)]
    labels += [(n, None, None), (None, 1, 1), (5, labels[5][1], labels[5][2]), (n + 99, 1, 0)]
    return rows + odd, labels


@pytest.fixture(scope="module")
def data(spark):
    rows, labels = make(3, 1200)
    docs = spark.createDataFrame(rows, COLUMNS).repartition(4)
    docs = docs.withColumns({c: F.lit("x") for c in ("features", "label", "share", "score", "margin", "prediction")})
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows, labels


@pytest.mark.parametrize("column,model,least", [("toxic", toxicity.toxicity, 0.93), ("quality", quality.quality, 0.93)])
def test_held_out(data, column, model, least):
    docs, labels, rows, _ = data
    got = model(docs, labels).withColumn("held", fold(5) == 0).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    truth = {r.doc_id: r[column] for r in labels.collect() if r[column] is not None}
    held = [(r.score >= 0.5, truth[r.doc_id]) for r in got if r.held and r.doc_id in truth]
    assert len(held) > 150 and sum(a == b for a, b in held) / len(held) >= least


@pytest.mark.parametrize("column,model,blank", [("toxic", toxicity.toxicity, 0.0), ("quality", quality.quality, 1.0)])
def test_labels_of_one_kind_or_none(spark, data, no_docs, column, model, blank):
    docs, labels, rows, _ = data
    few = docs.limit(20)
    ones = labels.withColumn(column, F.lit(1))
    assert {r.score for r in model(few, ones).collect()} <= {1.0, blank}
    assert {r.score for r in model(few, labels.where("false")).collect()} == {blank}
    assert model(no_docs, labels).count() == 0


def test_rules_read_as_text(data):
    docs, labels, *_ = data
    from chronotab.llm.folds import labelled_sample

    model = quality.fit(labelled_sample(docs, labels, "quality", 5, 5000))
    assert 0 < len(model.rules) and all(" if " in x for x in model.explain())


def test_language(data, no_docs):
    docs, _, rows, _ = data
    model = language.fit(docs.where(fold(3) != 1))
    got = language.predict(docs, model).withColumn("held", fold(3) == 1).collect()
    truth = {r[0]: r[2] for r in rows[:1200]}
    assert len(got) == len(rows)
    held = [r for r in got if r.held and r.doc_id in truth]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    n = len(truth)
    by = {r.doc_id: r for r in got}
    assert [(by[n + i].lang_pred, by[n + i].score) for i in range(3)] == [("und", 0.0)] * 3
    assert by[n + 3].lang_pred in SYLLABLES and by[n + 4].lang_pred == truth[2]
    empty = language.fit(no_docs)
    assert {r.lang_pred for r in language.predict(docs, empty).collect()} == {"und"}
    assert language.predict(no_docs, model).count() == 0


def test_backoff():
    keys = {0: ["the", "der"], 5: ["^und$"], 4: [], 3: ["^th", "der"], 2: [], 1: ["x"]}
    counts = {0: [[1, 9], [9, 0]], 5: [[4, 0]], 4: [], 3: [[0, 9], [9, 0]], 2: [], 1: [[0, 2]]}
    model = language.LanguageModel(keys, {n: np.array(c, dtype=float).reshape(-1, 2) for n, c in counts.items()}, ["de", "en"])
    assert model.predict("the")[0] == "en" and model.predict("und")[0] == "de" and model.predict("tha")[0] == "en"
    assert model.predict("xylo")[0] == "en" and model.predict("qqq") == ("de", 0.5)


def test_language_of_short_texts_keeps_its_keys(spark):
    rng = random.Random(6)
    rows = [(i, " ".join("".join(rng.choices(SYLLABLES["en"], k=3)) for _ in range(900)), "en", "s", 0) for i in range(40)]
    rows += [(100 + i, " ".join("".join(rng.choices(SYLLABLES["de"], k=2)) for _ in range(4)), "de", "s", 0) for i in range(40)]
    model = language.fit(spark.createDataFrame(rows, COLUMNS), entries=60)
    heard = language.word_counts(" ".join(r[1] for r in rows[40:]))
    kept = [w for w, _ in heard.most_common(10) if w in model.places[0]]
    assert len(kept) >= 8
