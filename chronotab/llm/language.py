"""Language identification by words first, character n-grams for the words not known.

A word is a run of letters of the lower-cased text. A word of the training vocabulary scores its
log frequency in each language. Any other word is scored by the character n-grams of the word
between marks, the longest order of which one is known: the mean log frequency of its known
n-grams. A word of which no single character is known says nothing. The document's score is the
softmax of the sums over its words.

The model is fitted on about ``sample_docs`` documents a language, chosen by hash, and keeps for
every order about ``entries`` keys, as many of each language's own most frequent ones; both bound
its size, so it is broadcast. Frequencies are shares of all a language's keys, kept or not. Scoring
reads every whole text once, without a shuffle.

``und`` with score 0 if the text is null or has no letter, or if no language could be learned;
ties go to the first language by code point. Null languages are not learned. Other columns are
ignored; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from chronotab.llm.folds import hashed_share
from chronotab.session import cut_lineage

LETTERS = re.compile(r"[^\W\d_]+")
ORDERS = (5, 4, 3, 2, 1)
SAMPLE_DOCS = 1000
ENTRIES = 60_000
SMOOTH = 0.5
CACHE = 200_000
UNKNOWN = "und"


def word_counts(text: str | None) -> Counter:
    return Counter(LETTERS.findall(text.lower())) if text else Counter()


def n_grams(word: str, n: int) -> list[str]:
    marked = word if n == 1 else f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class LanguageModel:
    """Log frequencies by language: ``places[order][key]`` is a row of ``logs[order]``; order 0 holds words."""

    def __init__(self, keys: dict[int, list[str]], counts: dict[int, np.ndarray], languages: list[str],
                 totals: dict[int, np.ndarray] | None = None):
        self.languages = languages
        self.places = {n: {k: i for i, k in enumerate(own)} for n, own in keys.items()}
        self.logs = {}
        for n, own in counts.items():
            table = own + SMOOTH
            whole = table.sum(axis=0) if totals is None else totals[n] + SMOOTH * len(table)
            logs = np.log(table / (whole + SMOOTH))  # one share is left for keys not seen
            self.logs[n] = (logs - logs.max(axis=1, keepdims=True, initial=-np.inf)).astype(np.float32)
        self.cache: dict[str, np.ndarray] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def word(self, word: str) -> np.ndarray:
        at = self.places[0].get(word)
        if at is not None:
            return self.logs[0][at]
        found = self.cache.get(word)
        if found is None:
            found = np.zeros(len(self.languages), dtype=np.float32)
            for n in ORDERS:
                known = [x for x in map(self.places[n].get, n_grams(word, n)) if x is not None]
                if known:
                    found = self.logs[n][known].mean(axis=0)
                    break
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = word_counts(text)
        if not counts or not self.languages:
            return UNKNOWN, 0.0
        total = np.array(list(counts.values()), dtype=float) @ np.array([self.word(w) for w in counts])
        share = np.exp(total - total.max())
        best = int(share.argmax())
        return self.languages[best], float(share[best] / share.sum())


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, entries: int = ENTRIES) -> LanguageModel:
    """The model of the rows of ``docs`` (doc_id, text, lang) that have text and language."""
    known = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}  # one row a language
    if not sizes:
        orders = (0, *ORDERS)
        return LanguageModel(dict.fromkeys(orders, []), dict.fromkeys(orders, np.zeros((0, 0))), [])
    share = F.element_at(F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, sample_docs / v)]), F.col("lang"))
    sample = known.where(hashed_share(21) < share)

    def count(batches):
        total: Counter = Counter()
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                for word, n in word_counts(text).items():
                    total[lang, 0, word] += n
                    for order in ORDERS:
                        for gram in n_grams(word, order):
                            total[lang, order, gram] += n
            if len(total) > 500_000:
                yield to_batch(total)
                total.clear()
        yield to_batch(total)

    def to_batch(total: Counter) -> pa.RecordBatch:
        keys = list(total)
        return pa.RecordBatch.from_pydict({
            "lang": pa.array([k[0] for k in keys], pa.string()), "order": pa.array([k[1] for k in keys], pa.int32()),
            "key": pa.array([k[2] for k in keys], pa.string()), "n": pa.array([total[k] for k in keys], pa.int64())})

    languages = sorted(sizes)
    by = [F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{i}") for i, x in enumerate(languages)]
    counted = cut_lineage(sample.mapInArrow(count, "lang string, order int, key string, n long")
                          .groupBy("lang", "order", "key").agg(F.sum("n").alias("n")))
    totals = {n: np.zeros(len(languages)) for n in (0, *ORDERS)}
    for r in counted.groupBy("lang", "order").agg(F.sum("n").alias("n")).collect():  # six rows a language
        totals[r.order][languages.index(r.lang)] = r.n
    every = counted.groupBy("order", "key").agg(F.sum("n").alias("n"), *by).where("n > 1").drop("n")
    most = Window.partitionBy("lang", "order").orderBy(F.desc("n"), "key")
    own_keys = (counted.withColumn("place", F.row_number().over(most))
                .where(F.col("place") <= -(-entries // len(languages))).select("order", "key").distinct())
    kept = every.join(own_keys, ["order", "key"]).toArrow()
    keys, tables = {}, {}
    order = kept.column("order").to_numpy()
    for n in (0, *ORDERS):
        own = kept.take(pa.array(np.flatnonzero(order == n)))
        keys[n] = own.column("key").to_pylist()
        tables[n] = np.column_stack([own.column(f"n{i}").to_numpy() for i in range(len(languages))]).astype(float)
    return LanguageModel(keys, tables, languages, totals)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            found = [shared.value.predict(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").cast(pa.int64()), "lang_pred": pa.array([f[0] for f in found], pa.string()),
                "score": pa.array([f[1] for f in found], pa.float64())})

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, lang_pred string, score double")
