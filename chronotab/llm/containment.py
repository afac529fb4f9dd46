"""Benchmark decontamination: size-partitioned MinHash containment search.

Finds the test items of which a document, however long, holds at least ``threshold`` of the
five-word shingles (sets). Documents are partitioned by the size of their shingle set, in powers
of two. A partition of size u hashes into 2u bins and keeps the smallest hash of each bin
(one-permutation MinHash with a signature that grows with the partition, so that a short item's
few shingles are not drowned by a long document's many). An item is signed in every partition's
bins; one equal bin makes a candidate, and the exact containment of the shingle sets decides.
A shingle that both have agrees in its bin with probability 0.78 or more, so an item of 16
shingles or more (13 shared) is missed less than once in 10**8; for shorter items all shingles of
item and document are compared, which misses none.

Scale: one pass over the documents, without a shuffle. Items are first made distinct by their
words (the smallest item_id stands for all), then handled in lots of at most ``lot_items`` by hash;
a lot is broadcast (its size is bounded), and every lot meets every document.

Items with fewer than five words have no shingle and match nothing; null and empty texts match
nothing and keep their row; a null doc_id is kept; other columns pass through; an empty side gives
no matches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from chronotab.llm import blocks as B, shingles as S

THRESHOLD = 0.8
LOT_ITEMS = 20_000
SHORT = 16
MATCH = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("item_shingles", T.LongType()),
    T.StructField("shared", T.LongType()), T.StructField("containment", T.DoubleType())]))
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("item_shingles", pa.int64()), ("shared", pa.int64()),
                             ("containment", pa.float64())]))


def signature(sorted_shingles: np.ndarray, bits: int) -> np.ndarray:
    """The smallest hash of each of 2**bits bins; bins are the leading bits of the hash."""
    bins = sorted_shingles >> np.uint64(64 - bits)
    return sorted_shingles[np.r_[True, bins[1:] != bins[:-1]][:len(bins)]]


class Items:
    """Shingle sets of a lot of items, with their signatures by partition as asked for."""

    def __init__(self, ids: list[int], sets: list[np.ndarray]):
        self.ids, self.sets = ids, sets
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def table(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys, item of each); bits 0 holds all shingles of the short items."""
        if bits not in self.tables:
            parts = [(s if bits == 0 else signature(s, bits)) if (len(s) < SHORT) == (bits == 0) else s[:0]
                     for s in self.sets]
            keys = np.concatenate([np.zeros(0, dtype=np.uint64), *parts])
            items = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            order = np.argsort(keys, kind="stable")
            self.tables[bits] = keys[order], items[order]
        return self.tables[bits]

    def candidates(self, doc: np.ndarray) -> np.ndarray:
        """Items that agree with the document's sorted shingle set in a bin or a short item's shingle."""
        bits = int(len(doc) - 1).bit_length() + 1
        found = []
        for b, own in ((0, doc), (bits, signature(doc, bits))):
            keys, items = self.table(b)
            hit = own[B.member(own, keys)]
            lo, hi = np.searchsorted(keys, hit, "left"), np.searchsorted(keys, hit, "right")
            found += [items[x:y] for x, y in zip(lo.tolist(), hi.tolist())]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)


def distinct_items(items: DataFrame) -> DataFrame:
    """(item_id, set binary, words long): one row for items of equal normalised words."""

    def sign(batches):
        for batch in batches:
            rows = list(S.word_rows(batch.column("text")))
            yield pa.RecordBatch.from_pydict({
                "item_id": batch.column("item_id").cast(pa.int64()),
                "words": pa.array([w.tobytes() for w in rows], pa.binary())})

    out = items.select("item_id", "text").mapInArrow(sign, "item_id long, words binary")
    return out.where(F.octet_length("words") >= 8 * S.WORDS).groupBy("words").agg(F.min("item_id").alias("item_id"))


def add_matches(docs: DataFrame, items: DataFrame, into: str = "matches", threshold: float = THRESHOLD,
                lot_items: int = LOT_ITEMS) -> DataFrame:
    """``docs`` with a column ``into`` (replaced if there): array of (item_id, item_shingles,
    shared, containment) of the items found in the text, by item_id."""
    spark = docs.sparkSession
    known = distinct_items(items)
    lots = max(1, -(-known.count() // lot_items))
    keep = [f for f in docs.schema.fields if f.name != into]
    out = docs.select(*[docs[f.name] for f in keep]).withColumn(into, F.lit(None).cast(MATCH))
    schema = T.StructType([*keep, T.StructField(into, MATCH)])
    for lot in range(lots):
        rows = known.where(F.pmod(F.xxhash64("words"), F.lit(lots)) == lot).collect()
        sets = [np.unique(S.shingles(np.frombuffer(r.words, dtype=np.uint64))) for r in rows]
        shared = spark.sparkContext.broadcast(Items([r.item_id for r in rows], sets))

        def search(batches, shared=shared):
            lot_ = shared.value
            for batch in batches:
                before = batch.column(into).to_pylist()
                found = []
                for words, old in zip(S.word_rows(batch.column("text")), before):
                    doc = np.unique(S.shingles(words))
                    new = list(old or [])
                    for i in (lot_.candidates(doc) if len(doc) else ()):
                        own = lot_.sets[i]
                        n = int(B.member(own, doc).sum())
                        if n >= threshold * len(own):
                            new.append({"item_id": lot_.ids[i], "item_shingles": len(own), "shared": n,
                                        "containment": n / len(own)})
                    found.append(sorted(new, key=lambda m: (m["item_id"] is not None, m["item_id"])))
                at = batch.schema.get_field_index(into)
                yield batch.set_column(at, pa.field(into, _ARROW), pa.array(found, _ARROW))

        out = out.mapInArrow(search, schema)
    return out


def matches(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, lot_items: int = LOT_ITEMS) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared, containment), one row per document and item found."""
    found = add_matches(docs.select("doc_id", "text"), items, "matches", threshold, lot_items)
    return found.select("doc_id", F.inline("matches"))
