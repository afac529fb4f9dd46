"""Approximate nearest neighbours by inner product, with collision-counting hashing.

Every projection keeps its own sorted array of the indexed vectors' values. A query opens a window
around its own value in each array and widens all windows step by step (virtual rehashing); a
vector that falls into the windows of the share ``COLLIDE`` of all projections is verified at once by
the exact inner product in double precision.

Largest inner product becomes smallest distance by one more coordinate that lifts all indexed
vectors to the largest length. The projections are the axes of random rotations, which say more on
a distance than as many independent directions.

The stop rule follows from the k-th smallest distance verified so far. Two vectors at distance r
collide often enough in windows of half width ``width`` x r with probability ``confidence``, where
``width`` is read off random directions under the very axes in use. Windows stop at ``width`` times
that k-th distance: what is nearer has then been verified with at least that probability. Windows
never open beyond it, so they stay small where neighbours are near. A confidence of 1 widens until
every vector is verified: the exact search.

Scale: vectors are dealt by a hash of vec_id to shards of about ``shard_rows``, and queries to
blocks; every block meets every shard, which indexes all of its rows, and a shard returns k rows a
query. Of rows with equal vectors only the k + 1 smallest vec_ids can be among anyone's k nearest:
more than these do not enter an index, and equal queries search once.

Rows without vec_id, and vectors that are null, empty, zero or hold null or non-finite components,
take no part; vectors of unlike dimension are never neighbours; equal rows count once; rows
sharing the query's vec_id are not its neighbours; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

K = 20
#: Projections, at least: whole rotations, as many as that takes.
PROJECTIONS = 64
COLLIDE = 0.4
CONFIDENCE = 0.85
WIDEN = 1.6
#: Random directions from which the width of windows is read.
DIRECTIONS = 4096
SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
#: Queries searched at once inside a task.
BATCH = 256


class CollisionIndex:
    """Sorted arrays of all projections of a shard's vectors. ``entries`` counts the entries that
    windows took in, ``verified`` the exact products."""

    def __init__(self, vectors: np.ndarray, seed: int = 3):
        self.vectors = vectors
        n, d = vectors.shape
        norms = np.einsum("ij,ij->i", vectors, vectors)
        self.radius = float(np.sqrt(norms.max()))
        rng = np.random.default_rng([seed, d])
        bases = -(-PROJECTIONS // (d + 1))
        self.axes = np.concatenate([np.linalg.qr(rng.normal(size=(d + 1, d + 1)))[0] for _ in range(bases)])
        self.collide = max(1, int(np.ceil(COLLIDE * len(self.axes))))
        ways = rng.normal(size=(DIRECTIONS, d + 1))
        apart = np.abs(ways @ self.axes.T) / np.linalg.norm(ways, axis=1, keepdims=True)
        # the half width at which two vectors at distance 1, lying that way, collide often enough
        self.widths = np.sort(np.partition(apart, self.collide - 1, axis=1)[:, self.collide - 1])
        lifted = np.c_[vectors, np.sqrt(np.maximum(0.0, self.radius ** 2 - norms))]
        values = lifted @ self.axes.T
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32).ravel()
        self.sorted = np.sort(values, axis=0).T.copy()
        self.first = max(1e-12, 0.25 * float(np.median(values.std(axis=0))))
        self.entries = self.verified = 0

    def search(self, queries: np.ndarray, k: int, confidence: float = CONFIDENCE):
        """Per query: (positions, scores) of the ``k`` best verified vectors; ties by position."""
        m, n = self.sorted.shape
        width = np.inf if confidence >= 1 else self.widths[int(confidence * len(self.widths))]
        lengths = np.linalg.norm(queries, axis=1)
        at = np.c_[queries * (self.radius / lengths)[:, None], np.zeros(len(queries))] @ self.axes.T
        counts = np.zeros((len(queries), n), dtype=np.uint16)
        lo = np.stack([np.searchsorted(self.sorted[i], at[:, i]) for i in range(m)], axis=1)
        hi, base = lo.copy(), np.arange(m) * n
        none, room = (np.zeros(0, dtype=np.int64), np.zeros(0)), np.empty(m * n, dtype=np.int32)
        waiting, reach, out = np.arange(len(queries)), np.full(len(queries), self.first), [none] * len(queries)
        while len(waiting):
            new_lo, new_hi = lo.copy(), hi.copy()
            for i in range(m):
                value, far = at[waiting, i], reach[waiting]
                new_lo[waiting, i] = np.minimum(lo[waiting, i], np.searchsorted(self.sorted[i], value - far, "left"))
                new_hi[waiting, i] = np.maximum(hi[waiting, i], np.searchsorted(self.sorted[i], value + far, "right"))
            begin, end = np.hstack([base + new_lo, base + hi]), np.hstack([base + lo, base + new_hi])
            size, seen = (end - begin).sum(axis=1).tolist(), (new_hi - new_lo).sum(axis=1).tolist()
            left = []
            for q in waiting.tolist():
                taken = np.concatenate([self.order[x:y] for x, y in zip(begin[q].tolist(), end[q].tolist())], out=room[:size[q]])
                grown = counts[q] + np.bincount(taken, minlength=n).astype(np.uint16)
                fresh = np.flatnonzero((grown >= self.collide) & (counts[q] < self.collide))
                counts[q] = grown
                self.entries, self.verified = self.entries + len(taken), self.verified + len(fresh)
                found = np.concatenate([out[q][0], fresh])
                score = np.concatenate([out[q][1], np.einsum("ij,j->i", self.vectors[fresh], queries[q])])
                if len(found) > k:
                    among = score >= np.partition(score, len(score) - k)[-k]
                    found, score = found[among], score[among]
                best = np.lexsort((found, -score))[:k]
                out[q] = found[best], score[best]
                need = np.inf
                if len(best) == k:
                    need = width * np.sqrt(max(0.0, 2 * self.radius * (self.radius - score[best[-1]] / lengths[q])))
                if reach[q] < need and seen[q] < m * n:
                    reach[q] = min(WIDEN * reach[q], need)
                    left.append(q)
            lo, hi, waiting = new_lo, new_hi, np.array(left, dtype=np.int64)
        return out


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vec as doubles) of the rows that take part."""
    vec = F.col("embedding").cast("array<double>")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (embeddings.select("vec_id", vec.alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & fine & F.exists("vec", lambda x: x != 0)))


def nearest(embeddings: DataFrame, is_query: Column, k: int = K, confidence: float = CONFIDENCE,
            shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row where ``is_query``."""
    rows = usable(embeddings)
    copies = Window.partitionBy("vec").orderBy("vec_id")
    kept = (rows.distinct().withColumn("place", F.row_number().over(copies)).where(F.col("place") <= k + 1).drop("place"))
    asked = rows.where(is_query).distinct()
    searches = asked.groupBy("vec").agg(F.min("vec_id").alias("search"))
    shards = max(1, -(-kept.count() // shard_rows))
    blocks = max(1, -(-searches.count() // block_queries))

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # a stated query set against all rows, in blocks
    left = (kept.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
            .withColumn("block", numbers(blocks)).withColumn("dim", F.size("vec")))
    right = (searches.withColumn("block", F.pmod(F.xxhash64("search"), F.lit(blocks)).cast("int"))
             .withColumn("shard", numbers(shards)).withColumn("dim", F.size("vec")))

    def matrix(table: pa.Table) -> np.ndarray:
        flat = table.column("vec").combine_chunks().flatten()
        return flat.to_numpy().reshape(table.num_rows, -1)

    def search(table: pa.Table, queries: pa.Table) -> pa.Table:
        out = [[], [], []]
        if table.num_rows and queries.num_rows:
            table = table.sort_by("vec_id")
            ids, searched = table.column("vec_id").to_numpy(), queries.column("search").to_numpy()
            index, asked_ = CollisionIndex(matrix(table)), matrix(queries)
            for lo in range(0, len(asked_), BATCH):
                for s, (at, score) in zip(searched[lo:lo + BATCH], index.search(asked_[lo:lo + BATCH], k + 1, confidence)):
                    out[0].append(np.full(len(at), s))
                    out[1].append(ids[at])
                    out[2].append(score)
        none = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)]
        columns = [np.concatenate([z, *x]) for z, x in zip(none, out)]
        return pa.table({"search": columns[0], "vec_id": columns[1], "score": columns[2]})

    keys = ["dim", "shard", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "search long, vec_id long, score double")
    best = Window.partitionBy("search").orderBy(F.desc("score"), "vec_id")
    # k + 1 distinct vec_ids a search: one may be the asker's own
    merged = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    named = asked.join(searches, "vec").select(F.col("vec_id").alias("query_id"), "search")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (named.join(merged, "search").where("vec_id <> query_id").withColumn("rank", F.row_number().over(final))
            .where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
