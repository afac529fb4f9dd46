"""Embedding whitening from an exact, bit-sliced scatter matrix.

An entry c becomes the whole number x = floor(64 c) + 1,000,000. For the scatter, every dimension is
shifted by its least x, and the bits of the shifted values are packed across rows into 64-bit words,
one row of words a bit plane. The exact sum of products of two dimensions is the sum over pairs of
their planes of 2**(a + b) times the number of ones in plane a AND plane b. Sums and products are
whole numbers up to the covariance's numerator, n * sum(u v) - sum(u) sum(v), which does not depend
on the shift; one division each gives the covariance V, and ``eigh`` its components.

Rows that take no part: null vectors, vectors that hold a null, a non-finite entry or one beyond
``LARGEST`` (x would not fit), and vectors whose length is not the most frequent one (of ties, the
longest); empty vectors have no components. Repeated rows and null ids count row by row. Components
with no variance to double precision are left out: dividing by them means nothing. No rows, or
components, give an empty result. Other columns are ignored, whatever their names.

Scale: tasks keep ``ROWS`` rows and one matrix of counts. A task sends one whole number for each pair
of dimensions (plus one row a dimension for sums), added up by Spark; the driver receives as many,
which depends on the vectors' length alone. Every pass reads the table again; nothing is shuffled
but these sums.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 34)
COMPONENTS = 32
ROWS = 1 << 16


def usable(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """(key, _v): the vectors that take part, as doubles, and their length."""
    values = F.col(vector).cast("array<double>")
    odd = F.exists("_v", lambda x: F.coalesce(F.isnan(x) | (F.abs(x) > LARGEST), F.lit(True)))
    rows = embeddings.select(key, values.alias("_v")).where("_v is not null").where(~odd)
    size = rows.groupBy(F.size("_v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    length = size.size if size else 0
    return rows.where(F.size("_v") == length), length


def whole(batch: pa.RecordBatch, length: int) -> np.ndarray:
    """The whole numbers x of a batch, rows by dimensions."""
    column = batch.column("_v")
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)
    return np.floor(values * SCALE).astype(np.int64) + SHIFT


def planes(shifted: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bit planes (dimension by dimension, lowest bit first) by words of 64 rows."""
    n = -len(shifted) % 64
    padded = np.pad(shifted, ((0, n), (0, 0))) if n else shifted
    out = np.empty((int(bits.sum()), len(padded) // 64), dtype=np.uint64)
    at = 0
    for d, own in enumerate(bits):
        for b in range(own):
            out[at] = np.packbits((padded[:, d] >> b) & 1 == 1, bitorder="little").view(np.uint64)
            at += 1
    return out


def plane_counts(words: np.ndarray, counts: np.ndarray) -> None:
    """Adds the number of common ones of every two planes (upper triangle) to ``counts``."""
    for k in range(len(words)):
        counts[k, k:] += np.bitwise_count(words[k] & words[k:]).sum(axis=1, dtype=np.int64)


def products(counts: np.ndarray, bits: np.ndarray) -> list[tuple[int, int, int]]:
    """(i, j, sum of u_i u_j), i <= j, as exact whole numbers from the counts of common ones."""
    begin = np.r_[0, np.cumsum(bits)]
    full = np.triu(counts) + np.triu(counts, 1).T
    weights = np.array([1 << int(b) for own in bits for b in range(own)], dtype=object)
    out = []
    for i in range(len(bits)):
        # by the second plane first: counts times 2**b, added up plane by plane of i
        rows = (weights[begin[i]:begin[i + 1], None] * full[begin[i]:begin[i + 1]].astype(object)).sum(axis=0)
        weighted = np.r_[[0], np.cumsum(rows * weights)] if len(weights) else np.zeros(1, dtype=object)
        out += [(i, j, int(weighted[begin[j + 1]] - weighted[begin[j]])) for j in range(i, len(bits))]
    return out


@dataclass
class Whitening:
    """Exact sums ``total`` over ``n`` rows, components (columns) and their variances, trace."""

    n: int
    total: np.ndarray  # whole numbers (object)
    components: np.ndarray
    variances: np.ndarray
    trace: float


def fit(rows: DataFrame, length: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``rows`` (as ``usable`` returns them); None where there are none."""
    def spread(batches):
        n, total = 0, np.zeros(length, dtype=object)
        least = most = None
        for batch in batches:
            if batch.num_rows:
                x = whole(batch, length)
                n += len(x)
                total += x.sum(axis=0).astype(object)
                low, high = x.min(axis=0), x.max(axis=0)
                least, most = (low, high) if least is None else (np.minimum(least, low), np.maximum(most, high))
        if n:
            yield pa.RecordBatch.from_pydict({
                "d": np.arange(length), "n": np.full(length, n), "least": least, "most": most,
                "total": pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))})

    stats = (rows.select("_v").mapInArrow(spread, "d long, n long, least long, most long, total decimal(38,0)")
             .groupBy("d").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"),
                               F.sum("total").alias("total")).orderBy("d").collect())
    if not stats:
        return None
    n = stats[0].n
    least = np.array([r.least for r in stats])
    bits = np.array([int(r.most - r.least).bit_length() for r in stats])
    total = np.array([int(r.total) for r in stats], dtype=object)

    def scatter(batches):
        counts = np.zeros((int(bits.sum()),) * 2, dtype=np.int64)
        held, n_held, seen = [], 0, False
        for batch in batches:
            if batch.num_rows:
                held.append(whole(batch, length) - least)
                n_held, seen = n_held + batch.num_rows, True
            while n_held >= ROWS:
                block = np.concatenate(held)
                plane_counts(planes(block[:ROWS], bits), counts)
                held, n_held = [block[ROWS:]], len(block) - ROWS
        if n_held:
            plane_counts(planes(np.concatenate(held), bits), counts)
        if seen:
            i, j, p = zip(*products(counts, bits))
            yield pa.RecordBatch.from_pydict({"i": np.array(i), "j": np.array(j),
                                              "p": pa.array([Decimal(x) for x in p], pa.decimal128(38, 0))})

    sums = rows.select("_v").mapInArrow(scatter, "i long, j long, p decimal(38,0)").groupBy("i", "j").agg(F.sum("p").alias("p")).collect()
    moved = total - n * least.astype(object)  # sums of the shifted values
    covariance = np.zeros((length, length))
    for r in sums:
        covariance[r.i, r.j] = covariance[r.j, r.i] = (n * int(r.p) - moved[r.i] * moved[r.j]) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > length * np.finfo(float).eps * max(values[-1], 0)]
    chosen = vectors[:, order]
    largest = np.abs(chosen).argmax(axis=0)  # one sign for all runs: the largest entry is positive
    chosen = chosen * np.where(chosen[largest, np.arange(len(order))] < 0, -1.0, 1.0)
    return Whitening(n, total, chosen, values[order], float(np.trace(covariance)))


def centred(x: np.ndarray, fitted: Whitening) -> np.ndarray:
    """n x - S, exact: long where it fits, else whole numbers of any size."""
    top = max(int(x.max()), 0) - min(int(x.min()), 0)
    if (top + max(abs(int(t)) for t in fitted.total) // fitted.n + 1) * 2 * fitted.n < 1 << 62:
        return x * fitted.n - fitted.total.astype(np.int64)
    return x.astype(object) * fitted.n - fitted.total


def squares(y: np.ndarray) -> list[int]:
    """Exact sums of squares by row."""
    if y.dtype != object and y.shape[1] * max(abs(int(y.min())), int(y.max())) ** 2 < 1 << 62:
        return (y * y).sum(axis=1).tolist()
    return [int(t) for t in (y.astype(object) ** 2).sum(axis=1)]


def project(y: np.ndarray, fitted: Whitening) -> np.ndarray:
    return (y.astype(float) / fitted.n) @ (fitted.components / np.sqrt(fitted.variances))


def apply(rows: DataFrame, length: int, fitted: Whitening, key: str = "vec_id") -> DataFrame:
    """(key, deviation, whitened): deviation is the exact sum over dimensions of (n x - S)**2, null
    where it has over 38 digits; whitened has the row's components in order."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                y = centred(whole(batch, length), fitted)
                w = project(y, fitted)
                off = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
                far = [Decimal(d) if d < 10**38 else None for d in squares(y)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), pa.array(far, pa.decimal128(38, 0)), pa.ListArray.from_arrays(off, pa.array(w.ravel()))],
                    [key, "deviation", "whitened"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, length: int, fitted: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, measured
    over all rows. Sums and products go through Spark: a number for each pair of components."""
    k = fitted.components.shape[1]

    def gram(batches):
        total, seen = np.zeros((k + 1, k)), False
        for batch in batches:
            if batch.num_rows:
                w = project(centred(whole(batch, length), fitted), fitted)
                total[:k] += w.T @ w
                total[k] += w.sum(axis=0)
                seen = True
        if seen:
            i, j = np.divmod(np.arange(total.size), k)
            yield pa.RecordBatch.from_pydict({"i": i, "j": j, "s": total.ravel()})

    found = np.zeros((k + 1, k))
    for r in rows.select("_v").mapInArrow(gram, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        found[r.i, r.j] = r.s
    mean = found[k] / fitted.n
    return float(np.abs(found[:k] / fitted.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error), a row for each usable
    vector and component, numbered from 1 by falling variance; deviation is a decimal(38,0)."""
    rows, length = usable(embeddings, key, vector)
    fitted = fit(rows, length, components) if length else None
    names = [f"`{key}`", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if fitted is None or not len(fitted.variances):
        kinds = ["int", "long", "decimal(38,0)", "double", "double", "double"]
        none = embeddings.sparkSession.createDataFrame([], ", ".join(f"{c} {t}" for c, t in zip(names[1:], kinds)))
        return embeddings.where("false").select(key).join(none, F.lit(True), "inner").select(*names)
    explained = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.variances])
    error = identity_error(rows, length, fitted)
    out = apply(rows, length, fitted, key).select(key, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(key, (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
