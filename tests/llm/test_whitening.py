"""op13 against covariances in whole numbers of any size, computed row by row."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from chronotab.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, _v string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in vectors], SCHEMA).repartition(3)


def exact(vectors):
    """n, sums, covariance and n x - S, all as whole numbers or fractions of them."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    total = [sum(r[k] for r in x) for k in range(d)]
    cov = [[float(Fraction(sum((n * r[i] - total[i]) * (n * r[j] - total[j]) for r in x), n**3)) for j in range(d)] for i in range(d)]
    return n, total, np.array(cov), [[n * r[k] - total[k] for k in range(d)] for r in x]


@pytest.mark.parametrize("spread", [1.0, 300.0, 2.0**30])
def test_whitening_is_exact(spark, spread):
    rng = random.Random(3)
    good = [[rng.gauss(0, spread) * (k + 1) + rng.random() * spread for k in range(5)] for _ in range(150)]
    good += good[:20]  # repeated rows count one by one
    odd = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf"), 1.0, 1.0, 1.0, 1.0], [1.0, 2.0]]
    rows = [(i, v) for i, v in enumerate(good)] + [(1000 + i, v) for i, v in enumerate(odd)]
    got = whitening.whiten(table(spark, rows), components=4).collect()
    n, total, cov, moved = exact(good)
    assert n == 170 and len(got) == n * 4 and {r.n for r in got} == {n}
    values, vectors = np.linalg.eigh(cov)
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(by_row) == list(range(170))
    w = np.array([[by_row[i][c].whitened for c in range(1, 5)] for i in range(170)])
    want = np.array(moved, dtype=float) / n @ vectors[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])
    signs = np.sign((w * want).sum(axis=0))
    assert np.allclose(w, want * signs, atol=1e-8)
    for i in range(170):
        assert int(by_row[i][1].deviation) == sum(y * y for y in moved[i])
    for c in range(1, 5):
        assert math.isclose(by_row[0][c].explained, values[::-1][c - 1] / np.trace(cov), rel_tol=1e-9)
    off = np.abs(np.cov(w.T, bias=True) - np.eye(4)).max()
    assert {r.identity_error for r in got} == {by_row[0][1].identity_error}
    assert off < 1e-8 and by_row[0][1].identity_error < 1e-8


def test_products_of_planes():
    rng = np.random.default_rng(1)
    u = np.stack([rng.integers(0, 1 << b, 1000) if b else np.zeros(1000, dtype=np.int64) for b in (0, 1, 7, 40)], axis=1)
    bits = np.array([int(u[:, k].max()).bit_length() for k in range(4)])
    counts = np.zeros((bits.sum(),) * 2, dtype=np.int64)
    for at in range(0, 1000, 130):
        whitening.plane_counts(whitening.planes(u[at:at + 130], bits), counts)
    big = u.astype(object)
    assert whitening.products(counts, bits) == [(i, j, int((big[:, i] * big[:, j]).sum())) for i in range(4) for j in range(i, 4)]


def test_blocks_do_not_matter(spark, monkeypatch):
    rows = [(i, [float((i * k) % 17) for k in range(1, 4)]) for i in range(300)]
    one = whitening.whiten(table(spark, rows)).orderBy("vec_id", "component").collect()
    u = whitening.usable(table(spark, rows).coalesce(1))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        fitted = whitening.fit(*u)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    again = whitening.fit(*whitening.usable(table(spark, rows)))
    assert len(one) == 900 and np.array_equal(fitted.components, again.components) and fitted.trace == again.trace


def test_no_variance_and_no_rows(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    flat = whitening.whiten(table(spark, [(i, [1.0, 1.0]) for i in range(5)]))
    none = whitening.whiten(table(spark, [(1, None)]))
    line = whitening.whiten(table(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(5)])).collect()
    assert flat.columns == none.columns == columns and flat.count() == none.count() == 0
    assert {r.component for r in line} == {1} and len(line) == 5  # one direction holds all variance
    assert {f.dataType.simpleString() for f in none.schema if f.name == "deviation"} == {"decimal(38,0)"}
