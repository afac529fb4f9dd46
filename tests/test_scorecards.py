"""I1-I10 and the quantile sketches: bins against a direct search, models that fail their checks."""

import itertools
import math
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from chronotab.operators import binning as B
from chronotab.operators import models as I
from chronotab.operators import sketches as K
from chronotab.operators import versions as V
from chronotab.operators.drift import psi_from_sketches, psi_numeric


def pooled_by_search(blocks, rising):
    """Of all ways to cut the sequence into strictly monotone runs, the one nearest to the pre-bins'
    rates (weighted least squares): what pooling adjacent violators must find."""
    m, best = len(blocks), None
    for cuts in itertools.product([0, 1], repeat=m - 1):
        runs, cur = [], [blocks[0]]
        for c, b in zip(cuts, blocks[1:]):
            if c:
                runs.append(cur)
                cur = []
            cur.append(b)
        runs.append(cur)
        rates = [sum(e for e, _ in r) / sum(e + n for e, n in r) for r in runs]
        if any((x >= y) if rising else (x <= y) for x, y in zip(rates, rates[1:])):
            continue
        loss = sum((e + n) * (e / (e + n) - q) ** 2 for r, q in zip(runs, rates) for e, n in r)
        if best is None or loss < best[0] - 1e-12:
            best = (loss, [(sum(e for e, _ in r), sum(n for _, n in r)) for r in runs])
    return best[1]


@pytest.mark.parametrize("seed", range(12))
def test_pooling_is_the_best_monotone_cut(seed):
    rng = random.Random(seed)
    raw = [(rng.randrange(0, 9), rng.randrange(1, 30)) for _ in range(rng.randrange(2, 9))]
    for rising in (True, False):
        got = B.pool_violators([B.Block(e, n, [k]) for k, (e, n) in enumerate(raw)], rising)
        assert [(b.e, b.n) for b in got] == pooled_by_search(raw, rising)
        assert [m for b in got for m in b.members] == list(range(len(raw)))


@pytest.mark.parametrize("seed", range(6))
def test_short_bins_join_the_nearer_neighbour(seed):
    rng = random.Random(seed)
    blocks = B.pool_violators([B.Block(rng.randrange(0, 20), rng.randrange(1, 60), [k]) for k in range(10)])
    got = B.pool_short(blocks, 40, 4)
    assert len(got) == 1 or all(b.e + b.n >= 40 and b.e >= 4 for b in got)
    assert [m for b in got for m in b.members] == list(range(10))
    assert all(x.rate < y.rate for x, y in zip(got, got[1:]))


def rows(spark, n=3000, seed=1):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        x = rng.choice([None, rng.gauss(0, 1), rng.gauss(0, 1), float(rng.randrange(3))])
        c = rng.choice(["a", "a", "b", "c", None, f"rare{rng.randrange(200)}"])
        p = 1 / (1 + math.exp(-((x or 0) * 2 + {"a": 1, "b": -1}.get(c, 0))))
        data.append((i, x, c, int(rng.random() < p)))
    return spark.createDataFrame(data, "id long, x double, c string, y int")


def test_fitted_bins(spark):
    df = rows(spark)
    bins = B.fit_bins(df, "y", ["x"], ["c"], n_prebins=12, min_share=0.06, min_events=20, level_share=0.02)
    data = [r.asDict() for r in df.collect()]
    for v in ("x", "c"):
        own = sorted((b for b in bins if b.variable == v), key=lambda b: b.bin)
        assert own[0].bin == B.MISSING and [b.bin for b in own[1:]] == list(range(len(own) - 1))
        assert sum(b.n_event + b.n_nonevent for b in own) == len(data)
        weights = [b.woe for b in own[1:]]
        assert weights in (sorted(weights), sorted(weights, reverse=True))  # monotone
        assert all(b.n_event + b.n_nonevent >= 0.06 * len(data) and b.n_event >= 20 for b in own[1:])

    def place(v, value):
        own = [b for b in bins if b.variable == v and b.bin != B.MISSING]
        if value is None:
            return next(b for b in bins if b.variable == v and b.bin == B.MISSING)
        if v == "c":
            return next((b for b in own if value in b.levels), None) or next(b for b in own if b.rest)
        return next(b for b in sorted(own, key=lambda b: b.bin) if b.upper is None or value <= b.upper)

    for v in ("x", "c"):
        counts = {}
        for r in data:
            b = place(v, r[v])
            counts.setdefault(b.bin, [0, 0])[1 - r["y"]] += 1
        assert counts == {b.bin: [b.n_event, b.n_nonevent] for b in bins if b.variable == v}
    more = spark.createDataFrame([(1, 1e9, "never seen", 0), (2, -1e9, None, 0), (3, None, "a", 0)], df.schema).unionByName(df.limit(200))
    for r in more.select("x", "c", B.woe_of("x", bins).alias("wx"), B.woe_of("c", bins).alias("wc")).collect():
        assert (r.wx, r.wc) == (place("x", r.x).woe, place("c", r.c).woe)
    with pytest.raises(ValueError):
        B.fit_bins(df.where("y = 1"), "y", ["x"])


def test_checks_fail_on_broken_models(spark):
    from chronotab.plans import q_govern as Q
    df = rows(spark).withColumn("SPLIT", F.when(F.col("id") % 2 == 0, "train").otherwise("test"))
    train = df.where("SPLIT = 'train'")
    card = I.fit_woe_scorecard(train, "y", ["x"], ["c"], max_iter=200)
    good = df.select("SPLIT", "y", card.score().alias("score"))
    assert all(r.ranked and r.in_range for r in Q.fit_check(good).collect())
    assert all(r.at_optimum for r in Q.optimum(card, train).collect())
    shuffled = I.fit_woe_scorecard(train.withColumn("y", (F.xxhash64("id") % 2 == 0).cast("int")), "y", ["x"], ["c"], max_iter=50)
    bad = df.select("SPLIT", "y", shuffled.score().alias("score"))
    assert not any(r.ranked for r in Q.fit_check(bad).where("SPLIT = 'test'").collect())
    worse = I.Scorecard(card.bins, card.intercept + 0.1, card.coefficients, card.mean_woe)
    assert not all(r.at_optimum for r in Q.optimum(worse, train).collect())


def test_versions(spark):
    root = tempfile.mkdtemp(dir=os.environ.get("TMPDIR", "/tmp"))
    train = rows(spark)
    card = I.fit_woe_scorecard(train, "y", ["x"], ["c"], max_iter=50)
    trees = I.fit_gbt(train, ["x"], ["c"], "y", max_iter=3)
    V.save_version(root, "m", "1", card, train, ["x"], {"test_pr_auc": "0.5"})
    V.save_version(root, "m", "2", trees, train.where("id < 1000"), ["x"])
    for alias, version, number in [("champion", "2", 1), ("champion", "1", 2), ("challenger", "2", 3)]:
        V.set_alias(spark, root, "m", alias, version, number)
    assert {(r.alias, r.version) for r in V.aliases(spark, root, "m").collect()} == {("champion", "1"), ("challenger", "2")}
    champion, challenger = (V.load_version(spark, root, "m", a) for a in ("champion", "challenger"))
    assert champion.tags == {"test_pr_auc": "0.5", "model_type": "scorecard"} and challenger.tags["model_type"] == "pipeline"
    assert champion.model.bins == sorted(card.bins, key=lambda b: (b.variable, b.bin))
    for version, model in ((champion, None), (challenger, trees)):
        got = {r.id: r.score for r in version.score_reference(["id"]).collect()}
        fresh = train if model is None else train.where("id < 1000")
        want = fresh.select("id", card.score().alias("score")) if model is None else I.batch_score(model, fresh, ["id"])
        assert got == {r.id: r.score for r in want.collect()}
    assert champion.means["x"] == pytest.approx(train.agg(F.avg("x")).first()[0])
    assert challenger.sketches.first().n == train.where("id < 1000 and x is not null").count()


def test_sketches_merge_within_the_stated_error(spark):
    df = spark.range(200_000).select((F.xxhash64("id") % 1000).cast("double").alias("x"), (F.col("id") % 7).alias("day"),
                                     F.when(F.col("id") % 3 == 0, F.col("id").cast("double")).alias("z"))
    k = 512
    parts = K.column_sketches(df, ["x", "z"], ["day"], k)
    one = K.column_sketches(df, ["x", "z"], (), k)
    assert parts.select(F.max(F.length("sketch"))).first()[0] < 40_000  # bounded, whatever the rows
    probs = [0.01, 0.25, 0.5, 0.9]
    for sketches in (K.merge_sketches(parts, k), one):
        assert {r.column_name: r.n for r in sketches.collect()} == {"x": 200_000, "z": df.where("z is not null").count()}
        for r in K.sketch_quantiles(sketches, probs).collect():
            n, below, upto = df.select(F.count(r.column_name), F.count_if(F.col(r.column_name) < r.value), F.count_if(F.col(r.column_name) <= r.value)).first()
            assert below / n - K.rank_error(k) <= r.q <= upto / n + K.rank_error(k)
    cur = df.where("x > 100").select("x", "z")
    near = {r.column_name: r.psi for r in psi_from_sketches(K.merge_sketches(parts, k), cur, ["x", "z"]).collect()}
    exact = {r.column_name: r.psi for r in psi_numeric(df, cur, ["x", "z"]).collect()}
    assert all(abs(near[c] - exact[c]) < 0.02 for c in exact) and exact["x"] > 0.02
