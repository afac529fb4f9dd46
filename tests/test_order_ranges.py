"""Running totals and row numbers over ranges of the whole sort key, ties and hot keys included."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronotab.operators.order import exact_quantiles, global_row_number, prefix_totals


def test_row_number_with_many_ranges(spark):
    rng = np.random.default_rng(3)
    vals = rng.integers(0, 300, 2000)
    df = spark.createDataFrame([(int(i), int(v)) for i, v in enumerate(vals)], "id int, v int")
    got = dict(global_row_number(df, ["v", "id"], "pos", n_buckets=64).select("id", "pos").collect())
    order = sorted(range(len(vals)), key=lambda i: (vals[i], i))
    assert all(got[i] == p for p, i in enumerate(order))


@pytest.mark.parametrize("descending", [False, True])
def test_totals_with_one_common_first_key_and_nulls(spark, descending):
    rng = np.random.default_rng(5)
    rows = [(i, None if i % 11 == 0 else int(i % 3), 7 if i % 5 else None, int(rng.integers(0, 9))) for i in range(800)]
    df = spark.createDataFrame(rows, "id int, g int, t int, v int").repartition(3)
    got = {r.id: (r.total, r.most, r.pos) for r in prefix_totals(
        df, ["t", "id"], {"total": F.col("v")}, ["g"], descending, "pos", 16, {"most": F.col("v")}).collect()}
    state = {}
    low = lambda r: (r[2] is not None, r[2] or 0, r[0])  # noqa: E731  nulls first ascending, last descending
    for i, g, _, v in sorted(rows, key=low, reverse=descending):
        total, most, n = state.get(g, (0, -1, -1))
        state[g] = total + v, max(most, v), n + 1
        assert got[i] == state[g]


def test_a_common_time_spreads_over_ranges(spark):
    df = spark.range(5000).select(F.lit(1).alias("t"), "id")
    ranges = prefix_totals(df, ["t", "id"], {"n": F.lit(1)}, n_buckets=8)
    assert sorted(r.n for r in ranges.collect()) == list(range(1, 5001))


def test_quantiles_meet_their_own_values_only(spark):
    rng = np.random.default_rng(1)
    rows = [(g, float(x)) for g in "ab" for x in rng.integers(0, 50, 301)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    for by in (["g"], []):
        out = exact_quantiles(df, "v", probs, by=by)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Cross" not in plan
        for r in out.collect():
            own = [x for g, x in rows if not by or g == r.g]
            assert r.value == pytest.approx(float(np.percentile(own, probs[r.q_index] * 100)), abs=1e-12)
