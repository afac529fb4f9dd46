"""Splits and maturity (F1-F4), metrics (H1-H8), slices (H9, H10), curves."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from chronotab.config import EvalConfig, LabelConfig, SliceConfig, SplitConfig
from chronotab.operators import evaluate as H
from chronotab.operators.splits import maturity_flag, mature_splits, split_label

SPLIT = SplitConfig.of(("2016-01-01", "2017-06-30"), ("2017-08-01", "2017-12-31"), ("2018-01-01", "2018-06-30"), gap_days=30)


def test_chronological_split_labels(spark):
    rows = [("2016-01-01",), ("2017-06-30",), ("2017-06-30 12:00:00",), ("2017-07-15",), ("2017-08-01",),
            ("2017-12-31",), ("2018-01-01",), ("2018-06-30",), ("2018-07-01",), ("2015-12-31",)]
    df = spark.createDataFrame(rows, "s string").withColumn("ts", F.col("s").cast("timestamp_ntz"))
    got = [r[0] for r in df.select(split_label("ts", SPLIT)).collect()]
    assert got == ["train", "train", "excluded", "excluded", "validation", "validation", "test", "test",
                   "excluded", "excluded"]


def test_gap_error():
    bad = SplitConfig.of(("2016-01-01", "2017-06-30"), ("2017-07-15", "2017-12-31"), ("2018-01-01", "2018-06-30"), gap_days=30)
    with pytest.raises(ValueError):
        split_label("ts", bad)


def test_maturity(spark):
    cfg = LabelConfig.of(540, "2018-06-30")
    df = spark.createDataFrame([("2017-01-06",), ("2017-01-07",), (None,)], "s string").withColumn(
        "ts", F.col("s").cast("timestamp_ntz"))
    assert [r[0] for r in df.select(maturity_flag("ts", cfg)).collect()] == [True, False, False]


def test_mature_splits_omit_empty(spark):
    df = spark.createDataFrame([("train", True), ("test", True), ("validation", False)], "SPLIT string, IS_MATURE boolean")
    assert set(mature_splits(df)) == {"train", "test"}


CFG = EvalConfig(cost_of_miss=10, cost_of_review=1, target_fpr=0.05, alert_budget_fraction=0.5)


def _metrics(spark, y, s, cfg=CFG):
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, score double")
    return H.compute_metrics(df, cfg).first().asDict()


def test_perfect_separation(spark):
    m = _metrics(spark, [0] * 7 + [1] * 5, [i / 20 for i in range(7)] + [0.5 + i / 16 for i in range(5)])
    assert m["roc_auc"] == 1.0 and m["pr_auc"] == 1.0


def test_alert_volume_matches_budget(spark):
    cfg = EvalConfig(10, 1, 0.05, 0.2)
    m = _metrics(spark, [0, 1] * 5, list(np.linspace(0, 1, 10)), cfg)
    assert m["alert_volume_fraction"] == pytest.approx(0.2)


def test_confusion_and_cost(spark):
    m = _metrics(spark, [1, 0, 0, 1], [0.9, 0.8, 0.2, 0.1])
    assert (m["true_positive"], m["false_positive"], m["false_negative"], m["true_negative"]) == (1, 1, 1, 1)
    assert m["expected_cost"] == 11.0


def test_auc_ties_half_weight(spark):
    m = _metrics(spark, [1, 0], [0.5, 0.5])
    assert m["roc_auc"] == 0.5


def test_recall_at_fpr_uses_kept_vertices(spark):
    # equal steps make (fpr .25, .5) collinear: the middle vertex is dropped
    y = [1, 0, 1, 0, 1, 0, 0, 0]
    s = [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]
    m = _metrics(spark, y, s, EvalConfig(10, 1, 0.45, 0.5))
    assert 0.0 <= m["recall_at_target_fpr"] <= 1.0


def _slices(spark, rows, tol=0.05):
    df = spark.createDataFrame(rows, "y int, score double, GROUP string")
    cfg = EvalConfig(10, 1, 0.05, 0.1, slices=(SliceConfig("GROUP", tol),))
    return {r["slice_value"]: r.asDict() for r in H.slice_metrics(df, cfg).collect()}


def test_degraded_slice_flagged(spark):
    rows = [(i // 6, 0.05 + 0.07 * i, "A") for i in range(12)] + [(1 - i // 6, 0.06 + 0.07 * i, "B") for i in range(12)]
    s = _slices(spark, rows)
    assert s["A"]["within_tolerance"] is True and s["B"]["within_tolerance"] is False
    assert H.outside_tolerance(H.slice_metrics(
        spark.createDataFrame(rows, "y int, score double, GROUP string"),
        EvalConfig(10, 1, 0.05, 0.1, slices=(SliceConfig("GROUP", 0.05),)))).count() == 1


def test_one_class_slice_gets_nulls(spark):
    rows = [(0, 0.1, "A"), (1, 0.9, "A"), (0, 0.3, "C"), (0, 0.4, "C")]
    s = _slices(spark, rows)
    assert s["C"]["roc_auc"] is None and s["C"]["within_tolerance"] is None and s["C"]["n"] == 2


def test_base_rate_changes_pr_auc_but_not_tolerance(spark):
    rng = np.random.default_rng(42)
    rows = []
    for group, rate in (("low", 0.05), ("high", 0.30)):
        for _ in range(8800):
            y = int(rng.random() < rate)
            rows.append((y, float(rng.normal(1.0 if y else 0.0, 1.0)), group))
    s = _slices(spark, rows)
    assert abs(s["low"]["pr_auc"] - s["high"]["pr_auc"]) > 0.05
    assert s["low"]["within_tolerance"] and s["high"]["within_tolerance"]


def test_auc_matches_mann_whitney(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 500)
    s = np.round(rng.normal(y, 1.0), 1)  # many ties
    m = _metrics(spark, y, s)
    pos, neg = s[y == 1], s[y == 0]
    u = sum((p > neg).sum() + 0.5 * (p == neg).sum() for p in pos)
    assert m["roc_auc"] == pytest.approx(u / (len(pos) * len(neg)), abs=1e-12)


def test_exact_quantile_matches_numpy(spark):
    from chronotab.operators.order import exact_quantiles
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(size=777), 2)
    df = spark.createDataFrame([(float(x),) for x in v], "value double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r["q_index"]: r["value"] for r in exact_quantiles(df, "value", probs, n_buckets=5).collect()}
    for i, q in enumerate(probs):
        assert got[i] == pytest.approx(float(np.percentile(v, q * 100)), abs=1e-12)


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(5)
    s = rng.random(300)
    y = (rng.random(300) < 0.3).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, score double")
    h = {(r["y"], r["bin"]): r["density"] for r in H.score_histogram(df).collect()}
    edges = np.linspace(0, s.max(), 50)
    for cls in (0, 1):
        dens, _ = np.histogram(s[y == cls], bins=edges, density=True)
        for i, d in enumerate(dens):
            assert h.get((cls, i), 0.0) == pytest.approx(d, rel=1e-9)


def test_global_row_number_without_single_partition(spark):
    from chronotab.operators.order import global_row_number
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000)
    r = global_row_number(df, ["k"], "pos", n_buckets=13)
    assert sorted(x["pos"] for x in r.collect()) == list(range(1000))
    assert r.where("pos != k").count() == 0
    plan = r._jdf.queryExecution().executedPlan().toString()
    # rows are windowed per range bucket; only the small per-bucket offsets table is ordered
    # as a whole
    assert "hashpartitioning(_rng" in plan
