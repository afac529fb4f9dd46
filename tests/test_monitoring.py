"""Drift (K3-K9), log read (A6, A7, C13), outcomes and delayed performance (C7, K10-K15),
replay cursor and examples (E13-E15), gate and promotion (J1, J2), contracts (G*)."""

import datetime as dt
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotab.config import DriftConfig, EvalConfig, PerformanceConfig
from chronotab.operators import contracts as G
from chronotab.operators import drift as K
from chronotab.operators import governance as J
from chronotab.operators import order as O
from chronotab.operators import outcomes as OC
from chronotab.sources import predlog as P

REF_SCHEMA = "income double, education string, children int"


def _reference(spark):
    rng = np.random.default_rng(42)
    rows = [(float(rng.normal(150000, 20000)), "Higher" if rng.random() < 0.4 else "Secondary",
             int(rng.integers(0, 4))) for _ in range(1000)]
    return spark.createDataFrame(rows, REF_SCHEMA)


def _current(spark, income_shift=0.0, higher=0.4, null_education=False, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(float(rng.normal(150000 + income_shift, 20000)),
             None if null_education else ("Higher" if rng.random() < higher else "Secondary"),
             int(rng.integers(0, 4))) for _ in range(200)]
    return spark.createDataFrame(rows, REF_SCHEMA)


def _drift(spark, cur):
    d = K.compute_drift(_reference(spark), cur)
    return {r["column_name"]: r.asDict() for r in d.collect()}, K.dataset_drift(d).first()


def test_income_shift_flags_only_income(spark):
    cols, ds = _drift(spark, _current(spark, income_shift=250000))
    assert cols["income"]["drifted"] and not cols["education"]["drifted"] and not cols["children"]["drifted"]
    assert ds["dataset_drift"] is False


def test_category_shift(spark):
    cols, _ = _drift(spark, _current(spark, higher=0.95))
    assert cols["education"]["drifted"]


def test_same_distribution_no_drift(spark):
    cols, ds = _drift(spark, _current(spark))
    assert not any(c["drifted"] for c in cols.values()) and not ds["dataset_drift"]


def test_all_null_column_skipped(spark):
    cols, _ = _drift(spark, _current(spark, null_education=True))
    assert "education" not in cols and "income" in cols


def test_boolean_column_is_categorical(spark):
    ref = spark.createDataFrame([(True,), (False,)] * 50, "flag boolean")
    cur = spark.createDataFrame([(True,)] * 100, "flag boolean")
    d = {r["column_name"]: r.asDict() for r in K.compute_drift(ref, cur).collect()}
    assert d["flag"]["kind"] == "categorical" and d["flag"]["drifted"]


def test_no_shared_columns_errors(spark):
    with pytest.raises(ValueError):
        K.compute_drift(spark.createDataFrame([(1.0,)], "a double"), spark.createDataFrame([(1.0,)], "b double"))


def test_retrain_truth_table(spark):
    df = spark.createDataFrame([(True, False), (False, True), (False, False), (None, None)], "i boolean, p boolean")
    got = [r[0] for r in df.select(K.retrain_decision(F.col("i"), F.col("p"))).collect()]
    assert got == [True, True, False, False]


def _record(rid, ts, score=0.5, version="1", source=None, client="x"):
    return {"request_id": rid, "entity_id": rid, "model_name": "m", "model_version": version, "score": score,
            "decision": "flag" if score >= 0.5 else "pass", "threshold": 0.5, "feature_vector": {"a": "1"},
            "traffic_source": source, "client": client, "timestamp": ts}


def test_log_read_merge_dedup_window_and_pruning(spark):
    d = tempfile.mkdtemp(dir=os.environ.get("TMPDIR", "/tmp"))
    local = [_record("r1", "2024-01-01T10:00:00+00:00", client="local-old"),
             _record("r1", "2024-01-05T10:00:00+00:00", client="local-new"),
             _record("r2", "2024-01-06T10:00:00+00:00", client="local")]
    blob = [_record("r1", "2024-01-07T10:00:00+00:00", client="blob"),
            _record("r3", "2024-01-06T11:00:00+00:00", client="blob")]
    for path, recs in (("local", local), ("blob", blob)):
        df = spark.createDataFrame(recs, P.LOG_SCHEMA).withColumn("domain", F.lit("credit"))
        P.write_prediction_log(df, f"{d}/{path}")
    out = P.read_prediction_log(spark, [f"{d}/local", f"{d}/blob"], "credit")
    got = {r["request_id"]: r["client"] for r in out.collect()}
    assert got == {"r1": "local-new", "r2": "local", "r3": "blob"}  # first copy wins, last record in it
    since = P.read_prediction_log(spark, [f"{d}/local", f"{d}/blob"], "credit", since=dt.datetime(2024, 1, 6))
    # day files before the window are not read, so the durable copy's newer r1 is the only one left
    assert {r["request_id"]: r["client"] for r in since.collect()} == {"r1": "blob", "r2": "local", "r3": "blob"}
    plan = since._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "day" in plan


def test_matured_window_and_performance(spark):
    cfg = PerformanceConfig(window_days=30, delay_days=7, min_labeled=500, min_positives=25)
    as_of = dt.datetime(2024, 3, 1)
    rows = [("a", "replay", "1", dt.datetime(2024, 2, 1)), ("b", "replay", "1", dt.datetime(2024, 2, 25)),
            ("c", "live", "1", dt.datetime(2024, 2, 1)), ("d", "replay", "2", dt.datetime(2024, 2, 1)),
            ("e", "replay", "1", dt.datetime(2023, 12, 1))]
    log = spark.createDataFrame(rows, "request_id string, traffic_source string, model_version string, timestamp timestamp_ntz")
    w = OC.matured_window(log, "1", as_of, cfg)
    assert [r[0] for r in w.select("request_id").collect()] == ["a"]

    rng = np.random.default_rng(0)

    def perf(n, sep):
        y = (rng.random(n) < 0.1).astype(int)
        s = 1 / (1 + np.exp(-(rng.normal(0, 1, n) + sep * y - 2)))
        recs = [(str(i), float(si), "flag" if si >= 0.5 else "pass", dt.datetime(2024, 2, 1)) for i, si in enumerate(s)]
        win = spark.createDataFrame(recs, "id string, score double, decision string, timestamp timestamp_ntz")
        outc = spark.createDataFrame([(str(i), int(v)) for i, v in enumerate(y)], "id string, outcome int")
        return OC.delayed_performance(win, outc, "id", 0.80, 0.3, cfg).first()

    ok = perf(1000, 1.5)
    assert ok["status"] == "ok" and ok["degraded"] is False
    bad = perf(1000, 0.0)
    assert bad["degraded"] is True
    assert perf(200, 1.5)["status"] == "insufficient_outcomes"


def test_outcome_table_drops_null_and_dedups(spark):
    f = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 0), (4, 1)], "k long, TARGET int")
    ids = spark.createDataFrame([("1",), ("2",), ("3",)], "id string")
    got = {r["id"]: r["outcome"] for r in OC.outcome_table(f, ids, "k", "TARGET").collect()}
    assert got == {"1": 1, "3": 0}


def test_cursor_wraps_without_repeats(spark):
    df = spark.range(0, 10).withColumnRenamed("id", "position")
    b = O.cursor_batch(df, "position", 10, 8, 5).orderBy("batch_order")
    assert [r[0] for r in b.select("position").collect()] == [8, 9, 0, 1, 2]
    assert O.next_cursor(10, 8, 5) == 3
    assert O.cursor_batch(df, "position", 10, 3, 50).count() == 10


def test_stratified_examples_in_file_order(spark):
    rows = [(i, 1 if i % 20 == 0 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "position long, outcome int")
    s = O.stratified_spaced_sample(df, ["position"], "outcome", 50, 15)
    got = s.orderBy("position").collect()
    assert sum(r["outcome"] for r in got) == 5 and len(got) == 50


def test_spaced_sample_matches_numpy(spark):
    df = spark.range(0, 1001).withColumnRenamed("id", "k")
    got = sorted(r["k"] for r in O.spaced_sample(df, ["k"], 37).collect())
    want = sorted(set(np.linspace(0, 1000, 37).round().astype(int).tolist()))
    assert got == want


def test_gate_reasons(spark):
    cfg = EvalConfig(10, 1, 0.05, 0.1, min_pr_auc=0.15)
    m = spark.createDataFrame([("a", 0.1), ("b", 0.3), ("c", 0.3), ("d", None)], "model string, pr_auc double")
    s = spark.createDataFrame([("a", "G", "x", 0.61, False), ("b", "G", "y", None, None), ("c", "G", "z", 0.8, True)],
                              "model string, slice_column string, slice_value string, roc_auc double, within_tolerance boolean")
    rc = spark.createDataFrame([("a", 3), ("b", 0), ("c", 2), ("d", 1)], "model string, n_reason_codes long")
    card = spark.createDataFrame([("a", "text"), ("b", "text"), ("c", "  "), ("d", "text")], "model string, card string")
    g = {r["model"]: r.asDict() for r in J.gate(m, s, rc, card, cfg).collect()}
    assert g["a"]["reasons"] == ["pr_auc 0.1000 under 0.1500", "slice G=x: roc_auc 0.6100 out of tolerance"]
    assert g["d"]["reasons"] == ["pr_auc unknown"] and not any(r["passed"] for r in g.values())
    assert g["b"]["reasons"] == ["reason codes missing"]  # null slice passes (T13)
    assert g["c"]["reasons"] == ["model card blank"]


def test_promotion(spark):
    df = spark.createDataFrame([(0.2, None), (0.2, 0.204), (0.2, 0.21)], "c double, p double")
    got = [r[0] for r in df.select(J.decide_promotion(F.col("c"), F.col("p"), 0.005)["promote"]).collect()]
    assert got == [True, True, False]


ORDERS = G.Contract("t", (
    G.Field("id", T.LongType(), unique=True),
    G.Field("amt", T.DoubleType(), ge=0.0),
    G.Field("gender", T.StringType(), isin=("F", "M")),
    G.Field("lat", T.DoubleType(), ge=-90.0, le=90.0),
    G.Field("note", T.StringType(), nullable=True),
))


def _violations(spark, rows, schema="id string, amt string, gender string, lat string, note string"):
    return {(r["column_name"], r["check"]) for r in G.violations(spark.createDataFrame(rows, schema), ORDERS).collect()}


def test_contract_accepts_valid_and_nulls_where_allowed(spark):
    assert _violations(spark, [("1", "2.5", "F", "10", None), ("2", "0", "M", "-90", "x")]) == set()


def test_contract_rejects_each_case(spark):
    assert ("id", "unique") in _violations(spark, [("1", "1", "F", "1", None), ("1", "1", "F", "1", None)])
    assert ("amt", "not_null") in _violations(spark, [("1", None, "F", "1", None)])
    assert ("gender", "in_set") in _violations(spark, [("1", "1", "X", "1", None)])
    assert ("lat", "less_than_or_equal") in _violations(spark, [("1", "1", "F", "91", None)])
    assert ("amt", "greater_than_or_equal") in _violations(spark, [("1", "-1", "F", "1", None)])
    assert ("amt", "type") in _violations(spark, [("1", "abc", "F", "1", None)])
    extra = _violations(spark, [("1", "1", "F", "1", None, "z")],
                        "id string, amt string, gender string, lat string, note string, extra string")
    assert ("extra", "extra_column") in extra
    assert ("note", "missing_column") in _violations(spark, [("1", "1", "F", "1")], "id string, amt string, gender string, lat string")


def test_null_profile_and_empty_typed(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "a long, b string")
    p = {r["column_name"]: r["n_null"] for r in G.null_profile(df).collect()}
    assert p == {"a": 0, "b": 1}
    e = G.empty_typed(spark, ORDERS)
    assert e.count() == 0 and e.columns == ORDERS.columns


def test_send_summary_takes_every_target(spark):
    from types import SimpleNamespace

    from chronotab.plans.q_files import q_send

    events = spark.createDataFrame([("view", 300.0), ("other", 1.0), ("other", 201.0), (None, 5.0)], "event_type string, value double")
    fn = getattr(q_send, "__wrapped__", q_send)
    got = {r.target: (r.sent, r.failed, r.run_failed) for r in fn(SimpleNamespace(events=events)).collect()}
    assert got == {"view": (1, 1, True), "other": (2, 1, True), None: (1, 0, False)}
