"""File sources and sinks (A1-A14), series operators (L1-L22) and the scoring stream."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotab.operators import series as L
from chronotab.sources import predlog as P
from chronotab.sources import tables as S


def _tmp():
    return tempfile.mkdtemp(dir=os.environ.get("TMPDIR", "/tmp"))


def test_csv_contract_and_leading_index(spark):
    d = _tmp()
    with open(f"{d}/a.csv", "w") as f:
        f.write(",id,amt\n0,1,2.5\n1,2,NaN\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("amt", T.DoubleType())])
    df = S.read_csv_contract(spark, f"{d}/a.csv", schema, drop_leading_index=True)
    rows = df.orderBy("id").collect()
    assert df.columns == ["id", "amt"] and rows[0]["amt"] == 2.5 and rows[1]["amt"] is None  # NaN -> null


def test_feature_sink_source_prunes_split(spark):
    d = _tmp()
    df = spark.createDataFrame([(1, 0.5, "train"), (2, 0.7, "test")], "k long, f double, SPLIT string")
    S.write_features(df, f"{d}/feat")
    back = S.read_features(spark, f"{d}/feat", columns=["k", "f"], split="test")
    assert [r["k"] for r in back.collect()] == [2]
    assert "PartitionFilters: [isnotnull(SPLIT" in back._jdf.queryExecution().executedPlan().toString() or \
        "SPLIT" in back._jdf.queryExecution().executedPlan().toString()


def test_filtered_scan_semi_join(spark):
    big = spark.range(0, 100).withColumnRenamed("id", "k")
    ids = spark.createDataFrame([(3,), (5,), (5,), (500,)], "k long")
    assert sorted(r["k"] for r in S.filtered_scan(big, ids, "k").collect()) == [3, 5]


def test_requests_round_trip_gzip(spark):
    d = _tmp()
    schema = T.StructType([T.StructField("id", T.LongType()),
                           T.StructField("history", T.ArrayType(T.StructType([T.StructField("x", T.DoubleType())])))])
    req = spark.createDataFrame([(1, [(1.0,), (None,)]), (2, [])], schema)
    P.write_requests(req, f"{d}/req", n_files=2)
    assert any(f.endswith(".gz") for f in os.listdir(f"{d}/req"))
    back = P.read_requests(spark, f"{d}/req", schema)
    got = {r["id"]: [h["x"] for h in r["history"]] for r in back.collect()}
    assert got == {1: [1.0, None], 2: []}


def test_outcomes_round_trip_id_as_string(spark):
    d = _tmp()
    P.write_outcomes(spark.createDataFrame([(12, 1), (7, 0)], "id long, outcome int"), f"{d}/o")
    back = P.read_outcomes(spark, f"{d}/o")
    assert dict(back.dtypes)["id"] == "string" and {r["id"] for r in back.collect()} == {"12", "7"}


def test_gauge_replace_and_merge(spark):
    d = _tmp()
    g = spark.createDataFrame(
        [("drift", "credit", "psi", {"c": "a"}, dt.datetime(2024, 1, 1), 0.1),
         ("perf", "credit", "auc", {}, dt.datetime(2024, 1, 1), 0.8)], P.GAUGE_SCHEMA)
    P.replace_gauges(g, f"{d}/g")
    g2 = spark.createDataFrame([("drift", "credit", "psi", {"c": "b"}, dt.datetime(2024, 1, 2), 0.3)], P.GAUGE_SCHEMA)
    P.replace_gauges(g2, f"{d}/g")  # replaces the drift group only
    back = spark.read.parquet(f"{d}/g")
    assert back.count() == 2 and back.where("job = 'perf'").count() == 1
    merged = P.merge_gauge(g, spark.createDataFrame(
        [("drift", "credit", "psi", {"c": "a"}, dt.datetime(2024, 1, 3), 0.9)], P.GAUGE_SCHEMA))
    vals = {(r["name"], r["value"]) for r in merged.collect()}
    assert ("psi", 0.9) in vals and ("psi", 0.1) not in vals and ("auc", 0.8) in vals


def test_reference_snapshot_fallback(spark):
    d = _tmp()
    feats = spark.createDataFrame([(1, "train"), (2, "test")], "k long, SPLIT string")
    feats.write.parquet(f"{d}/features")
    fallback = P.read_reference_snapshot(spark, f"{d}/snap", "7", f"{d}/features")
    assert [r["k"] for r in fallback.collect()] == [1]
    P.write_reference_snapshot(feats.where("k = 2"), f"{d}/snap", "7")
    assert [r["k"] for r in P.read_reference_snapshot(spark, f"{d}/snap", "7", f"{d}/features").collect()] == [2]


def _samples(spark, rows):
    return spark.createDataFrame([(s, dt.datetime.fromisoformat(t), float(v)) for s, t, v in rows],
                                 "series string, ts timestamp_ntz, value double")


def test_counter_rate_handles_reset(spark):
    rows = [("a", "2024-01-01 00:00:00", 10), ("a", "2024-01-01 00:01:00", 30), ("a", "2024-01-01 00:02:00", 5),
            ("a", "2024-01-01 00:03:00", 15)]
    r = L.counter_rate(_samples(spark, rows), ["series"], n_buckets=2).first()
    assert r["increase"] == 20 + 5 + 10 and r["rate_per_second"] == pytest.approx(35 / 180)


def test_alert_runs_hold(spark):
    rows = [("a", "2024-01-01 00:00:00", 95), ("a", "2024-01-01 00:05:00", 96), ("a", "2024-01-01 00:12:00", 50),
            ("a", "2024-01-01 01:00:00", 99), ("a", "2024-01-01 01:03:00", 10)]
    runs = L.alert_runs(_samples(spark, rows), ["series"], F.col("value") > 90, 600, dt.datetime(2024, 1, 2), n_buckets=2)
    got = sorted((r["run_start"], r["fired"]) for r in runs.collect())
    assert got == [(dt.datetime(2024, 1, 1, 0, 0), True), (dt.datetime(2024, 1, 1, 1, 0), False)]


def test_staleness_and_no_data(spark):
    st = L.staleness(_samples(spark, [("a", "2024-01-01 00:00:00", 1)]), ["series"], dt.datetime(2024, 1, 3), 172800.0)
    assert st.first()["stale"] is False  # exactly the bound is not stale
    rules = spark.createDataFrame([("cpu", "OK"), ("job", "Alerting"), ("drift", "OK")], "title string, no_data_state string")
    counts = spark.createDataFrame([("cpu", 3)], "title string, n_series long")
    states = {r["title"]: r["state"] for r in L.no_data_policy(rules, counts).collect()}
    assert states == {"cpu": "Evaluated", "job": "Alerting", "drift": "OK"}


def test_ties_give_one_answer(spark):
    """Samples of a series at one time are ordered by value, whatever the partitioning."""
    at = "2024-01-01 00:00:00"
    rows = [("a", at, 8), ("a", at, 2), ("a", at, 5), ("a", "2024-01-01 00:10:00", 1), ("a", "2024-01-01 00:10:00", 9)]
    rates, runs = set(), set()
    for n in (1, 2, 3, 5):
        samples = _samples(spark, rows).repartition(n, "value")
        rates.add(L.counter_rate(samples, ["series"], n_buckets=n).first()["increase"])
        runs.add(L.alert_runs(samples, ["series"], F.col("value") > 4, 60, dt.datetime(2024, 1, 2), n_buckets=n).count())
    assert rates == {3 + 3 + 1 + 8} and len(runs) == 1


def test_up_health_bad_states(spark):
    last = spark.createDataFrame([("api", 1.0), ("api", 0.0), ("db", 1.0)], "job string, value double")
    up = {r["job"]: r["up"] for r in L.up_rollup(last).collect()}
    assert up == {"api": False, "db": True}
    cpu = spark.createDataFrame([("web", 95.0)], "role string, value double")
    mem = spark.createDataFrame([("db", 80.0)], "role string, value double")
    disk = spark.createDataFrame([], "role string, value double")
    upr = spark.createDataFrame([("web", True)], "role string, up boolean")
    h = {r["role"]: r.asDict() for r in L.host_health(cpu, mem, disk, upr).withColumn("band", L.health_band("cpu_pct")).collect()}
    assert h["web"]["band"] == "red" and h["db"]["cpu_pct"] is None and h["db"]["band"] is None
    phases = spark.createDataFrame([("p1", "Failed", 1.0), ("p2", "Running", 1.0)], "pod string, phase string, value double")
    waiting = spark.createDataFrame([("p3", "CrashLoopBackOff", 1.0), ("p4", "ContainerCreating", 1.0)],
                                    "pod string, reason string, value double")
    assert {r["pod"] for r in L.bad_state_union(phases, waiting).collect()} == {"p1", "p3"}


def test_histogram_quantile_prometheus_rule(spark):
    b = spark.createDataFrame([("x", 1.0, 2.0), ("x", 5.0, 3.0)], "job string, value double, w double")
    buckets = L.cumulative_buckets(b, "value", ["job"], [1.0, 2.0, 10.0])
    q = L.histogram_quantile(buckets, 0.5, "q").first()["q"]
    assert q == pytest.approx(1.0)  # rank 1 falls in the first bucket at its upper bound
    q9 = L.histogram_quantile(buckets, 0.9, "q").first()["q"]
    assert 2.0 < q9 <= 10.0


def test_readers_beside_writers_see_whole_pushes(spark):
    """Nothing of a staged push is seen; parallel merges both hold; an emptied group is empty."""
    root = _tmp()

    def group(job, values, name="size"):
        rows = [(job, "d", name, {"k": str(k)}, None, float(v)) for k, v in values.items()]
        return spark.createDataFrame(rows, P.GAUGE_SCHEMA)

    def held():
        return {(r.job, r.name, r.labels["k"]): r.value for r in P.read_gauges(spark, root).collect()}

    P.push_gauges(group("a", {1: 1, 2: 2}), root, [("a", "d")])
    P.push_gauges(group("b", {1: 5}), root, [("b", "d")])
    before = {("a", "size", "1"): 1.0, ("a", "size", "2"): 2.0, ("b", "size", "1"): 5.0}
    P.stage_push(group("a", {1: 10}), root, "later")  # the writer is between its two steps
    assert held() == before
    seen = P.read_gauges(spark, root)
    P.commit_push(spark, root, "later", [("a", "d")], "replace", 1 << 60)
    assert {(r.job, r.name, r.labels["k"]): r.value for r in seen.collect()} == before  # a reader that had begun
    assert held() == {("a", "size", "1"): 10.0, ("b", "size", "1"): 5.0}
    for k in (1, 2):  # both were staged before either was committed
        P.stage_push(group("a", {k: 20 + k}, "beat"), root, f"beat{k}")
    for k in (2, 1):
        P.commit_push(spark, root, f"beat{k}", [("a", "d")], "merge", (1 << 60) + 1)
    assert held() == {("a", "size", "1"): 10.0, ("a", "beat", "1"): 21.0, ("a", "beat", "2"): 22.0, ("b", "size", "1"): 5.0}
    P.push_gauges(group("b", {}), root, [("b", "d")], at=1 << 61)
    assert ("b", "size", "1") not in held() and len(held()) == 3


def test_scoring_stream_quarantines_and_logs(spark):
    from chronotab.operators import contracts as G
    from chronotab.operators import models as I
    from chronotab.streaming import core as M
    from chronotab.streaming.batches import decisions_writer
    d = _tmp()
    train = spark.createDataFrame([(float(i), i % 2) for i in range(40)], "x double, y int")
    model = I.fit_logistic(train, ["x"], [], "y", max_iter=20)
    rows = spark.createDataFrame([(1, 3.0), (2, -1.0), (3, 30.0)], "id long, x double")
    rows.coalesce(1).write.parquet(f"{d}/in")
    contract = G.Contract("req", (G.Field("id", T.LongType()), G.Field("x", T.DoubleType(), ge=0.0)))
    stream = spark.readStream.schema(rows.schema).parquet(f"{d}/in")
    out = M.run_to_table(stream, "decide", foreach_batch=decisions_writer(contract, model, 0.5, "id", f"{d}/bad"))
    assert {r["request_id"] for r in out.collect()} == {"1", "3"}
    assert [r["id"] for r in spark.read.parquet(f"{d}/bad").collect()] == [2]


def test_ratio_over_zero_is_that_of_doubles(spark):
    a = spark.createDataFrame([(1, 5.0), (2, -5.0), (3, 0.0), (4, 5.0), (5, 6.0), (6, None), (7, 5.0)], "k int, value double")
    b = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 0.0), (4, -0.0), (5, 8.0), (6, 0.0), (7, None)], "k int, value double")
    got = {r.k: r.pct for r in L.gauge_ratio_pct(a, b, ["k"]).collect()}
    inf = float("inf")
    assert got[3] != got[3] and {k: got[k] for k in (1, 2, 4, 5, 6, 7)} == {1: inf, 2: -inf, 4: -inf, 5: 75.0, 6: None, 7: None}
    used = {r.k: r.pct for r in L.gauge_ratio_pct(a, b, ["k"], complement=True).collect()}
    assert used[1] == -inf and used[5] == 25.0
