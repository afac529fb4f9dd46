"""Fraud window features on the reference's fixture (E2-E12, T1, T2, T4) plus brute-force
recompute (D10), bucket splitting (P4) and the stream twin (M3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronotab.operators.recompute import feature_differences, recompute_features
from chronotab.operators.windows import FEATURE_COLUMNS, event_features
from chronotab.plans import fraud
from fixtures import FRAUD_FIXTURE_CFG as CFG
from fixtures import TX_SCHEMA, fraud_rows


def _feats(spark, extra=False, bucket_days=None):
    raw = spark.createDataFrame(fraud_rows(extra), TX_SCHEMA)
    if bucket_days:
        f = fraud.assemble_fraud_features(raw, bucket_days=bucket_days)
    else:
        f = fraud.build_fraud_features([raw], CFG)
    return {r["trans_num"]: r.asDict() for r in f.collect()}


def test_windows_exclude_own_and_later_rows(spark):
    f = _feats(spark)
    assert f["t0"]["CC_TXN_COUNT_24H"] == 0  # a naive window would count 5
    assert f["t2"]["CC_TXN_COUNT_1H"] == 0 and f["t2"]["CC_TXN_COUNT_24H"] == 2
    assert f["t3"]["CC_TXN_COUNT_24H"] == 1
    assert f["s0"]["CC_TXN_COUNT_24H"] == 0 and f["s1"]["CC_TXN_COUNT_24H"] == 1


def test_empty_30_day_history(spark):
    f = _feats(spark)
    t4 = f["t4"]
    assert t4["CC_AMT_AVG_30D"] is None and t4["CC_SECONDS_SINCE_LAST_TXN"] is None
    assert t4["DISTANCE_FROM_USUAL_MERCHANT_KM"] is None
    assert t4["CC_AMT_SUM_24H"] == 0.0 and t4["CC_CATEGORY_TXN_COUNT_30D"] == 0


def test_values(spark):
    f = _feats(spark)
    assert f["t2"]["CC_AMT_AVG_30D"] == 15.0 and f["t2"]["CC_SECONDS_SINCE_LAST_TXN"] == 5400.0
    assert f["t2"]["CC_CATEGORY_TXN_COUNT_30D"] == 1
    assert f["t2"]["AMT_DEVIATION_FROM_CC_CATEGORY_AVG"] == 20.0
    assert f["t0"]["TRANSACTION_DAYOFWEEK"] == 2  # 2020-01-01 was a Wednesday, Monday = 0
    assert f["t3"]["TRANSACTION_HOUR"] == 1
    assert f["t1"]["AMT_ZSCORE_30D"] is None  # one earlier row: no sample std


def test_edges_ties_and_zero_std(spark):
    f = _feats(spark, extra=True)
    # u1 and u2 share card and time: neither sees the other (T4); u0 is exactly 30 d old
    assert f["u1"]["CC_TXN_COUNT_24H"] == 0 and f["u2"]["CC_TXN_COUNT_24H"] == 0
    assert f["u1"]["CC_SECONDS_SINCE_LAST_TXN"] == 30 * 86400.0
    assert f["u3"]["CC_TXN_COUNT_1H"] == 2  # u1, u2 exactly one hour old are in
    # u4: u1..u3 within 24 h, u0 beyond 30 d... u0 is 31 d old
    assert f["u4"]["CC_TXN_COUNT_24H"] == 3
    # u3's earlier amounts 8, 8, 9 -> std > 0; u1's only earlier amount 8 -> null
    assert f["u1"]["AMT_ZSCORE_30D"] is None


def test_zero_std_gives_null_zscore(spark):
    rows = [("a", "2020-01-01 00:00:00", 7, 5.0, "x", 0.0, 0.0, 0.0, 0.0, 0),
            ("b", "2020-01-01 01:00:00", 7, 5.0, "x", 0.0, 0.0, 0.0, 0.0, 0),
            ("c", "2020-01-01 02:00:00", 7, 9.0, "x", 0.0, 0.0, 0.0, 0.0, 0)]
    from fixtures import TX_SCHEMA as S
    f = fraud.assemble_fraud_features(spark.createDataFrame(rows, S))
    c = f.where("trans_num = 'c'").first()
    assert c["AMT_ZSCORE_30D"] is None and c["AMT_DEVIATION_FROM_CC_AVG"] == 4.0


@pytest.mark.parametrize("bucket_days", [1, 7, 45])
def test_bucket_splitting_is_exact(spark, bucket_days):
    base = _feats(spark, extra=True, bucket_days=None)
    split = _feats(spark, extra=True, bucket_days=bucket_days)
    for k, row in base.items():
        for c in ("CC_TXN_COUNT_1H", "CC_TXN_COUNT_24H", "CC_AMT_AVG_30D", "CC_SECONDS_SINCE_LAST_TXN",
                  "CC_CATEGORY_TXN_COUNT_30D", "AMT_ZSCORE_30D"):
            assert row[c] == split[k][c], (k, c)


@pytest.mark.parametrize("hot_card_rows", [0, 3])
def test_hot_card_range_path_is_exact(spark, hot_card_rows):
    """P4 for hot cards: frames read at probe rows from running totals over global time ranges
    equal the bucket windows on the fixture's edges, ties and zero-std cases (0 = every card on
    the range path, 3 = cards split between the paths)."""
    raw = spark.createDataFrame(fraud_rows(True), TX_SCHEMA)
    base = {r["trans_num"]: r.asDict() for r in fraud.assemble_fraud_features(raw, hot_card_rows=None).collect()}
    hot = {r["trans_num"]: r.asDict() for r in
           fraud.assemble_fraud_features(raw, hot_card_rows=hot_card_rows).collect()}
    assert base == hot


def test_card_with_a_third_of_all_rows(spark):
    """One card holding a third of the events: the split plan gives the bucket result, and the
    hot card's windows are partitioned by (card, time range), not by card alone."""
    from chronotab.operators.windows import hot_cards
    from chronotab.plans.driver import card_transactions
    from chronotab.sources.tables import Tables
    tx = card_transactions(Tables(spark, "/root/testdata/sf0.001"))
    skewed = tx.withColumn("card", F.when(F.col("trans_num") % 3 == 0, F.lit(-1)).otherwise(F.col("card")))
    n = skewed.count()
    limit = n // 4
    assert [r["card"] for r in hot_cards(skewed, "card", limit).collect()] == [-1]
    want = event_features(skewed, hot_card_rows=None)
    got = event_features(skewed, hot_card_rows=limit, n_buckets=16)
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(card#" in plan and "_rng" in plan


def test_only_cards_cut_by_a_range_are_read_at_probes(spark, monkeypatch):
    """Hot cards that lie in one range are read in place; probe rows are for those a range's end cuts."""
    from chronotab.operators import order
    rows = [(c * 100 + i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * (i // 2) + c), None if c == 12 else c, "ab"[i % 2],
             None if i % 9 == 4 else float(i % 5), 36.0, -81.0, 36.0 + i / 100, -81.0 - i / 100) for c in range(13) for i in range(20 + 400 * (c == 5))]
    tx = spark.createDataFrame(rows, "trans_num long, trans_ts timestamp_ntz, card long, category string, amt double, "
                                     "lat double, long double, merch_lat double, merch_long double")
    probed, prefix_totals = set(), order.prefix_totals
    monkeypatch.setattr(order, "prefix_totals", lambda df, *a, **k: probed.update(
        r.card for r in df.select("card").distinct().collect()) or prefix_totals(df, *a, **k))
    got = event_features(tx, hot_card_rows=10, n_buckets=4)
    want = event_features(tx, hot_card_rows=None)
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    assert 5 in probed and len(probed) <= 3


def test_recompute_of_all_features(spark):
    """No feature differs, with ties, nulls and a card that holds a third of all events; one that
    looks at the event itself does."""
    from chronotab.plans.driver import card_transactions
    from chronotab.sources.tables import Tables
    n = F.col("trans_num")
    tx = card_transactions(Tables(spark, "/root/testdata/sf0.001")).withColumns({
        "card": F.when(n % 3 == 0, F.lit(-1)).when(n % 50 == 7, F.lit(None)).otherwise(F.col("card")),
        "trans_ts": F.when(n % 90 == 11, F.lit(None)).otherwise(F.date_trunc("hour", "trans_ts").cast("timestamp_ntz")),
        "category": F.when(n % 40 == 3, F.lit(None)).otherwise(F.col("category")),
        "amt": F.when(n % 30 == 5, F.lit(None)).otherwise(F.col("amt")),
        "merch_lat": F.when(n % 35 == 6, F.lit(None)).otherwise(F.col("merch_lat")),
        "merch_long": F.when(n % 35 == 6, F.lit(None)).otherwise(F.col("merch_long"))})
    f = event_features(tx)
    for band_days in (3, 30):
        again = feature_differences(f, recompute_features(tx, band_days=band_days)).collect()
        assert {r.feature: (r.n_events, r.n_different) for r in again} == {c: (tx.count(), 0) for c in FEATURE_COLUMNS}
    shifted = event_features(tx.withColumn("trans_ts", F.col("trans_ts") + F.expr("INTERVAL 1 SECOND") * (n % 2)))  # ties broken: later ones see earlier ones
    assert any(r.n_different for r in feature_differences(shifted, recompute_features(tx)).collect())
    assert feature_differences(f.where("trans_num > 0"), recompute_features(tx)).where("n_different <> 1").isEmpty()


def test_stream_twin_equals_batch(spark):
    from chronotab.streaming import core as M
    from chronotab.streaming import stateful as S
    import tempfile, os
    raw = spark.createDataFrame(fraud_rows(extra=True), TX_SCHEMA)
    tx = raw.select("trans_num", F.col("trans_date_trans_time").cast("timestamp_ntz").alias("trans_ts"),
                    F.col("cc_num").alias("card"), "category", "amt", "lat", "long", "merch_lat", "merch_long")
    d = tempfile.mkdtemp(dir=os.environ.get("TMPDIR", "/tmp"))
    # two files so the stream sees two micro-batches, and a tick that lets the last events out
    tx.where("trans_ts < '2020-01-20'").coalesce(1).write.parquet(f"{d}/in/a")
    tx.where("trans_ts >= '2020-01-20'").coalesce(1).write.parquet(f"{d}/in/b")
    M.tick(tx, "trans_ts", "40 days").write.parquet(f"{d}/in/c")
    stream = spark.readStream.schema(tx.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in/*")
    out = M.run_to_table(S.stream_event_features(stream), "twin")
    got = {r["trans_num"]: r.asDict() for r in out.collect()}
    want = {r["trans_num"]: r.asDict() for r in event_features(tx, keep_intermediate=True).collect()}
    assert set(got) == set(want)
    for k in want:
        assert not got[k]["late"]
        for c in ("CC_TXN_COUNT_1H", "CC_TXN_COUNT_24H", "CC_AMT_SUM_24H", "CC_AMT_AVG_30D",
                  "CC_CATEGORY_TXN_COUNT_30D", "CC_SECONDS_SINCE_LAST_TXN", "AMT_ZSCORE_30D"):
            assert got[k][c] == want[k][c], (k, c)


def test_fraud_split_bounds_are_instants(spark):
    f = _feats(spark)
    assert f["t0"]["SPLIT"] == "train" and f["t1"]["SPLIT"] == "excluded"  # T11: to = midnight
    assert f["t3"]["SPLIT"] == "excluded" and f["t4"]["SPLIT"] == "test"  # 01:00 is after the validation instant
