"""Streams over several files, out of order, restarted and failing: M1, M3, M4, M7-M10."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotab.operators.contracts import Contract, Field
from chronotab.operators.series import alert_runs
from chronotab.operators.windows import event_features
from chronotab.plans.driver import card_transactions
from chronotab.sources.tables import Tables
from chronotab.streaming import core as M
from chronotab.streaming import stateful as S
from chronotab.streaming.batches import decisions_writer, drift_counts_writer

SF = "/root/testdata/sf0.001"

NAMES = ["trans_num", *[n for n, _ in S.FEATURES if not n.startswith("_")], "DISTANCE_FROM_USUAL_MERCHANT_KM"]


def arrivals(parts, last=None):
    return [lambda folder, p=p: M.land(p, folder) for p in parts] + ([lambda folder: M.land(last, folder, 1)] if last is not None else [])


@pytest.mark.parametrize("bucket_days", [4, 30])
def test_card_features_in_any_order(spark, bucket_days):
    """A third of all events on one card, nulls of every kind, files dealt at random, restarts."""
    tx = card_transactions(Tables(spark, SF))
    n = F.col("trans_num")
    tx = tx.withColumns({
        "card": F.when(n % 3 == 0, F.lit(-1)).when(n % 50 == 7, F.lit(None)).otherwise(F.col("card")),
        "trans_ts": F.when(n % 90 == 11, F.lit(None)).otherwise(F.date_trunc("hour", "trans_ts").cast("timestamp_ntz")),  # ties
        "category": F.when(n % 40 == 3, F.lit(None)).otherwise(F.col("category")),
        "amt": F.when(n % 30 == 5, F.lit(None)).otherwise(F.col("amt")),
        "merch_lat": F.when(n % 35 == 6, F.lit(None)).otherwise(F.col("merch_lat")),
        "merch_long": F.when(n % 35 == 6, F.lit(None)).otherwise(F.col("merch_long"))})
    parts = [tx.where(F.pmod(F.xxhash64("trans_num"), F.lit(3)) == k) for k in range(3)]
    out = M.run_arrivals(spark, "any_order", arrivals(parts, M.tick(tx, "trans_ts", "90 days")), lambda folder: S.stream_event_features(
        spark.readStream.schema(tx.schema).option("maxFilesPerTrigger", 3).parquet(folder), delay="60 days", bucket_days=bucket_days))
    want = event_features(tx, keep_intermediate=True).select(NAMES)
    got = out.select(NAMES)
    assert out.where("late").isEmpty()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert out.where("card is null").count() == tx.where("card is null").count() > 0


def test_late_events_come_out_flagged_and_change_nothing(spark):
    tx = card_transactions(Tables(spark, SF))
    early, rest = tx.where("trans_ts < '2024-01-15' and trans_num % 10 <> 3"), tx.where("trans_ts >= '2024-01-15'")
    late = tx.where("trans_ts < '2024-01-10' and trans_num % 10 = 3")
    out = M.run_arrivals(spark, "late", arrivals([early, rest.unionByName(late)], M.tick(tx, "trans_ts", "90 days")),
                         lambda folder: S.stream_event_features(spark.readStream.schema(tx.schema).parquet(folder), delay="1 day"))
    want = event_features(early.unionByName(rest), keep_intermediate=True).select(NAMES)
    got = out.where("not late").select(NAMES)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    flagged = out.where("late")
    assert {r.trans_num for r in flagged.collect()} == {r.trans_num for r in late.collect()}
    assert flagged.where(" or ".join(f"{c} is not null" for c in NAMES[1:])).isEmpty()


def samples(spark, n=400):
    rng = random.Random(9)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for k in range(n):
        rows.append((k, f"s{rng.randrange(4)}", start + dt.timedelta(minutes=rng.randrange(0, 4000, 5)), rng.choice([True, True, True, False, None])))
    return spark.createDataFrame(rows, "id long, series string, ts timestamp_ntz, cond boolean")


@pytest.mark.parametrize("on_sample", [False, True])
def test_held_alerts(spark, on_sample):
    """Equal to the batch runs with the watermark as their end, the open run included."""
    s = samples(spark)
    parts = [s.where(F.col("id") % 3 == k) for k in range(3)]
    out = M.run_arrivals(spark, "held", arrivals(parts, M.tick(s, "ts", "10 days")), lambda folder: S.stream_alert_for(
        spark.readStream.schema(s.schema).parquet(folder), "series", "ts", "cond", 1200, "4 days", on_sample))
    runs = alert_runs(s, ["series"], F.col("cond"), 1200, dt.datetime(2024, 1, 20))
    if on_sample:
        runs = runs.where(F.unix_micros(F.col("last_true_ts").cast("timestamp")) - F.unix_micros(F.col("run_start").cast("timestamp")) >= 1_200_000_000)
        runs = runs.withColumn("fire_at", (F.col("run_start").cast("timestamp") + F.expr("INTERVAL 1200 SECONDS")).cast("timestamp_ntz"))
    else:
        assert not runs.where("run_end is null and fired").isEmpty()
        runs = runs.where("fired")
    want = sorted((r.series, r.run_start, r.fire_at) for r in runs.collect())
    assert sorted((r.series, r.run_start, r.fire_at) for r in out.collect()) == want and len(want) > 10


def test_alert_fires_without_a_further_sample(spark):
    s = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1, 10), True), (2, "b", dt.datetime(2024, 1, 1, 12), False),
                               (3, None, None, True)], "id long, series string, ts timestamp_ntz, cond boolean")
    out = M.run_arrivals(spark, "single", arrivals([s]), lambda folder: S.stream_alert_for(
        spark.readStream.schema(s.schema).parquet(folder), "series", "ts", "cond", 3600))
    assert [tuple(r) for r in out.collect()] == [("a", dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11))]


def test_heartbeat_by_clock_when_all_are_silent(spark):
    s = samples(spark)
    d = tempfile.mkdtemp(dir=os.environ.get("TMPDIR", "/tmp"))
    M.land(s, f"{d}/in", 2)
    stream = spark.readStream.schema(s.schema).parquet(f"{d}/in")
    out = M.run_until_quiet(S.stream_heartbeat(stream, "series", "ts", "1 second", by_clock=True), "quiet", 120)
    want = {r.series: r.last for r in s.groupBy("series").agg(F.max("ts").alias("last")).collect()}
    assert {r.series: r.last_ts for r in out.collect()} == want and out.count() == 4  # each once


class Stopped(Exception):
    pass


def failing(write, at):
    """``write``, which fails once, after it has written epoch ``at`` and before Spark commits it."""
    failed = []

    def run(batch, epoch, out):
        write(batch, epoch, out)
        if epoch == at and not failed:
            failed.append(epoch)
            raise Stopped()
    return run


def restarted(spark, name, rows, write, at=1):
    """Three batches of ``rows``, the second of which fails after its write; started again."""
    base = M.scratch_path(spark, name)
    for k in range(3):
        M.land(rows.where(F.col("id") % 3 == k), f"{base}/in", 1)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    once = failing(write, at)
    with pytest.raises(Exception, match="Stopped"):
        M.drain(stream, base, foreach_batch=once)
    M.drain(stream, base, foreach_batch=once)
    return M.results(spark, base, rows.schema)


def test_a_repeated_epoch_counts_once(spark):
    rows = spark.createDataFrame([(i, float(i % 40), dt.datetime(2024, 1, 1 + i % 3)) for i in range(300)], "id long, x double, ts timestamp_ntz")
    edges = spark.createDataFrame([("x", [10.0, 20.0, 30.0])], "column_name string, _edges array<double>")
    got = restarted(spark, "drift_again", rows, drift_counts_writer(edges, ["x"], "ts"))
    counts = {(r.day, r.bin): r.n for r in got.groupBy("day", "bin").agg(F.sum("n").alias("n")).collect()}
    want = rows.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.expr("int(x > 10) + int(x > 20) + int(x > 30)").alias("bin")).groupBy("day", "bin").count()
    assert counts == {(r.day, r.bin): r["count"] for r in want.collect()} and got.select("epoch").distinct().count() == 3


def test_decisions_logged_once(spark):
    rows = spark.createDataFrame([(i, float(i % 7 - 1)) for i in range(90)], "id long, x double")
    bad = M.scratch_path(spark, "bad")
    contract = Contract("req", (Field("id", T.LongType()), Field("x", T.DoubleType(), ge=0.0)))
    log = restarted(spark, "decide_again", rows, decisions_writer(contract, F.col("x") / 10, 0.3, "id", bad))
    assert sorted((int(r.request_id), r.score, r.decision) for r in log.collect()) == [
        (i, (i % 7 - 1) / 10, "flag" if (i % 7 - 1) / 10 >= 0.3 else "pass") for i in range(90) if i % 7]
    assert sorted(r.id for r in spark.read.parquet(bad).collect()) == [i for i in range(90) if i % 7 == 0]


def test_log_of_growing_day_files(spark):
    """Twelve or more files in three arrivals, old days growing, two restarts."""
    from chronotab.plans import q_stream as Q
    log = Q.log_records(spark, SF)
    seen = []

    def build(folder):
        seen.append(len(Q.log_stream(spark, folder).sparkSession.read.json(f"{folder}/log").inputFiles()))
        return M.stream_dedup(Q.log_stream(spark, folder).select("request_id", "ts", "day", "domain"), "request_id", "ts", "2 days")
    out = M.run_arrivals(spark, "grow", Q.log_arrivals(log), build)
    assert seen[0] >= 10 and seen == sorted(set(seen))
    assert out.select("request_id").exceptAll(log.select("request_id").distinct()).isEmpty()
    assert out.count() == log.select("request_id").distinct().count()
    assert out.where("day <> date_format(ts, 'yyyy-MM-dd') or domain <> 'events'").isEmpty()


def test_cards_of_a_slot_are_taken_together_and_kept_apart():
    import pandas as pd
    rng = random.Random(4)
    past = pd.DataFrame([(f"+{k % 5}", rng.randrange(40) * 10**11, rng.choice([S.ABSENT, 12500, 31000]), rng.choice(["a", "b", None]), 30 * 10**6, -90 * 10**6)
                         for k in range(200)], columns=S.HISTORY)
    now = pd.DataFrame([(f"+{k % 6}", rng.randrange(40) * 10**11, rng.choice(["a", "b", None]), float(k)) for k in range(60)], columns=["card", "t", "cat", "amt"])
    together = S.card_features(past, now, 25 * 10**11)
    for card, rows in now.groupby("card"):
        pd.testing.assert_frame_equal(together.loc[rows.index], S.card_features(past[past["card"] == card], rows, 25 * 10**11))
    assert together["CC_CATEGORY_TXN_COUNT_30D"].max() > 2
