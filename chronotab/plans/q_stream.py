"""Registered stream twins: each runs a Structured Streaming query over a driver table with
``availableNow`` into Parquet and returns what it wrote (M1-M10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotab.operators.contracts import Contract, Field
from chronotab.operators.windows import FEATURE_COLUMNS
from chronotab.plans import driver as D
from chronotab.plans.catalog import QUERIES, ORACLES, DOCS
from chronotab.plans.q_events import event_sql
from chronotab.plans.q_monitor import edges_sql
from chronotab.plans.sqlparts import split_case
from chronotab.session import prepare_session
from chronotab.sources.predlog import LOG_SCHEMA, write_prediction_log
from chronotab.sources.tables import Tables
from chronotab.streaming import core as M
from chronotab.streaming import stateful as S
from chronotab.streaming.batches import decisions_writer, drift_counts_writer


def register_stream(name: str, sql: str | None, ids: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_session(spark)
            return fn(spark, sf_dir)
        run.__doc__ = f"[{ids}] {fn.__doc__ or ''}"
        QUERIES[name] = run
        DOCS[name] = ids
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# Events come a few hours out of order, in three arrivals cut at these times, and
# every 97th comes with the last one, however old it is.
CUTS = ("2024-01-11", "2024-01-21")
OUT_OF_ORDER_HOURS = 24
LATE_EVERY, LATE_AT = 97, 5
DELAY_DAYS = 2
DELAY = f"{DELAY_DAYS} days"


def arrival(key: str, ts: str) -> Column:
    """Which arrival an event comes with: 0, 1, 2."""
    comes = F.col(ts).cast("timestamp") + F.make_dt_interval(hours=(F.col(key) % OUT_OF_ORDER_HOURS).cast("int"))
    return sum(((comes >= F.to_timestamp(F.lit(c))).cast("int") for c in CUTS), F.lit(0))


def arrival_sql(key: str, ts: str) -> str:
    comes = f"{ts} + to_hours(CAST({key} % {OUT_OF_ORDER_HOURS} AS BIGINT))"
    return " + ".join(f"CASE WHEN {comes} >= TIMESTAMP '{c}' THEN 1 ELSE 0 END" for c in CUTS)


def arrivals(df: DataFrame, when: Column, ts: str | None = None, later: str = "100 days") -> list:
    """What ``run_arrivals`` takes: the parts of ``df`` by ``when``, four files each, and, with ``ts``,
    a last tick that closes the stream."""
    parts = [lambda folder, k=k: M.land(df.where(when == k), folder) for k in range(len(CUTS) + 1)]
    return parts + ([lambda folder: M.land(M.tick(df, ts, later), folder, 1)] if ts else [])


# The features of the feature table that a stream computes from the card's history, in its order.
HISTORY_FEATURES = [c for c in FEATURE_COLUMNS if c not in ("DISTANCE_FROM_HOME_KM", "TRANSACTION_HOUR", "TRANSACTION_DAYOFWEEK")]
STREAM_FEATURES = ["trans_num", "card", "trans_ts", "late", "CC_AMT_STD_30D", *HISTORY_FEATURES]

HELD_BACK = f"trans_num % {LATE_EVERY} = {LATE_AT}"
# the watermark when the last arrival comes: behind the newest event of the first two
BEHIND = f"""({HELD_BACK} AND epoch_ms(trans_ts) < (SELECT epoch_ms(max(ts)) - {DELAY_DAYS * 86_400_000} FROM events
  WHERE event_id % {LATE_EVERY} <> {LATE_AT} AND {arrival_sql('event_id', 'ts')} < {len(CUTS)}))"""


@register_stream("stream_event_features", f"""SELECT trans_num, card, trans_ts, false AS late, {', '.join(STREAM_FEATURES[4:])}
FROM ({event_sql(f"NOT {BEHIND}")})
UNION ALL SELECT trans_num, card, trans_ts, true, {', '.join('NULL' for _ in STREAM_FEATURES[4:])}
FROM ({D.CARD_SQL}) WHERE {BEHIND}""", "M3 M4 (batch twin: E12)")
def q_stream_features(spark, sf_dir):
    """Card-history features of events that arrive out of order, in three arrivals of four files with
    the stream restarted after each; every 97th event comes with the last one, and those behind the
    watermark by then come out flagged late. Equal to the batch features of the others."""
    tx = D.card_transactions(Tables(spark, sf_dir))
    when = F.when(F.expr(HELD_BACK), F.lit(len(CUTS))).otherwise(arrival("trans_num", "trans_ts"))
    out = M.run_arrivals(spark, "event_features", arrivals(tx, when, "trans_ts"), lambda folder: S.stream_event_features(
        spark.readStream.schema(tx.schema).parquet(folder), delay=DELAY))
    return out.withColumn("DISTANCE_FROM_USUAL_MERCHANT_KM", F.round("DISTANCE_FROM_USUAL_MERCHANT_KM", 6)) \
        .select(*STREAM_FEATURES)


LOG_DOMAIN = "events"


def log_records(spark, sf_dir):
    """The prediction log's records with their domain."""
    return D.prediction_log(Tables(spark, sf_dir)).select("*", F.lit(LOG_DOMAIN).alias("domain"))


def log_arrivals(log: DataFrame) -> list:
    """The log's day files, which grow in three arrivals: an old day gets new files with a later one."""
    marked = log.withColumn("_when", arrival("_line", "timestamp")).withColumn("timestamp", F.col("timestamp").cast("string"))
    return [lambda folder, k=k: write_prediction_log(marked.where(F.col("_when") == k).drop("_when", "_line", "_copy"), f"{folder}/log")
            for k in range(len(CUTS) + 1)]


def log_stream(spark, folder: str) -> DataFrame:
    return M.stream_prediction_log(spark, f"{folder}/log", LOG_SCHEMA)


@register_stream("stream_log_dedup", f"SELECT DISTINCT request_id FROM ({D.LOG_SQL})", "M1 M2")
def q_log_dedup(spark, sf_dir):
    """Request ids of a log whose day files grow between three runs of the stream, each once."""
    out = M.run_arrivals(spark, "log_dedup", log_arrivals(log_records(spark, sf_dir)), lambda folder: M.stream_dedup(
        log_stream(spark, folder).select("request_id", "ts"), "request_id", "ts", DELAY))
    return out.select("request_id")


@register_stream("stream_log_counter", f"""WITH l AS ({D.LOG_SQL})
SELECT * FROM (SELECT CAST(time_bucket(INTERVAL 1 HOUR, timestamp) AS TIMESTAMP) AS window_start, decision,
  CAST(count(*) AS BIGINT) AS n FROM l GROUP BY ALL)
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(timestamp) FROM l) - INTERVAL {DELAY_DAYS} DAY""", "M1 M6 L7")
def q_log_counter(spark, sf_dir):
    """Predictions per hour and decision of the growing log; hours that the watermark has passed."""
    out = M.run_arrivals(spark, "log_counter", log_arrivals(log_records(spark, sf_dir)), lambda folder: M.stream_counters(
        log_stream(spark, folder).select("decision", "ts"), "ts", ["decision"], "1 hour", delay=DELAY))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "decision", "n")


@register_stream("stream_dedup", f"SELECT DISTINCT request_id FROM ({D.LOG_SQL})", "M2")
def q_stream_dedup(spark, sf_dir):
    """Request ids of the log stream after dropping duplicates within the watermark."""
    log = D.prediction_log(M.StreamTables(spark, sf_dir)).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    out = M.run_to_table(M.stream_dedup(log, "request_id", "timestamp", "2 days"), "dedup")
    return out.select("request_id")


@register_stream("stream_prediction_counter", f"""WITH l AS ({D.LOG_SQL})
SELECT * FROM (SELECT CAST(time_bucket(INTERVAL 1 HOUR, timestamp) AS TIMESTAMP) AS window_start, decision,
  CAST(count(*) AS BIGINT) AS n FROM l GROUP BY ALL)
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(timestamp) FROM l) - INTERVAL 1 HOUR""", "M6 L7")
def q_stream_counter(spark, sf_dir):
    """Predictions per hour and decision, appended once the watermark (an hour behind the
    newest) has passed the hour; the state holds open hours only."""
    log = D.prediction_log(M.StreamTables(spark, sf_dir)).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    out = M.run_to_table(M.stream_counters(log, "timestamp", ["decision"], "1 hour", delay="1 hour"), "counter")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "decision", "n")


@register_stream("stream_outcome_join", f"""WITH p AS (SELECT request_id, entity_id, timestamp FROM ({D.LOG_SQL}) WHERE copy = 1),
o AS (SELECT CAST(event_id AS VARCHAR) AS entity_id, ts + to_hours(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS outcome_ts,
  CAST(event_type = 'error' AS INTEGER) AS outcome FROM events)
SELECT p.request_id, p.entity_id, p.timestamp, o.outcome_ts, o.outcome FROM p JOIN o
  ON p.entity_id = o.entity_id AND o.outcome_ts >= p.timestamp AND o.outcome_ts <= p.timestamp + INTERVAL 72 HOUR""",
                 "M5 C8")
def q_stream_join(spark, sf_dir):
    """Durable-copy predictions joined in-stream to outcomes that arrive within 72 hours."""
    st = M.StreamTables(spark, sf_dir)
    log = D.prediction_log(st).where("_copy = 1").select(
        "request_id", "entity_id", F.col("timestamp").cast("timestamp").alias("timestamp"))
    ev = st.events
    outcomes = ev.select(F.col("event_id").cast("string").alias("entity_id"),
                         (F.col("ts").cast("timestamp") + F.make_dt_interval(hours=F.get_json_object("props", "$.k").cast("int")))
                         .alias("outcome_ts"), (F.col("event_type") == "error").cast("int").alias("outcome"))
    j = M.stream_outcome_join(log, outcomes, "entity_id", "timestamp", "outcome_ts", "72 hours", "4 days", "4 days")
    out = M.run_to_table(j, "outcome_join")
    return out.select("request_id", "entity_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                      F.col("outcome_ts").cast("timestamp_ntz").alias("outcome_ts"), "outcome")


@register_stream("stream_log_outcomes", f"""WITH p AS (SELECT request_id, entity_id, timestamp FROM ({D.LOG_SQL}) WHERE copy = 1),
o AS (SELECT CAST(event_id AS VARCHAR) AS entity_id, ts + to_hours(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS outcome_ts,
  CAST(event_type = 'error' AS INTEGER) AS outcome FROM events)
SELECT p.request_id, p.entity_id, p.timestamp, o.outcome_ts, o.outcome FROM p JOIN o
  ON p.entity_id = o.entity_id AND o.outcome_ts >= p.timestamp AND o.outcome_ts <= p.timestamp + INTERVAL 72 HOUR""",
                 "M1 M5 C8")
def q_log_outcomes(spark, sf_dir):
    """The durable copy of the growing log joined to outcomes that arrive beside it, within 72 hours."""
    log = log_records(spark, sf_dir)
    ev = Tables(spark, sf_dir).events
    later = F.make_dt_interval(hours=F.get_json_object("props", "$.k").cast("int"))
    known = ev.select(F.col("event_id").cast("string").alias("entity_id"), (F.col("ts").cast("timestamp") + later).alias("outcome_ts"),
                      (F.col("event_type") == "error").cast("int").alias("outcome"), arrival("event_id", "ts").alias("_when"))
    logs = log_arrivals(log)

    def arrive(k: int):
        def add(folder: str) -> None:
            logs[k](folder)
            M.land(known.where(F.col("_when") == k).drop("_when"), f"{folder}/outcomes")
        return add

    def build(folder: str) -> DataFrame:
        made = log_stream(spark, folder).where("client = 'blob'").select("request_id", "entity_id", "ts")
        outcomes = spark.readStream.schema(known.drop("_when").schema).parquet(f"{folder}/outcomes")
        return M.stream_outcome_join(made, outcomes, "entity_id", "ts", "outcome_ts", "72 hours", "6 days", "6 days")

    out = M.run_arrivals(spark, "log_outcomes", [arrive(k) for k in range(len(CUTS) + 1)], build)
    return out.select("request_id", "entity_id", F.col("ts").cast("timestamp_ntz").alias("timestamp"),
                      F.col("outcome_ts").cast("timestamp_ntz").alias("outcome_ts"), "outcome")


ALERT_SQL = """WITH s AS (SELECT user_id, ts, coalesce(value > 50.0, false) AS cond,
  sum(CASE WHEN coalesce(value > 50.0, false) THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, coalesce(value > 50.0, false)
    ROWS UNBOUNDED PRECEDING) AS nf FROM events)
SELECT CAST(user_id AS VARCHAR) AS series, min(ts) AS run_start, min(ts) + INTERVAL 1 HOUR AS fire_at
FROM s WHERE cond GROUP BY user_id, nf HAVING max(ts) - min(ts) >= INTERVAL 1 HOUR"""


def alert_stream(spark, sf_dir: str, name: str, on_sample: bool) -> DataFrame:
    ev = Tables(spark, sf_dir).events.select("event_id", F.col("user_id").alias("series"), "ts", (F.col("value") > 50.0).alias("cond"))
    return M.run_arrivals(spark, name, arrivals(ev, arrival("event_id", "ts"), "ts"), lambda folder: S.stream_alert_for(
        spark.readStream.schema(ev.schema).parquet(folder), "series", "ts", "cond", 3600, DELAY, on_sample))


@register_stream("stream_alert_for", ALERT_SQL, "M9 (batch form: L8)")
def q_stream_alert(spark, sf_dir):
    """Per user, the alert fires once a sample shows the gauge above 50 for an hour; samples arrive
    out of order, in three arrivals."""
    return alert_stream(spark, sf_dir, "alert_for", True)


HELD_SQL = """WITH s AS (SELECT user_id, ts, coalesce(value > 50.0, false) AS cond,
  sum(CASE WHEN coalesce(value > 50.0, false) THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, coalesce(value > 50.0, false)
    ROWS UNBOUNDED PRECEDING) AS nf FROM events),
runs AS (SELECT user_id, nf, min(ts) AS run_start FROM s WHERE cond GROUP BY user_id, nf),
ends AS (SELECT user_id, nf - 1 AS nf, min(ts) AS run_end FROM s WHERE NOT cond GROUP BY user_id, nf)
SELECT CAST(user_id AS VARCHAR) AS series, run_start, run_start + INTERVAL 1 HOUR AS fire_at
FROM runs LEFT JOIN ends USING (user_id, nf) WHERE run_end IS NULL OR run_end - run_start >= INTERVAL 1 HOUR"""


@register_stream("stream_alert_held", HELD_SQL, "M9 (batch form: L8)")
def q_stream_held(spark, sf_dir):
    """Per user, the alert fires an hour after the gauge went above 50 unless it came down by then,
    also for the run that is still open when the samples end."""
    return alert_stream(spark, sf_dir, "alert_held", False)


@register_stream("stream_heartbeat", """SELECT CAST(user_id AS VARCHAR) AS series, 'stale' AS status, max(ts) AS last_ts
FROM events GROUP BY user_id HAVING max(ts) + INTERVAL 2 DAY < (SELECT max(ts) FROM events)""", "M8 A13")
def q_stream_heartbeat(spark, sf_dir):
    """Series (users) reported stale once event time passes their last sample by two days."""
    ev = M.StreamTables(spark, sf_dir).events
    return M.run_to_table(S.stream_heartbeat(ev, "user_id", "ts", "2 days"), "heartbeat")


@register_stream("stream_heartbeat_clock", """SELECT CAST(user_id AS VARCHAR) AS series, 'stale' AS status, max(ts) AS last_ts
FROM events GROUP BY user_id""", "M8")
def q_stream_heartbeat_clock(spark, sf_dir):
    """Every series is reported stale once when all have fallen silent, by the machine's clock."""
    ev = M.StreamTables(spark, sf_dir).events
    return M.run_until_quiet(S.stream_heartbeat(ev, "user_id", "ts", "2 seconds", by_clock=True), "heartbeat_clock")


TRANSACTION = Contract("scored_event", (
    Field("event_id", T.LongType()), Field("value", T.DoubleType(), ge=1.0, le=400.0),
    Field("event_type", T.StringType(), isin=("view", "click", "purchase", "signup"))))


@register_stream("stream_decisions", f"""SELECT CAST(event_id AS VARCHAR) AS request_id, ok,
  CASE WHEN ok THEN value / 500.0 END AS score, CASE WHEN ok THEN CASE WHEN value / 500.0 >= {D.SCORE_THRESHOLD} THEN 'flag' ELSE 'pass' END END AS decision
FROM (SELECT *, coalesce(value BETWEEN 1.0 AND 400.0, false) AND coalesce(event_type IN ('view', 'click', 'purchase', 'signup'), false) AS ok FROM events)""", "M10 B15 G7")
def q_stream_decisions(spark, sf_dir):
    """Events as scoring requests in three arrivals: rows that break the contract are quarantined,
    the others scored, decided and logged; the log and the quarantine are returned together."""
    ev = Tables(spark, sf_dir).events.select("event_id", "value", "event_type", arrival("event_id", "ts").alias("_when"))
    rows = ev.drop("_when")
    bad = M.scratch_path(spark, "quarantine")
    write = decisions_writer(TRANSACTION, F.col("value") / F.lit(500.0), D.SCORE_THRESHOLD, "event_id", bad)
    parts = [lambda folder, k=k: M.land(ev.where(F.col("_when") == k).drop("_when"), folder) for k in range(len(CUTS) + 1)]
    log = M.run_arrivals(spark, "decisions", parts, lambda folder: spark.readStream.schema(rows.schema).parquet(folder), foreach_batch=write)
    kept = log.select("request_id", F.lit(True).alias("ok"), "score", "decision")
    refused = spark.read.parquet(bad).select(F.col("event_id").cast("string").alias("request_id"), F.lit(False).alias("ok"),
                                             F.lit(None).cast("double").alias("score"), F.lit(None).cast("string").alias("decision"))
    return kept.unionByName(refused)


DRIFT_COUNTS_SQL = f"""WITH ref AS (SELECT 'value' AS column_name, value FROM events
  WHERE {split_case('ts', D.EVENTS_SPLIT)} = 'train' AND value IS NOT NULL), {edges_sql()}
x AS (SELECT strftime(ts, '%Y-%m-%d') AS day, (SELECT count(*) FROM edges e WHERE e.v < i.value) AS bin FROM events i WHERE value IS NOT NULL)
SELECT day, 'value' AS column_name, CAST(bin AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n, 0 AS epoch FROM x GROUP BY day, bin"""


@register_stream("stream_drift_counts", DRIFT_COUNTS_SQL, "M7 K3")
def q_stream_drift(spark, sf_dir):
    """Per-day bin counts of the value feature against reference deciles, accumulated by the
    stream; PSI per day is a batch job over these counts."""
    from chronotab.operators.order import exact_quantiles
    from chronotab.operators.splits import split_label
    ref = spark.read.parquet(f"{sf_dir}/events.parquet").where(split_label("ts", D.EVENTS_SPLIT) == "train")
    long = ref.select(F.lit("value").alias("column_name"), F.col("value").alias("value"))
    edges = exact_quantiles(long, "value", [i / 10 for i in range(1, 10)], by=["column_name"]).groupBy(
        "column_name").agg(F.array_sort(F.array_distinct(F.collect_list("value"))).alias("_edges"))
    ev = M.StreamTables(spark, sf_dir).events
    return M.run_to_table(ev, "drift", foreach_batch=drift_counts_writer(edges, ["value"], "ts"))


__all__ = ["T"]
