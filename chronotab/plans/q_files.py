"""Registered file round trips: every source and sink writes into a new folder below the shared
checkpoint folder and reads back; the oracle is what the files must hold (A1-A14, C13, K16, K17)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotab.operators import outcomes as O
from chronotab.operators.contracts import violations
from chronotab.plans import driver as D
from chronotab.plans.catalog import register
from chronotab.plans.q_asof import FEATURES_SQL
from chronotab.plans.q_monitor import OUTCOME_SQL, RUN_SECONDS, outcomes
from chronotab.plans.q_nested import event_requests
from chronotab.plans.sqlparts import split_case
from chronotab.plans.table_contracts import TRANSACTION
from chronotab.session import ensure_checkpoint_dir
from chronotab.sources import predlog as P
from chronotab.sources import tables as S

LOG_SINCE = dt.datetime(2024, 1, 10)


def folder(t, name: str) -> str:
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/files/{name}-{uuid.uuid4().hex}"


CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()), T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DoubleType()), T.StructField("c_mktsegment", T.StringType())])


@register("csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer", "A1 B13")
def q_csv(t):
    """`customer` written as CSV and read with its declared types."""
    path = folder(t, "csv")
    t.customer.select(*CUSTOMER_SCHEMA.names).write.option("header", True).csv(path)
    return S.read_csv_contract(t.spark, path, CUSTOMER_SCHEMA)


@register("csv_scan_drop_index", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer", "A2")
def q_csv_index(t):
    """The same with an unnamed leading index column in the file, which is dropped."""
    path = folder(t, "csv-index")
    (t.customer.select(F.monotonically_increasing_id().alias(" "), *CUSTOMER_SCHEMA.names)
     .write.option("header", True).csv(path))
    return S.read_csv_contract(t.spark, path, CUSTOMER_SCHEMA, drop_leading_index=True)


PRUNED = ["c_custkey", "ORDERS_COUNT", "LINEITEM_EXTENDEDPRICE_SUM"]


@register("feature_table_pruned_read", f"SELECT {', '.join(PRUNED)} FROM ({FEATURES_SQL}) WHERE SPLIT = 'test'", "A3 A4")
def q_features(t):
    """The feature table written by split; three columns of the test split read back."""
    path = folder(t, "features")
    S.write_features(D.asof_customer_features(t), path)
    return S.read_features(t.spark, path, PRUNED, "test")


@register("filtered_scan", """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""", "A5 C6")
def q_filtered(t):
    """Line items of the orders in status P."""
    ids = t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return S.filtered_scan(t.lineitem, ids, "l_orderkey").select("l_orderkey", "l_linenumber", "l_extendedprice")


@register("prediction_log_files", f"""WITH c AS (SELECT *, row_number() OVER (PARTITION BY request_id
  ORDER BY copy, CAST(timestamp AS DATE) DESC, timestamp DESC, line DESC) AS rn
  FROM ({D.LOG_SQL}) WHERE timestamp >= TIMESTAMP '{LOG_SINCE}')
SELECT request_id, entity_id, client, model_version, score, decision, traffic_source FROM c WHERE rn = 1""", "A6 A7 C13 T10")
def q_log_files(t):
    """Two copies of the log written as day files and read from a day on: the first copy wins
    per request, the last record inside a copy."""
    log = D.prediction_log(t).withColumns({
        "domain": F.lit("events"), "timestamp": F.date_format(F.col("timestamp").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")})
    paths = []
    for copy in (0, 1):
        paths.append(folder(t, f"log{copy}"))
        P.write_prediction_log(log.where(F.col("_copy") == copy).drop("_copy", "_line"), paths[-1])
    got = P.read_prediction_log(t.spark, paths, "events", LOG_SINCE)
    return got.select("request_id", "entity_id", "client", "model_version", "score", "decision", "traffic_source")


@register("requests_file", f"""WITH tx AS ({D.CARD_SQL}), s AS (SELECT trans_num FROM tx WHERE {split_case('trans_ts', D.EVENTS_SPLIT)} = 'test')
SELECT a.trans_num, a.card, a.amt, CAST(count(h.trans_num) AS BIGINT) AS n_history
FROM tx a JOIN s USING (trans_num) LEFT JOIN tx h ON h.card = a.card AND h.trans_ts < a.trans_ts
  AND epoch_us(h.trans_ts) >= epoch_us(a.trans_ts) - {30 * 86_400_000_000}
GROUP BY ALL""", "A9 A10 C9")
def q_requests(t):
    """Nested requests written as compressed JSON lines and read with their schema."""
    req, path = event_requests(t), folder(t, "requests")
    P.write_requests(req, path)
    got = P.read_requests(t.spark, path, req.schema)
    return got.groupBy("trans_num").agg(F.max("card").alias("card"), F.max("transaction.amt").alias("amt"),
                                        F.sum(F.size("history")).cast("bigint").alias("n_history"))


@register("outcomes_file", OUTCOME_SQL, "A11 C7")
def q_outcomes(t):
    """Outcomes written as CSV and read back, the id a string."""
    path = folder(t, "outcomes")
    P.write_outcomes(outcomes(t), path)
    return P.read_outcomes(t.spark, path)


@register("gauge_replace_and_merge", f"""SELECT 'a' AS job, 'size' AS name, event_type AS label, CAST(count(*) AS DOUBLE) AS value
FROM events GROUP BY event_type
UNION ALL SELECT 'a', 'last_run', NULL, {RUN_SECONDS}.0::DOUBLE
UNION ALL SELECT 'b', 'size', event_type, CAST(count(*) AS DOUBLE) FROM events WHERE value > 50 GROUP BY event_type""", "A12 A13")
def q_gauges(t):
    """A job's second push replaces its own group and leaves the other job's; a heartbeat is
    merged in."""
    def group(job, events, ts):
        own = events.groupBy("event_type").agg(F.count(F.lit(1)).cast("double").alias("value"))
        return own.select(F.lit(job).alias("job"), F.lit("events").alias("domain"), F.lit("size").alias("name"),
                          F.create_map(F.lit("kind"), F.col("event_type")).alias("labels"),
                          F.lit(ts).cast("timestamp").alias("ts"), "value")

    path = folder(t, "gauges")
    P.replace_gauges(group("a", t.events.where("value > 400"), "2024-01-01"), path)
    P.replace_gauges(group("b", t.events.where("value > 50"), "2024-01-01"), path)
    P.replace_gauges(group("a", t.events, "2024-01-02"), path)
    columns = ["job", "domain", "name", "labels", "ts", "value"]
    beat = t.spark.range(1).select(
        F.lit("a").alias("job"), F.lit("events").alias("domain"), F.lit("last_run").alias("name"),
        F.create_map(F.lit("domain"), F.lit("events")).alias("labels"), F.lit("2024-01-03").cast("timestamp").alias("ts"),
        F.lit(float(RUN_SECONDS)).alias("value"))
    out = P.merge_gauge(t.spark.read.parquet(path).select(columns), beat.select(columns))
    return out.select("job", "name", F.element_at("labels", "kind").alias("label"), "value")


@register("gauge_pushes", f"""SELECT 'a' AS job, 'size' AS name, event_type AS label, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY event_type
UNION ALL SELECT 'a', 'last_run', 'x', {RUN_SECONDS}.0::DOUBLE
UNION ALL SELECT 'a', 'last_run', 'y', {RUN_SECONDS}.0::DOUBLE + 1
UNION ALL SELECT 'b', 'size', 'view', -1.0
UNION ALL SELECT 'b', 'size', event_type, CAST(count(*) AS DOUBLE) FROM events WHERE value > 50 AND event_type <> 'view' GROUP BY event_type""", "A12 A13")
def q_pushes(t):
    """Groups replaced, merged into by two pushes at a time, and emptied, read as one moment's state."""
    root = folder(t, "pushes")

    def sample(job, name, label, ts, value):
        return t.spark.range(1).select(F.lit(job).alias("job"), F.lit("events").alias("domain"), F.lit(name).alias("name"),
                                       F.create_map(F.lit("kind"), F.lit(label)).alias("labels"), F.lit(ts).cast("timestamp").alias("ts"), F.lit(float(value)).alias("value"))

    def group(job, events, ts):
        own = events.groupBy("event_type").agg(F.count(F.lit(1)).cast("double").alias("value"))
        return own.select(F.lit(job).alias("job"), F.lit("events").alias("domain"), F.lit("size").alias("name"),
                          F.create_map(F.lit("kind"), F.col("event_type")).alias("labels"), F.lit(ts).cast("timestamp").alias("ts"), "value")

    a, b, c = ("a", "events"), ("b", "events"), ("c", "events")
    P.push_gauges(group("a", t.events.where("value > 400"), "2024-01-01").unionByName(sample("a", "old", "x", "2024-01-01", 1)), root, [a], at=1)
    P.push_gauges(group("b", t.events.where("value > 50"), "2024-01-01").unionByName(group("c", t.events, "2024-01-01")), root, [b, c], at=2)
    P.push_gauges(group("a", t.events, "2024-01-02"), root, [a], at=3)
    P.push_gauges(sample("a", "last_run", "x", "2024-01-03", RUN_SECONDS), root, [a], "merge", at=4)
    P.push_gauges(sample("a", "last_run", "y", "2024-01-03", RUN_SECONDS + 1), root, [a], "merge", at=4)
    P.push_gauges(sample("b", "size", "view", "2024-01-03", -1), root, [b], "merge", at=5)
    P.push_gauges(group("c", t.events.where("false"), "2024-01-04"), root, [c], at=6)
    return P.read_gauges(t.spark, root).select("job", "name", F.element_at("labels", "kind").alias("label"), "value")


@register("reference_snapshot", f"""SELECT c_custkey, ORDERS_COUNT, 'snapshot' AS source FROM ({FEATURES_SQL}) WHERE SPLIT = 'train' AND IS_MATURE
UNION ALL SELECT c_custkey, ORDERS_COUNT, 'features' FROM ({FEATURES_SQL}) WHERE SPLIT = 'train'""", "A14 F4")
def q_snapshot(t):
    """The population a version was trained on, and the train split for a version without one."""
    features, root = folder(t, "features"), folder(t, "snapshots")
    S.write_features(D.asof_customer_features(t), features)
    P.write_reference_snapshot(S.read_features(t.spark, features, split="train").where("IS_MATURE"), root, "3")
    out = None
    for version, source in (("3", "snapshot"), ("4", "features")):
        own = P.read_reference_snapshot(t.spark, root, version, features).select("c_custkey", "ORDERS_COUNT", F.lit(source).alias("source"))
        out = own if out is None else out.unionByName(own)
    return out


@register("send_summary", """SELECT event_type AS target, CAST(count(*) AS BIGINT) AS sent,
  CAST(count(*) FILTER (WHERE value > 200) AS BIGINT) AS failed,
  count(*) FILTER (WHERE value > 200) > count(*) * 0.1::DOUBLE AS run_failed
FROM events GROUP BY event_type""", "K16")
def q_send(t):
    """Per target (any, null included), requests sent and failed, and whether the run fails."""
    sent = t.events.select(F.col("event_type").alias("target"), F.when(F.col("value") > 200, 503).otherwise(200).alias("status"))
    return O.send_summary(sent, by=("target",)).select("target", "sent", "failed", "run_failed")


def transaction_rows(t):
    """Transactions in the full contract's shape: what the events do not have is derived from ids;
    every 97th amount is negative and every 89th gender unknown."""
    c = D.card_transactions(t)
    own = {
        "trans_date_trans_time": F.date_format("trans_ts", "yyyy-MM-dd HH:mm:ss"), "cc_num": F.col("card"),
        "merchant": F.concat(F.lit("m"), (F.col("trans_num") % 50).cast("string")), "category": F.col("category"),
        "amt": F.when(F.col("trans_num") % 97 == 0, -1.0).otherwise(F.abs("amt")), "gender": F.when(F.col("trans_num") % 89 == 0, "?").otherwise("F"),
        "zip": F.col("card") % 1000, "lat": F.col("lat"), "long": F.col("long"), "city_pop": F.col("card") * 10,
        "trans_num": F.col("trans_num").cast("string"), "unix_time": F.unix_seconds(F.col("trans_ts").cast("timestamp")),
        "merch_lat": F.col("merch_lat"), "merch_long": F.col("merch_long"), "is_fraud": F.col("is_fraud").cast("long")}
    return c.select(*[own.get(f, F.lit(f)).alias(f) for f in TRANSACTION.columns])


@register("transaction_contract_file", """SELECT 'amt' AS column_name, 'greater_than_or_equal' AS "check", CAST(count(*) AS BIGINT) AS n_failed
FROM events WHERE event_id % 97 = 0
UNION ALL SELECT 'gender', 'in_set', CAST(count(*) AS BIGINT) FROM events WHERE event_id % 89 = 0""", "A2 G1 G2 G3 G4 G5 G7")
def q_transaction_contract(t):
    """Transactions written as CSV with an index column, read by their contract and checked."""
    path = folder(t, "transactions")
    transaction_rows(t).select(F.monotonically_increasing_id().alias(" "), *TRANSACTION.columns).write.option("header", True).csv(path)
    rows = S.read_csv_contract(t.spark, path, TRANSACTION.schema, drop_leading_index=True)
    return violations(rows, TRANSACTION).select("column_name", "check", "n_failed")
