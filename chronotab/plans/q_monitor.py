"""Registered monitoring queries: events as a prediction log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotab.config import DriftConfig, PerformanceConfig
from chronotab.functions.scalar import traffic_filter
from chronotab.functions.timecols import ts_literal
from chronotab.operators import drift as K
from chronotab.operators import outcomes as O
from chronotab.operators.splits import split_label
from chronotab.plans import driver as D
from chronotab.plans.catalog import register
from chronotab.plans.sqlparts import split_case
from chronotab.sources.predlog import dedup_log, flatten_features

AS_OF = dt.datetime.fromisoformat(D.LOG_AS_OF)
DRIFT = DriftConfig(min_current=500, window_days=7)
SINCE = AS_OF - dt.timedelta(days=DRIFT.window_days)
PERF = PerformanceConfig(window_days=10, delay_days=2, min_labeled=100, min_positives=10)
PRODUCTION = "v2"
REFERENCE_ROC_AUC, REFERENCE_PR_AUC = 0.5, 0.2
REF_SCHEMA = T.StructType([T.StructField("value", T.DoubleType()), T.StructField("k", T.LongType()),
                           T.StructField("event_type", T.StringType())])


def deduped(t):
    """Both copies merged and deduplicated (materialised once per query: several branches read
    it)."""
    return t.derived("deduped_log", lambda: dedup_log(D.prediction_log(t), order_cols=["timestamp", "_line"]))


def current_window(t):
    """K1 + A8: deduped records since the window start, production version, no test traffic,
    flattened to typed feature columns plus the score."""
    def build():
        log = deduped(t).where((F.col("timestamp") >= ts_literal(SINCE)) &
                               traffic_filter("model_version", "traffic_source", PRODUCTION))
        return flatten_features(log, REF_SCHEMA.add("score", T.DoubleType()))
    return t.derived("current_window", build)


def reference(t):
    """The train-split population the production model was fit on (the reference snapshot)."""
    def build():
        e = t.events.where(split_label("ts", D.EVENTS_SPLIT) == "train")
        return e.select(F.col("value"), F.get_json_object("props", "$.k").cast("bigint").alias("k"),
                        "event_type", (F.col("value") / F.lit(500.0)).alias("score"))
    return t.derived("reference", build)


@register("log_dedup_window", f"""SELECT request_id, entity_id, client, score, model_version, traffic_source, timestamp
FROM ({D.DEDUP_SQL}) WHERE timestamp >= TIMESTAMP '{SINCE.isoformat(sep=' ')}'""", "A7 C13 T10")
def q_log(t):
    """Both log copies merged, first copy wins per request id, last record inside a copy;
    records since the 7-day window start."""
    return deduped(t).where(F.col("timestamp") >= ts_literal(SINCE)).select(
        "request_id", "entity_id", "client", "score", "model_version", "traffic_source", "timestamp")


CURRENT_SQL = f"""SELECT value, k, event_type, score FROM ({D.DEDUP_SQL})
WHERE timestamp >= TIMESTAMP '{SINCE.isoformat(sep=' ')}' AND model_version = '{PRODUCTION}'
  AND coalesce(traffic_source <> 'test', true)"""
REFERENCE_SQL = f"""SELECT value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type,
  value / 500.0 AS score FROM events WHERE {split_case('ts', D.EVENTS_SPLIT)} = 'train'"""


@register("current_window", CURRENT_SQL, "K1 A8 B14 T14 T22")
def q_current(t):
    """Production-version, non-test predictions of the last 7 days with typed features."""
    return current_window(t)


def edges_sql() -> str:
    """CTEs from ``ref`` (column_name, value) to ``edges`` (column_name, v): the deciles."""
    qs = " UNION ALL ".join(f"SELECT {i} AS qi, CAST({(i / 10 * 100.0) / 100.0!r} AS DOUBLE) AS q" for i in range(1, 10))
    return f"""rk AS (SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY value) - 1 AS r,
  count(*) OVER (PARTITION BY column_name) AS T FROM ref),
hq AS (SELECT column_name, max(T) AS T FROM rk GROUP BY column_name),
qq AS (SELECT hq.*, qs.qi, qs.q, CAST(T - 1 AS DOUBLE) * qs.q AS h FROM hq, ({qs}) qs),
ab AS (SELECT qq.column_name, qq.qi, h - floor(h) AS gm,
  max(CASE WHEN r = CAST(floor(h) AS BIGINT) THEN value END) AS a,
  max(CASE WHEN r = least(CAST(floor(h) AS BIGINT) + 1, qq.T - 1) THEN value END) AS b
  FROM qq JOIN rk USING (column_name) GROUP BY ALL),
edges AS (SELECT DISTINCT column_name, CASE WHEN gm >= 0.5 THEN b - (b - a) * (1.0 - gm) ELSE a + (b - a) * gm END AS v FROM ab),"""


def _psi_sql(cols: list[str], numeric: bool) -> str:
    def long(src):
        cast = "DOUBLE" if numeric else "VARCHAR"
        return " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS {cast}) AS value FROM ({src}) "
                                  f"WHERE {c} IS NOT NULL" for c in cols)
    if numeric:
        bins = edges_sql() + """
rb AS (SELECT column_name, (SELECT count(*) FROM edges e WHERE e.column_name = x.column_name AND e.v < x.value) AS bin FROM ref x),
cb AS (SELECT column_name, (SELECT count(*) FROM edges e WHERE e.column_name = x.column_name AND e.v < x.value) AS bin FROM cur x),"""
    else:
        bins = "rb AS (SELECT column_name, value AS bin FROM ref), cb AS (SELECT column_name, value AS bin FROM cur),"
    return f"""WITH ref AS ({long(REFERENCE_SQL)}), cur AS ({long(CURRENT_SQL)}), {bins}
rs AS (SELECT column_name, bin, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY column_name) AS DOUBLE) AS r
  FROM rb GROUP BY column_name, bin),
cs AS (SELECT column_name, bin, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY column_name) AS DOUBLE) AS c
  FROM cb GROUP BY column_name, bin),
j AS (SELECT coalesce(rs.column_name, cs.column_name) AS column_name,
  greatest(coalesce(r, 0.0), CAST(0.0001 AS DOUBLE)) AS r, greatest(coalesce(c, 0.0), CAST(0.0001 AS DOUBLE)) AS c
  FROM rs FULL OUTER JOIN cs ON rs.column_name = cs.column_name AND rs.bin = cs.bin)
SELECT column_name, round(sum((c - r) * ln(c / r)), 12) AS psi, round(sum((c - r) * ln(c / r)), 12) > {DRIFT.psi_threshold} AS drifted
FROM j GROUP BY column_name"""


@register("psi_numeric", _psi_sql(["value", "k"], True), "K3 P7 P8 T8 C12")
def q_psi_num(t):
    """PSI of the numeric features at ten reference-decile bins, all columns in one pass."""
    p = K.psi_numeric(reference(t).drop("score"), current_window(t).drop("score"), ["value", "k"], DRIFT)
    return p.withColumn("drifted", F.col("psi") > F.lit(DRIFT.psi_threshold))


@register("psi_categorical", _psi_sql(["event_type"], False), "K4")
def q_psi_cat(t):
    """PSI of the categorical feature over the union of its levels."""
    p = K.psi_categorical(reference(t).drop("score"), current_window(t).drop("score"), ["event_type"], DRIFT)
    return p.withColumn("drifted", F.col("psi") > F.lit(DRIFT.psi_threshold))


SCORE_PSI_SQL = _psi_sql(["score"], True)


DRIFT_SQL = f"""WITH per AS (SELECT * FROM ({_psi_sql(['value', 'k'], True)}) UNION ALL SELECT * FROM ({_psi_sql(['event_type'], False)})),
sp AS ({SCORE_PSI_SQL}),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_columns, CAST(count(*) FILTER (WHERE drifted) AS BIGINT) AS n_drifted FROM per),
n AS (SELECT (SELECT count(*) FROM ({REFERENCE_SQL})) AS n_reference, (SELECT count(*) FROM ({CURRENT_SQL})) AS n_current),
x AS (SELECT *, n_current >= {DRIFT.min_current} AS ok, CAST(n_drifted AS DOUBLE) / CAST(n_columns AS DOUBLE) AS share
  FROM n CROSS JOIN (SELECT n_columns, n_drifted, psi, drifted FROM s LEFT JOIN sp ON true))
SELECT n_reference, n_current, CASE WHEN ok THEN 'ok' ELSE 'no_data' END AS status,
  CASE WHEN ok THEN n_columns END AS n_columns, CASE WHEN ok THEN n_drifted END AS n_drifted,
  CASE WHEN ok THEN share END AS drifted_share, CASE WHEN ok THEN share >= {DRIFT.dataset_share} END AS dataset_drift,
  CASE WHEN ok THEN psi END AS prediction_psi, CASE WHEN ok THEN drifted END AS prediction_drift,
  ok AND (share >= {DRIFT.dataset_share} OR drifted) AS retrain
FROM x"""
RUN_SECONDS = int(AS_OF.replace(tzinfo=dt.timezone.utc).timestamp())


@register("dataset_drift", DRIFT_SQL, "K2 K5 K6 K7 K8 K9")
def q_dataset_drift(t):
    """Drift report: counts, guard status, drifted share, dataset flag, prediction (score)
    drift and the retrain decision; without enough current rows no numbers and no retrain."""
    return K.drift_run(reference(t), current_window(t), "score", DRIFT)[0]


REPORT_SQL = f"""SELECT column_name, 'numeric' AS kind, psi, drifted, false AS skipped FROM ({_psi_sql(['value', 'k'], True)})
UNION ALL SELECT column_name, 'categorical', psi, drifted, false FROM ({_psi_sql(['event_type'], False)})
UNION ALL SELECT 'legacy', 'categorical', NULL, false, true"""


@register("drift_report", REPORT_SQL, "K3 K4 K5")
def q_drift_report(t):
    """Drift of every shared column; one that the current window holds no value of is skipped."""
    ref = reference(t).drop("score").withColumn("legacy", F.lit("x"))
    cur = current_window(t).drop("score").withColumn("legacy", F.lit(None).cast("string"))
    return K.drift_report(ref, cur, DRIFT)


@register("drift_gauges", f"""WITH d AS ({DRIFT_SQL}), p AS (
  SELECT * FROM ({_psi_sql(['value', 'k'], True)}) UNION ALL SELECT * FROM ({_psi_sql(['event_type'], False)}))
SELECT 'events_drift_dataset_drift' AS name, 'input' AS label, CAST(dataset_drift AS DOUBLE) AS value FROM d WHERE status = 'ok'
UNION ALL SELECT 'events_drift_drifted_share', 'input', drifted_share FROM d WHERE status = 'ok'
UNION ALL SELECT 'events_drift_dataset_drift', 'prediction', CAST(prediction_drift AS DOUBLE) FROM d WHERE status = 'ok'
UNION ALL SELECT 'events_drift_drifted_share', 'prediction', CAST(prediction_drift AS DOUBLE) FROM d WHERE status = 'ok'
UNION ALL SELECT 'events_drift_feature_psi', column_name, psi FROM p, d WHERE status = 'ok'
UNION ALL SELECT 'events_drift_last_run_timestamp_seconds', NULL, {RUN_SECONDS}.0::DOUBLE""", "K7 K8 A12")
def q_drift_gauges(t):
    """The drift run's samples: flag and share by kind, PSI by feature, run time."""
    report, per = K.drift_run(reference(t), current_window(t), "score", DRIFT)
    g = O.drift_gauges(report, per, "events_drift", "events", AS_OF)
    return g.select("name", F.coalesce(F.element_at("labels", "kind"), F.element_at("labels", "feature")).alias("label"), "value")


def outcome_features(t):
    """The feature table's target: outcome known for every event but signups."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return t.events.select(F.col("event_id"),
                           F.when(F.col("event_type") == "signup", F.lit(None)).otherwise((k >= 80).cast("int")).alias("TARGET"))


OUTCOME_SQL = f"""SELECT DISTINCT CAST(event_id AS VARCHAR) AS id,
  CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) >= 80 AS INTEGER) AS outcome FROM events
WHERE event_type <> 'signup' AND CAST(event_id AS VARCHAR) IN
  (SELECT entity_id FROM ({D.DEDUP_SQL}) WHERE traffic_source = 'replay')"""


def outcomes(t):
    ids = deduped(t).where(F.col("traffic_source") == "replay").select(F.col("entity_id").alias("id")).distinct()
    return O.outcome_table(outcome_features(t), ids, "event_id", "TARGET")


@register("outcome_table", OUTCOME_SQL, "C6 C7 B12")
def q_outcomes(t):
    """Known outcome of every replayed entity (id as string, null target dropped)."""
    return outcomes(t)


def performance(t):
    window = O.matured_window(deduped(t), PRODUCTION, AS_OF, PERF)
    return O.delayed_performance(window, outcomes(t), "entity_id", REFERENCE_ROC_AUC, REFERENCE_PR_AUC, PERF)


_CUT = AS_OF - dt.timedelta(days=PERF.delay_days)
_START = _CUT - dt.timedelta(days=PERF.window_days)
PERF_SQL = f"""WITH w AS (SELECT * FROM ({D.DEDUP_SQL}) WHERE traffic_source = 'replay' AND model_version = '{PRODUCTION}'
  AND timestamp >= TIMESTAMP '{_START.isoformat(sep=' ')}' AND timestamp < TIMESTAMP '{_CUT.isoformat(sep=' ')}'),
lab AS (SELECT w.*, o.outcome, decision = 'flag' AS flag FROM w JOIN ({OUTCOME_SQL}) o ON w.entity_id = o.id),
g AS (SELECT score, sum(outcome) AS p, count(*) - sum(outcome) AS n FROM lab GROUP BY score),
st AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS tot_pos, sum(n) OVER () AS tot_neg
  FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
auc AS (SELECT CASE WHEN max(tot_pos) > 0 AND max(tot_neg) > 0 THEN CAST(sum(CAST(n AS HUGEINT) * (2 * tp - p)) AS DOUBLE)
    / CAST(2 * CAST(max(tot_pos) AS HUGEINT) * max(tot_neg) AS DOUBLE) END AS roc_auc,
  CASE WHEN max(tot_pos) > 0 AND max(tot_neg) > 0 THEN round(sum(CAST(p AS DOUBLE) * (CAST(tp AS DOUBLE)
    / CAST(tp + fp AS DOUBLE))) / CAST(max(tot_pos) AS DOUBLE), 12) END AS pr_auc FROM st),
c AS (SELECT CAST(count(*) AS BIGINT) AS n_labeled, CAST(coalesce(sum(outcome), 0) AS BIGINT) AS n_positive,
  CAST(count(*) FILTER (WHERE outcome = 1 AND flag) AS BIGINT) AS true_positive,
  CAST(count(*) FILTER (WHERE outcome = 0 AND flag) AS BIGINT) AS false_positive,
  CAST(count(*) FILTER (WHERE outcome = 1 AND NOT flag) AS BIGINT) AS false_negative,
  CAST(count(*) FILTER (WHERE outcome = 0 AND NOT flag) AS BIGINT) AS true_negative FROM lab),
x AS (SELECT *, n_labeled >= {PERF.min_labeled} AND n_positive >= {PERF.min_positives} AS enough,
  (SELECT count(*) FROM w) AS n_in_window FROM c, auc)
SELECT CASE WHEN enough THEN 'ok' ELSE 'insufficient_outcomes' END AS status, CAST(n_in_window AS BIGINT) AS n_in_window,
  n_labeled, n_positive,
  CASE WHEN enough THEN CAST(n_positive AS DOUBLE) / CAST(n_labeled AS DOUBLE) END AS positive_rate,
  CASE WHEN enough THEN roc_auc END AS roc_auc, CASE WHEN enough THEN pr_auc END AS pr_auc,
  CASE WHEN enough THEN CAST(true_positive + false_positive AS DOUBLE) / CAST(n_labeled AS DOUBLE) END AS alert_rate,
  CASE WHEN enough AND true_positive + false_negative <> 0 THEN CAST(true_positive AS DOUBLE) / CAST(true_positive + false_negative AS DOUBLE) END AS recall,
  CASE WHEN enough AND true_positive + false_positive <> 0 THEN CAST(true_positive AS DOUBLE) / CAST(true_positive + false_positive AS DOUBLE) END AS precision,
  true_positive, false_positive, false_negative, true_negative,
  CAST({REFERENCE_ROC_AUC} AS DOUBLE) AS test_roc_auc, CAST({REFERENCE_PR_AUC} AS DOUBLE) AS test_pr_auc,
  CASE WHEN enough THEN CAST({REFERENCE_ROC_AUC} AS DOUBLE) - roc_auc END AS roc_auc_drop,
  CASE WHEN enough THEN CAST({REFERENCE_ROC_AUC} AS DOUBLE) - roc_auc > {PERF.max_roc_auc_drop} END AS degraded
FROM x"""


@register("delayed_performance", PERF_SQL, "K10 K11 K12 K13 C8")
def q_perf(t):
    """Replayed production predictions matured by the delay, joined to outcomes: ranking and
    logged-decision quality, guard status and the degraded flag."""
    return performance(t)


# The metrics published as gauges.
GAUGES_SQL = ("test_roc_auc", "test_pr_auc", "n_labeled", "n_positive", "roc_auc", "pr_auc",
              "roc_auc_drop", "recall", "alert_rate", "positive_rate")


@register("performance_gauges", f"""WITH p AS ({PERF_SQL}), l AS (
  {' UNION ALL '.join(f"SELECT 'events_perf_{m}' AS name, CAST({m} AS DOUBLE) AS value FROM p" for m in GAUGES_SQL)}
  UNION ALL SELECT 'events_perf_measured', CAST(status = 'ok' AS DOUBLE) FROM p)
SELECT name, 'events' AS domain, '{PRODUCTION}' AS model_version, value FROM l WHERE value IS NOT NULL
UNION ALL SELECT 'events_perf_last_run_timestamp_seconds', 'events', NULL, {RUN_SECONDS}.0::DOUBLE""", "K15")
def q_gauges(t):
    """A performance run's gauge samples: the metrics known, whether it measured, and when it ran."""
    g = O.metrics_to_gauges(performance(t), "events_perf", "events", PRODUCTION, AS_OF)
    return g.select("name", F.element_at("labels", "domain").alias("domain"),
                    F.element_at("labels", "model_version").alias("model_version"), "value")


SKETCHED = ["value", "k"]
DECILES = [i / 10 for i in range(1, 10)]


@register("reference_sketches", f"""SELECT column_name, CAST(count(value) AS BIGINT) AS n, CAST(count(DISTINCT day) AS BIGINT) AS n_days,
  true AS within_rank_error, true AS psi_close
FROM (SELECT 'value' AS column_name, value, CAST(ts AS DATE) AS day FROM events WHERE {split_case('ts', D.EVENTS_SPLIT)} = 'train'
  UNION ALL SELECT 'k', CAST(json_extract_string(props, '$.k') AS DOUBLE), CAST(ts AS DATE) FROM events
  WHERE {split_case('ts', D.EVENTS_SPLIT)} = 'train') WHERE value IS NOT NULL GROUP BY column_name""", "K3 A14 (quantile sketches)")
def q_sketches(t):
    """Day by day sketches of the reference, stored beside the snapshot and merged on reading: every
    decile's rank within the stated error of the rows, and a PSI against them near the exact one."""
    from chronotab.operators import sketches as Q
    from chronotab.session import ensure_checkpoint_dir
    import uuid
    rows = t.events.where(split_label("ts", D.EVENTS_SPLIT) == "train").select(
        F.col("value"), F.get_json_object("props", "$.k").cast("double").alias("k"), F.to_date("ts").alias("day"))
    root = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/sketches-{uuid.uuid4().hex}"
    daily = Q.column_sketches(rows, SKETCHED, by=["day"])
    path = Q.write_sketches(daily, root, PRODUCTION)
    stored = Q.read_sketches(t.spark, root, PRODUCTION)
    found = {(r.column_name, r.q_index): r.value for r in Q.sketch_quantiles(stored, DECILES).collect()}  # columns x deciles
    def ok(c: str):
        total = F.count(c)
        near = F.lit(True)
        for i, q in enumerate(DECILES):
            at = F.lit(found[c, i])
            near = near & (F.count_if(F.col(c) < at) / total <= q + Q.rank_error()) & (F.count_if(F.col(c) <= at) / total >= q - Q.rank_error())
        return F.struct(F.lit(c).alias("column_name"), total.alias("n"), near.alias("within_rank_error"))
    ranks = rows.agg(F.array(*[ok(c) for c in SKETCHED]).alias("r")).select(F.inline("r"))
    days = t.spark.read.parquet(path).groupBy("column_name").agg(F.countDistinct("day").alias("n_days"))
    cur = current_window(t)
    exact = K.psi_numeric(rows, cur, SKETCHED, DRIFT).withColumnRenamed("psi", "_exact")
    close = K.psi_from_sketches(stored, cur, SKETCHED, DRIFT).join(exact, "column_name").select(
        "column_name", (F.abs(F.col("psi") - F.col("_exact")) < 0.01).alias("psi_close"))
    return ranks.join(days, "column_name").join(close, "column_name").select("column_name", "n", "n_days", "within_rank_error", "psi_close")
