"""Outcomes and delayed performance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotab.config import PerformanceConfig
from chronotab.functions.timecols import ts_literal
from chronotab.operators.evaluate import auc_table, score_steps


def replayed_ids(requests: DataFrame, field: str) -> DataFrame:
    """Distinct entity ids in the request lines, as strings."""
    return requests.select(F.get_json_object("value", f"$.{field}").alias("id")).where(
        F.col("id").isNotNull()).distinct()


def outcome_table(features: DataFrame, ids: DataFrame, key: str, target: str) -> DataFrame:
    """Entities among ``ids`` (semi-join on the id as a string), null target dropped,
    target as int, one row per id (an aggregate, so duplicates combine map-side)."""
    f = features.select(F.col(key).cast("string").alias("id"), F.col(target))
    known = f.join(ids.select("id"), "id", "left_semi").where(F.col(target).isNotNull())
    return known.groupBy("id").agg(F.max(F.col(target).cast("int")).alias("outcome"))


def matured_window(log: DataFrame, model_version: str, as_of: dt.datetime, cfg: PerformanceConfig,
                   ts: str = "timestamp", traffic: str = "traffic_source") -> DataFrame:
    """Replay traffic of one version with start <= ts < cutoff, cutoff = as_of - delay,
    start = cutoff - window (a missing source is not replay, T22)."""
    cutoff = as_of - dt.timedelta(days=cfg.delay_days)
    start = cutoff - dt.timedelta(days=cfg.window_days)
    return log.where(F.coalesce(F.col(traffic) == "replay", F.lit(False))
                     & (F.col("model_version").cast("string") == str(model_version))
                     & (F.col(ts) >= ts_literal(start)) & (F.col(ts) < ts_literal(cutoff)))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a.cast("double") / b.cast("double"))


def delayed_performance(window: DataFrame, outcomes: DataFrame, id_field: str,
                        reference_roc_auc: float, reference_pr_auc: float,
                        cfg: PerformanceConfig) -> DataFrame:
    """Logged predictions joined to known outcomes (C8), ranking quality and the
    confusion of the *logged* decisions; ``insufficient_outcomes`` under the minimums, and
    ``degraded`` when test AUC - live AUC exceeds the allowed drop. One row."""
    w = window.withColumn("id", F.col(id_field).cast("string"))
    n_window = w.agg(F.count(F.lit(1)).cast("bigint").alias("n_in_window"), F.lit(0).alias("_k"))
    lab = w.join(outcomes, "id").withColumn("_flag", F.col("decision") == "flag")
    conf = lab.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_labeled"),
        F.coalesce(F.sum("outcome"), F.lit(0)).cast("bigint").alias("n_positive"),
        F.count_if((F.col("outcome") == 1) & F.col("_flag")).cast("bigint").alias("true_positive"),
        F.count_if((F.col("outcome") == 0) & F.col("_flag")).cast("bigint").alias("false_positive"),
        F.count_if((F.col("outcome") == 1) & ~F.col("_flag")).cast("bigint").alias("false_negative"),
        F.count_if((F.col("outcome") == 0) & ~F.col("_flag")).cast("bigint").alias("true_negative"),
    ).withColumn("_k", F.lit(0))
    auc = auc_table(score_steps(lab.select(F.col("outcome").alias("y"), "score"), "y", "score"), ())
    out = n_window.join(conf, "_k").join(auc.withColumnRenamed("_g", "_k"), "_k", "left")
    enough = (F.col("n_labeled") >= cfg.min_labeled) & (F.col("n_positive") >= cfg.min_positives)
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    n = F.col("n_labeled")
    drop = F.lit(float(reference_roc_auc)) - F.col("roc_auc")
    return out.select(
        F.when(enough, F.lit("ok")).otherwise(F.lit("insufficient_outcomes")).alias("status"),
        "n_in_window", "n_labeled", "n_positive",
        F.when(enough, _ratio(F.col("n_positive"), n)).alias("positive_rate"),
        F.when(enough, F.col("roc_auc")).alias("roc_auc"),
        F.when(enough, F.col("pr_auc")).alias("pr_auc"),
        F.when(enough, _ratio(tp + fp, n)).alias("alert_rate"),
        F.when(enough, _ratio(tp, tp + fn)).alias("recall"),
        F.when(enough, _ratio(tp, tp + fp)).alias("precision"),
        "true_positive", "false_positive", "false_negative", "true_negative",
        F.lit(float(reference_roc_auc)).alias("test_roc_auc"),
        F.lit(float(reference_pr_auc)).alias("test_pr_auc"),
        F.when(enough, drop).alias("roc_auc_drop"),
        F.when(enough, drop > F.lit(cfg.max_roc_auc_drop)).alias("degraded"))


# The metrics published as gauges.
KNOWN_METRICS = ("test_roc_auc", "test_pr_auc", "n_labeled", "n_positive", "roc_auc", "pr_auc",
                 "roc_auc_drop", "recall", "alert_rate", "positive_rate")


def _samples(result: DataFrame, prefix: str, values: dict[str, str], labels: Column) -> DataFrame:
    stack = ", ".join(f"'{prefix}_{name}', CAST({value} AS DOUBLE)" for name, value in values.items())
    long = result.selectExpr(f"stack({len(values)}, {stack}) AS (name, value)")
    return long.where(F.col("value").isNotNull()).select("name", labels.alias("labels"), "value")


def metrics_to_gauges(result: DataFrame, prefix: str, domain: str, version: str, run_ts: dt.datetime,
                      metrics=KNOWN_METRICS) -> DataFrame:
    """A run's samples ``(name, labels, value)``: known metrics with missing (null) ones
    left out, ``measured`` (1 if there were enough outcomes), and ``last_run`` as a Unix time.
    Labels are domain and model version; ``last_run`` has the domain alone."""
    own = F.create_map(F.lit("domain"), F.lit(domain), F.lit("model_version"), F.lit(version))
    out = _samples(result, prefix, {**{m: f"`{m}`" for m in metrics}, "measured": "status = 'ok'"}, own)
    return out.unionByName(heartbeat_gauge(result.sparkSession, prefix, domain, run_ts))


def heartbeat_gauge(spark, prefix: str, domain: str, run_ts: dt.datetime) -> DataFrame:
    """The sample that a job ran at ``run_ts`` (UTC), merged into its gauges when there was
    nothing to measure."""
    seconds = run_ts.replace(tzinfo=dt.timezone.utc).timestamp()
    return spark.range(1).select(
        F.lit(f"{prefix}_last_run_timestamp_seconds").alias("name"),
        F.create_map(F.lit("domain"), F.lit(domain)).alias("labels"), F.lit(seconds).alias("value"))


def drift_gauges(report: DataFrame, per_column: DataFrame, prefix: str, domain: str, run_ts: dt.datetime) -> DataFrame:
    """K7, K8: a drift run's samples: flag and share for inputs and for predictions, PSI of
    every compared feature, and the run time. Without data only the run time is new."""

    def of(kind: str) -> Column:
        return F.create_map(F.lit("domain"), F.lit(domain), F.lit("kind"), F.lit(kind))

    measured = report.where(F.col("status") == "ok")
    out = _samples(measured, prefix, {"dataset_drift": "dataset_drift", "drifted_share": "drifted_share"}, of("input"))
    out = out.unionByName(_samples(measured, prefix, {"dataset_drift": "prediction_drift",
                                                      "drifted_share": "CAST(prediction_drift AS INT)"}, of("prediction")))
    feature = F.create_map(F.lit("domain"), F.lit(domain), F.lit("feature"), F.col("column_name"))
    compared = per_column.where(F.col("psi").isNotNull()).select(
        F.lit(f"{prefix}_feature_psi").alias("name"), feature.alias("labels"), F.col("psi").alias("value"))
    return out.unionByName(compared).unionByName(heartbeat_gauge(report.sparkSession, prefix, domain, run_ts))


def send_summary(send_log: DataFrame, max_failure_share: float = 0.10, by: tuple[str, ...] = ()) -> DataFrame:
    """Requests by status, sent, failed, and whether the run fails (> 10 % failures); one row a
    group of ``by`` (null is a group), or one row in all."""
    s = send_log.groupBy(*by).agg(F.count(F.lit(1)).cast("bigint").alias("sent"),
                     F.count_if(F.col("status") >= 400).cast("bigint").alias("failed"))
    return s.withColumn("run_failed", F.col("failed").cast("double") > F.col("sent").cast("double") * max_failure_share)


def monitoring_history(run: DataFrame, run_ts, kind: str) -> DataFrame:
    """One run's numbers stamped for appending to the run table."""
    return run.withColumns({"run_ts": F.lit(run_ts).cast("timestamp"), "job": F.lit(kind)})
