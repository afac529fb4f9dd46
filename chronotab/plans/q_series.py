"""Registered metric-series queries: events as metric samples.

Samples: a gauge ``events_value`` per user (instance) and event type (job); a counter
``requests_total`` per user from ``props.k`` (it drops now and then, which is a counter reset);
an ``up`` gauge per (job, instance) that is 1 when the value is at least 2.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chronotab.functions.fixedpoint import mean_from, scaled, sum_from
from chronotab.operators import series as L
from chronotab.plans import driver as D
from chronotab.plans.catalog import register

AS_OF = dt.datetime(2024, 1, 31)
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
HOLD = 3600
BOUND = 250.0
STALE = 172800.0  # the drift job's staleness bound
BUCKETS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0)


def gauges(t):
    return t.events.select(F.lit("events_value").alias("name"), F.col("user_id").cast("string").alias("instance"),
                           F.col("event_type").alias("job"), "ts", "value")


def counters(t):
    return t.events.select(F.lit("requests_total").alias("name"), F.col("user_id").cast("string").alias("instance"),
                           "ts", F.get_json_object("props", "$.k").cast("double").alias("value"))


def ups(t):
    return gauges(t).withColumn("value", F.when(F.col("value") >= 2.0, 1.0).otherwise(0.0)).withColumn("name", F.lit("up"))


GAUGE_SQL = "SELECT CAST(user_id AS VARCHAR) AS instance, event_type AS job, ts, value FROM events"
COUNTER_SQL = ("SELECT CAST(user_id AS VARCHAR) AS instance, ts, "
               "CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events")

RATE_SQL = f"""WITH c AS ({COUNTER_SQL}), p AS (SELECT *, lag(value) OVER (PARTITION BY instance ORDER BY ts, value) AS prev FROM c)
SELECT instance, CAST(count(*) AS BIGINT) AS n_samples,
  sum(CASE WHEN prev IS NULL THEN 0.0 WHEN value >= prev THEN value - prev ELSE value END) AS increase,
  CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1000000.0 AS span_seconds,
  CASE WHEN epoch_us(max(ts)) > epoch_us(min(ts)) THEN
    sum(CASE WHEN prev IS NULL THEN 0.0 WHEN value >= prev THEN value - prev ELSE value END)
    / (CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1000000.0) END AS rate_per_second
FROM p GROUP BY instance HAVING count(*) >= 2"""


@register("counter_rate", RATE_SQL, "L1")
def q_rate(t):
    """Increase and per-second rate of each counter series, resets handled."""
    return L.counter_rate(counters(t), ["instance"])


@register("topk_series", f"SELECT instance, rate_per_second FROM ({RATE_SQL}) ORDER BY rate_per_second DESC, instance LIMIT 10",
          "E17")
def q_topk(t):
    """The ten series with the highest rate (a top-k report: the limit is the feature)."""
    return L.topk(L.counter_rate(counters(t), ["instance"]).select("instance", "rate_per_second"), 10,
                  "rate_per_second")


def _hourly_last(df):
    return df.groupBy("instance", "job", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.max_by("value", F.struct("ts", "value")).alias("value"))


@register("gauge_ratio_pct", f"""WITH g AS ({GAUGE_SQL}),
h AS (SELECT instance, job, date_trunc('hour', ts) AS hour, arg_max(value, (ts, value)) AS value FROM g GROUP BY ALL)
SELECT a.instance, a.hour, a.value / b.value * 100.0 AS pct FROM h a JOIN h b
  ON a.instance = b.instance AND a.hour = b.hour AND a.job = 'purchase' AND b.job = 'click'""", "L2")
def q_ratio(t):
    """Purchase value as a percentage of click value, per user and hour where both exist."""
    h = _hourly_last(gauges(t))
    return L.gauge_ratio_pct(h.where("job = 'purchase'"), h.where("job = 'click'"), ["instance", "hour"])


@register("agg_by_labels", f"""WITH g AS ({GAUGE_SQL})
SELECT job, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day,
  CAST(sum(CAST(round(value * 100.0) AS HUGEINT)) AS DOUBLE) / CAST(count(value) AS DOUBLE) / 100.0 AS avg_value,
  CAST(sum(CAST(round(value * 100.0) AS HUGEINT)) AS DOUBLE) / 100.0 AS sum_value, max(value) AS max_value
FROM g GROUP BY ALL""", "L3")
def q_agg(t):
    """Average, sum and maximum of the gauge by job and day (exact cents sums)."""
    g = gauges(t)
    out = g.groupBy("job", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(
        F.sum(scaled("value", 2)).alias("_s"), F.count("value").alias("_n"), F.max("value").alias("max_value"))
    return out.select("job", "day", mean_from("_s", "_n", 2).alias("avg_value"),
                      sum_from("_s", 2).alias("sum_value"), "max_value")


@register("last_over_time", f"""WITH g AS ({GAUGE_SQL})
SELECT job, instance, max(ts) AS last_ts, arg_max(value, ts) AS value FROM g
WHERE ts > {AS_OF_SQL} - INTERVAL 2 HOUR AND ts <= {AS_OF_SQL} GROUP BY ALL""", "L4")
def q_last(t):
    """Last sample of each series within the 2 hours before the as-of time."""
    return L.last_over_time(gauges(t), ["job", "instance"], AS_OF, 7200)


def _hq_sql():
    cases = ", ".join(f"count(*) FILTER (WHERE value <= {b})" for b in BUCKETS)
    les = list(BUCKETS)
    parts = [f"SELECT job, {i} AS i, CAST({le} AS DOUBLE) AS le, c{i} AS cum FROM cb" for i, le in enumerate(les)]
    parts.append(f"SELECT job, {len(les)} AS i, CAST('inf' AS DOUBLE) AS le, total AS cum FROM cb")
    cols = ", ".join(f"count(*) FILTER (WHERE value <= {b}) AS c{i}" for i, b in enumerate(BUCKETS))
    del cases
    return f"""WITH g AS ({GAUGE_SQL}), cb AS (SELECT job, {cols}, count(value) AS total FROM g GROUP BY job),
b AS ({' UNION ALL '.join(parts)}),
r AS (SELECT job, 0.95 * CAST(max(cum) FILTER (WHERE le = 'inf'::DOUBLE) AS DOUBLE) AS rank FROM b GROUP BY job),
f AS (SELECT b.job, min(i) AS i FROM b JOIN r USING (job) WHERE CAST(cum AS DOUBLE) >= rank GROUP BY b.job),
x AS (SELECT f.job, r.rank, cur.le, cur.cum, coalesce(prev.le, 0.0) AS start, coalesce(prev.cum, 0) AS pcum,
  (SELECT le FROM b b2 WHERE b2.job = f.job AND b2.i = {len(les) - 1}) AS last_finite
  FROM f JOIN r USING (job) JOIN b cur ON cur.job = f.job AND cur.i = f.i
  LEFT JOIN b prev ON prev.job = f.job AND prev.i = f.i - 1)
SELECT job, CASE WHEN isinf(le) THEN last_finite
  ELSE start + (le - start) * ((rank - CAST(pcum AS DOUBLE)) / (CAST(cum AS DOUBLE) - CAST(pcum AS DOUBLE))) END AS p95
FROM x"""


@register("histogram_quantile", _hq_sql(), "L5 L6")
def q_hq(t):
    """p95 of the gauge per job from cumulative buckets, Prometheus-style interpolation."""
    b = L.cumulative_buckets(gauges(t), "value", ["job"], BUCKETS)
    return L.histogram_quantile(b, 0.95, "p95").select("job", "p95")


@register("latency_buckets", f"""WITH g AS ({GAUGE_SQL}) {' UNION ALL '.join(
    f"SELECT job, CAST({b} AS DOUBLE) AS le, CAST(count(*) FILTER (WHERE value <= {b}) AS BIGINT) AS cum FROM g GROUP BY job"
    for b in BUCKETS)} UNION ALL SELECT job, CAST('inf' AS DOUBLE), CAST(count(value) AS BIGINT) FROM g GROUP BY job""", "L6")
def q_buckets(t):
    """Cumulative bucket counts per job (the histogram a latency metric keeps)."""
    b = L.cumulative_buckets(gauges(t), "value", ["job"], BUCKETS)
    return b.select("job", F.explode("buckets").alias("b")).select("job", "b.le", F.col("b.cum").cast("bigint").alias("cum"))


ALERT_SQL = f"""WITH g AS ({GAUGE_SQL}),
s AS (SELECT instance, ts, coalesce(value > {BOUND}, false) AS cond,
  sum(CASE WHEN coalesce(value > {BOUND}, false) THEN 0 ELSE 1 END) OVER (PARTITION BY instance ORDER BY ts, coalesce(value > {BOUND}, false) ROWS UNBOUNDED PRECEDING) AS nf
  FROM g),
runs AS (SELECT instance, nf, min(ts) AS run_start, max(ts) AS last_true_ts, CAST(count(*) AS BIGINT) AS n_samples FROM s WHERE cond GROUP BY ALL),
ends AS (SELECT instance, nf - 1 AS nf, ts AS run_end FROM s WHERE NOT cond)
SELECT instance, run_start, last_true_ts, run_end, n_samples,
  epoch_us(coalesce(run_end, {AS_OF_SQL})) - epoch_us(run_start) >= {HOLD * 1_000_000} AS fired,
  CASE WHEN epoch_us(coalesce(run_end, {AS_OF_SQL})) - epoch_us(run_start) >= {HOLD * 1_000_000}
    THEN run_start + INTERVAL {HOLD} SECOND END AS fire_at
FROM runs LEFT JOIN ends USING (instance, nf)"""


@register("alert_for_duration", ALERT_SQL, "L8 M9")
def q_alert(t):
    """Runs of a user's gauge above 250; a run fires once it has held for an hour."""
    g = gauges(t)
    return L.alert_runs(g, ["instance"], F.col("value") > BOUND, HOLD, AS_OF)


@register("staleness_alert", f"""WITH g AS ({GAUGE_SQL})
SELECT instance, CAST(epoch_us({AS_OF_SQL}) - epoch_us(max(ts)) AS DOUBLE) / 1000000.0 AS age_seconds,
  CAST(epoch_us({AS_OF_SQL}) - epoch_us(max(ts)) AS DOUBLE) / 1000000.0 > {STALE} AS stale FROM g GROUP BY instance""", "L9")
def q_stale(t):
    """Seconds since each user's last sample and whether that is past the 2-day bound."""
    return L.staleness(gauges(t), ["instance"], AS_OF, STALE)


UP_SQL = f"""WITH g AS (SELECT job, instance, ts, CASE WHEN value >= 2.0 THEN 1.0 ELSE 0.0 END AS value FROM ({GAUGE_SQL})),
l AS (SELECT job, instance, arg_max(value, ts) AS value FROM g
  WHERE ts > {AS_OF_SQL} - INTERVAL 2 HOUR AND ts <= {AS_OF_SQL} GROUP BY ALL)"""


@register("up_rollup", f"""{UP_SQL} SELECT job, bool_and(value = 1.0) AS up, CAST(count(*) AS BIGINT) AS n_targets
FROM l GROUP BY job""", "L14 L4")
def q_up(t):
    """A job is up only if every target's last sample in 2 hours is 1."""
    return L.up_rollup(L.last_over_time(ups(t), ["job", "instance"], AS_OF, 7200))


def _role_pct(t, seconds):
    last = L.last_over_time(gauges(t), ["job", "instance"], AS_OF, seconds)
    return last.groupBy(F.col("job").alias("role")).agg((F.max("value") / 5.0).alias("value"))


@register("host_health", f"""{UP_SQL},
w AS (SELECT job, instance, ts, value FROM ({GAUGE_SQL})),
cpu AS (SELECT job AS role, max(v) / 5.0 AS cpu_pct FROM (SELECT job, instance, arg_max(value, ts) AS v FROM w
  WHERE ts > {AS_OF_SQL} - INTERVAL 2 HOUR AND ts <= {AS_OF_SQL} GROUP BY ALL) GROUP BY job),
mem AS (SELECT job AS role, max(v) / 5.0 AS memory_pct FROM (SELECT job, instance, arg_max(value, ts) AS v FROM w
  WHERE ts > {AS_OF_SQL} - INTERVAL 6 HOUR AND ts <= {AS_OF_SQL} GROUP BY ALL) GROUP BY job),
dsk AS (SELECT job AS role, max(v) / 5.0 AS disk_pct FROM (SELECT job, instance, arg_max(value, ts) AS v FROM w
  WHERE ts > {AS_OF_SQL} - INTERVAL 30 MINUTE AND ts <= {AS_OF_SQL} GROUP BY ALL) GROUP BY job),
u AS (SELECT job AS role, bool_and(value = 1.0) AS up FROM l GROUP BY job)
SELECT coalesce(cpu.role, mem.role, dsk.role, u.role) AS role, cpu_pct, memory_pct, disk_pct, up,
  CASE WHEN cpu_pct > 90.0 THEN 'red' WHEN cpu_pct > 75.0 THEN 'amber' WHEN cpu_pct IS NOT NULL THEN 'green' END AS cpu_band
FROM cpu FULL OUTER JOIN mem USING (role) FULL OUTER JOIN dsk USING (role) FULL OUTER JOIN u USING (role)""", "L15 L17")
def q_health(t):
    """Per role: cpu, memory and disk percentages from three look-backs, up, and the colour
    band; a role missing from a source stays unknown."""
    up = L.up_rollup(L.last_over_time(ups(t), ["job", "instance"], AS_OF, 7200)).withColumnRenamed("job", "role")
    h = L.host_health(_role_pct(t, 7200), _role_pct(t, 21600), _role_pct(t, 1800), up)
    return h.withColumn("cpu_band", L.health_band("cpu_pct"))


@register("prediction_counter", f"""SELECT CAST(time_bucket(INTERVAL 1 HOUR, timestamp) AS TIMESTAMP) AS window_start,
  decision, CAST(count(*) AS BIGINT) AS n FROM ({D.DEDUP_SQL}) GROUP BY ALL""", "L7 M6")
def q_counter(t):
    """Predictions by hour and decision from the deduplicated log."""
    from chronotab.plans.q_monitor import deduped
    d = deduped(t)
    return d.groupBy(F.window(F.col("timestamp").cast("timestamp"), "1 hour").alias("w"), "decision").agg(
        F.count(F.lit(1)).cast("bigint").alias("n")).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), "decision", "n")
