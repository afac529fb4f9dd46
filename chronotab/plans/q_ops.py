"""Registered rows of operations data: rules, pods, deployments and apps played by events (L10, L19-L22),
the request file's ids (K14), the run table (K17) and fixed samples (B16)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chronotab.functions.scalar import fixed_sample
from chronotab.operators import outcomes as O
from chronotab.operators import series as L
from chronotab.plans import driver as D
from chronotab.plans.catalog import register
from chronotab.plans.q_files import folder
from chronotab.plans.q_monitor import AS_OF, PRODUCTION, current_window
from chronotab.plans.q_nested import SELECTED_EVENTS_SQL, event_requests
from chronotab.sources import predlog as P

# Each rule's condition and what it reports when its query finds no series.
RULES = {"many errors": ("event_type = 'error' AND value > 100", "OK"), "no such type": ("event_type = 'refund'", "Alerting"),
         "huge amounts": ("value > 1e12", "OK"), "any view": ("event_type = 'view'", "Alerting")}


@register("no_data_policy", " UNION ALL ".join(
    f"SELECT '{title}' AS title, CAST(count(DISTINCT user_id) AS BIGINT) AS n_series, CASE WHEN count(*) = 0 THEN '{state}' ELSE 'Evaluated' END AS state FROM events WHERE {cond}"
    for title, (cond, state) in RULES.items()), "L10 T17")
def q_no_data(t):
    """Rules whose query finds no series take their own no-data state."""
    rules = t.spark.createDataFrame([(k, s) for k, (_, s) in RULES.items()], "title string, no_data_state string")
    hits = F.array_compact(F.array(*[F.when(F.expr(c), F.lit(k)) for k, (c, _) in RULES.items()]))
    found = t.events.select("user_id", F.explode(hits).alias("title")).groupBy("title").agg(F.countDistinct("user_id").alias("n_series"))
    return L.no_data_policy(rules, found)


PHASE = "CASE event_type WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'Unknown' ELSE 'Running' END"
REASON = "CASE WHEN event_type = 'view' AND event_id % 3 = 0 THEN 'CrashLoopBackOff' WHEN event_type = 'click' THEN 'ContainerCreating' ELSE 'ErrImagePull' END"
ON = "CASE WHEN value > 100 THEN 1.0 ELSE 0.0 END"


@register("bad_state_union", f"""SELECT CAST(event_id AS VARCHAR) AS pod, {PHASE} AS state FROM events WHERE {PHASE} IN ('Failed', 'Unknown') AND {ON} > 0
UNION ALL SELECT CAST(event_id AS VARCHAR), {REASON} FROM events WHERE {REASON} IN ('ImagePullBackOff', 'ErrImagePull', 'CrashLoopBackOff',
  'CreateContainerConfigError', 'InvalidImageName') AND {ON} > 0""", "L19")
def q_bad_states(t):
    """Pods in a failed or unknown phase, and pods that wait for a bad reason."""
    pods = t.events.selectExpr("CAST(event_id AS STRING) AS pod", f"{PHASE} AS phase", f"{REASON} AS reason", f"{ON} AS value")
    return L.bad_state_union(pods.drop("reason"), pods.drop("phase"))


GAUGE_NAME = "CASE WHEN event_type = 'view' THEN 'model_drift_share' WHEN event_type = 'click' THEN 'model_pr_auc' ELSE 'other_total' END"
GAUGE_DOMAIN, GAUGE_VERSION = "CASE WHEN user_id % 2 = 0 THEN 'fraud' ELSE 'credit' END", "CAST(1 + user_id % 3 AS STRING)"


@register("production_gauges", f"""SELECT event_id, {GAUGE_NAME} AS name, {GAUGE_DOMAIN} AS domain, CAST(1 + user_id % 3 AS VARCHAR) AS version, value
FROM events WHERE {GAUGE_NAME} LIKE 'model_%' AND {GAUGE_DOMAIN} = 'fraud' AND 1 + user_id % 3 = 2""", "L20")
def q_production(t):
    """Samples by name pattern, of one domain and of the version that holds the production alias."""
    s = t.events.select("event_id", F.expr(GAUGE_NAME).alias("name"), F.create_map(
        F.lit("domain"), F.expr(GAUGE_DOMAIN), F.lit("model_version"), F.expr(GAUGE_VERSION)).alias("labels"), "value")
    versions = t.spark.createDataFrame([("1", ["challenger"]), ("2", ["champion", "production"]), ("3", [])], "version string, aliases array<string>")
    out = L.production_gauges(s, versions, "^model_", "fraud")
    return out.select("event_id", "name", F.element_at("labels", "domain").alias("domain"), F.element_at("labels", "model_version").alias("version"), "value")


@register("desired_vs_available", """WITH d AS (SELECT user_id, CAST(count(*) AS DOUBLE) AS desired FROM events WHERE event_type <> 'error' GROUP BY user_id),
a AS (SELECT user_id, CAST(count(*) AS DOUBLE) AS available FROM events WHERE event_type = 'view' AND value > 50 GROUP BY user_id)
SELECT user_id, desired, available, desired - coalesce(available, 0.0) AS missing FROM d FULL OUTER JOIN a USING (user_id)""", "L21")
def q_desired(t):
    """Wanted and available counts by user side by side, and what is missing."""
    def of(where):
        return t.events.where(where).groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("value"))
    return L.desired_vs_available(of("event_type <> 'error'"), of("event_type = 'view' AND value > 50"), ["user_id"])


SYNC, HEALTH = "CASE WHEN event_type = 'error' THEN 'OutOfSync' ELSE 'Synced' END", "CASE WHEN value > 300 THEN 'Degraded' ELSE 'Healthy' END"


@register("out_of_sync_apps", f"""SELECT CAST(user_id AS VARCHAR) AS name, {SYNC} AS sync_status, {HEALTH} AS health_status, max(value) AS value FROM events
WHERE {SYNC} <> 'Synced' OR {HEALTH} <> 'Healthy' GROUP BY ALL""", "L22")
def q_out_of_sync(t):
    """Apps that are not synced or not healthy, with the largest value of each state."""
    return L.out_of_sync_apps(t.events.selectExpr("CAST(user_id AS STRING) AS name", f"{SYNC} AS sync_status", f"{HEALTH} AS health_status", "value"))


@register("replayed_ids", f"SELECT CAST(trans_num AS VARCHAR) AS id FROM ({SELECTED_EVENTS_SQL})", "K14 A9 B12")
def q_replayed(t):
    """The distinct entity ids in the lines of the request file, as text."""
    path = folder(t, "replayed")
    P.write_requests(event_requests(t), path)
    return O.replayed_ids(t.spark.read.text(path), "trans_num")


RUNS = [("drift", AS_OF - dt.timedelta(days=2)), ("performance", AS_OF - dt.timedelta(days=1)), ("drift", AS_OF)]


@register("monitoring_history", f"""WITH w AS (SELECT count(*) AS n FROM ({D.DEDUP_SQL})
  WHERE timestamp >= TIMESTAMP '{AS_OF - dt.timedelta(days=7)}' AND coalesce(traffic_source, '') <> 'test' AND model_version = '{PRODUCTION}')
SELECT job, CAST(n + k AS BIGINT) AS n_rows, run_ts FROM w, (VALUES {', '.join(f"('{j}', {k}, TIMESTAMP '{ts}')" for k, (j, ts) in enumerate(RUNS))}) r(job, k, run_ts)""", "K17 K1")
def q_history(t):
    """Three monitoring runs appended, one after the other, to the run table, which holds them all."""
    path = folder(t, "runs")
    n = current_window(t).agg(F.count(F.lit(1)).alias("n"))
    for k, (job, ts) in enumerate(RUNS):
        run = n.select((F.col("n") + k).cast("bigint").alias("n_rows"))
        O.monitoring_history(run, ts, job).write.mode("append").parquet(path)
    return t.spark.read.parquet(path).select("job", "n_rows", F.col("run_ts").cast("timestamp_ntz").alias("run_ts"))


SAMPLE = 200


@register("fixed_sample", f"""SELECT CAST(least(count(*), {SAMPLE}) AS BIGINT) AS n, true AS distinct_rows, true AS same_again, true AS other_seed_differs, true AS spread FROM events""", "B16")
def q_fixed_sample(t):
    """Events by a fixed seed: as many as asked, no event twice, the same ones however the table
    is dealt, others with another seed, and not the first ones by id."""
    ids = t.events.select("event_id")
    one, again = fixed_sample(ids, "event_id", SAMPLE), fixed_sample(ids.repartition(7), "event_id", SAMPLE)
    other = fixed_sample(ids, "event_id", SAMPLE, seed=7)
    tag = lambda df, k: df.withColumn("_of", F.lit(k))
    by = tag(one, 1).unionByName(tag(again, 2)).unionByName(tag(other, 3)).groupBy("event_id").agg(
        *[F.count_if(F.col("_of") == k).alias(f"_n{k}") for k in (1, 2, 3)])
    return by.agg(F.sum("_n1").alias("n"), F.bool_and(F.col("_n1") <= 1).alias("distinct_rows"), F.bool_and(F.col("_n1") == F.col("_n2")).alias("same_again"),
                  (~F.bool_and(F.col("_n1") == F.col("_n3"))).alias("other_seed_differs"), (F.max(F.when(F.col("_n1") > 0, F.col("event_id"))) > SAMPLE).alias("spread"))

