"""Metric-series operators over sample tables ``(name, labels, ts, value)`` (L1-L10, L14, L15,
L17-L22).

The reference only *uses* these queries (a time-series database evaluates them); here they are
batch operators. Anything that needs a series in time order (counter resets, runs of a held
condition) uses the global-order helper (P1) partitioned by series: the window partitions are
(series, time range), so one very busy series is spread over many tasks, and the previous sample
comes from an equi-join on (series, position - 1), never from a window over a whole series.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotab.functions.timecols import micros, ts_literal
from chronotab.operators.order import prefix_totals

# Pod phases and waiting reasons that count as a bad state.
BAD_PHASES = ("Failed", "Unknown")
BAD_WAITING_REASONS = ("ImagePullBackOff", "ErrImagePull", "CrashLoopBackOff",
                       "CreateContainerConfigError", "InvalidImageName")
# Health colour bands.
RED_ABOVE, AMBER_ABOVE = 90.0, 75.0


def _ordered(samples: DataFrame, series: Sequence[str], ts: str, value: str, n_buckets: int | None) -> DataFrame:
    """Samples of a series at one time are ordered by value."""
    s = samples.withColumn("_t", micros(ts))
    return prefix_totals(s, ["_t", value], {}, partition_by=list(series), position="_pos", n_buckets=n_buckets)


def with_previous(samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value",
                  n_buckets: int | None = None) -> DataFrame:
    """Each sample with the previous sample of its series (``_prev_value``, ``_prev_t``)."""
    o = _ordered(samples, series, ts, value, n_buckets)
    prev = o.select(*series, (F.col("_pos") + 1).alias("_pos"), F.col(value).alias("_prev_value"),
                    F.col("_t").alias("_prev_t"))
    return o.join(prev, [*series, "_pos"], "left")


def counter_rate(samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value",
                 n_buckets: int | None = None) -> DataFrame:
    """L1: per series, the increase over the samples with counter resets handled (a drop means
    the counter restarted, so the new value is the increase) and the rate per second over the
    span from the first to the last sample. No extrapolation to the range edges [ours]."""
    p = with_previous(samples, series, ts, value, n_buckets)
    inc = F.when(F.col("_prev_value").isNull(), F.lit(0.0)).when(
        F.col(value) >= F.col("_prev_value"), F.col(value) - F.col("_prev_value")).otherwise(F.col(value))
    agg = p.groupBy(*series).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_samples"),
        F.sum(inc).alias("increase"),
        F.min("_t").alias("_t0"), F.max("_t").alias("_t1"))
    span = (F.col("_t1") - F.col("_t0")).cast("double") / 1e6
    return agg.where("n_samples >= 2").select(
        *series, "n_samples", "increase", span.alias("span_seconds"),
        F.when(span > 0, F.col("increase") / span).alias("rate_per_second"))


def gauge_ratio_pct(a: DataFrame, b: DataFrame, keys: Sequence[str], name: str = "pct",
                    complement: bool = False) -> DataFrame:
    """L2: ``a / b * 100`` (or ``(1 - a / b) * 100``) for samples present in both, joined on
    labels and time. Over zero the ratio is an infinity or NaN, as for any double."""
    j = a.select(*keys, F.col("value").alias("_a")).join(b.select(*keys, F.col("value").alias("_b")), list(keys))
    # an ANSI session refuses to divide by zero; the power has the sign of the zero
    r = F.when(F.col("_b") != 0, F.col("_a") / F.col("_b")).otherwise(F.col("_a") * F.pow("_b", F.lit(-1.0)))
    return j.select(*keys, (((F.lit(1.0) - r) if complement else r) * 100.0).alias(name))


def agg_by_labels(samples: DataFrame, by: Sequence[Column | str], fns: Sequence[str] = ("avg", "sum", "max")) -> DataFrame:
    """L3: avg / sum / max of the values by the given labels (and time step)."""
    return samples.groupBy(*by).agg(*[getattr(F, f)("value").alias(f"{f}_value") for f in fns])


def last_over_time(samples: DataFrame, series: Sequence[str], as_of: dt.datetime, range_seconds: int,
                   ts: str = "ts") -> DataFrame:
    """L4: the last sample of each series within ``(as_of - range, as_of]``."""
    lo = as_of - dt.timedelta(seconds=range_seconds)
    w = samples.where((F.col(ts) > ts_literal(lo)) & (F.col(ts) <= ts_literal(as_of)))
    return w.groupBy(*series).agg(F.max(ts).alias("last_ts"),
                                  F.max_by("value", F.struct(F.col(ts), F.col("value"))).alias("value"))


def cumulative_buckets(df: DataFrame, value: str, by: Sequence[str], bounds: Sequence[float]) -> DataFrame:
    """Cumulative bucket counts (``le``) per group, +Inf last, as an array of structs."""
    cols = [F.struct(F.lit(float(b)).alias("le"), F.count_if(F.col(value) <= F.lit(float(b))).alias("cum"))
            for b in bounds]
    cols.append(F.struct(F.lit(float("inf")).alias("le"), F.count(F.col(value)).alias("cum")))
    return df.groupBy(*by).agg(F.array(*cols).alias("buckets"))


def histogram_quantile(buckets: DataFrame, q: float, name: str = "quantile") -> DataFrame:
    """Prometheus' bucket quantile: rank = q * total, first bucket whose cumulative count
    reaches it, linear inside it from the previous bound (0 for the first); in the +Inf bucket
    the previous bound is returned."""
    b = F.col("buckets")
    total = F.element_at(b, -1)["cum"]
    rank = F.lit(float(q)) * total.cast("double")
    idx = F.array_position(F.transform(b, lambda x: x["cum"].cast("double") >= rank), True).cast("int")  # 1-based
    cur = F.element_at(b, idx)
    prev = F.when(idx > 1, F.element_at(b, idx - 1))
    start = F.when(idx > 1, prev["le"]).otherwise(F.lit(0.0))
    prev_cum = F.when(idx > 1, prev["cum"]).otherwise(F.lit(0)).cast("double")
    inside = start + (cur["le"] - start) * ((rank - prev_cum) / (cur["cum"].cast("double") - prev_cum))
    last_finite = F.element_at(b, -2)["le"]
    val = F.when(total == 0, F.lit(None)).when(F.isnan(cur["le"]) | (cur["le"] == float("inf")), last_finite) \
        .otherwise(inside)
    return buckets.withColumn(name, val)


def alert_runs(samples: DataFrame, series: Sequence[str], condition: Column, hold_seconds: int,
               as_of: dt.datetime, ts: str = "ts", n_buckets: int | None = None) -> DataFrame:
    """Runs of consecutive samples where the condition holds (gaps and islands). A run
    starts at its first true sample and lasts until the next false sample (or ``as_of``); it
    fires at start + hold when it lasted that long. Island ids come from a running count of
    false samples (P1), so no window spans a whole series."""
    s = samples.withColumn("_cond", F.coalesce(condition, F.lit(False)))
    # at one time, samples where it does not hold come first
    o = prefix_totals(s.withColumn("_t", micros(ts)), ["_t", "_cond"],
                      {"_nfalse": F.when(F.col("_cond"), 0).otherwise(1).cast("bigint")},
                      partition_by=list(series), n_buckets=n_buckets)
    true_runs = o.where("_cond").groupBy(*series, "_nfalse").agg(
        F.min("_t").alias("_start"), F.max("_t").alias("_last"), F.count(F.lit(1)).cast("bigint").alias("n_samples"))
    # the false sample that ends a run is the one whose running count is island id + 1
    ends = o.where(~F.col("_cond")).select(*series, (F.col("_nfalse") - 1).alias("_nfalse"),
                                           F.col("_t").alias("_end"))
    r = true_runs.join(ends, [*series, "_nfalse"], "left")
    as_of_us = int((as_of - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    end = F.coalesce(F.col("_end"), F.lit(as_of_us))
    hold = F.lit(hold_seconds * 1_000_000)
    from chronotab.functions.timecols import from_micros
    return r.select(
        *series, from_micros("_start").alias("run_start"), from_micros("_last").alias("last_true_ts"),
        from_micros(F.col("_end")).alias("run_end"), "n_samples",
        (end - F.col("_start") >= hold).alias("fired"),
        F.when(end - F.col("_start") >= hold, from_micros(F.col("_start") + hold)).alias("fire_at"))


def staleness(samples: DataFrame, series: Sequence[str], as_of: dt.datetime, bound_seconds: float,
              ts: str = "ts") -> DataFrame:
    """Seconds since the last sample of each series, and whether it exceeds the bound."""
    as_of_us = int((as_of - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    last = samples.groupBy(*series).agg(F.max(micros(ts)).alias("_last"))
    age = (F.lit(as_of_us) - F.col("_last")).cast("double") / 1e6
    return last.select(*series, age.alias("age_seconds"), (age > F.lit(float(bound_seconds))).alias("stale"))


def no_data_policy(rules: DataFrame, series_count: DataFrame) -> DataFrame:
    """Rules left-joined to the number of series their query found; a rule without data
    takes its own no-data state (T17), others are evaluated."""
    j = rules.join(series_count, "title", "left")
    return j.select("title", F.coalesce("n_series", F.lit(0)).cast("bigint").alias("n_series"),
                    F.when(F.coalesce("n_series", F.lit(0)) == 0, F.col("no_data_state"))
                    .otherwise(F.lit("Evaluated")).alias("state"))


def up_rollup(last_up: DataFrame, job: str = "job") -> DataFrame:
    """A job is up only if every one of its targets is."""
    return last_up.groupBy(job).agg(F.bool_and(F.col("value") == 1.0).alias("up"),
                                    F.count(F.lit(1)).cast("bigint").alias("n_targets"))


def host_health(cpu: DataFrame, memory: DataFrame, disk: DataFrame, up: DataFrame, role: str = "role") -> DataFrame:
    """Full outer merge by role; a role missing from a source stays unknown (null)."""
    parts = [cpu.select(role, F.col("value").alias("cpu_pct")),
             memory.select(role, F.col("value").alias("memory_pct")),
             disk.select(role, F.col("value").alias("disk_pct")),
             up.select(role, F.col("up"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, role, "full_outer")
    return out


def health_band(pct) -> Column:
    """> 90 red, > 75 amber, else green (null stays unknown)."""
    c = F.col(pct) if isinstance(pct, str) else pct
    return F.when(c > RED_ABOVE, "red").when(c > AMBER_ABOVE, "amber").when(c.isNotNull(), "green")


def bad_state_union(phases: DataFrame, waiting: DataFrame) -> DataFrame:
    """Pods in a failed/unknown phase, or waiting for a bad reason."""
    a = phases.where(F.col("phase").isin(list(BAD_PHASES)) & (F.col("value") > 0)).select(
        "pod", F.col("phase").alias("state"))
    b = waiting.where(F.col("reason").isin(list(BAD_WAITING_REASONS)) & (F.col("value") > 0)).select(
        "pod", F.col("reason").alias("state"))
    return a.unionByName(b)


def production_gauges(samples: DataFrame, versions: DataFrame, pattern: str, domain: str) -> DataFrame:
    """Samples whose name matches, of one domain and of the version holding the
    production alias (joined from the versions table)."""
    prod = versions.where(F.array_contains("aliases", "production")).select(
        F.col("version").cast("string").alias("_v"))
    s = samples.where(F.col("name").rlike(pattern) & (F.element_at("labels", "domain") == domain))
    return s.join(F.broadcast(prod), F.element_at(s["labels"], "model_version") == F.col("_v")).drop("_v")


def desired_vs_available(desired: DataFrame, available: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two series side by side and their difference."""
    j = desired.select(*keys, F.col("value").alias("desired")).join(
        available.select(*keys, F.col("value").alias("available")), list(keys), "full_outer")
    return j.withColumn("missing", F.col("desired") - F.coalesce("available", F.lit(0.0)))


def out_of_sync_apps(apps: DataFrame) -> DataFrame:
    """Max by (name, sync, health) over apps not Synced or not Healthy."""
    bad = apps.where((F.col("sync_status") != "Synced") | (F.col("health_status") != "Healthy"))
    return bad.groupBy("name", "sync_status", "health_status").agg(F.max("value").alias("value"))


def topk(samples: DataFrame, k: int, value: str = "value") -> DataFrame:
    """The k highest values (a top-k; Spark plans TakeOrderedAndProject, each task keeps
    k rows)."""
    return samples.orderBy(F.col(value).desc(), *[F.col(c) for c in samples.columns if c != value]).limit(k)
