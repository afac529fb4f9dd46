"""Prediction log, requests, outcomes and gauge sinks/sources."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

LOG_SCHEMA = StructType([
    StructField("request_id", StringType()),
    StructField("entity_id", StringType()),
    StructField("model_name", StringType()),
    StructField("model_version", StringType()),
    StructField("score", DoubleType()),
    StructField("decision", StringType()),
    StructField("threshold", DoubleType()),
    StructField("feature_vector", MapType(StringType(), StringType())),
    StructField("traffic_source", StringType()),
    StructField("client", StringType()),
    StructField("timestamp", StringType()),
])

OUTCOME_SCHEMA = StructType([StructField("id", StringType()), StructField("outcome", IntegerType())])


def write_prediction_log(records: DataFrame, path: str, domain_col: str = "domain",
                         mode: str = "append") -> None:
    """A6 (batch form of M1's sink): JSON lines partitioned by domain and UTC day, so a
    windowed read prunes day folders."""
    day = F.date_format(F.to_timestamp("timestamp"), "yyyy-MM-dd")
    records.withColumn("day", day).write.mode(mode).partitionBy(domain_col, "day").json(path)


def read_prediction_log(spark: SparkSession, paths: list[str], domain: str,
                        since: dt.datetime | None = None) -> DataFrame:
    """A7 + C13: read every copy of the log (first path = first copy), skip day folders before
    ``since``'s date (partition pruning) and records before ``since``; first copy wins per
    request id, and within a copy the last record in (day, timestamp) order wins (T10).

    Dedup is an aggregate (``max_by`` over a priority struct), so a hot request id is combined
    map-side instead of being sorted in one task."""
    parts = []
    for i, p in enumerate(paths):
        df = spark.read.schema(LOG_SCHEMA).json(p)  # partition columns domain/day are appended
        df = df.where(F.col("domain") == domain) if "domain" in df.columns else df
        if since is not None and "day" in df.columns:
            df = df.where(F.col("day") >= since.strftime("%Y-%m-%d"))
        parts.append(df.withColumn("_copy", F.lit(i)))
    log = parts[0]
    for p in parts[1:]:
        log = log.unionByName(p, allowMissingColumns=True)
    log = log.withColumn("_ts", F.to_timestamp("timestamp"))
    out = dedup_log(log, order_cols=["day", "_ts"] if "day" in log.columns else ["_ts"])
    if since is not None:  # after the dedup: a newer copy of an id never revives an old winner
        out = out.where(F.col("_ts") >= F.lit(since))
    return out.drop("_ts")


def dedup_log(log: DataFrame, key: str = "request_id", copy: str = "_copy",
              order_cols: list[str] | None = None) -> DataFrame:
    """Per key, the lowest copy wins; inside it the record latest in ``order_cols``."""
    order_cols = order_cols or []
    cols = [c for c in log.columns if c != key]
    # the record's own text decides between records alike in copy and order
    prio = F.struct((-F.col(copy)).alias("_c"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                    F.to_json(F.struct(*cols)).alias("_all"))
    best = log.groupBy(key).agg(F.max_by(F.struct(*cols), prio).alias("_r"))
    return best.select(key, "_r.*").drop(copy)


def flatten_features(log: DataFrame, reference_schema: StructType, score: str = "score",
                     vector: str = "feature_vector") -> DataFrame:
    """The feature map to one typed column per reference column (a missing key or an
    uncastable value is null), plus the score."""
    return log.select(*[F.element_at(F.col(vector), F.lit(f.name)).try_cast(f.dataType).alias(f.name)
                        for f in reference_schema.fields if f.name != score], F.col(score))


def write_requests(requests: DataFrame, path: str, n_files: int | None = None) -> None:
    """Nested requests as gzip JSON lines. Gzip is not splittable, so write many files
    (one per task) rather than one large file."""
    out = requests.select(F.to_json(F.struct(*requests.columns), {"ignoreNullFields": "false"}).alias("value"))
    if n_files:
        out = out.repartition(n_files)
    out.write.mode("overwrite").option("compression", "gzip").text(path)


def read_requests(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A10: read them back with the request schema; blank lines are skipped."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def write_outcomes(outcomes: DataFrame, path: str) -> None:
    """A11 sink: ``(id, outcome)`` CSV."""
    outcomes.select(F.col("id").cast("string"), F.col("outcome").cast("int")) \
        .write.mode("overwrite").option("header", True).csv(path)


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """A11 source: the id is always read as a string."""
    return spark.read.schema(OUTCOME_SCHEMA).option("header", True).csv(path)


GAUGE_SCHEMA = "job string, domain string, name string, labels map<string,string>, ts timestamp, value double"


def replace_gauges(samples: DataFrame, path: str) -> None:
    """Replace a job's whole metric group: dynamic partition overwrite on (job, domain)
    leaves every other group's files alone."""
    samples.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job", "domain").parquet(path)


def merge_gauge(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """Heartbeat update: replace the updated (name, labels) series, keep the rest.
    Map columns cannot be join keys, so series are matched on their labels as JSON."""
    key = F.to_json(F.array_sort(F.map_entries("labels")))
    old = existing.withColumn("_series", F.concat_ws("|", "job", "domain", "name", key))
    new = updates.withColumn("_series", F.concat_ws("|", "job", "domain", "name", key))
    kept = old.join(new.select("_series").distinct(), "_series", "left_anti")
    return kept.unionByName(new).drop("_series")


PUSHES = "push string, at long, job string, domain string, kind string"


def stage_push(samples: DataFrame, root: str, push: str) -> None:
    """First half of a push: its samples in a folder of their own, which no reader looks at yet."""
    samples.select("job", "domain", "name", "labels", "ts", "value").write.mode("overwrite").parquet(f"{root.rstrip('/')}/data/push={push}")


def commit_push(spark: SparkSession, root: str, push: str, groups: Sequence[tuple[str, str]], kind: str, at: int) -> None:
    """Second half: one small file, which appears whole or not at all, makes the push visible."""
    rows = [(push, at, job, domain, kind) for job, domain in groups]
    spark.createDataFrame(rows, PUSHES).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/pushes")


def push_gauges(samples: DataFrame, root: str, groups: Sequence[tuple[str, str]], kind: str = "replace", at: int | None = None) -> str:
    """A12 / A13 with readers and writers beside each other: ``kind`` ``replace`` puts ``samples`` in place of
    all the (job, domain) ``groups`` hold, also where there are none left; ``merge`` replaces only the
    series that it names. Pushes are added, never rewritten: a reader sees each whole or not at all, and
    parallel merges both hold. ``at`` orders pushes (microseconds; now, if not given)."""
    push = uuid.uuid4().hex
    stage_push(samples, root, push)
    commit_push(samples.sparkSession, root, push, groups, kind, time.time_ns() // 1000 if at is None else at)
    return push


def read_gauges(spark: SparkSession, root: str) -> DataFrame:
    """The samples that hold: of each group the newest replacement and the merges after it, of each
    series the newest push. The list of pushes is read once, so the result is one moment's state."""
    base = root.rstrip("/")
    pushes = spark.read.schema(PUSHES).parquet(f"{base}/pushes")
    start = pushes.where("kind = 'replace'").groupBy("job", "domain").agg(F.max(F.struct("at", "push")).alias("_from"))
    live = (pushes.join(start, ["job", "domain"], "left").where(F.col("_from").isNull() | (F.struct("at", "push") >= F.col("_from")))
            .select("push", "at", "job", "domain").distinct())
    found = [r.asDict() for r in live.collect()]  # pushes since the groups' last replacement
    if not found:
        return spark.createDataFrame([], GAUGE_SCHEMA)
    folders = sorted({f"{base}/data/push={r['push']}" for r in found})
    data = spark.read.schema(GAUGE_SCHEMA).option("basePath", f"{base}/data").parquet(*folders)
    held = data.join(F.broadcast(spark.createDataFrame(found, "push string, at long, job string, domain string")), ["push", "job", "domain"])
    series = F.to_json(F.array_sort(F.map_entries("labels")))
    newest = held.groupBy("job", "domain", "name", series.alias("_series")).agg(
        F.max_by(F.struct(F.to_json("labels").alias("labels"), "ts", "value"), F.struct("at", "push")).alias("r"))
    return newest.select("job", "domain", "name", F.from_json("r.labels", "map<string,string>").alias("labels"), "r.ts", "r.value")


def write_reference_snapshot(train_rows: DataFrame, root: str, model_version: str) -> str:
    """The exact train rows, saved beside the model version."""
    path = f"{root.rstrip('/')}/model_version={model_version}"
    train_rows.write.mode("overwrite").parquet(path)
    return path


def read_reference_snapshot(spark: SparkSession, root: str, model_version: str,
                            features_path: str, split_col: str = "SPLIT") -> DataFrame:
    """The snapshot if it exists, else the feature table's train rows."""
    try:
        return spark.read.parquet(f"{root.rstrip('/')}/model_version={model_version}")
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(features_path).where(F.col(split_col) == "train")


__all__ = ["LOG_SCHEMA", "OUTCOME_SCHEMA", "LongType"]
