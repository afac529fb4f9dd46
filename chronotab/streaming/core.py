"""Structured Streaming forms of the log, scoring and monitoring flows.

Each operator takes a streaming DataFrame and returns one; ``run_to_table`` drives a stream to
completion (``availableNow``) into Parquet in the shared checkpoint folder and reads the result
back, which is how the stream twins are compared with their batch operators.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chronotab.session import ensure_checkpoint_dir


def stream_table(spark: SparkSession, sf_dir: str, name: str, schema: StructType | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A driver table as a file stream. A file source needs a folder or a glob, so the single
    Parquet file is addressed by a glob on its own name."""
    path = f"{sf_dir.rstrip('/')}/{name}.parque[t]"
    schema = schema or spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


LOG_FOLDERS = StructType([StructField("domain", StringType()), StructField("day", StringType())])


def stream_prediction_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """M1: the append-only day files (``<path>/domain=/day=``) as a stream: files are picked up as they
    land, also between runs from one checkpoint. ``ts`` is the record's time; a record that does not
    parse has nulls."""
    folders = StructType([f for f in LOG_FOLDERS.fields if f.name not in schema.names])
    log = spark.readStream.schema(StructType(schema.fields + folders.fields)).json(path)
    return log.withColumn("ts", F.to_timestamp("timestamp"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for one stream run."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def drain(df: DataFrame, base: str, output_mode: str = "append", foreach_batch: Callable | None = None) -> None:
    """Start a stream from the checkpoint below ``base``, let it take all input there is, however long
    that takes, and stop. Results go to Parquet below ``base``, never to the driver's memory. A failed
    stream raises."""
    w = df.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).outputMode(output_mode)
    if foreach_batch is not None:
        q = w.foreachBatch(lambda batch, epoch: foreach_batch(batch, epoch, f"{base}/out")).start()
    else:
        q = w.format("parquet").option("path", f"{base}/out").start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def results(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """What streams wrote below ``base``; an empty table if they wrote nothing."""
    try:
        return spark.read.parquet(f"{base}/out")
    except AnalysisException as fault:
        if fault.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def run_to_table(df: DataFrame, name: str, output_mode: str = "append",
                 foreach_batch: Callable | None = None) -> DataFrame:
    """Run a stream over all available input and return the written table as a batch DataFrame."""
    base = scratch_path(df.sparkSession, name)
    drain(df, base, output_mode, foreach_batch)
    return results(df.sparkSession, base, df.schema)


def land(df: DataFrame, folder: str, files: int = 4) -> None:
    """Adds the rows of ``df`` to a folder that a file stream watches, as ``files`` files."""
    df.repartition(files).write.mode("append").parquet(folder)


def run_arrivals(spark: SparkSession, name: str, arrivals: Sequence[Callable[[str], None]],
                 build: Callable[[str], DataFrame], output_mode: str = "append",
                 foreach_batch: Callable | None = None) -> DataFrame:
    """Data that arrives while nothing runs: each of ``arrivals`` adds files below a folder, then the
    stream ``build`` makes of that folder is started from its checkpoint, takes what is new and stops."""
    base = scratch_path(spark, name)
    for arrive in arrivals:
        arrive(f"{base}/in")
        stream = build(f"{base}/in")
        drain(stream, base, output_mode, foreach_batch)
    return results(spark, base, stream.schema)


def run_until_quiet(df: DataFrame, name: str, timeout_s: int = 600) -> DataFrame:
    """Run a stream with timers on the machine's clock until its input is used up and no key has state
    left, and return what it wrote. Raises after ``timeout_s`` seconds."""
    spark = df.sparkSession
    base = scratch_path(spark, name)
    q = (df.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(processingTime="200 milliseconds")
         .outputMode("append").format("parquet").option("path", f"{base}/out").start())
    until = time.monotonic() + timeout_s
    try:
        while q.isActive:
            p = q.lastProgress
            if p and p["batchId"] > 0 and not p["numInputRows"] and all(not s["numRowsTotal"] for s in p["stateOperators"]):
                break
            if time.monotonic() > until:
                raise TimeoutError(f"{name} still has state after {timeout_s} s")
            time.sleep(0.2)
    finally:
        q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return results(spark, base, df.schema)


def tick(df: DataFrame, ts: str, later: str) -> DataFrame:
    """One row of nulls but for ``ts``, ``later`` than the newest of ``df``: it moves the watermark."""
    at = (F.max(ts) + F.expr(f"INTERVAL {later}")).cast(df.schema[ts].dataType)
    return df.agg(at.alias(ts)).select(*[F.col(c.name) if c.name == ts else F.lit(None).cast(c.dataType).alias(c.name) for c in df.schema])


def stream_dedup(df: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """M2: first record per key within the watermark delay (state is dropped once the
    watermark passes, so it stays bounded)."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def stream_counters(df: DataFrame, ts: str, by: list[str], window: str = "1 hour",
                    slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """M6 (L6, L7): counts per tumbling (or sliding) window and labels, emitted once the
    watermark closes the window."""
    w = F.window(F.col(ts), window, slide) if slide else F.window(F.col(ts), window)
    return (df.withWatermark(ts, delay).groupBy(w.alias("w"), *by)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n"))


def stream_outcome_join(predictions: DataFrame, outcomes: DataFrame, key: str, pred_ts: str,
                        outcome_ts: str, max_delay: str, pred_delay: str = "1 day",
                        outcome_delay: str = "1 day") -> DataFrame:
    """M5: a prediction meets its outcome when the outcome arrives within ``max_delay`` after
    it. Both sides carry watermarks and the join has a time-range condition, so state for a
    key is dropped once it can no longer match. Project to the needed columns first."""
    p = predictions.withWatermark(pred_ts, pred_delay).alias("p")
    o = outcomes.withWatermark(outcome_ts, outcome_delay).alias("o")
    cond = ((F.col(f"p.{key}") == F.col(f"o.{key}")) &
            (F.col(f"o.{outcome_ts}") >= F.col(f"p.{pred_ts}")) &
            (F.col(f"o.{outcome_ts}") <= F.col(f"p.{pred_ts}") + F.expr(f"INTERVAL {max_delay}")))
    return p.join(o, cond, "inner").select("p.*", *[F.col(f"o.{c}") for c in outcomes.columns if c != key])


class StreamTables:
    """Driver tables as streams, with the same attribute access as ``sources.tables.Tables``,
    so the batch mappings (``plans.driver``) build their streaming twins unchanged."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return stream_table(self.spark, self.sf_dir, name)
