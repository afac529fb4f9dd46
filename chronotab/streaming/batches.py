"""Micro-batch sinks: drift counts (M7) and the scoring flow (M10), via ``foreachBatch``.

Spark runs an epoch again when it stopped before the epoch was committed. A sink here writes an
epoch to a partition of its own (``epoch=<n>``) and overwrites it, so an epoch that is run twice
counts once, and readers find ``epoch`` as a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotab.functions.scalar import decide
from chronotab.operators.contracts import Contract, _checks
from chronotab.session import cut_lineage


def write_epoch(rows: DataFrame, epoch: int, out: str) -> None:
    """The rows of one epoch, in place of what an earlier run of the same epoch wrote."""
    rows.write.mode("overwrite").parquet(f"{out.rstrip('/')}/epoch={epoch}")


def drift_counts_writer(edges: DataFrame, columns: Sequence[str], ts: str, day_col: str = "day"):
    """M7: a ``foreachBatch`` function writing per (day, column, bin) counts of each batch,
    binned against the reference edges (a small table: columns x deciles). PSI per day is then
    computed from the accumulated counts (``drift.psi_from_counts``) as a batch job."""
    edges = cut_lineage(edges)  # once, not in every micro-batch

    def write(batch: DataFrame, epoch: int, out: str) -> None:
        stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
        long = batch.selectExpr(f"CAST(to_date({ts}) AS STRING) AS {day_col}",
                                f"stack({len(columns)}, {stack}) AS (column_name, value)").where("value IS NOT NULL")
        binned = long.join(F.broadcast(edges), "column_name").withColumn(
            "bin", F.size(F.filter("_edges", lambda e: e < F.col("value"))))
        counts = binned.groupBy(day_col, "column_name", "bin").agg(F.count(F.lit(1)).alias("n"))
        write_epoch(counts, epoch, out)
    return write


def decisions_writer(contract: Contract, model: PipelineModel | Column, threshold: float, key: str,
                     quarantine_path: str | None = None):
    """Each micro-batch is validated (rows failing a contract check are quarantined), scored by a
    fitted model or a column expression, thresholded and written to the prediction log."""
    def write(batch: DataFrame, epoch: int, out: str) -> None:
        bad = F.lit(False)
        for _, _, fail, _ in _checks(batch, contract):
            bad = bad | F.coalesce(fail, F.lit(False))
        marked = batch.withColumn("_bad", bad)
        if quarantine_path:
            write_epoch(marked.where("_bad").drop("_bad"), epoch, quarantine_path)
        good = marked.where(~F.col("_bad")).drop("_bad")
        if isinstance(model, Column):
            rec = good.select(F.col(key).cast("string").alias("request_id"), model.cast("double").alias("score"))
        else:
            rec = model.transform(good).select(F.col(key).cast("string").alias("request_id"),
                                               vector_to_array("_prob")[1].alias("score"))
        write_epoch(rec.withColumns({"decision": decide("score", threshold), "threshold": F.lit(float(threshold))}), epoch, out)
    return write
