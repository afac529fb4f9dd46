"""Reference quantiles kept as mergeable sketches beside the reference snapshot.

A sketch (KLL) holds a bounded sample of a column with weights: its size depends on ``k`` only, two
sketches merge into the sketch of both parts, and the rank of a quantile taken from it is off by
``rank_error(k)`` of the rows or less (at 99 % confidence). A drift run reads the sketches, not the
reference rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SKETCH_K = 4096


def rank_error(k: int = SKETCH_K) -> float:
    """The share of the rows by which a quantile's rank may be off (fixed values of the sketch)."""
    return 2.296 / k ** 0.9021


def column_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(by, column_name, n, sketch): one row a group and column, nulls left out. Partial sketches are
    merged map-side, so a group of any size sends one a task."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_v")) for c in columns])
    long = df.select(*by, F.inline(cells)).where("_v is not null and not isnan(_v)")
    return long.groupBy(*by, "column_name").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_v", F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """(column_name, n, sketch) of all parts together."""
    return sketches.groupBy("column_name").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(column_name, q_index, q, value)."""
    asked = F.array(*[F.struct(F.lit(i).alias("q_index"), F.lit(float(q)).alias("q"),
                               F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("value")) for i, q in enumerate(probs)])
    return sketches.select("column_name", F.inline(asked))


def edges_from(sketches: DataFrame, probs: Sequence[float]) -> dict[str, list[float]]:
    """Distinct quantiles of each column in order: columns x probs numbers."""
    found: dict[str, set] = {}
    for r in sketch_quantiles(sketches, probs).collect():
        found.setdefault(r.column_name, set()).add(r.value)
    return {c: sorted(v) for c, v in found.items()}


def bin_counts(sketches: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """(column_name, bin, n): how many of the sketched rows have as many edges strictly below them,
    from the sketch's ranks, without the rows."""
    def upto(e: float) -> Column:
        return F.round(F.col("n") * F.kll_sketch_get_rank_double("sketch", F.lit(float(e)))).cast("bigint")

    none = F.array().cast("array<bigint>")
    ranks = F.coalesce(*[F.when(F.col("column_name") == c, F.array(*[upto(e) for e in v]) if v else none) for c, v in edges.items()], none)
    cum = sketches.select("column_name", F.array_append(ranks, F.col("n")).alias("_cum"))
    each = cum.select("column_name", "_cum", F.posexplode("_cum").alias("bin", "_to"))
    return each.select("column_name", "bin", (F.col("_to") - F.coalesce(F.get("_cum", F.col("bin") - 1), F.lit(0))).alias("n"))


def write_sketches(sketches: DataFrame, root: str, model_version: str) -> str:
    """Beside the version's reference snapshot; parts (days) may be added and are merged on reading."""
    path = f"{root.rstrip('/')}/sketches/model_version={model_version}"
    sketches.write.mode("append").parquet(path)
    return path


def read_sketches(spark: SparkSession, root: str, model_version: str) -> DataFrame:
    return merge_sketches(spark.read.parquet(f"{root.rstrip('/')}/sketches/model_version={model_version}"))
