"""Drift of a current window against a reference population (K1-K9).

PSI is computed for all columns at once (P7): both tables are unpivoted to
``(column_name, value)``, the reference deciles of every numeric column come from one exact
quantile pass, values are binned against them, and bin shares are compared with a full outer
join. Our binning (T8): ten bins at the reference deciles with duplicate edges merged, a value
above an edge moves to the next bin, nulls dropped, shares floored at 1e-4, categorical levels
over the union of both sides, booleans categorical.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from chronotab.config import DriftConfig
from chronotab.operators.sketches import bin_counts, edges_from
from chronotab.operators.order import count_below, exact_quantiles
from chronotab.session import cut_lineage

ROUND = 12


def shared_columns(reference: DataFrame, current: DataFrame) -> list[str]:
    """Columns common to both tables, in reference order."""
    cur = set(current.columns)
    return [c for c in reference.columns if c in cur]


def split_kinds(reference: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric (not boolean) vs categorical by the reference's types."""
    types = {f.name: f.dataType for f in reference.schema.fields}
    num = [c for c in columns if isinstance(types[c], NumericType) and not isinstance(types[c], BooleanType)]
    return num, [c for c in columns if c not in num]


def _long(df: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    stack = ", ".join(f"'{c}', CAST(`{c}` AS {cast})" for c in columns)
    return df.selectExpr(f"stack({len(columns)}, {stack}) AS (column_name, value)").where(
        F.col("value").isNotNull())


def _psi_from_counts(ref_counts: DataFrame, cur_counts: DataFrame, key: list[str], floor: float) -> DataFrame:
    """Shares per bin from counts, floored, PSI = sum (c - r) ln(c / r) per column."""
    def shares(c, name):
        tot = c.groupBy("column_name").agg(F.sum("n").alias("_tot"))
        return c.join(tot, "column_name").select(*key, (F.col("n") / F.col("_tot")).alias(name))

    r, c = shares(ref_counts, "_r"), shares(cur_counts, "_c")
    j = r.join(c, key, "full_outer").select(
        *key, F.greatest(F.coalesce("_r", F.lit(0.0)), F.lit(floor)).alias("_r"),
        F.greatest(F.coalesce("_c", F.lit(0.0)), F.lit(floor)).alias("_c"))
    term = (F.col("_c") - F.col("_r")) * F.log(F.col("_c") / F.col("_r"))
    return j.groupBy("column_name").agg(F.round(F.sum(term), ROUND).alias("psi"))


def psi_numeric(reference: DataFrame, current: DataFrame, columns: Sequence[str],
                cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """K3: ``(column_name, psi)`` for numeric columns."""
    if not columns:
        return reference.sparkSession.createDataFrame([], "column_name string, psi double")
    ref = _long(reference, columns, "DOUBLE")
    cur = _long(current, columns, "DOUBLE")
    probs = [i / cfg.n_bins for i in range(1, cfg.n_bins)]
    edges = exact_quantiles(ref, "value", probs, by=["column_name"]).groupBy("column_name").agg(
        F.array_sort(F.array_distinct(F.collect_list("value"))).alias("_edges"))  # n_bins - 1 values per column

    def counts(df):
        b = df.join(F.broadcast(edges), "column_name").withColumn(
            "bin", count_below("_edges", "value", cfg.n_bins - 1))
        return b.groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("n"))

    return _psi_from_counts(counts(ref), counts(cur), ["column_name", "bin"], cfg.share_floor)


def psi_from_sketches(sketches: DataFrame, current: DataFrame, columns: Sequence[str],
                      cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """K3 against the sketches stored with the reference snapshot: ``(column_name, psi)``. The reference
    rows are not read; bins and their reference shares come from the sketches."""
    own = sketches.where(F.col("column_name").isin(list(columns)))
    edges = edges_from(own, [i / cfg.n_bins for i in range(1, cfg.n_bins)])
    at = F.coalesce(*[F.when(F.col("column_name") == c, F.array(*[F.lit(e) for e in v])) for c, v in edges.items()],
                    F.array().cast("array<double>"))
    cur = _long(current, columns, "DOUBLE").withColumn("_edges", at).withColumn("bin", count_below("_edges", "value", cfg.n_bins - 1))
    return _psi_from_counts(bin_counts(own, edges), cur.groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("n")),
                            ["column_name", "bin"], cfg.share_floor)


def psi_categorical(reference: DataFrame, current: DataFrame, columns: Sequence[str],
                    cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """K4: ``(column_name, psi)`` over the union of levels; booleans are levels too."""
    if not columns:
        return reference.sparkSession.createDataFrame([], "column_name string, psi double")

    def counts(df):
        return _long(df, columns, "STRING").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))

    return _psi_from_counts(counts(reference), counts(current), ["column_name", "value"], cfg.share_floor)


def comparable_columns(current: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """K5: a column all-null in the current window is skipped (one aggregate for all)."""
    if not columns:
        raise ValueError("nothing to compare: the two tables have no column in common")
    row = current.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    keep = [c for i, c in enumerate(columns) if row[f"_{i}"] > 0]
    if not keep:
        raise ValueError("nothing to compare: every common column is null in the current window")
    return keep, [c for c in columns if c not in keep]


def compute_drift(reference: DataFrame, current: DataFrame, cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """K3-K6: ``(column_name, kind, psi, drifted)`` for every comparable shared column."""
    cols, _skipped = comparable_columns(current, shared_columns(reference, current))
    num, cat = split_kinds(reference, cols)
    out = psi_numeric(reference, current, num, cfg).withColumn("kind", F.lit("numeric")).unionByName(
        psi_categorical(reference, current, cat, cfg).withColumn("kind", F.lit("categorical")))
    return out.withColumn("drifted", F.col("psi") > F.lit(cfg.psi_threshold))


def drift_report(reference: DataFrame, current: DataFrame, cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """K5: one row per shared column, ``(column_name, kind, psi, drifted, skipped)``; a column
    without current values is skipped: no number, not drifted."""
    shared = shared_columns(reference, current)
    _, skipped = comparable_columns(current, shared)
    num, _ = split_kinds(reference, shared)
    out = compute_drift(reference, current, cfg).withColumn("skipped", F.lit(False))
    if skipped:
        rows = [(c, "numeric" if c in num else "categorical", None, False, True) for c in skipped]
        out = out.select("column_name", "kind", "psi", "drifted", "skipped").unionByName(
            reference.sparkSession.createDataFrame(rows, "column_name string, kind string, psi double, drifted boolean, skipped boolean"))
    return out.select("column_name", "kind", "psi", "drifted", "skipped")


def dataset_drift(per_column: DataFrame, cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """K6: drifted share and the dataset flag (share >= 0.5)."""
    return per_column.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_columns"),
        F.count_if("drifted").cast("bigint").alias("n_drifted"),
    ).withColumns({
        "drifted_share": F.col("n_drifted").cast("double") / F.col("n_columns").cast("double"),
    }).withColumn("dataset_drift", F.col("drifted_share") >= F.lit(cfg.dataset_share))


def retrain_decision(input_drift, prediction_drift):
    """K9: retrain iff input or prediction drift; never promotes."""
    return F.coalesce(input_drift, F.lit(False)) | F.coalesce(prediction_drift, F.lit(False))


RUN_SCHEMA = ("n_reference bigint, n_current bigint, status string, n_columns bigint, n_drifted bigint, drifted_share double, "
              "dataset_drift boolean, prediction_psi double, prediction_drift boolean, retrain boolean")


def drift_run(reference: DataFrame, current: DataFrame, score: str, cfg: DriftConfig = DriftConfig()) -> tuple[DataFrame, DataFrame]:
    """K2, K6-K9: (one report row, the features' rows of ``compute_drift``).

    Under the minimum of current rows the report says ``no_data``: no numbers and no retrain.
    The score's drift is measured in the same pass as the features'.
    """
    spark = reference.sparkSession
    sizes = (reference.count(), current.count())
    if sizes[1] < cfg.min_current:
        report = spark.createDataFrame([(*sizes, "no_data", None, None, None, None, None, None, False)], RUN_SCHEMA)
        return report, spark.createDataFrame([], "column_name string, kind string, psi double, drifted boolean")
    per = cut_lineage(compute_drift(reference, current, cfg))  # one row a column
    features = per.where(F.col("column_name") != score)
    own = F.col("column_name") == score
    out = per.agg(F.count_if(~own).alias("n_columns"), F.count_if(~own & F.col("drifted")).alias("n_drifted"),
                  F.max(F.when(own, F.col("psi"))).alias("prediction_psi"),
                  F.bool_or(F.when(own, F.col("drifted"))).alias("prediction_drift"))
    share = F.col("n_drifted").cast("double") / F.col("n_columns").cast("double")
    flag = share >= F.lit(cfg.dataset_share)
    report = out.select(F.lit(sizes[0]).cast("bigint").alias("n_reference"), F.lit(sizes[1]).cast("bigint").alias("n_current"),
                        F.lit("ok").alias("status"), "n_columns", "n_drifted", share.alias("drifted_share"), flag.alias("dataset_drift"),
                        "prediction_psi", "prediction_drift", retrain_decision(flag, F.col("prediction_drift")).alias("retrain"))
    return report, features.select("column_name", "kind", "psi", "drifted")
