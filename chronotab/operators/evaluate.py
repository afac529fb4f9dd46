"""Evaluation of scored tables (H1-H16) on one shared sub-plan, ``score_steps``.

``score_steps`` groups rows by score (so repeated scores collapse), then gives each distinct
score, in descending order, the running counts of positives ``tp`` and negatives ``fp`` of all
rows scoring at least that much (P1: range buckets + small offset table, never one task).
Every metric is an aggregate over that table joined to small per-group tables; nothing is
collected to the driver.

Groups (``by``) are model x split for H8, or (slice column, slice value) for H9. Counts and
AUC are exact ratios of integers; sums of per-step doubles (AP, mean score) are rounded to 12
places, the only place where summation order could show.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotab.config import EvalConfig, SliceConfig
from chronotab.session import cut_lineage
from chronotab.operators.order import count_below, exact_quantiles, lerp, numpy_q, prefix_totals

ROUND = 12


def _key(by: Sequence[str]) -> list[str]:
    return list(by) if by else ["_g"]


def _with_key(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df if by else df.withColumn("_g", F.lit(0))


def score_steps(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = (),
                n_buckets: int | None = None) -> DataFrame:
    """``(*key, score, p, n, tp, fp, pos, tot_pos, tot_neg, n_steps)``: per distinct score its positives and
    negatives, inclusive running totals in descending score order, 0-based step position, and
    the group totals. Rows with a null score or label are dropped."""
    key = _key(by)
    src = _with_key(df, by).where(F.col(score).isNotNull() & F.col(y).isNotNull())
    g = src.groupBy(*key, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(y).cast("bigint")).alias("p"),
        F.sum((1 - F.col(y).cast("bigint"))).alias("n"))
    steps = prefix_totals(g, ["score"], {"tp": F.col("p"), "fp": F.col("n")}, partition_by=key,
                          descending=True, position="pos", n_buckets=n_buckets)
    totals = g.groupBy(*key).agg(F.sum("p").alias("tot_pos"), F.sum("n").alias("tot_neg"),
                                 F.count(F.lit(1)).alias("n_steps"))
    # every metric reads this table (AUC, AP, vertices, threshold, confusion): materialise it
    # once in the shared checkpoint folder instead of recomputing it per consumer
    return cut_lineage(steps.join(totals, key))


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def auc_table(steps: DataFrame, by: Sequence[str]) -> DataFrame:
    """H1 + H2 per group: ROC-AUC = sum n * (2 tp - p) / (2 P N) (ties at half weight);
    AP = sum p * tp / (tp + fp) / P. Null when a class is missing."""
    key = _key(by)
    d = "decimal(38,0)"
    agg = steps.groupBy(*key).agg(
        F.first("tot_pos").alias("tot_pos"), F.first("tot_neg").alias("tot_neg"),
        F.sum(F.col("n").cast(d) * (2 * F.col("tp") - F.col("p")).cast(d)).alias("_auc_num"),
        F.sum(F.col("p").cast("double") * (F.col("tp").cast("double") /
                                           (F.col("tp") + F.col("fp")).cast("double"))).alias("_ap"))
    both = (F.col("tot_pos") > 0) & (F.col("tot_neg") > 0)
    return agg.select(
        *key,
        F.when(both, _ratio(F.col("_auc_num"), F.lit(2) * F.col("tot_pos").cast(d) * F.col("tot_neg").cast(d))).alias("roc_auc"),
        F.when(both, F.round(F.col("_ap") / F.col("tot_pos").cast("double"), ROUND)).alias("pr_auc"))


def roc_vertices(steps: DataFrame, by: Sequence[str]) -> DataFrame:
    """ROC points after dropping collinear ones (T9): keep a step iff the next step's p or n
    differs from its own, plus the first and last. The next step comes from an equi-join on
    ``pos + 1``, not a global window."""
    key = _key(by)
    nxt = steps.select(*key, (F.col("pos") - 1).alias("pos"), F.col("p").alias("_p_next"),
                       F.col("n").alias("_n_next"))
    s = steps.join(nxt, [*key, "pos"], "left")
    keep = ((F.col("pos") == 0) | (F.col("pos") == F.col("n_steps") - 1) |
            (F.col("_p_next") != F.col("p")) | (F.col("_n_next") != F.col("n")))
    return s.where(keep).select(
        *key, "score", "tp", "fp", "pos", "tot_pos", "tot_neg",
        _ratio(F.col("fp"), F.col("tot_neg")).alias("fpr"), _ratio(F.col("tp"), F.col("tot_pos")).alias("tpr"))


def recall_at_fpr(steps: DataFrame, by: Sequence[str], target_fpr: float) -> DataFrame:
    """H3: tpr at the last kept ROC vertex with fpr <= target; 0 at the origin."""
    key = _key(by)
    v = roc_vertices(steps, by).where(F.col("fpr") <= F.lit(float(target_fpr)))
    best = v.groupBy(*key).agg(F.max_by("tpr", "pos").alias("_tpr"))
    groups = steps.select(*key).distinct()
    return groups.join(best, key, "left").select(
        *key, F.coalesce("_tpr", F.lit(0.0)).alias("recall_at_target_fpr"))


def alert_threshold(df: DataFrame, score: str, by: Sequence[str], budget: float) -> DataFrame:
    """H4: linear-interpolated quantile of all scores at 1 - budget (exact)."""
    q = exact_quantiles(_with_key(df, by), score, [1.0 - budget], by=_key(by))
    return q.select(*_key(by), F.col("value").alias("alert_threshold"))


def threshold_from_steps(steps: DataFrame, by: Sequence[str], budget: float) -> DataFrame:
    """H4 from the score steps already built: the rows scoring below a step's score are
    ``T - (tp + fp)``, so each distinct score covers a known range of ascending positions and
    the two positions the quantile needs are looked up there (no second ordering pass)."""
    key = _key(by)
    q = numpy_q(1.0 - budget)
    g = steps.groupBy(*key).agg((F.first("tot_pos") + F.first("tot_neg")).alias("_T"))
    g = g.withColumn("_h", (F.col("_T") - 1).cast("double") * F.lit(q))
    g = g.withColumn("_lo", F.floor("_h").cast("bigint"))
    g = g.withColumns({"_hi": F.least(F.col("_lo") + 1, F.col("_T") - 1),
                       "_gm": F.col("_h") - F.col("_lo").cast("double")})
    s = steps.join(g, key).withColumn("_start", F.col("_T") - (F.col("tp") + F.col("fp")))
    s = s.withColumn("_end", F.col("_start") + F.col("p") + F.col("n"))

    def inside(c):
        return (F.col("_start") <= F.col(c)) & (F.col(c) < F.col("_end"))

    ab = s.where(inside("_lo") | inside("_hi")).groupBy(*key, "_gm").agg(
        F.max(F.when(inside("_lo"), F.col("score"))).alias("_a"),
        F.max(F.when(inside("_hi"), F.col("score"))).alias("_b"))
    return ab.select(*key, lerp(F.col("_a"), F.col("_b"), F.col("_gm")).alias("alert_threshold"))


def compute_metrics(df: DataFrame, cfg: EvalConfig, y: str = "y", score: str = "score",
                    by: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """H8: H1-H7 in one row per group."""
    key = _key(by)
    steps = score_steps(df, y, score, by, n_buckets)
    th = threshold_from_steps(steps, by, cfg.alert_budget_fraction)
    conf = (steps.join(th, key)
            .groupBy(*key).agg(
                F.first("tot_pos").alias("tot_pos"), F.first("tot_neg").alias("tot_neg"),
                F.sum(F.when(F.col("score") >= F.col("alert_threshold"), F.col("p")).otherwise(0)).alias("tp"),
                F.sum(F.when(F.col("score") >= F.col("alert_threshold"), F.col("n")).otherwise(0)).alias("fp"),
                F.first("alert_threshold").alias("alert_threshold")))
    conf = conf.select(
        *key, "alert_threshold",
        F.col("tp").cast("bigint").alias("true_positive"),
        (F.col("tot_pos") - F.col("tp")).cast("bigint").alias("false_negative"),
        F.col("fp").cast("bigint").alias("false_positive"),
        (F.col("tot_neg") - F.col("fp")).cast("bigint").alias("true_negative"),
        (F.col("tot_pos") + F.col("tot_neg")).cast("bigint").alias("n_rows"),
        _ratio(F.col("tot_pos"), F.col("tot_pos") + F.col("tot_neg")).alias("positive_rate"))
    conf = conf.withColumns({
        "alert_volume_fraction": _ratio(F.col("true_positive") + F.col("false_positive"), F.col("n_rows")),
        "expected_cost": (F.col("false_negative").cast("double") * F.lit(float(cfg.cost_of_miss)) +
                          F.col("false_positive").cast("double") * F.lit(float(cfg.cost_of_review))),
    })
    out = conf.join(auc_table(steps, by), key).join(recall_at_fpr(steps, by, cfg.target_fpr), key)
    return out.drop("_g") if not by else out


def unpivot_slices(df: DataFrame, slices: Sequence[SliceConfig], y: str, score: str) -> DataFrame:
    """Long form ``(slice_column, slice_value, y, score)``; null slice values dropped."""
    stack = ", ".join(f"'{s.column}', CAST(`{s.column}` AS STRING)" for s in slices)
    return (df.selectExpr(f"stack({len(slices)}, {stack}) AS (slice_column, slice_value)",
                          f"`{y}` AS y", f"`{score}` AS score")
            .where(F.col("slice_value").isNotNull()))


def slice_metrics(df: DataFrame, cfg: EvalConfig, y: str = "y", score: str = "score",
                  n_buckets: int | None = None) -> DataFrame:
    """H9 + H10: per slice value n, positive rate, ROC-AUC, PR-AUC, the same three of all rows, and
    whether the AUC drop from overall is within the column's tolerance; a one-class slice gets nulls (T13)."""
    spark = df.sparkSession
    long = unpivot_slices(df, cfg.slices, y, score)
    by = ["slice_column", "slice_value"]
    steps = score_steps(long, "y", "score", by, n_buckets)
    per = auc_table(steps, by).join(
        steps.groupBy(*by).agg(F.first("tot_pos").alias("tot_pos"), F.first("tot_neg").alias("tot_neg")), by)
    rows = df.select(F.col(y).alias("y"), F.col(score).alias("score"))
    all_steps = score_steps(rows, "y", "score", (), n_buckets)
    totals = all_steps.agg(F.first("tot_pos").alias("_p"), F.first("tot_neg").alias("_n"))
    overall = auc_table(all_steps, ()).join(totals, F.lit(True), "inner").select(  # one row each
        F.struct("roc_auc", "pr_auc", _ratio(F.col("_p"), F.col("_p") + F.col("_n")).alias("positive_rate")).alias("o"))
    tol = spark.createDataFrame([(s.column, float(s.tolerance)) for s in cfg.slices],
                                "slice_column string, tolerance double")
    out = (per.join(F.broadcast(tol), "slice_column")  # one row per configured slice column
           .withColumn("_overall", overall.scalar())
           .withColumn("overall_roc_auc", F.col("_overall.roc_auc")))
    return out.select(
        *by, (F.col("tot_pos") + F.col("tot_neg")).cast("bigint").alias("n"),
        _ratio(F.col("tot_pos"), F.col("tot_pos") + F.col("tot_neg")).alias("positive_rate"),
        "roc_auc", "pr_auc", "overall_roc_auc", F.col("_overall.pr_auc").alias("overall_pr_auc"),
        F.col("_overall.positive_rate").alias("overall_positive_rate"), "tolerance",
        (F.col("overall_roc_auc") - F.col("roc_auc") <= F.col("tolerance")).alias("within_tolerance"))


def outside_tolerance(slices: DataFrame) -> DataFrame:
    """Slice values failing H10 (null passes)."""
    return slices.where(F.col("within_tolerance").eqNullSafe(F.lit(False)))


def roc_curve_points(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Kept ROC vertices (threshold, fpr, tpr)."""
    v = roc_vertices(score_steps(df, y, score, by), by)
    return v.select(*_key(by), F.col("score").alias("threshold"), "fpr", "tpr").drop(*([] if by else ["_g"]))


def pr_curve_points(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at each distinct threshold until full recall, with the base
    rate."""
    s = score_steps(df, y, score, by)
    first_full = s.where(F.col("tp") == F.col("tot_pos")).groupBy(*_key(by)).agg(F.min("pos").alias("_last"))
    s = s.join(first_full, _key(by)).where(F.col("pos") <= F.col("_last"))
    out = s.select(*_key(by), F.col("score").alias("threshold"),
                   _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                   _ratio(F.col("tp"), F.col("tot_pos")).alias("recall"),
                   _ratio(F.col("tot_pos"), F.col("tot_pos") + F.col("tot_neg")).alias("base_rate"))
    return out if by else out.drop("_g")


def calibration_table(df: DataFrame, y: str = "y", score: str = "score", n_bins: int = 10,
                      by: Sequence[str] = ()) -> DataFrame:
    """Bins at exact score quantiles (inner edges, value > edge moves up a bin); mean
    score and observed rate per non-empty bin."""
    key = _key(by)
    src = _with_key(df, by).where(F.col(score).isNotNull() & F.col(y).isNotNull())
    probs = [i / n_bins for i in range(n_bins + 1)]
    edges = exact_quantiles(src, score, probs, by=key).where(
        (F.col("q_index") > 0) & (F.col("q_index") < n_bins))
    inner = edges.groupBy(*key).agg(F.array_sort(F.collect_list("value")).alias("_edges"))  # n_bins - 1 values
    binned = src.join(F.broadcast(inner), key).withColumn(  # one row of edges per group
        "bin", count_below("_edges", F.col(score).cast("double"), n_bins - 1).cast("bigint"))
    out = binned.groupBy(*key, "bin").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.round(F.sum(F.col(score).cast("double")) / F.count(F.lit(1)).cast("double"), ROUND).alias("mean_score"),
        (F.sum(F.col(y).cast("bigint")).cast("double") / F.count(F.lit(1)).cast("double")).alias("observed_rate"))
    return out if by else out.drop("_g")


def confusion_table(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The four counts at the alert threshold and their shares of the total."""
    stack = ("stack(4, 1, 1, true_positive, 1, 0, false_negative, 0, 1, false_positive, "
             "0, 0, true_negative) AS (actual, flagged, n)")
    long = metrics.selectExpr(*by, "n_rows", stack)
    return long.select(*by, "actual", "flagged", "n",
                       (F.col("n").cast("double") / F.col("n_rows").cast("double")).alias("share"))


def score_histogram(df: DataFrame, y: str = "y", score: str = "score", n_edges: int = 50) -> DataFrame:
    """Np.histogram on linspace(0, max score, 50) per class with density=True; only
    non-empty bins are listed. Bin from (v * bins / max), corrected against the edges as numpy
    does; the last bin is closed."""
    nb = n_edges - 1
    src = df.where(F.col(score).isNotNull() & F.col(y).isNotNull()).select(
        F.col(y).cast("int").alias("y"), F.col(score).cast("double").alias("v"))
    w = src.withColumn("_max", src.agg(F.max("v")).scalar())  # scalar subquery, evaluated once
    step = F.col("_max") / F.lit(float(nb))

    def edge(i):
        return F.when(i == nb, F.col("_max")).otherwise(i.cast("double") * step)

    idx = F.floor(F.col("v") * (F.lit(float(nb)) / F.col("_max"))).cast("bigint")
    idx = F.when(idx >= nb, F.lit(nb - 1)).otherwise(idx)
    w = w.where((F.col("v") >= 0) & (F.col("v") <= F.col("_max"))).withColumn("_i", idx)
    w = w.withColumn("_i", F.when(F.col("v") < edge(F.col("_i")), F.col("_i") - 1).otherwise(F.col("_i")))
    w = w.withColumn("_i", F.when((F.col("v") >= edge(F.col("_i") + 1)) & (F.col("_i") != nb - 1),
                                  F.col("_i") + 1).otherwise(F.col("_i")))
    counts = w.groupBy("y", "_i", "_max").agg(F.count(F.lit(1)).alias("n"))
    tot = src.groupBy("y").agg(F.count(F.lit(1)).alias("_tot"))
    c = counts.join(tot, "y")
    width = edge(F.col("_i") + 1) - edge(F.col("_i"))
    return c.select("y", F.col("_i").alias("bin"), edge(F.col("_i")).alias("bin_low"),
                    edge(F.col("_i") + 1).alias("bin_high"), F.col("n").cast("bigint").alias("n"),
                    (F.col("n").cast("double") / width / F.col("_tot").cast("double")).alias("density"))
