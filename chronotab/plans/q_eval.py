"""Registered evaluation queries: orders as a scored table.

score = o_totalprice / 500000, y = urgent priority, groups = split by order date, slices =
order status and the customer's market segment.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from chronotab.operators import evaluate as H
from chronotab.operators.order import numpy_q
from chronotab.operators.splits import split_label
from chronotab.plans import driver as D
from chronotab.plans.catalog import register
from chronotab.plans.sqlparts import split_case

CFG = D.ORDERS_EVAL
SLICES = ("o_orderstatus", "c_mktsegment")
CFG_SLICED = H.EvalConfig(**{**CFG.__dict__, "slices": tuple(
    H.SliceConfig(c, 0.05) for c in SLICES)})

SCORED_SQL = f"""SELECT o.o_orderkey, CAST(o.o_orderpriority = '{D.URGENT}' AS INTEGER) AS y,
  o.o_totalprice / 500000.0 AS score, o.o_orderstatus, c.c_mktsegment,
  {split_case('o.o_orderdate', D.CUSTOMER_SPLIT)} AS SPLIT
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""


def scored(t):
    o, c = t.orders, t.customer
    return o.join(c.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey").select(
        "o_orderkey", (F.col("o_orderpriority") == D.URGENT).cast("int").alias("y"),
        (F.col("o_totalprice") / F.lit(500000.0)).alias("score"), "o_orderstatus", "c_mktsegment",
        split_label("o_orderdate", D.CUSTOMER_SPLIT).alias("SPLIT"))


def _dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def steps_sql(src: str, by: list[str]) -> str:
    """score_steps in SQL (ordinary windows; independent of the range-bucket plan)."""
    k = ", ".join(by)
    return f"""g AS (SELECT {k}, CAST(score AS DOUBLE) AS score, sum(y) AS p, count(*) - sum(y) AS n
  FROM ({src}) WHERE score IS NOT NULL AND y IS NOT NULL GROUP BY {k}, CAST(score AS DOUBLE)),
st AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp, row_number() OVER w - 1 AS pos,
  sum(p) OVER (PARTITION BY {k}) AS tot_pos, sum(n) OVER (PARTITION BY {k}) AS tot_neg,
  count(*) OVER (PARTITION BY {k}) AS n_steps
  FROM g WINDOW w AS (PARTITION BY {k} ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


def auc_sql(by: list[str]) -> str:
    k = ", ".join(by)
    return f"""auc AS (SELECT {k},
  CASE WHEN max(tot_pos) > 0 AND max(tot_neg) > 0 THEN CAST(sum(CAST(n AS HUGEINT) * (2 * tp - p)) AS DOUBLE)
    / CAST(2 * CAST(max(tot_pos) AS HUGEINT) * max(tot_neg) AS DOUBLE) END AS roc_auc,
  CASE WHEN max(tot_pos) > 0 AND max(tot_neg) > 0 THEN round(sum(CAST(p AS DOUBLE) * (CAST(tp AS DOUBLE)
    / CAST(tp + fp AS DOUBLE))) / CAST(max(tot_pos) AS DOUBLE), 12) END AS pr_auc
  FROM st GROUP BY {k})"""


def kept_sql(by: list[str]) -> str:
    k = ", ".join(by)
    return f"""vt AS (SELECT *, lead(p) OVER (PARTITION BY {k} ORDER BY pos) AS p_next,
  lead(n) OVER (PARTITION BY {k} ORDER BY pos) AS n_next FROM st),
kept AS (SELECT *, CASE WHEN tot_neg <> 0 THEN CAST(fp AS DOUBLE) / CAST(tot_neg AS DOUBLE) END AS fpr,
  CASE WHEN tot_pos <> 0 THEN CAST(tp AS DOUBLE) / CAST(tot_pos AS DOUBLE) END AS tpr FROM vt
  WHERE pos = 0 OR pos = n_steps - 1 OR p_next <> p OR n_next <> n)"""


def rec_sql(by: list[str], target: float) -> str:
    k = ", ".join(by)
    return f"""rec AS (SELECT {k}, coalesce(arg_max(tpr, pos) FILTER (WHERE fpr <= {_dbl(target)}), 0.0)
  AS recall_at_target_fpr FROM kept GROUP BY {k})"""


def threshold_sql(src: str, by: list[str], q: float) -> str:
    k = ", ".join(by)
    return f"""rk AS (SELECT {k}, score, row_number() OVER (PARTITION BY {k} ORDER BY score) - 1 AS r,
  count(*) OVER (PARTITION BY {k}) AS T FROM ({src}) WHERE score IS NOT NULL),
hq AS (SELECT {k}, max(T) AS T, CAST(max(T) - 1 AS DOUBLE) * {_dbl(numpy_q(q))} AS h FROM rk GROUP BY {k}),
ab AS (SELECT hq.{by[0]}{''.join(f', hq.{c}' for c in by[1:])}, h - floor(h) AS gm,
  max(CASE WHEN r = CAST(floor(h) AS BIGINT) THEN score END) AS a,
  max(CASE WHEN r = least(CAST(floor(h) AS BIGINT) + 1, hq.T - 1) THEN score END) AS b
  FROM hq JOIN rk USING ({k}) GROUP BY ALL),
th AS (SELECT {k}, CASE WHEN gm >= 0.5 THEN b - (b - a) * (1.0 - gm) ELSE a + (b - a) * gm END
  AS alert_threshold FROM ab)"""


def metrics_sql(src: str, by: list[str], cfg) -> str:
    k = ", ".join(by)
    return f"""WITH {steps_sql(src, by)}, {auc_sql(by)}, {kept_sql(by)},
{rec_sql(by, cfg.target_fpr)}, {threshold_sql(src, by, 1.0 - cfg.alert_budget_fraction)},
cf AS (SELECT {k}, max(tot_pos) AS tot_pos, max(tot_neg) AS tot_neg, max(alert_threshold) AS alert_threshold,
  sum(CASE WHEN score >= alert_threshold THEN p ELSE 0 END) AS tp,
  sum(CASE WHEN score >= alert_threshold THEN n ELSE 0 END) AS fp FROM st JOIN th USING ({k}) GROUP BY {k})
SELECT {k}, alert_threshold, CAST(tp AS BIGINT) AS true_positive, CAST(tot_pos - tp AS BIGINT) AS false_negative,
  CAST(fp AS BIGINT) AS false_positive, CAST(tot_neg - fp AS BIGINT) AS true_negative,
  CAST(tot_pos + tot_neg AS BIGINT) AS n_rows, CAST(tot_pos AS DOUBLE) / CAST(tot_pos + tot_neg AS DOUBLE) AS positive_rate,
  CAST(tp + fp AS DOUBLE) / CAST(tot_pos + tot_neg AS DOUBLE) AS alert_volume_fraction,
  CAST(tot_pos - tp AS DOUBLE) * {_dbl(float(cfg.cost_of_miss))} + CAST(fp AS DOUBLE) * {_dbl(float(cfg.cost_of_review))} AS expected_cost,
  roc_auc, pr_auc, recall_at_target_fpr
FROM cf JOIN auc USING ({k}) JOIN rec USING ({k})"""


def _metrics(t):
    return H.compute_metrics(scored(t), CFG, by=["SPLIT"])


METRICS_SQL = metrics_sql(SCORED_SQL, ["SPLIT"], CFG)


@register("metrics_at_alert_budget", METRICS_SQL, "H1-H8 H4 H5 H6 H7 P1 P8")
def q_metrics(t):
    """All decision metrics per split at the alert budget."""
    return _metrics(t)


@register("roc_auc", f"WITH {steps_sql(SCORED_SQL, ['SPLIT'])}, {auc_sql(['SPLIT'])} "
                     "SELECT SPLIT, roc_auc FROM auc", "H1")
def q_roc_auc(t):
    """ROC-AUC per split (ties at half weight)."""
    return H.auc_table(H.score_steps(scored(t), by=["SPLIT"]), ["SPLIT"]).select("SPLIT", "roc_auc")


@register("average_precision", f"WITH {steps_sql(SCORED_SQL, ['SPLIT'])}, {auc_sql(['SPLIT'])} "
                               "SELECT SPLIT, pr_auc FROM auc", "H2")
def q_ap(t):
    """Step-wise average precision per split."""
    return H.auc_table(H.score_steps(scored(t), by=["SPLIT"]), ["SPLIT"]).select("SPLIT", "pr_auc")


@register("recall_at_fpr", f"WITH {steps_sql(SCORED_SQL, ['SPLIT'])}, {kept_sql(['SPLIT'])}, "
                           f"{rec_sql(['SPLIT'], CFG.target_fpr)} SELECT * FROM rec", "H3 T9")
def q_recall(t):
    """Recall at the last kept ROC vertex with fpr within the target."""
    return H.recall_at_fpr(H.score_steps(scored(t), by=["SPLIT"]), ["SPLIT"], CFG.target_fpr)


SLICE_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS slice_column, CAST({c} AS VARCHAR) AS slice_value, y, score FROM ({SCORED_SQL}) "
    f"WHERE {c} IS NOT NULL" for c in SLICES)
OVERALL = f"SELECT 0 AS one, y, score FROM ({SCORED_SQL})"


def slice_sql(tolerance: float) -> str:
    return f"""WITH {steps_sql(SLICE_LONG, ['slice_column', 'slice_value'])},
{auc_sql(['slice_column', 'slice_value'])},
tot AS (SELECT slice_column, slice_value, max(tot_pos) AS tot_pos, max(tot_neg) AS tot_neg FROM st GROUP BY ALL),
ov AS (WITH {steps_sql(OVERALL, ['one'])}, {auc_sql(['one'])} SELECT roc_auc AS overall_roc_auc, pr_auc AS overall_pr_auc FROM auc),
base AS (SELECT CAST(sum(y) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS overall_positive_rate FROM ({OVERALL}))
SELECT slice_column, slice_value, CAST(tot_pos + tot_neg AS BIGINT) AS n,
  CAST(tot_pos AS DOUBLE) / CAST(tot_pos + tot_neg AS DOUBLE) AS positive_rate, roc_auc, pr_auc, overall_roc_auc, overall_pr_auc, overall_positive_rate,
  CAST({tolerance} AS DOUBLE) AS tolerance, overall_roc_auc - roc_auc <= CAST({tolerance} AS DOUBLE) AS within_tolerance
FROM auc JOIN tot USING (slice_column, slice_value), ov, base"""


SLICE_SQL = slice_sql(0.05)


@register("slice_metrics", SLICE_SQL, "H9 H10 T13")
def q_slices(t):
    """Per slice value: n, positive rate, ROC-AUC, PR-AUC, within tolerance of overall."""
    return H.slice_metrics(scored(t), CFG_SLICED)


@register("outside_tolerance_report", f"SELECT * FROM ({SLICE_SQL}) WHERE within_tolerance IS NOT DISTINCT FROM false",
          "H16")
def q_outside(t):
    """Slice values whose AUC drop exceeds the tolerance."""
    return H.outside_tolerance(H.slice_metrics(scored(t), CFG_SLICED))


@register("outside_tolerance_strict", f"SELECT * FROM ({slice_sql(0.0)}) WHERE within_tolerance IS NOT DISTINCT FROM false", "H16")
def q_outside_strict(t):
    """With no drop tolerated, every slice value below the overall AUC."""
    return H.outside_tolerance(H.slice_metrics(scored(t), H.EvalConfig(**{**CFG.__dict__, "slices": tuple(H.SliceConfig(c, 0.0) for c in SLICES)})))


@register("roc_points", f"WITH {steps_sql(SCORED_SQL, ['SPLIT'])}, {kept_sql(['SPLIT'])} "
                        "SELECT SPLIT, score AS threshold, fpr, tpr FROM kept", "H11")
def q_roc_points(t):
    """ROC vertices per split (collinear points dropped)."""
    return H.roc_curve_points(scored(t), by=["SPLIT"])


@register("pr_points", f"""WITH {steps_sql(SCORED_SQL, ['SPLIT'])},
ff AS (SELECT SPLIT, min(pos) AS last FROM st WHERE tp = tot_pos GROUP BY SPLIT)
SELECT SPLIT, score AS threshold, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,
  CASE WHEN tot_pos <> 0 THEN CAST(tp AS DOUBLE) / CAST(tot_pos AS DOUBLE) END AS recall,
  CAST(tot_pos AS DOUBLE) / CAST(tot_pos + tot_neg AS DOUBLE) AS base_rate
FROM st JOIN ff USING (SPLIT) WHERE pos <= last""", "H12")
def q_pr_points(t):
    """Precision and recall per distinct threshold until full recall."""
    return H.pr_curve_points(scored(t), by=["SPLIT"])


def _quantile_sql(src: str, by: list[str], probs: list[float]) -> str:
    k = ", ".join(by)
    qs = " UNION ALL ".join(f"SELECT {i} AS qi, {_dbl(numpy_q(q))} AS q" for i, q in enumerate(probs))
    return f"""rk AS (SELECT {k}, score, row_number() OVER (PARTITION BY {k} ORDER BY score) - 1 AS r,
  count(*) OVER (PARTITION BY {k}) AS T FROM ({src}) WHERE score IS NOT NULL),
hq AS (SELECT {k}, max(T) AS T FROM rk GROUP BY {k}),
qq AS (SELECT hq.*, qs.qi, qs.q, CAST(T - 1 AS DOUBLE) * qs.q AS h FROM hq, ({qs}) qs),
ab AS (SELECT qq.{by[0]}{''.join(f', qq.{c}' for c in by[1:])}, qq.qi, qq.h - floor(qq.h) AS gm,
  max(CASE WHEN r = CAST(floor(qq.h) AS BIGINT) THEN score END) AS a,
  max(CASE WHEN r = least(CAST(floor(qq.h) AS BIGINT) + 1, qq.T - 1) THEN score END) AS b
  FROM qq JOIN rk USING ({k}) GROUP BY ALL),
edges AS (SELECT {k}, qi, CASE WHEN gm >= 0.5 THEN b - (b - a) * (1.0 - gm) ELSE a + (b - a) * gm END AS v FROM ab)"""


CAL_PROBS = [i / 10 for i in range(11)]


@register("calibration_deciles", f"""WITH {_quantile_sql(SCORED_SQL, ['SPLIT'], CAL_PROBS)},
binned AS (SELECT s.SPLIT, s.y, s.score,
  (SELECT count(*) FROM edges e WHERE e.SPLIT = s.SPLIT AND e.qi > 0 AND e.qi < 10 AND e.v < s.score) AS bin
  FROM ({SCORED_SQL}) s WHERE s.score IS NOT NULL AND s.y IS NOT NULL)
SELECT SPLIT, CAST(bin AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n,
  round(sum(score) / CAST(count(*) AS DOUBLE), 12) AS mean_score,
  CAST(sum(y) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS observed_rate
FROM binned GROUP BY SPLIT, bin""", "H13 P8")
def q_calibration(t):
    """Observed rate and mean score per score decile (exact quantile edges) per split."""
    return H.calibration_table(scored(t), by=["SPLIT"])


@register("score_histogram", f"""WITH s AS (SELECT y, CAST(score AS DOUBLE) AS v FROM ({SCORED_SQL})
  WHERE score IS NOT NULL AND y IS NOT NULL),
m AS (SELECT max(v) AS mx FROM s),
e AS (SELECT y, v, mx, CASE WHEN CAST(floor(v * (49.0 / mx)) AS BIGINT) >= 49 THEN 48
  ELSE CAST(floor(v * (49.0 / mx)) AS BIGINT) END AS i0 FROM s, m WHERE v >= 0 AND v <= mx),
e1 AS (SELECT *, CASE WHEN v < (CASE WHEN i0 = 49 THEN mx ELSE CAST(i0 AS DOUBLE) * (mx / 49.0) END)
  THEN i0 - 1 ELSE i0 END AS i1 FROM e),
e2 AS (SELECT *, CASE WHEN v >= (CASE WHEN i1 + 1 = 49 THEN mx ELSE CAST(i1 + 1 AS DOUBLE) * (mx / 49.0) END)
  AND i1 <> 48 THEN i1 + 1 ELSE i1 END AS i FROM e1),
c AS (SELECT y, i, max(mx) AS mx, count(*) AS n FROM e2 GROUP BY y, i),
tot AS (SELECT y, count(*) AS tot FROM s GROUP BY y),
b AS (SELECT c.*, tot.tot, CASE WHEN i = 49 THEN mx ELSE CAST(i AS DOUBLE) * (mx / 49.0) END AS lo,
  CASE WHEN i + 1 = 49 THEN mx ELSE CAST(i + 1 AS DOUBLE) * (mx / 49.0) END AS hi FROM c JOIN tot USING (y))
SELECT y, i AS bin, lo AS bin_low, hi AS bin_high, CAST(n AS BIGINT) AS n,
  CAST(n AS DOUBLE) / (hi - lo) / CAST(tot AS DOUBLE) AS density FROM b""", "H15")
def q_histogram(t):
    """Score density per class over 49 equal bins from 0 to the maximum score."""
    return H.score_histogram(scored(t)).withColumn("y", F.col("y").cast("int"))


@register("confusion_table", f"""WITH m AS ({METRICS_SQL})
SELECT SPLIT, a.actual, a.flagged, a.n, CAST(a.n AS DOUBLE) / CAST(n_rows AS DOUBLE) AS share FROM m,
LATERAL (VALUES (1, 1, true_positive), (1, 0, false_negative), (0, 1, false_positive),
  (0, 0, true_negative)) a(actual, flagged, n)""", "H14 H5")
def q_confusion(t):
    """Counts and shares of the four outcomes at the alert threshold, per split."""
    return H.confusion_table(_metrics(t), ["SPLIT"])
