"""Registered governance and modelling queries on scored orders."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from chronotab.functions.fixedpoint import mean_from, scaled
from chronotab.operators import evaluate as H
from chronotab.operators import governance as J
from chronotab.operators import models as I
from chronotab.operators import versions as V
from chronotab.operators.binning import bins_table, fit_bins, woe_of
from chronotab.plans import driver as D
from chronotab.plans.catalog import register
from chronotab.plans.q_monitor import edges_sql
from chronotab.session import cut_lineage, ensure_checkpoint_dir
from chronotab.plans.q_eval import CFG, METRICS_SQL, SCORED_SQL, SLICES, auc_sql, steps_sql, scored

MODEL = "price_v1"
# Fixed coefficients of the linear model whose reason codes are reported.
COEFFICIENTS = {"o_totalprice": 0.00001, "c_acctbal": -0.0002, "n_lines": 0.3}
SCALES = {"o_totalprice": 2, "c_acctbal": 2, "n_lines": 0}
WOE_EDGES = {"o_totalprice": [50000.0, 100000.0, 200000.0, 300000.0],
             "c_acctbal": [0.0, 2500.0, 5000.0, 7500.0],
             "n_lines": [2.0, 4.0, 6.0]}
CFG_TEST_SLICES = H.EvalConfig(**{**CFG.__dict__, "slices": tuple(H.SliceConfig(c, 0.05) for c in SLICES)})

FEATURES_SQL = f"""SELECT s.*, o.o_totalprice, c.c_acctbal, CAST(coalesce(l.n, 0) AS DOUBLE) AS n_lines
FROM ({SCORED_SQL}) s JOIN orders o USING (o_orderkey) JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = s.o_orderkey"""


def order_features(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"))
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    f = scored(t).join(o, "o_orderkey").join(c, "o_custkey").join(
        lines.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    return f.withColumn("n_lines", F.coalesce(F.col("_n"), F.lit(0)).cast("double")).drop("_n", "o_custkey")


def reason_codes(t):
    f = order_features(t)
    # population means: one scalar subquery (a struct of all means), evaluated once
    m = f.agg(F.struct(*[mean_from(F.sum(scaled(c, SCALES[c])), F.count(c), SCALES[c]).alias(c)
                         for c in COEFFICIENTS])).scalar()
    means = {c: m.getField(c) for c in COEFFICIENTS}
    return I.linear_reason_codes(f, "o_orderkey", COEFFICIENTS, means)


def _mean_sql(c: str) -> str:
    f = float(10 ** SCALES[c])
    return f"CAST(sum(CAST(round({c} * {f}) AS HUGEINT)) AS DOUBLE) / CAST(count({c}) AS DOUBLE) / {f} AS m_{c}"


REASON_SQL = f"""WITH f AS ({FEATURES_SQL}), m AS (SELECT {', '.join(_mean_sql(c) for c in COEFFICIENTS)} FROM f),
c AS ({' UNION ALL '.join(f"SELECT o_orderkey, '{c}' AS feature, CAST({v!r} AS DOUBLE) * ({c} - m_{c}) AS contribution FROM f, m" for c, v in COEFFICIENTS.items())}),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(contribution) DESC, feature) AS rank FROM c)
SELECT o_orderkey, CAST(rank AS BIGINT) AS rank, feature, contribution FROM r WHERE rank <= 5"""


@register("linear_reason_codes", REASON_SQL, "I7 E16 T18")
def q_reasons(t):
    """Top contributions (coefficient x (value - population mean)) for every order."""
    return reason_codes(t)


def _woe_sql() -> str:
    parts = []
    for v, edges in WOE_EDGES.items():
        cnt = " + ".join(f"CASE WHEN {e} < {v} THEN 1 ELSE 0 END" for e in edges)
        parts.append(f"SELECT '{v}' AS variable, CASE WHEN {v} IS NULL THEN -1 ELSE {cnt} END AS bin, y FROM f")
    return f"""WITH f AS (SELECT * FROM ({FEATURES_SQL}) WHERE SPLIT = 'train'), l AS ({' UNION ALL '.join(parts)}),
c AS (SELECT variable, CAST(bin AS INTEGER) AS bin, CAST(sum(y) AS BIGINT) AS n_event, CAST(sum(1 - y) AS BIGINT) AS n_nonevent
  FROM l GROUP BY ALL),
t AS (SELECT c.*, sum(n_event) OVER (PARTITION BY variable) AS te, sum(n_nonevent) OVER (PARTITION BY variable) AS tn FROM c)
SELECT variable, bin, n_event, n_nonevent,
  round(ln(((n_nonevent + 0.5) / CAST(tn AS DOUBLE)) / ((n_event + 0.5) / CAST(te AS DOUBLE))), 12) AS woe,
  round((((n_nonevent + 0.5) / CAST(tn AS DOUBLE)) - ((n_event + 0.5) / CAST(te AS DOUBLE)))
    * ln(((n_nonevent + 0.5) / CAST(tn AS DOUBLE)) / ((n_event + 0.5) / CAST(te AS DOUBLE))), 12) AS iv_term
FROM t"""


@register("woe_table", _woe_sql(), "I1")
def q_woe(t):
    """Weight of evidence and IV term per variable and bin (fixed edges), from train rows."""
    f = order_features(t).where(F.col("SPLIT") == "train")
    return I.woe_table(f, "y", WOE_EDGES)


TEST_SLICE_SRC = f"SELECT * FROM ({SCORED_SQL}) WHERE SPLIT = 'test'"
TEST_SLICE_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS slice_column, CAST({c} AS VARCHAR) AS slice_value, y, score FROM ({TEST_SLICE_SRC}) "
    f"WHERE {c} IS NOT NULL" for c in SLICES)
TEST_OVERALL = f"SELECT 0 AS one, y, score FROM ({TEST_SLICE_SRC})"
TEST_SLICE_SQL = f"""WITH {steps_sql(TEST_SLICE_LONG, ['slice_column', 'slice_value'])},
{auc_sql(['slice_column', 'slice_value'])},
ov AS (WITH {steps_sql(TEST_OVERALL, ['one'])}, {auc_sql(['one'])} SELECT roc_auc AS overall_roc_auc FROM auc)
SELECT slice_column, slice_value, roc_auc, overall_roc_auc - roc_auc <= CAST(0.05 AS DOUBLE) AS within_tolerance FROM auc, ov"""


def test_parts(t):
    sc = scored(t)
    metrics = H.compute_metrics(sc, CFG, by=["SPLIT"])
    slices = H.slice_metrics(sc.where(F.col("SPLIT") == "test"), CFG_TEST_SLICES).withColumn("model", F.lit(MODEL))
    return metrics.withColumn("model", F.lit(MODEL)), slices


@register("gate_decision", f"""WITH m AS (SELECT * FROM ({METRICS_SQL}) WHERE SPLIT = 'test'), s AS ({TEST_SLICE_SQL}),
r AS (SELECT count(*) AS n FROM ({REASON_SQL}) WHERE o_orderkey IN (SELECT o_orderkey FROM ({SCORED_SQL}) WHERE SPLIT = 'test')),
b AS (SELECT string_agg(x, '; ' ORDER BY x) AS txt FROM (
  SELECT printf('slice %s=%s: roc_auc %.4f out of tolerance', slice_column, slice_value, roc_auc) AS x
  FROM s WHERE within_tolerance IS NOT DISTINCT FROM false))
SELECT '{MODEL}' AS model, m.pr_auc,
  concat_ws('; ', CASE WHEN m.pr_auc IS NULL THEN 'pr_auc unknown' WHEN m.pr_auc < {CFG.min_pr_auc} THEN printf('pr_auc %.4f under {CFG.min_pr_auc:.4f}', m.pr_auc) END,
    b.txt, CASE WHEN r.n = 0 THEN 'reason codes missing' END) AS reasons,
  coalesce(m.pr_auc >= {CFG.min_pr_auc}, false) AND b.txt IS NULL AND r.n > 0 AS passed
FROM m, b, r""", "J1 J7 H16 T13 T20")
def q_gate(t):
    """The champion's gate on its test split: PR-AUC floor, slice tolerances, reason codes
    and a non-empty model card; the reasons in order."""
    metrics, slices = test_parts(t)
    test_metrics = metrics.where(F.col("SPLIT") == "test")
    test_ids = scored(t).where(F.col("SPLIT") == "test").select("o_orderkey")
    rc = reason_codes(t).join(test_ids, "o_orderkey", "left_semi").agg(
        F.count(F.lit(1)).alias("n_reason_codes")).withColumn("model", F.lit(MODEL))
    card_rows = J.model_card_rows(test_metrics, slices, CFG)
    card = card_rows.agg(F.concat_ws("\n", F.collect_list(F.concat_ws(" ", "item", "status"))).alias("card")) \
        .withColumn("model", F.lit(MODEL))  # card text: one line per card row (bounded by metrics x slices)
    g = J.gate(test_metrics, slices, rc, card, CFG)
    return g.select("model", "pr_auc", F.concat_ws("; ", "reasons").alias("reasons"), "passed")


@register("model_card_rows", f"""WITH m AS (SELECT * FROM ({METRICS_SQL}) WHERE SPLIT = 'test'), s AS ({TEST_SLICE_SQL})
{' UNION ALL '.join(f"SELECT '{MODEL}' AS model, 'metric' AS section, '{n}' AS item, CAST({n} AS DOUBLE) AS value, "
                    + ("CASE WHEN pr_auc >= " + str(float(CFG.min_pr_auc)) + " THEN 'pass' ELSE 'FAIL' END" if n == 'pr_auc' else "'N/A'")
                    + " AS status FROM m" for n in J.METRIC_NAMES)}
UNION ALL SELECT '{MODEL}', 'slice', slice_column || '=' || slice_value, roc_auc,
  CASE WHEN within_tolerance IS NULL THEN 'N/A' WHEN within_tolerance THEN 'pass' ELSE 'FAIL' END FROM s""", "J7")
def q_card(t):
    """The model card's metric and slice rows with pass / FAIL / N/A."""
    metrics, slices = test_parts(t)
    return J.model_card_rows(metrics.where(F.col("SPLIT") == "test"), slices, CFG)


@register("promotion_decision", f"""WITH c AS (SELECT pr_auc FROM ({METRICS_SQL}) WHERE SPLIT = 'test'),
p AS (SELECT pr_auc FROM ({METRICS_SQL}) WHERE SPLIT = 'validation')
SELECT c.pr_auc AS candidate_pr_auc, p.pr_auc AS production_pr_auc,
  CASE WHEN p.pr_auc IS NULL OR c.pr_auc >= p.pr_auc - {CFG.max_pr_auc_regression} THEN true ELSE false END AS promote,
  CASE WHEN p.pr_auc IS NULL THEN 'first version'
       WHEN c.pr_auc >= p.pr_auc - {CFG.max_pr_auc_regression} THEN printf('%.4f against %.4f: within the regression allowed', c.pr_auc, p.pr_auc)
       ELSE printf('%.4f against %.4f: regression too large', coalesce(c.pr_auc, 'nan'::DOUBLE), p.pr_auc) END AS reason
FROM c, p""", "J2")
def q_promote(t):
    """Candidate (test-split PR-AUC) against the production stand-in (validation split)."""
    m = H.compute_metrics(scored(t), CFG, by=["SPLIT"])
    c = m.where(F.col("SPLIT") == "test").select(F.col("pr_auc").alias("candidate_pr_auc"), F.lit(0).alias("_k"))
    p = m.where(F.col("SPLIT") == "validation").select(F.col("pr_auc").alias("production_pr_auc"), F.lit(0).alias("_k"))
    d = c.join(p, "_k", "left").withColumn(
        "_d", J.decide_promotion(F.col("candidate_pr_auc"), F.col("production_pr_auc"), CFG.max_pr_auc_regression))
    return d.select("candidate_pr_auc", "production_pr_auc", "_d.promote", "_d.reason")


@register("flatten_metrics", f"""WITH m AS ({METRICS_SQL}) {' UNION ALL '.join(
    f"SELECT SPLIT || '_{n}' AS name, CAST({n} AS DOUBLE) AS value FROM m WHERE {n} IS NOT NULL" for n in J.METRIC_NAMES)}""",
          "J8")
def q_flatten(t):
    """Per-split metrics as `{split}_{metric}` rows, numbers only."""
    return J.flatten_metrics(H.compute_metrics(scored(t), CFG, by=["SPLIT"]))


VERSIONS = {"train": "1", "validation": "2", "test": "3"}
ALIASES = [("3", "production"), ("3", "champion"), ("2", "challenger")]


@register("version_evidence", f"""WITH m AS ({METRICS_SQL})
SELECT CASE SPLIT {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in VERSIONS.items())} END AS version,
  pr_auc, roc_auc, expected_cost, CAST(NULL AS DOUBLE) AS note,
  CASE SPLIT WHEN 'test' THEN 'champion,production' WHEN 'validation' THEN 'challenger' ELSE '' END AS aliases
FROM m WHERE SPLIT IN ('train', 'validation', 'test')""", "J6")
def q_versions(t):
    """Model versions' tags parsed to typed metric columns (a non-number tag becomes null),
    aliases merged from the alias table."""
    spark = t.spark
    m = H.compute_metrics(scored(t), CFG, by=["SPLIT"]).where(F.col("SPLIT").isin(list(VERSIONS)))
    ver = F.element_at(F.create_map(*[F.lit(x) for kv in VERSIONS.items() for x in kv]), F.col("SPLIT"))
    tags = m.select(ver.alias("version"), F.create_map(
        F.lit("pr_auc"), F.col("pr_auc").cast("string"), F.lit("roc_auc"), F.col("roc_auc").cast("string"),
        F.lit("expected_cost"), F.col("expected_cost").cast("string"), F.lit("note"), F.lit("n/a")).alias("tags"))
    aliases = spark.createDataFrame(ALIASES, "version string, alias string")
    ev = J.version_evidence(tags, aliases, ["pr_auc", "roc_auc", "expected_cost", "note"])
    return ev.withColumn("aliases", F.concat_ws(",", "aliases"))


SPLITS = ("train", "validation", "test")


def split_slices(t):
    """The slice table of every split, each against its own overall."""
    sc, out = cut_lineage(scored(t)), None
    for name in SPLITS:
        own = H.slice_metrics(sc.where(F.col("SPLIT") == name), CFG_TEST_SLICES).withColumn("SPLIT", F.lit(name))
        out = own if out is None else out.unionByName(own)
    return out


def _split_slice_sql(name: str) -> str:
    source = f"SELECT * FROM ({SCORED_SQL}) WHERE SPLIT = '{name}'"
    long = " UNION ALL ".join(f"SELECT '{c}' AS slice_column, CAST({c} AS VARCHAR) AS slice_value, y, score FROM ({source}) WHERE {c} IS NOT NULL" for c in SLICES)
    return f"""SELECT '{name}' AS split, 'slice' AS section, slice_column || '=' || slice_value AS item, CAST(p + q AS BIGINT) AS n,
  CAST(p AS DOUBLE) / CAST(p + q AS DOUBLE) AS positive_rate, roc_auc, pr_auc, CAST(NULL AS DOUBLE) AS recall_at_target_fpr,
  CAST(NULL AS DOUBLE) AS alert_volume_fraction, CAST(NULL AS DOUBLE) AS expected_cost,
  CASE WHEN roc_auc IS NULL THEN 'N/A' WHEN overall - roc_auc <= CAST(0.05 AS DOUBLE) THEN 'pass' ELSE 'FAIL' END AS status
FROM (WITH {steps_sql(long, ['slice_column', 'slice_value'])}, {auc_sql(['slice_column', 'slice_value'])},
  tot AS (SELECT slice_column, slice_value, max(tot_pos) AS p, max(tot_neg) AS q FROM st GROUP BY ALL),
  ov AS (WITH {steps_sql(f"SELECT 0 AS one, y, score FROM ({source})", ['one'])}, {auc_sql(['one'])} SELECT roc_auc AS overall FROM auc)
  SELECT * FROM auc JOIN tot USING (slice_column, slice_value), ov)"""


@register("model_card", f"""SELECT SPLIT AS split, 'metrics' AS section, 'all' AS item, n_rows AS n, positive_rate, roc_auc, pr_auc, recall_at_target_fpr,
  alert_volume_fraction, expected_cost, CAST(NULL AS VARCHAR) AS status FROM ({METRICS_SQL}) WHERE SPLIT IN ('train', 'validation', 'test')
{' '.join('UNION ALL ' + _split_slice_sql(n) for n in SPLITS)}""", "J7 H9")
def q_full_card(t):
    """The card over every split: metrics, and each slice's n, positive rate, ROC-AUC, PR-AUC and status."""
    metrics = H.compute_metrics(scored(t), CFG, by=["SPLIT"]).where(F.col("SPLIT").isin(*SPLITS))
    return J.model_card(metrics, split_slices(t))


# Fixed values of the versions' tags: one number that is none, reasons as a list, as text, and none.
PAGE_TAGS = {"1": ("trees", "fail", '["pr_auc low", "slice F"]', "rejected"), "2": ("scorecard", "pass", "", "promoted"), "10": ("scorecard", "fail", "no card", "")}
PAGE_SPLIT = {"1": "train", "2": "validation", "10": "test"}


@register("version_pages", f"""WITH m AS ({METRICS_SQL}), v(version, split, model_type, gate, gate_reasons, promotion, aliases, rank) AS (VALUES
  ('1', 'train', 'trees', 'fail', 'pr_auc low|slice F', 'rejected', '', 3), ('2', 'validation', 'scorecard', 'pass', '', 'promoted', 'challenger', 2),
  ('10', 'test', 'scorecard', 'fail', 'no card', '', 'champion|production', 1))
SELECT version, CAST(m.n_rows AS BIGINT) AS created_ms, rank, model_type, gate, gate_reasons, promotion, pr_auc, roc_auc, recall_at_target_fpr,
  CAST(NULL AS DOUBLE) AS alert_volume_fraction, expected_cost, aliases FROM v JOIN m ON v.split = m.SPLIT""", "J6")
def q_pages(t):
    """Versions with the test metrics of their tags, gate, reasons and promotion, newest first by number
    (10 before 2), aliases from the alias table."""
    m = H.compute_metrics(scored(t), CFG, by=["SPLIT"])
    version = F.element_at(F.create_map(*[F.lit(x) for k, v in PAGE_SPLIT.items() for x in (v, k)]), F.col("SPLIT"))
    own = cut_lineage(m.where(F.col("SPLIT").isin(*PAGE_SPLIT.values())).withColumn("version", version))
    numbers = F.array(*[F.struct(F.lit(f"test_{c}").alias("tag"), (F.lit("n/a") if c == "alert_volume_fraction" else F.col(c).cast("string")).alias("value"))
                        for c in J.EVIDENCE_METRICS])
    rows = [(v, k, x) for v, tags in PAGE_TAGS.items() for k, x in zip(("model_type", "gate", "gate_reasons", "promotion"), tags) if x]
    tags = own.select("version", F.inline(numbers)).unionByName(t.spark.createDataFrame(rows, "version string, tag string, value string"))
    aliases = t.spark.createDataFrame([("production", "10"), ("champion", "10"), ("challenger", "2")], "alias string, version string")
    pages = J.version_pages(own.select("version", F.col("n_rows").cast("bigint").alias("created_ms")), tags, aliases)
    return pages.withColumns({"gate_reasons": F.array_join("gate_reasons", "|"), "aliases": F.array_join("aliases", "|")})


# ------------------------------------------------------------------ models (rows-only checks)

NUMERIC = ["o_totalprice", "c_acctbal", "n_lines"]
CATEGORICAL = ["c_mktsegment", "o_orderstatus"]


def versions_folder(spark) -> str:
    """A new folder for versions below the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/versions/{uuid.uuid4().hex}"


def _splits(t):
    f = order_features(t).where(F.col("SPLIT") != "excluded")
    return {s: f.where(F.col("SPLIT") == s) for s in ("train", "validation", "test")}, f


# Fixed values of a target that the inputs tell in part: price and nation, blurred by the order's number.
LARGE_ABOVE, NATION_WEIGHT, BLUR_STEP, BLUR = 450_000, 6_000, 7_919, 200_000
LARGE_NUMERIC, LARGE_CATEGORICAL = ["o_totalprice", "c_acctbal"], ["c_nationkey"]
BINNING = {"n_prebins": 10, "min_share": 0.05, "min_events": 5, "level_share": 0.04}
#: What a model of that target must reach on rows it was not fitted on (0.5: chance).
LEAST_AUC = 0.75

LARGE_SQL = f"""SELECT s.o_orderkey, s.SPLIT, s.o_totalprice, CASE WHEN s.c_acctbal >= 0 THEN s.c_acctbal END AS c_acctbal,
  CAST(c.c_nationkey AS VARCHAR) AS c_nationkey, CAST(s.o_totalprice + {NATION_WEIGHT} * c.c_nationkey + o_orderkey * {BLUR_STEP} % {BLUR} > {LARGE_ABOVE} AS INTEGER) AS y
FROM ({FEATURES_SQL}) s JOIN orders o USING (o_orderkey) JOIN customer c ON o.o_custkey = c.c_custkey WHERE s.SPLIT <> 'excluded'"""


def large_orders(t):
    """Inputs, target and split; a negative balance counts as unknown. Written once: fitting reads it
    several times."""
    nation = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(
        t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("c_nationkey")), "c_custkey").drop("c_custkey")
    return t.derived("large_orders", lambda: cut_lineage(
        order_features(t).where(F.col("SPLIT") != "excluded").join(nation, "o_orderkey").select(
            "o_orderkey", "SPLIT", "o_totalprice", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
            "c_nationkey", F.expr(f"CAST(o_totalprice + {NATION_WEIGHT} * CAST(c_nationkey AS BIGINT) + o_orderkey * {BLUR_STEP} % {BLUR} > {LARGE_ABOVE} AS INT)").alias("y"))))


def _bins_sql() -> str:
    """Pool adjacent violators by the max-min formula, then short bins by a recursion over lists."""
    iv = ("sum(round(((n + 0.5) / tn::DOUBLE - (e + 0.5) / te::DOUBLE) * ln(((n + 0.5) / tn::DOUBLE) / ((e + 0.5) / te::DOUBLE)), 12))")
    rate = lambda k: f"es[{k}]::DOUBLE / (es[{k}] + ns[{k}])"
    cut = lambda x: f"list_concat(list_concat({x}[1:j - 1], [{{}}]), {x}[j + 2:])"
    numeric = " UNION ALL ".join(f"SELECT '{v}' AS column_name, y, {v} AS value FROM f" for v in LARGE_NUMERIC)
    return f"""WITH RECURSIVE f AS (SELECT * FROM ({LARGE_SQL}) WHERE SPLIT = 'train'),
x AS ({numeric}), ref AS (SELECT column_name, value FROM x WHERE value IS NOT NULL), {edges_sql()}
cells AS (
  SELECT column_name AS variable, CASE WHEN value IS NOT NULL THEN
      (SELECT count(*) FROM edges g WHERE g.column_name = x.column_name AND g.v < x.value) END AS cell, CAST(NULL AS VARCHAR) AS level, false AS rest, y FROM x
  UNION ALL
  SELECT 'c_nationkey', NULL, CASE WHEN c < {BINNING['level_share']} * t THEN NULL ELSE c_nationkey END, c < {BINNING['level_share']} * t, y
  FROM (SELECT *, count(*) OVER (PARTITION BY c_nationkey) AS c, count(*) OVER () AS t FROM f)),
counts AS (SELECT variable, cell, level, rest, CAST(sum(y) AS BIGINT) AS e, CAST(sum(1 - y) AS BIGINT) AS n FROM cells GROUP BY ALL),
totals AS (SELECT variable, sum(e) AS te, sum(n) AS tn FROM counts GROUP BY variable),
pre AS (
  SELECT *, row_number() OVER (PARTITION BY variable ORDER BY cell, CASE WHEN cell IS NULL THEN e::DOUBLE / (e + n) END, rest, level) AS i,
    sum(e) OVER w AS ce, sum(n) OVER w AS cn
  FROM counts WHERE cell IS NOT NULL OR level IS NOT NULL OR rest
  WINDOW w AS (PARTITION BY variable ORDER BY cell, CASE WHEN cell IS NULL THEN e::DOUBLE / (e + n) END, rest, level ROWS UNBOUNDED PRECEDING)),
spans AS (
  SELECT a.variable, a.i AS a, b.i AS b, (b.ce - a.ce + a.e)::DOUBLE / (b.ce - a.ce + a.e + b.cn - a.cn + a.n) AS m
  FROM pre a JOIN pre b ON a.variable = b.variable AND a.i <= b.i),
ends AS (
  SELECT p.variable, p.i, a, min(m) AS least, max(m) AS most FROM pre p JOIN spans s ON s.variable = p.variable AND a <= p.i AND b >= p.i GROUP BY ALL),
level_of AS (SELECT variable, i, max(least) AS up, min(most) AS down FROM ends GROUP BY variable, i),
blocks AS (
  SELECT variable, 'up' AS way, up AS g, sum(pre.e) AS e, sum(pre.n) AS n, min(i) AS lo, max(i) AS hi FROM pre JOIN level_of USING (variable, i) GROUP BY ALL
  UNION ALL
  SELECT variable, 'down', down, sum(e), sum(n), min(i), max(i) FROM pre JOIN level_of USING (variable, i) WHERE variable <> 'c_nationkey' GROUP BY variable, down),
value AS (SELECT variable, way, {iv} AS iv FROM blocks JOIN totals USING (variable) GROUP BY variable, way),
way AS (SELECT variable, arg_max(way, (iv, way)) AS way FROM value GROUP BY variable),
merged AS (
  SELECT variable, list(e::BIGINT ORDER BY lo) AS es, list(n::BIGINT ORDER BY lo) AS ns, list(hi::BIGINT ORDER BY lo) AS his
  FROM blocks JOIN way USING (variable, way) GROUP BY variable
  UNION ALL
  SELECT variable, {cut('es').format('es[j] + es[j + 1]')}, {cut('ns').format('ns[j] + ns[j + 1]')}, {cut('his').format('his[j + 1]')}
  FROM (SELECT *, CASE WHEN k = len(es) OR k > 1 AND abs({rate('k')} - {rate('k - 1')}) <= abs({rate('k')} - {rate('k + 1')}) THEN k - 1 ELSE k END AS j
    FROM (SELECT m.*, list_position(list_transform(range(1, len(es) + 1), lambda q: es[q] + ns[q] < {BINNING['min_share']} * (te + tn) OR es[q] < {BINNING['min_events']}), true) AS k
          FROM merged m JOIN totals USING (variable))) WHERE coalesce(k, 0) > 0 AND len(es) > 1),
done AS (SELECT variable, arg_min(es, len(es)) AS es, arg_min(ns, len(es)) AS ns, arg_min(his, len(es)) AS his FROM merged GROUP BY variable),
bins AS (
  SELECT variable, k - 1 AS bin, es[k] AS e, ns[k] AS n, CASE WHEN k > 1 THEN his[k - 1] ELSE 0 END AS above, his[k] AS hi, k = len(es) AS last
  FROM (SELECT *, unnest(range(1, len(es) + 1)) AS k FROM done)),
named AS (
  SELECT b.variable, bin, CASE WHEN NOT last THEN max(CASE WHEN p.i = hi THEN g.v END) END AS upper,
    string_agg(DISTINCT level, ',' ORDER BY level) AS levels, bool_or(p.rest) AS rest, b.e, b.n
  FROM bins b JOIN pre p ON p.variable = b.variable AND p.i > above AND p.i <= hi
  LEFT JOIN (SELECT column_name, v, row_number() OVER (PARTITION BY column_name ORDER BY v) - 1 AS at FROM edges) g
    ON g.column_name = p.variable AND g.at = p.cell
  GROUP BY b.variable, bin, last, b.e, b.n
  UNION ALL
  SELECT variable, -1, NULL, NULL, false, e, n FROM counts WHERE cell IS NULL AND level IS NULL AND NOT rest)
SELECT variable, CAST(bin AS INTEGER) AS bin, upper, levels, rest, e AS n_event, n AS n_nonevent,
  round(ln(((n + 0.5) / tn::DOUBLE) / ((e + 0.5) / te::DOUBLE)), 12) AS woe
FROM named JOIN totals USING (variable)"""


@register("woe_bins", _bins_sql(), "I1")
def q_bins(t):
    """Bins fitted on numeric and categorical columns: quantile pre-bins and pooled rare levels, merged
    to monotone event rates of at least 5 % of the rows and 5 events; unknown values apart."""
    train = large_orders(t).where("SPLIT = 'train'")
    bins = fit_bins(train, "y", LARGE_NUMERIC, LARGE_CATEGORICAL, **BINNING)
    return bins_table(t.spark, bins).select("variable", "bin", "upper", F.when(F.size("levels") > 0, F.array_join("levels", ",")).alias("levels"),
                                            "rest", "n_event", "n_nonevent", "woe")


@register("fit_scorecard", None, "I1 I2 I3 I6")
def q_scorecard(t):
    """Fitted WoE bins, logistic regression on them, every split scored."""
    f = large_orders(t)
    card = I.fit_woe_scorecard(f.where("SPLIT = 'train'"), "y", LARGE_NUMERIC, LARGE_CATEGORICAL, max_iter=100, **BINNING)
    return f.select("o_orderkey", "SPLIT", "y", card.score().alias("score"))


@register("fit_gbt", None, "I4 I6 N3")
def q_gbt(t):
    """Boosted trees on numeric and categorical inputs, every split scored."""
    f = large_orders(t)
    model = I.fit_gbt(f.where("SPLIT = 'train'"), LARGE_NUMERIC, LARGE_CATEGORICAL, "y", max_iter=20)
    return I.batch_score(model, f, ["o_orderkey", "SPLIT", "y"])


@register("fit_logistic", None, "I5 I6")
def q_logistic(t):
    """One-hot + median imputation + logistic regression, every split scored."""
    f = large_orders(t)
    model = I.fit_logistic(f.where("SPLIT = 'train'"), LARGE_NUMERIC, LARGE_CATEGORICAL, "y", max_iter=100)
    return I.batch_score(model, f, ["o_orderkey", "SPLIT", "y"])


def fit_check(scored_rows):
    """Rows a split, whether every score is a probability, and whether the split is ranked: the two
    splits that no model saw must reach ``LEAST_AUC``."""
    out = cut_lineage(scored_rows.select("SPLIT", "y", "score"))
    per = out.groupBy("SPLIT").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("y").cast("bigint").alias("n_positive"),
                                   F.bool_and(F.coalesce(F.col("score").between(0, 1), F.lit(False))).alias("in_range"))
    auc = H.auc_table(H.score_steps(out, "y", "score", by=["SPLIT"]), ["SPLIT"]).select("SPLIT", (F.col("roc_auc") >= LEAST_AUC).alias("ranked"))
    return per.join(auc, "SPLIT").select("SPLIT", "n_rows", "n_positive", "in_range", "ranked")


def _fit_checks(fit: str, ids: str):
    """Registers ``<fit>_check``."""
    source = {"fit_scorecard": q_scorecard, "fit_gbt": q_gbt, "fit_logistic": q_logistic}[fit]
    register(f"{fit}_check", f"""SELECT SPLIT, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(y) AS BIGINT) AS n_positive, true AS in_range, true AS ranked
FROM ({LARGE_SQL}) GROUP BY SPLIT""", ids)(lambda t: fit_check(source(t)))


_fit_checks("fit_scorecard", "I2 I3 I6")
_fit_checks("fit_gbt", "I4 I6")
_fit_checks("fit_logistic", "I5 I6")


def scores_by_tables(spark, path: str, rows):
    """A stored scorecard's scores and contributions by joining its tables in SQL, without its code:
    (o_orderkey, score, feature, contribution)."""
    for name in ("bins", "weights"):
        spark.read.parquet(f"{path}/{name}").createOrReplaceTempView(f"card_{name}")
    rows.createOrReplaceTempView("card_rows")
    values = ", ".join(f"'{v}', CAST({v} AS STRING)" for v in [*LARGE_NUMERIC, *LARGE_CATEGORICAL])
    return spark.sql(f"""
      WITH x AS (SELECT o_orderkey, stack({len(LARGE_NUMERIC) + len(LARGE_CATEGORICAL)}, {values}) AS (variable, value) FROM card_rows),
      b AS (SELECT *, lag(upper) OVER (PARTITION BY variable ORDER BY bin) AS lower FROM card_bins),
      w AS (SELECT x.o_orderkey, x.variable, b.woe FROM x JOIN b ON x.variable = b.variable AND CASE
        WHEN x.value IS NULL THEN b.bin = -1
        WHEN b.kind = 'categorical' THEN b.bin >= 0 AND (array_contains(b.levels, x.value) OR b.rest AND NOT EXISTS (
          SELECT 1 FROM card_bins o WHERE o.variable = x.variable AND array_contains(o.levels, x.value)))
        ELSE b.bin >= 0 AND (b.lower IS NULL OR CAST(x.value AS DOUBLE) > b.lower) AND (b.upper IS NULL OR CAST(x.value AS DOUBLE) <= b.upper) END)
      SELECT o_orderkey, w.variable AS feature, k.weight * (woe - k.mean_woe) AS contribution,
        1 / (1 + exp(-(sum(k.weight * woe) OVER (PARTITION BY o_orderkey) + (SELECT weight FROM card_weights WHERE variable = '')))) AS score
      FROM w JOIN card_weights k ON k.variable = w.variable""")


@register("version_reference_scores", f"""SELECT o_orderkey, y, true AS scored, true AS as_stored, CAST(3 AS BIGINT) AS n_reasons, true AS reasons_as_stored
FROM ({LARGE_SQL}) WHERE SPLIT = 'train'""", "I7 I8 I10 N3 A14")
def q_version(t):
    """A scorecard kept as a version with its snapshot, means and tables, loaded by alias, scoring its own
    reference rows; scores and reason codes against plain SQL over the stored tables, row by row."""
    spark, root = t.spark, versions_folder(t.spark)
    train = large_orders(t).where("SPLIT = 'train'")
    card = I.fit_woe_scorecard(train, "y", LARGE_NUMERIC, LARGE_CATEGORICAL, max_iter=100, **BINNING)
    path = V.save_version(root, "large_orders", "1", card, train, LARGE_NUMERIC)
    V.set_alias(spark, root, "large_orders", "champion", "0", 1)
    V.set_alias(spark, root, "large_orders", "champion", "1", 2)
    version = V.load_version(spark, root, "large_orders", "champion")
    scores = version.score_reference(["o_orderkey", "y"])
    reasons = version.model.reasons(version.reference, "o_orderkey")
    stored = cut_lineage(scores_by_tables(spark, path, version.reference))
    pairs = reasons.join(stored, ["o_orderkey", "feature"], "left").groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n_reasons"),
        F.bool_and(F.coalesce(F.abs(reasons["contribution"] - stored["contribution"]) < 1e-9, F.lit(False))).alias("reasons_as_stored"),
        F.max(stored["score"]).alias("_stored"))
    return scores.join(pairs, "o_orderkey").select(
        "o_orderkey", "y", F.coalesce(F.col("score").between(0, 1), F.lit(False)).alias("scored"),
        F.coalesce(F.abs(F.col("score") - F.col("_stored")) < 1e-9, F.lit(False)).alias("as_stored"), "n_reasons", "reasons_as_stored")


@register("scorecard_optimum", f"""SELECT v.variable, CAST((SELECT count(*) FROM ({LARGE_SQL}) WHERE SPLIT = 'train') AS BIGINT) AS n, true AS at_optimum
FROM (VALUES {', '.join(f"('{v}')" for v in ['intercept', *LARGE_NUMERIC, *LARGE_CATEGORICAL])}) v(variable)""", "I3 I8")
def q_optimum(t):
    """The fitted weights are the maximum of the likelihood: for every weight, the mean of
    (score - y) x WoE over the training rows is zero."""
    train = large_orders(t).where("SPLIT = 'train'")
    card = I.fit_woe_scorecard(train, "y", LARGE_NUMERIC, LARGE_CATEGORICAL, max_iter=200, **BINNING)
    return optimum(card, train)


def optimum(card, train):
    off = card.score() - F.col("y")
    slopes = [("intercept", F.lit(1.0)), *[(v, woe_of(v, card.bins)) for v in card.coefficients]]
    means = train.agg(F.count(F.lit(1)).alias("n"), *[F.avg(off * w).alias(f"_{k}") for k, (_, w) in enumerate(slopes)])
    rows = F.array(*[F.struct(F.lit(v).alias("variable"), F.col("n"), (F.abs(F.col(f"_{k}")) < 1e-5).alias("at_optimum")) for k, (v, _) in enumerate(slopes)])
    return means.select(F.inline(rows))


@register("champion_challenger", None, "I9 H8")
def q_roles(t):
    """Two model types on the same splits, evaluated with the same metrics per role x split."""
    splits, _ = _splits(t)
    roles = I.champion_challenger(
        splits,
        {"champion": lambda tr: I.fit_logistic(tr, NUMERIC, CATEGORICAL, "y", max_iter=100),
         "challenger": lambda tr: I.fit_gbt(tr, NUMERIC, CATEGORICAL, "y", max_iter=20)},
        "o_orderkey", "y")
    scored_all = None
    for role, r in roles.items():
        s = r.scores.withColumn("role", F.lit(role))
        scored_all = s if scored_all is None else scored_all.unionByName(s)
    return H.compute_metrics(scored_all, CFG, by=["role", "SPLIT"])
