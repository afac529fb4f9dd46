"""Gate and promotion over metric tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotab.config import EvalConfig

METRIC_NAMES = ("pr_auc", "roc_auc", "recall_at_target_fpr", "alert_volume_fraction",
                "alert_threshold", "expected_cost", "true_positive", "false_negative",
                "false_positive", "true_negative")


def gate(test_metrics: DataFrame, test_slices: DataFrame, reason_counts: DataFrame,
         cards: DataFrame, cfg: EvalConfig, model: str = "model") -> DataFrame:
    """Per model, fail if PR-AUC is unknown or below the floor, any slice is out of
    tolerance (a null, as in a one-class slice, passes, T13), there are no reason codes, or the
    card is missing or blank. Reasons give the measured values, in that order (slices sorted)."""
    bad_slices = (test_slices.where(F.col("within_tolerance").eqNullSafe(F.lit(False)))
                  .groupBy(model).agg(F.array_sort(F.collect_list(
                      F.format_string("slice %s=%s: roc_auc %.4f out of tolerance", "slice_column", "slice_value", "roc_auc")))
                      .alias("_slices")))
    j = (test_metrics.select(model, "pr_auc").join(bad_slices, model, "left")
         .join(reason_counts, model, "left").join(cards, model, "left"))
    floor = float(cfg.min_pr_auc)
    reasons = F.concat(
        F.array_compact(F.array(
            F.when(F.col("pr_auc").isNull(), F.lit("pr_auc unknown"))
            .when(F.col("pr_auc") < F.lit(floor), F.format_string(f"pr_auc %.4f under {floor:.4f}", "pr_auc")))),
        F.coalesce("_slices", F.array().cast("array<string>")),
        F.array_compact(F.array(
            F.when(F.coalesce("n_reason_codes", F.lit(0)) == 0, F.lit("reason codes missing")),
            F.when(F.coalesce(F.trim("card"), F.lit("")) == "", F.lit("model card blank")))))
    return j.select(model, "pr_auc", (F.size(reasons) == 0).alias("passed"), reasons.alias("reasons"))


def decide_promotion(candidate: Column, production: Column, max_regression: float) -> Column:
    """Without a production version promote; else promote iff candidate >= production - max
    (an unknown candidate is not promoted). The reason gives both values."""
    floor = production - F.lit(float(max_regression))
    return F.when(production.isNull(), F.struct(F.lit(True).alias("promote"), F.lit("first version").alias("reason"))) \
        .when(candidate >= floor, F.struct(F.lit(True).alias("promote"), F.format_string("%.4f against %.4f: within the regression allowed", candidate, production).alias("reason"))) \
        .otherwise(F.struct(F.lit(False).alias("promote"), F.format_string("%.4f against %.4f: regression too large", F.coalesce(candidate, F.lit(float("nan"))), production).alias("reason")))


def flatten_metrics(metrics: DataFrame, split: str = "SPLIT", names: Sequence[str] = METRIC_NAMES) -> DataFrame:
    """Per-split metrics to ``{split}_{metric}`` rows, numbers only (nulls dropped)."""
    stack = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in names)
    long = metrics.selectExpr(f"`{split}` AS _split", f"stack({len(names)}, {stack}) AS (_metric, value)")
    return long.where(F.col("value").isNotNull()).select(
        F.concat_ws("_", "_split", "_metric").alias("name"), "value")


def version_evidence(versions: DataFrame, aliases: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tag map -> typed metric columns (a value that is not a number becomes null), aliases
    merged from the alias table as a sorted array."""
    al = aliases.groupBy("version").agg(F.array_sort(F.collect_list("alias")).alias("aliases"))
    typed = versions.select("version", *[F.element_at("tags", F.lit(k)).try_cast("double").alias(k) for k in keys])
    out = typed.join(al, "version", "left")
    return out.withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))


# The metrics that a version's page shows, read from its ``test_`` tags.
EVIDENCE_METRICS = ("pr_auc", "roc_auc", "recall_at_target_fpr", "alert_volume_fraction", "expected_cost")


def version_pages(versions: DataFrame, tags: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row a version, newest first by number (``rank`` 1): model type, gate, its reasons, promotion
    and the test metrics from its tags (a tag that is not a number gives null, a missing one is empty
    text), aliases merged in sorted. ``versions``: (version, created_ms); ``tags``: (version, tag, value);
    ``aliases``: (alias, version). Gate reasons are a JSON list; other text is one reason."""
    kept = ["model_type", "gate", "gate_reasons", "promotion", *[f"test_{m}" for m in EVIDENCE_METRICS]]
    by_tag = tags.where(F.col("tag").isin(kept)).groupBy("version").agg(F.map_from_entries(F.collect_list(F.struct("tag", "value"))).alias("_tags"))
    named = aliases.groupBy("version").agg(F.array_sort(F.collect_list("alias")).alias("aliases"))

    def tag(name: str) -> Column:
        return F.coalesce(F.element_at("_tags", name), F.lit(""))

    raw = tag("gate_reasons")
    listed = F.from_json(raw, "array<string>")
    reasons = F.when(raw == "", F.array().cast("array<string>")).otherwise(F.coalesce(listed, F.array(raw)))
    out = versions.join(by_tag, "version", "left").join(named, "version", "left")
    # versions of one model: a bounded list, numbered in one window
    rank = F.row_number().over(Window.orderBy(F.col("version").cast("bigint").desc()))
    return out.select("version", "created_ms", rank.alias("rank"), tag("model_type").alias("model_type"), tag("gate").alias("gate"),
                      reasons.alias("gate_reasons"), tag("promotion").alias("promotion"),
                      *[F.element_at("_tags", f"test_{m}").try_cast("double").alias(m) for m in EVIDENCE_METRICS],
                      F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"))


def model_card(metrics: DataFrame, slices: DataFrame, split: str = "SPLIT") -> DataFrame:
    """The card of a model over every split: (split, section, item, n, positive_rate, roc_auc, pr_auc,
    recall_at_target_fpr, alert_volume_fraction, expected_cost, status). Metric rows have no status; a
    slice passes, FAILs, or is N/A where it holds a single class."""
    head = metrics.select(F.col(split).alias("split"), F.lit("metrics").alias("section"), F.lit("all").alias("item"), F.col("n_rows").alias("n"),
                          "positive_rate", "roc_auc", "pr_auc", "recall_at_target_fpr", "alert_volume_fraction", "expected_cost",
                          F.lit(None).cast("string").alias("status"))
    none = F.lit(None).cast("double")
    body = slices.select(
        F.col(split).alias("split"), F.lit("slice").alias("section"), F.concat("slice_column", F.lit("="), "slice_value").alias("item"), "n",
        "positive_rate", "roc_auc", "pr_auc", none.alias("recall_at_target_fpr"), none.alias("alert_volume_fraction"), none.alias("expected_cost"),
        F.when(F.col("within_tolerance").isNull(), "N/A").when(F.col("within_tolerance"), "pass").otherwise("FAIL").alias("status"))
    return head.unionByName(body)


def model_card_rows(metrics: DataFrame, slices: DataFrame, cfg: EvalConfig, model: str = "model") -> DataFrame:
    """The card's rows: each metric with pass / FAIL against the gate where one applies
    (N/A otherwise), and each slice value with pass / FAIL / N/A from its tolerance flag."""
    stack = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in METRIC_NAMES)
    m = metrics.selectExpr(f"`{model}` AS {model}", f"stack({len(METRIC_NAMES)}, {stack}) AS (item, value)")
    m = m.select(model, F.lit("metric").alias("section"), "item", "value",
                 F.when(F.col("item") != "pr_auc", F.lit("N/A"))
                 .when(F.col("value") >= F.lit(float(cfg.min_pr_auc)), F.lit("pass")).otherwise(F.lit("FAIL"))
                 .alias("status"))
    s = slices.select(model, F.lit("slice").alias("section"),
                      F.concat(F.col("slice_column"), F.lit("="), F.col("slice_value")).alias("item"),
                      F.col("roc_auc").alias("value"),
                      F.when(F.col("within_tolerance").isNull(), F.lit("N/A"))
                      .when(F.col("within_tolerance"), F.lit("pass")).otherwise(F.lit("FAIL")).alias("status"))
    return m.unionByName(s)
