"""Modelling as Spark jobs.

The reference wraps single-machine solvers; here the jobs are Spark ML pipelines and grouped
aggregates. Results are not expected to match the reference digit for digit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotab.operators.binning import Bin, fit_bins, woe_of

ROUND = 12
SMOOTHING = 0.5  # [ours] added to every bin count so an empty class share has a finite WoE


def _bin_expr(value: str, edges: Sequence[float]) -> Column:
    """Bin index: number of edges strictly below the value; null stays its own bin (-1)."""
    v = F.col(value).cast("double")
    below = F.lit(0)
    for e in edges:
        below = below + F.when(F.lit(float(e)) < v, 1).otherwise(0)
    return F.when(F.col(value).isNull(), F.lit(-1)).otherwise(below)


def woe_table(train: DataFrame, y: str, edges: dict[str, Sequence[float]]) -> DataFrame:
    """I1 with given edges: per variable and bin, counts by class, WoE = ln(non-event share /
    event share) with +0.5 smoothing, and the bin's information value term. Computed from
    train rows only, all variables in one grouped pass after an unpivot."""
    stack = ", ".join(f"'{v}', CAST(_b{i} AS INT)" for i, v in enumerate(edges))
    binned = train.select(F.col(y).cast("int").alias("_y"),
                          *[_bin_expr(v, e).alias(f"_b{i}") for i, (v, e) in enumerate(edges.items())])
    long = binned.selectExpr("_y", f"stack({len(edges)}, {stack}) AS (variable, bin)")
    counts = long.groupBy("variable", "bin").agg(
        F.sum("_y").cast("bigint").alias("n_event"),
        F.sum(1 - F.col("_y")).cast("bigint").alias("n_nonevent"))
    tot = counts.groupBy("variable").agg(F.sum("n_event").alias("_te"), F.sum("n_nonevent").alias("_tn"))
    c = counts.join(tot, "variable")
    ev = (F.col("n_event") + F.lit(SMOOTHING)) / F.col("_te").cast("double")
    ne = (F.col("n_nonevent") + F.lit(SMOOTHING)) / F.col("_tn").cast("double")
    woe = F.log(ne / ev)
    return c.select("variable", F.col("bin").cast("int"), "n_event", "n_nonevent",
                    F.round(woe, ROUND).alias("woe"), F.round((ne - ev) * woe, ROUND).alias("iv_term"))


def woe_transform(df: DataFrame, table: DataFrame, edges: dict[str, Sequence[float]],
                  suffix: str = "_WOE") -> DataFrame:
    """Value -> WoE of its bin (same bins for every split) through a broadcast of the
    small WoE table (variables x bins rows); an unseen bin gets 0."""
    out = df
    small = F.broadcast(table.select("variable", "bin", "woe"))
    for v, e in edges.items():
        out = out.withColumn(f"_bin_{v}", _bin_expr(v, e))
        t = small.where(F.col("variable") == v).select(F.col("bin").alias(f"_bin_{v}"),
                                                        F.col("woe").alias(f"{v}{suffix}"))
        out = out.join(t, f"_bin_{v}", "left").withColumn(
            f"{v}{suffix}", F.coalesce(f"{v}{suffix}", F.lit(0.0))).drop(f"_bin_{v}")
    return out


def fit_scorecard(train: DataFrame, features: Sequence[str], y: str, max_iter: int = 1000) -> PipelineModel:
    """Logistic regression on WoE columns."""
    asm = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep")
    lr = LogisticRegression(featuresCol="_x", labelCol=y, maxIter=max_iter, probabilityCol="_prob",
                            rawPredictionCol="_raw", predictionCol="_pred")
    return Pipeline(stages=[asm, lr]).fit(train)


@dataclass
class Scorecard:
    """Fitted WoE bins, the logistic regression's weights on them, and the mean WoE of the training
    rows that reason codes are measured against."""

    bins: list[Bin]
    intercept: float
    coefficients: dict[str, float]
    mean_woe: dict[str, float]

    def woe_columns(self) -> dict[str, Column]:
        return {f"{v}_WOE": woe_of(v, self.bins) for v in self.coefficients}

    def score(self) -> Column:
        """Probability of the event as one expression over the raw columns."""
        z = F.lit(self.intercept)
        for v, c in self.coefficients.items():
            z = z + F.lit(c) * woe_of(v, self.bins)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def reasons(self, df: DataFrame, key: str, top_n: int = 5) -> DataFrame:
        """I7 of the fitted card: weight x (WoE - mean WoE) for every row."""
        woe = df.select(key, *[woe_of(v, self.bins).alias(v) for v in self.coefficients])
        return linear_reason_codes(woe, key, self.coefficients, {v: F.lit(m) for v, m in self.mean_woe.items()}, top_n)


def fit_woe_scorecard(train: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str] = (),
                      max_iter: int = 1000, **binning) -> Scorecard:
    """Bins fitted on the training rows given, logistic regression on their WoE."""
    bins = fit_bins(train, y, numeric, categorical, **binning)
    names = [*numeric, *categorical]
    card = Scorecard(bins, 0.0, {v: 0.0 for v in names}, {})
    woe = train.select(F.col(y).cast("double").alias(y), *[c.alias(n) for n, c in card.woe_columns().items()]).where(F.col(y).isNotNull())
    fitted = fit_scorecard(woe, [f"{v}_WOE" for v in names], y, max_iter).stages[-1]
    means = reference_means(woe, [f"{v}_WOE" for v in names]).first()
    return Scorecard(bins, float(fitted.intercept), {v: float(c) for v, c in zip(names, fitted.coefficients)},
                     {v: float(means[f"{v}_WOE"]) for v in names})


def fit_gbt(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: str,
            max_iter: int = 30, max_depth: int = 4, seed: int = 42) -> PipelineModel:
    """I4: boosted trees; categories indexed with unseen/null kept as their own index, numeric
    nulls imputed (trees need no scaling)."""
    most = max(train.agg(*[F.countDistinct(c) for c in categorical]).first()) if categorical else 0
    idx = [StringIndexer(inputCol=c, outputCol=f"_i_{c}", handleInvalid="keep") for c in categorical]
    imp = Imputer(inputCols=list(numeric), outputCols=[f"_n_{c}" for c in numeric], strategy="median")
    asm = VectorAssembler(inputCols=[f"_n_{c}" for c in numeric] + [f"_i_{c}" for c in categorical],
                          outputCol="_x", handleInvalid="keep")
    gbt = GBTClassifier(featuresCol="_x", labelCol=y, maxIter=max_iter, maxDepth=max_depth, seed=seed,
                        predictionCol="_pred", maxBins=max(64, most + 2))  # one bin a level, unseen and null too
    gbt.setProbabilityCol("_prob").setRawPredictionCol("_raw")
    return Pipeline(stages=[*idx, imp, asm, gbt]).fit(train)


def fit_logistic(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: str,
                 max_iter: int = 1000) -> PipelineModel:
    """One-hot (unknown ignored) + median imputation + logistic regression."""
    idx = [StringIndexer(inputCol=c, outputCol=f"_i_{c}", handleInvalid="keep") for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"_i_{c}" for c in categorical],
                        outputCols=[f"_o_{c}" for c in categorical], handleInvalid="keep", dropLast=True)
    imp = Imputer(inputCols=list(numeric), outputCols=[f"_n_{c}" for c in numeric], strategy="median")
    asm = VectorAssembler(inputCols=[f"_n_{c}" for c in numeric] + [f"_o_{c}" for c in categorical],
                          outputCol="_x", handleInvalid="keep")
    lr = LogisticRegression(featuresCol="_x", labelCol=y, maxIter=max_iter, probabilityCol="_prob",
                            rawPredictionCol="_raw", predictionCol="_pred")
    stages = ([*idx, ohe] if categorical else []) + [imp, asm, lr]
    return Pipeline(stages=stages).fit(train)


def batch_score(model: PipelineModel, df: DataFrame, keep: Sequence[str], name: str = "score") -> DataFrame:
    """Positive-class probability as ``score`` (a uniform output for any model)."""
    out = model.transform(df)
    return out.select(*keep, vector_to_array("_prob")[1].alias(name))


def reference_means(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """I8: mean of each model input over the train rows, kept with the model."""
    return train.agg(*[F.avg(c).alias(c) for c in columns])


def linear_reason_codes(df: DataFrame, key: str, coefficients: dict[str, float], means: dict[str, Column],
                        top_n: int = 5) -> DataFrame:
    """I7 + E16: contribution = coefficient x (value - population mean) for every row (not a
    sample); the ``top_n`` by absolute size as ``(key, rank, feature, contribution)``."""
    names = list(coefficients)
    df = df.select(key, *[(F.lit(float(coefficients[f])) * (F.col(f) - means[f])).alias(f"_c{i}")
                          for i, f in enumerate(names)])
    items = [F.struct(F.lit(f).alias("feature"), F.col(f"_c{i}").alias("contribution"))
             for i, f in enumerate(names)]
    ranked = F.array_sort(F.array(*items), lambda a, b: F.when(
        F.abs(a["contribution"]) > F.abs(b["contribution"]), -1).when(
        F.abs(a["contribution"]) < F.abs(b["contribution"]), 1).when(
        a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1).otherwise(0))
    top = F.slice(ranked, 1, top_n)
    return df.select(key, F.posexplode(top).alias("rank", "c")).select(
        key, (F.col("rank") + 1).cast("bigint").alias("rank"), "c.feature", "c.contribution")


@dataclass
class RoleResult:
    role: str
    model: PipelineModel
    scores: DataFrame


def champion_challenger(splits: dict[str, DataFrame], fitters: dict[str, callable], key: str,
                        y: str) -> dict[str, RoleResult]:
    """Each role's model fitted on the same train split and scored on every split (the
    train split is cached while the roles are fitted)."""
    train = splits["train"].cache()
    out = {}
    try:
        for role, fit in fitters.items():
            model = fit(train)
            scored = None
            for name, part in splits.items():
                s = batch_score(model, part, [key, y]).withColumn("SPLIT", F.lit(name))
                scored = s if scored is None else scored.unionByName(s)
            out[role] = RoleResult(role, model, scored)
    finally:
        train.unpersist()
    return out
