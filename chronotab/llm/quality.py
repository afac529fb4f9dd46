"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow boosted trees over the statistics are cut into rules (every path from the root to a node is
a conjunction of comparisons); logistic regression with lasso weighs the rules and drops most; the
rest is compiled into one Spark column expression. Scoring is a single pass of built-in functions
over every whole text.

Trees and weights are fitted on a bounded sample of labelled documents (``sample_rows``). Null and
empty texts have statistics of zero and are scored like any other; without labels of both kinds the
score is the share of label 1 among them (1 without labels: nothing is rejected). Other columns are ignored; empty
tables give an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from chronotab.llm.folds import labelled_sample
from chronotab.session import cut_lineage

SAMPLE_ROWS = 20_000
LASSO = 0.001
ACCEPT = 0.3
STATISTICS = ("words", "word_length", "distinct", "symbols", "punctuation", "capitals", "digits", "exclaims", "short",
              "line_length", "repeated_lines", "bars")

Rule = tuple[tuple[int, str, float], ...]


def statistics(text: Column) -> Column:
    """The values of STATISTICS as an array."""
    text = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.split(text, "\n")

    def share(signs: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, signs, ""))) / size

    values = F.array(
        F.size(words).cast("double"), size / F.greatest(F.size(words), F.lit(1)),
        F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1)),
        share("#$%&*@^~<>=+{}[]\\_/"), share(".,;:?()'\"-"), F.regexp_count(text, F.lit(r"\p{Lu}")) / size,
        share("0123456789"), share("!"), F.size(F.filter(words, lambda w: F.length(w) <= 3)) / F.greatest(F.size(words), F.lit(1)),
        size / F.size(lines), 1 - F.size(F.array_distinct(lines)) / F.size(lines), share("|"))
    return F.transform(values, lambda v: v.cast("double"))


def paths(node, before: Rule = ()) -> list[Rule]:
    """The rules of a fitted tree: the conjunction leading to each node below the root."""
    if node.getClass().getSimpleName() == "LeafNode":
        return []
    split, out = node.split(), []
    at, threshold = split.featureIndex(), float(split.threshold())
    for child, sign in ((node.leftChild(), "<="), (node.rightChild(), ">")):
        rule = tuple(sorted({*before, (at, sign, threshold)}))
        out += [rule, *paths(child, rule)]
    return out


def holds(rule: Rule, stats: Column) -> Column:
    """1.0 where all comparisons of the rule hold, else 0.0."""
    tests = [stats[i] <= t if sign == "<=" else stats[i] > t for i, sign, t in rule]
    every = tests[0]
    for test in tests[1:]:
        every = every & test
    return F.when(every, 1.0).otherwise(0.0)


class RuleEnsemble:
    """``bias`` and weighted rules over STATISTICS."""

    def __init__(self, bias: float, rules: list[tuple[Rule, float]]):
        self.bias, self.rules = bias, rules

    def score(self, stats: Column) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            total = total + weight * holds(rule, stats)
        return 1 / (1 + F.exp(-total))

    def explain(self) -> list[str]:
        return [f"{w:+.3f} if " + " and ".join(f"{STATISTICS[i]} {s} {t:.4g}" for i, s, t in r)
                for r, w in sorted(self.rules, key=lambda x: -abs(x[1]))]


def fit(sample: DataFrame, lasso: float = LASSO) -> RuleEnsemble | float:
    """The ensemble of labelled rows (text, label), or the share of label 1 if there is one kind only."""
    rows = cut_lineage(sample.select("label", statistics(F.col("text")).alias("stats")).coalesce(8))
    good, n, kinds = rows.agg(F.sum("label"), F.count("*"), F.countDistinct("label")).first()
    if kinds < 2:
        return float(good) / n if n else 1.0
    trees = GBTClassifier(maxIter=12, maxDepth=3, seed=7, subsamplingRate=0.7).fit(
        rows.select("label", array_to_vector("stats").alias("features"))).trees
    rules = sorted({r for t in trees for r in paths(t._call_java("rootNode"))})
    if not rules:
        return float(good) / n
    marked = rows.select("label", array_to_vector(F.array(*[holds(r, F.col("stats")) for r in rules])).alias("features"))
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=100).fit(cut_lineage(marked))
    kept = [(r, float(w)) for r, w in zip(rules, model.coefficients.toArray()) if w]
    return RuleEnsemble(float(model.intercept), kept)


def quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, keep: list[str] | None = None,
            into: str = "score") -> DataFrame:
    """The columns ``keep`` (doc_id) of every row and its score ``into``, learned from
    ``labels.quality`` outside fold 0 of 5."""
    model = fit(labelled_sample(docs, labels, "quality", 5, sample_rows))
    keep = [c for c in keep or ["doc_id"] if c not in (into, "_stats")]
    if isinstance(model, float):
        return docs.select(*keep, F.lit(model).alias(into))
    stats = docs.select(*keep, statistics(F.col("text")).alias("_stats"))
    return stats.select(*keep, model.score(F.col("_stats")).alias(into))
