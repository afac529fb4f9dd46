"""Toxicity by gradient-boosted trees over dense text features, with isotonic calibration.

Features of a whole text: density of insults from a fixed lexicon and from words and
stems learned on the training rows, both also after undoing letter substitutions; nearness of insults to second-person
words; shares of capitals and of words in capitals; rates of exclamation marks, other punctuation
and symbols; rates of obfuscated words and of letters spelled out. The trees are fitted on three
quarters of a bounded sample of labelled documents (``sample_rows``), isotonic regression on the
rest turns their margin into a probability.

Null and empty texts have features of zero and are scored like any other; without labels of both
kinds the score is the share of label 1 among them (0 without labels). Other columns are ignored;
empty tables give an empty result. Scoring reads every whole text once, without a shuffle.
"""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from chronotab.llm.folds import labelled_sample
from chronotab.session import cut_lineage

SAMPLE_ROWS = 20_000
LEARNED_WORDS = 300
STEMS = (3, 4, 5, 6)
NEAR = 5
# Common insults of the four languages of the data.
INSULTS = frozenset("""
idiot idiots moron morons stupid dumb loser losers trash garbage scum clown clowns pathetic worthless disgusting
fool fools jerk creep pig filth filthy vermin ugly coward liar hate imbecile dimwit shameful
crétin crétine débile connard imbécile abruti ordure minable pourri
dummkopf trottel depp blödmann abschaum widerlich erbärmlich wertlos
idiota estúpido estúpida imbécil basura asqueroso patético inútil escoria
""".split())
# Second-person words.
YOU = frozenset("you your yours yourself ur u tu toi te ton ta vous votre du dich dir dein deine ihr euch tú usted ustedes vosotros".split())
# Signs written for letters.
_SIGNS = str.maketrans("013457@$!|", "oieastasil")
_TOKEN = re.compile(r"\S+")
_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"(?<!\S)(?=\S*[^\W\d_])(?=\S*[\d@$*!|])\S*[^\W\d_][\d@$*!|.\-_]+[^\W\d_]\S*")
_SPELLED = re.compile(r"(?<!\S)(?:[^\W\d_][ .\-_*]){3,}[^\W\d_](?!\w)")
_CAPITALS = re.compile(r"(?<!\w)[^\W\d_a-zß-öø-ÿ]{2,}(?!\w)")
FEATURES = ("lexicon", "learned", "kinds", "hidden", "near_you", "you", "capitals", "capital_words", "exclaims", "punctuation",
            "symbols", "mixed", "spelled", "length")


def features(text: str | None, learned: frozenset[str], begins: frozenset[str]) -> list[float]:
    """The values of FEATURES; densities are per 100 words or per character.

    ``begins`` holds the first letters (as many as the shortest stem) of ``learned``.
    """

    def marks(word: str) -> bool:
        return (word[:STEMS[0]] in begins or len(word) < STEMS[0]) and (
            word in learned or any(f"{word[:n]}*" in learned for n in STEMS if n < len(word)))

    text = text or ""
    words = _WORD.findall(text.lower())
    n, size = max(1, len(words)), max(1, len(text))
    hits = [i for i, w in enumerate(words) if w in INSULTS or marks(w)]
    you = [i for i, w in enumerate(words) if w in YOU]
    near = 0
    for i in hits:
        k = bisect.bisect_left(you, i - NEAR)
        near += k < len(you) and you[k] <= i + NEAR
    mixed = _MIXED.findall(text)
    spelled = _SPELLED.findall(text)
    hidden = 0
    for x in mixed + spelled:
        plain = re.sub(r"[^\w]|_", "", x.lower().translate(_SIGNS))
        bare = re.sub(r"[\W\d_]", "", x.lower())
        hidden += plain in INSULTS or marks(plain) or bare in INSULTS or marks(bare)
    found = [words[i] for i in hits]
    return [100 * sum(w in INSULTS for w in found) / n, 100 * sum(map(marks, found)) / n, float(len(set(found))),
            float(hidden), near / max(1, len(hits)), 100 * len(you) / n,
            sum(map(str.isupper, text)) / size, 100 * len(_CAPITALS.findall(text)) / n, 100 * text.count("!") / size,
            100 * sum(map(text.count, ".,;:?-\"'()")) / size, 100 * sum(map(text.count, "#$%&*@^~|<>=+")) / size,
            100 * len(mixed) / n, 100 * len(spelled) / n, float(n)]


def add_features(docs: DataFrame, learned: frozenset[str], keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``features``, an array."""

    begins = frozenset(w.rstrip("*")[:STEMS[0]] for w in learned)

    def run(batches):
        for batch in batches:
            made = pa.array([features(x, learned, begins) for x in batch.column("text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], made], [*keep, "features"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in keep] + ["features array<double>"])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def learned_lexicon(sample: DataFrame, entries: int = LEARNED_WORDS) -> frozenset[str]:
    """Words, and beginnings of words (marked ``*``), that mark documents of label 1.

    Kept are those 20 times as frequent there, by share of documents, as in the others, and too
    often to be chance; at most ``entries``, the surest first.
    """
    sizes = sample.agg(F.sum("label"), F.count("*")).first()
    bad, total = float(sizes[0] or 0), float(sizes[1])
    if not 0 < bad < total:
        return frozenset()
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))
    stems = [F.transform(F.filter(words, lambda w, n=n: F.length(w) > n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*")))
             for n in STEMS]
    each = sample.select("label", F.explode(F.array_distinct(F.flatten(F.array(words, *stems)))).alias("word"))
    rate = (F.col("bad") / bad) / ((F.col("n") - F.col("bad") + 0.5) / (total - bad))
    sure = F.col("bad") * F.log(F.col("bad") * total / (F.col("n") * bad))
    best = (each.groupBy("word").agg(F.sum("label").alias("bad"), F.count("*").alias("n"))
            .where((rate >= 20) & (sure >= 10)).orderBy(sure.desc(), "word").limit(entries))
    return frozenset(r.word for r in best.collect())


def fit(sample: DataFrame):
    """A scorer of (doc_id, text) rows from labelled rows (doc_id, text, label, share)."""
    sample = cut_lineage(sample.coalesce(8))
    trees = sample.where("share < 0.75")
    held = sample.where("share >= 0.75")
    bad, n = sample.agg(F.sum("label"), F.count("*")).first()
    kinds = [r[0] for part in (trees, held) for r in part.agg(F.countDistinct("label")).collect()]
    if min(kinds) < 2:
        share = float(bad or 0) / n if n else 0.0
        return lambda docs: docs.select("doc_id", F.lit(share).alias("score"))
    learned = learned_lexicon(trees)
    vectors = cut_lineage(add_features(sample, learned, ["label", "share"]).withColumn("features", array_to_vector("features")))
    model = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, seed=7, cacheNodeIds=False).fit(vectors.where("share < 0.75"))

    def margin(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1])

    scale = (IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score")
             .fit(margin(vectors.where("share >= 0.75")).select("margin", "label")))

    def score(docs: DataFrame) -> DataFrame:
        made = add_features(docs.select("doc_id", "text"), learned, ["doc_id"]).withColumn("features", array_to_vector("features"))
        out = scale.transform(margin(made))
        return out.select("doc_id", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, score) for every row of ``docs``, learned from ``labels.toxic`` outside fold 0 of 5."""
    return fit(labelled_sample(docs, labels, "toxic", 5, sample_rows))(docs)
