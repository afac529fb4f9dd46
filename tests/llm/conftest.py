import random

import pytest

WORDS = "alpha beta gamma delta über straße naïve one two three four five six seven eight nine ten".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def corpus() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, extra columns): shared passages, copies, odd rows."""
    rng = random.Random(5)
    passages = [sentence(rng, n) for n in (12, 18, 30, 70)]
    rows = []
    for i in range(60):
        parts = [sentence(rng, rng.randrange(5, 60))]
        for p in passages:
            if rng.random() < 0.25:
                parts.insert(rng.randrange(len(parts) + 1), p)
        rows.append((i * 3, "\n".join(parts)))
    rows += [(500 + i, rows[i][1]) for i in range(6)]  # exact copies
    rows += [(600, None), (601, ""), (602, " \t\n"), (603, "x"), (604, "y " * 3000), (605, sentence(rng, 4000)),
             (None, rows[3][1]), (None, passages[3]), (9, rows[3][1]), (9, rows[3][1]), (607, "a b c " * 60)]
    out = []
    for d, t in rows:
        out.append((d, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s2", None]), None if t is None else len(t)))
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use inside
CLASHING = ["block", "row", "start", "until", "hash", "doc", "size", "score", "features", "label", "copy", "rank"]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(corpus, SCHEMA).repartition(5)
    return df.withColumns({c: F.lit(c) for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
