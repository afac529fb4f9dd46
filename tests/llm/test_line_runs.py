"""op11 against counting every line in Python, and the levels of the runs."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronotab.llm import line_runs

from .conftest import CLASHING, SCHEMA

BLANKS = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def by_hand(rows, min_docs):
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    split = [(d, (t or "").split("\n")) for d, t, *_ in rows]
    found = Counter(k for _, ls in split for k in {key(x) for x in ls})
    out = Counter()
    for d, ls in split:
        kept = [x for x in ls if not key(x) or found[key(x)] < min_docs]
        out[(d, len(ls), len(ls) - len(kept), "\n".join(kept))] += 1
    return out


def rows_of(df):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect())


ODD = [
    (700, "\n\n"), (701, "SHARED  line\r\nown 701\n"), (702, "\tshared  LINE \n\n\n"), (703, "shared  line\nshared  line\nÄ"),
    (704, "ä\nshared line"), (705, " shared  line"), (None, "shared  line\nx"), (None, "shared  line\nx"), (None, None),
    (706, "own " * 5 + "\n" + "\n".join(f"row {i}" for i in range(20_000))), (707, "row 7\nrow 8\nrow 9"), (707, "row 7"),
]


@pytest.mark.parametrize("batches", [1, 3, 5])
@pytest.mark.parametrize("min_docs", [1, 2, 5])
def test_lines_dropped(spark, corpus, batches, min_docs):
    rows = [*corpus, *[(d, t, None, None, None) for d, t in ODD]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({c: F.lit(c) for c in [*CLASHING, "_h1", "_lines", "_gone", "n", "kept"]})
    assert rows_of(line_runs.drop_common_lines(docs, min_docs, batches)) == by_hand(rows, min_docs)


def test_a_third_of_all_rows_alike(spark):
    rows = [(i, "the same\nline " + str(i), None, None, None) for i in range(200)] + [(5, "copy\nof 5", None, None, None)] * 100
    docs = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(line_runs.drop_common_lines(docs, 10, 2)) == by_hand(rows, 10)


def test_levels(spark, docs):
    runs = line_runs.LineRuns(spark, 5)
    tables = lambda: spark.sql(f"SHOW TABLES IN {runs.database}").count()
    for k, levels in enumerate([[0], [1], [0, 1], [2], [0, 2]]):
        runs.add(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == k))
        assert sorted(runs.levels) == levels and tables() == len(levels)
    merged = runs._merged(*[spark.table(runs.levels[k]) for k in (2, 0)])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan or "Exchange" not in plan  # runs meet bucket by bucket
    want = line_runs.line_counts(docs).where("n >= 5").select("_h1", "_h2")
    got = runs.common()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    runs.close()
    assert spark.sql("SHOW DATABASES").where(F.col("namespace") == runs.database).isEmpty()


def test_settled_keys_are_not_counted_again(spark):
    runs = line_runs.LineRuns(spark, 3)
    batch = spark.createDataFrame([(i, "again\nonly " + str(i), None, None, None) for i in range(4)], SCHEMA)
    runs.add(batch)
    runs.add(batch)
    run = spark.table(runs.levels[1])
    assert sorted(r.n for r in run.collect()) == [2, 2, 2, 2, 4]  # "again" was left out of the second run
    runs.close()


def test_empty(spark, no_docs):
    assert line_runs.drop_common_lines(no_docs).collect() == []
