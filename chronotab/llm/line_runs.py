"""Line dedup by levelled sorted runs of line hashes.

A text is split at ``\\n`` (null or empty: one empty line). A line's key is the line without the six
ASCII blanks at both ends and with A-Z lower-cased, kept as a 128-bit hash. ``LineRuns`` stores, for
every key, the number of documents that hold it, as runs: tables bucketed and sorted by the key. A
new batch is counted, merge-anti-joined with the runs (a key that a run already shows to be common
is settled and need not be counted again) and added as a run of level 0. Two runs of one level are
compacted into one run of the next level by a merge join, so n batches leave about log2(n) runs and
a key is rewritten as often. Runs are read bucket by bucket in their order: neither the anti-join
nor the compaction shuffles or sorts them again.

Every row is a document of its own, whatever doc_id it has or shares: rows alike in doc_id and text
count once each and get the same result. Empty keys (empty lines, lines of blanks) are never common.
A null doc_id is a value as any other. Other columns are ignored, whatever their names; an empty
table gives an empty result.

Scale: a line is counted map-side before the shuffle, so one that stands in every document sends
one row a task. Of the texts, only the lines with common keys leave their document, as numbers; the
documents meet them by a key of doc_id and text, so copies of one text under many ids spread.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chronotab.session import cut_lineage, ensure_checkpoint_dir

MIN_DOCS = 10
BATCHES = 4
# The six ASCII blanks.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEY = ["_h1", "_h2"]
#: Lets a scan of a run with one file a bucket state its order, so that merge joins need no sort.
SORTED_SCANS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def lines(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def hashes(key: str) -> list[Column]:
    return [F.xxhash64(key).alias(KEY[0]), F.xxhash64(F.lit(1), key).alias(KEY[1])]


def line_counts(docs: DataFrame) -> DataFrame:
    """(_h1, _h2, n): the number of documents that hold each key."""
    keys = F.array_distinct(F.transform(lines(), line_key))
    return (docs.select(F.explode(keys).alias("_key")).where("_key <> ''").select(*hashes("_key"))
            .groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")))


class LineRuns:
    """Levelled sorted runs of line hashes in a database of its own below the shared folder.

    ``min_docs``: the number of documents from which a line is common. ``close()`` drops the runs.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS):
        self.spark, self.min_docs = spark, min_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, str] = {}  # at most one run a level
        self.database = f"line_runs_{uuid.uuid4().hex}"
        folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{self.database}"
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{folder}'")

    def _write(self, run: DataFrame) -> str:
        name = f"{self.database}.run_{uuid.uuid4().hex}"
        before = self.spark.conf.get(SORTED_SCANS)
        self.spark.conf.set(SORTED_SCANS, "true")
        try:
            run.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        finally:
            self.spark.conf.set(SORTED_SCANS, before)
        return name

    def _merged(self, one: DataFrame, two: DataFrame) -> DataFrame:
        count = [F.coalesce(side["n"], F.lit(0)) for side in (one, two)]
        both = one.join(two, KEY, "full_outer")
        return both.select(*KEY, (count[0] + count[1]).alias("n"))

    def add(self, docs: DataFrame) -> None:
        """Counts a batch, leaves out what the runs have settled, and adds the rest as a run."""
        own = line_counts(docs)
        for name in self.levels.values():
            settled = self.spark.table(name).where(F.col("n") >= self.min_docs).select(*KEY)
            own = own.join(settled, KEY, "left_anti")
        name, level = self._write(own), 0
        while level in self.levels:  # compaction
            below = self.levels.pop(level)
            merged = self._write(self._merged(self.spark.table(below), self.spark.table(name)))
            for old in (below, name):
                self.spark.sql(f"DROP TABLE {old}")
            name, level = merged, level + 1
        self.levels[level] = name

    def common(self) -> DataFrame:
        """(_h1, _h2) of the lines found in ``min_docs`` documents or more, written once."""
        total = None
        for _, name in sorted(self.levels.items()):
            run = self.spark.table(name)
            total = run if total is None else self._merged(total, run)
        if total is None:
            return self.spark.createDataFrame([], "_h1 long, _h2 long")
        return cut_lineage(total.where(F.col("n") >= self.min_docs).select(*KEY))

    def close(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.database} CASCADE")
        self.levels = {}


def drop_lines(docs: DataFrame, common: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): ``docs`` without the lines whose keys are in ``common``."""
    own = [F.xxhash64("doc_id", "text").alias("_k1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("_k2")]
    rows = docs.select("doc_id", *own, lines().alias("_lines"))
    keyed = docs.select(*own, F.posexplode(F.transform(lines(), line_key)).alias("_at", "_key")).where("_key <> ''")
    gone = (keyed.select("_k1", "_k2", "_at", *hashes("_key")).join(common, KEY, "left_semi")
            .groupBy("_k1", "_k2").agg(F.collect_set("_at").alias("_gone")))
    none = F.array().cast("array<int>")
    out = rows.join(gone, ["_k1", "_k2"], "left").withColumn("_gone", F.coalesce("_gone", none))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
    kept = F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    return out.select("doc_id", F.size("_lines").cast("long").alias("n_lines"),
                      F.size("_gone").cast("long").alias("n_dropped"), kept.alias("kept"))


def drop_common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): lines found in ``min_docs`` documents or more dropped
    from every document. The documents enter the runs in ``batches`` by a hash of doc_id."""
    runs = LineRuns(docs.sparkSession, min_docs)
    try:
        for k in range(batches):
            runs.add(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == k))
        common = runs.common()
    finally:
        runs.close()
    return drop_lines(docs, common)
