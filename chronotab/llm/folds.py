"""Folds by document id and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(of: int) -> Column:
    """crc32 of doc_id as text, modulo ``of``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(of)).cast("int")


def hashed_share(seed: int) -> Column:
    """A number in [0, 1) by doc_id."""
    return F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / F.lit(1 << 30)


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, folds: int, rows: int) -> DataFrame:
    """(doc_id, text, label, share) of about ``rows`` labelled documents outside fold 0, by hash.

    Rows without id or label are left out; a doc_id with several labels takes the largest. The
    sample's ids are broadcast: ``rows`` bounds their size.
    """
    known = (labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & (fold(folds) != 0))
             .groupBy("doc_id").agg(F.max(column).cast("double").alias("label")))
    total = known.count()
    if total > rows:
        known = known.where(hashed_share(11) < rows / total)
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return text.join(F.broadcast(known), "doc_id").withColumn("share", hashed_share(12))
