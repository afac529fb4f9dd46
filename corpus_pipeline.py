"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, source mix.

``STAGES`` are (name, function) pairs in order; a function takes (spark, docs, sf_dir) and returns
the documents it keeps. Every stage is written as Parquet and read again before the next one. All
but the last return the columns of ``docs``; the last adds ``copy`` (and leaves out a column of that
name).

For every stage: columns beyond doc_id, text, source and n_chars are carried along whatever their
names; rows count one by one, whatever doc_id they have or share, so repeated rows and rows without
doc_id are handled like any others; texts are looked at whole, null texts as empty ones; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronotab.llm import containment, mixing, order_minhash, quality, suffix_dedup
from chronotab.llm.queries import shared_folder
from chronotab.session import cut_lineage, prepare_session

#: Rule ensembles and alignments are not expressible in SQL; tests check every stage by brute force.
ORACLE_SQL = None


def wrapped(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` beside the whole row as one column ``row``, so that no name can clash."""
    return docs.select(*columns, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def keyed(docs: DataFrame) -> DataFrame:
    """(row, key): every row with a key of its own, written with it in the shared folder. Spark removes
    the files when no table refers to them any more."""
    return cut_lineage(wrapped(docs).withColumn("key", F.monotonically_increasing_id()))


def fields(*columns: str) -> list:
    return [F.col(f"row.{c}").alias(c) for c in columns]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.3 or more); null and empty texts are
    scored as empty ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.quality(wrapped(docs, "doc_id", "text"), labels, keep=["row"], into="score")
    return scored.where(F.col("score") >= quality.ACCEPT).select("row.*")


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least doc_id (nulls last, then by text) of each class of near duplicates. Rows
    without words are in no class with others and all stay."""
    rows = keyed(docs)
    near = order_minhash.near_classes(rows.select(F.col("key").alias("doc_id"), *fields("text"))).select(F.col("doc_id").alias("key"), "class_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "key")
    first = (rows.select("key", *fields("doc_id", "text")).join(near, "key").select("class_id", "key", order.alias("order"))
             .groupBy("class_id").agg(F.min_by("key", "order").alias("key")).select("key"))
    return rows.join(first, "key", "leftsemi").select("row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 100 bytes that start earlier; n_chars follows the text.

    Bytes of a character that is cut through go as well (as do characters U+FFFD of a document that is
    cut). A document of which nothing is left goes; null and empty texts stay.
    """
    # the other columns travel with the text: whole rows are dealt once and joined to nothing
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("id"), F.col("text").isNull().alias("none"),
                       F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    cut = suffix_dedup.remove_repeats(rows, key="id", keep=("none", "row"))
    left = F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\ufffd", "")
    text = F.when(F.col("none"), F.lit(None)).when(F.col("n_removed") > 0, left).otherwise(F.col("kept").cast("string"))
    out = cut.select("n_removed", "row", text.alias("text")).where("n_removed = 0 or trim(text) <> ''")
    changed = {"text": F.col("text")}
    if "n_chars" in rest:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("n_removed") > 0, n_chars).otherwise(F.col("row.n_chars"))
    return out.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return containment.add_matches(wrapped(docs, "text"), items, into="leaks").where(F.size("leaks") == 0).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The source mix: every row as often as the mix takes it (``copy`` from 1). Documents without words
    are taken never; rows alike in all else are taken one after the other."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("near duplicates", keep_one_copy),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("source mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    prepare_session(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
