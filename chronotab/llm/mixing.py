"""Mixing sources to target weights by weighted fair queueing.

A document's size is its number of words (runs of anything but the six ASCII blanks; null text 0).
Sources, by code point with null last, weigh 5, 2, 1, repeating. They share the total size by
weight; a target stops at ``passes`` times its source's size and the excess is shared among the
others. Each source's documents queue up in an order shuffled by a hash of doc_id, ``passes`` times
over; a copy's virtual finish time is the source's cumulative words up to and with it, divided by
the source's target. All copies are range-sorted by finish time and the mix is cut off at the
total budget.

Ties in finish time go by source, shuffle value, doc_id, size, the row's key where one is given, and
copy. Without a key, of rows alike in all of these either may be the one that the cut leaves out;
``mixed_documents`` gives every row a key. A null doc_id shuffles as an empty text; documents of size 0 take no
part and are returned with taken 0; other columns are ignored; an empty table gives an empty
result. Reruns agree: nothing depends on partitioning.

Scale: only narrow rows move. Cumulative sums come from a range partitioning, written once to the
shared checkpoint folder: running totals inside each range plus the totals of the ranges before,
so a source that holds a third of all rows spreads over many ranges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from chronotab.session import cut_lineage

WEIGHTS = (5, 2, 1)
PASSES = 3
#: A table of at most so many sources is broadcast; a larger one is joined as Spark sees fit.
BROADCAST_SOURCES = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def running_total(df: DataFrame, order: list[Column], values: list[str], group: str | None = None) -> DataFrame:
    """``df`` with ``<value>_to`` for each of ``values``: its total over all rows up to and with
    the row in ``order``, within ``group`` if given (``order`` must then start with the group)."""
    ranged = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_range", F.spark_partition_id()))
    names = [f"{v}_to" for v in values]

    def local(batches):
        carried, last = np.zeros(len(values), dtype=np.int64), object()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if group is None:
                new = np.zeros(batch.num_rows, dtype=bool)
            else:
                code = batch.column(group).dictionary_encode(null_encoding="encode").indices.to_numpy()
                new = np.r_[batch.column(group)[0].as_py() != last, code[1:] != code[:-1]]
                last = batch.column(group)[-1].as_py()
            begin = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            columns = []
            for k, v in enumerate(values):
                own = batch.column(v).to_numpy().astype(np.int64)
                total = np.cumsum(own)
                total = np.where(begin >= 0, total - (total - own)[np.maximum(begin, 0)], total + carried[k])
                carried[k] = total[-1]
                columns.append(pa.array(total))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    schema = T.StructType([*ranged.schema.fields, *[T.StructField(x, T.LongType()) for x in names]])
    out = ranged.mapInArrow(local, schema)
    keys = ["_range"] + ([group] if group else [])
    sums = ranged.groupBy(*keys).agg(*[F.sum(v).alias(f"_{v}") for v in values])
    # one row a range and group; a group's rows are as many as its ranges
    before = Window.partitionBy(*([group] if group else [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                       *[F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_{v}") for v in values])
    on = [out[k].eqNullSafe(sums[f"_k{i}"]) for i, k in enumerate(keys)]
    out = out.join(sums, on, "left")
    return (out.withColumns({f"{v}_to": F.col(f"{v}_to") + F.col(f"_{v}") for v in values})
            .drop("_range", *[f"_k{i}" for i in range(len(keys))], *[f"_{v}" for v in values]))


def targets(sizes: DataFrame, passes: int = PASSES) -> DataFrame:
    """(source, source_size, target) from (source, size)."""
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_total(own.withColumn("one", F.lit(1).cast("long")), [F.col("source").asc_nulls_last()], ["one"])
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in WEIGHTS]),
                          (F.pmod(F.col("one_to") - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    own = (ranked.select("source", "source_size", weight.alias("weight"))
           .withColumn("cap", F.col("source_size") * passes)
           .withColumn("full_at", F.col("cap") / F.col("weight")))
    filled = cut_lineage(running_total(own, [F.col("full_at").asc(), F.col("source").asc_nulls_last()], ["cap", "weight"]))
    total, weights = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    # with the sources before it full, each source's level; the largest is where the rest is shared out
    level = filled.agg(F.max((F.lit(total).cast("long") - F.col("cap_to") + F.col("cap"))
                             / (F.lit(weights).cast("long") - F.col("weight_to") + F.col("weight")))).first()[0]
    return filled.select("source", "source_size",
                         F.least(F.col("weight") * F.lit(level).cast("double"), F.col("cap").cast("double")).alias("target"))


def mix(docs: DataFrame, passes: int = PASSES, key: str | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) per document, and ``key``, a long column
    that differs in every row, if given."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    shuffled = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")
    own = [F.col(key).cast("long").alias("_key")] if key else []
    sized = cut_lineage(docs.select("doc_id", "source", size.alias("size"), shuffled.alias("shuffled"), *own))
    goals = targets(sized, passes)
    if goals.count() <= BROADCAST_SOURCES:
        goals = F.broadcast(goals)
    goals = goals.withColumnRenamed("source", "_source")
    sized = sized.join(goals, sized["source"].eqNullSafe(goals["_source"]), "left").drop("_source")
    place = [F.col("source").asc_nulls_last(), F.col("shuffled").asc(), F.col("doc_id").asc_nulls_last(), F.col("size").asc()]
    place += [F.col("_key").asc()] if key else []
    queued = running_total(sized, place, ["size"], "source")

    def place_of(copy: Column) -> Column:
        finish = ((copy - 1) * F.col("source_size") + F.col("size_to")) / F.col("target")
        return F.struct(finish.alias("finish"), F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("source"),
                        F.col("shuffled"), F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
                        F.col("size"), *([F.col("_key").alias("key")] if key else []), copy.alias("copy"))

    queued = cut_lineage(queued)
    copies = (queued.where("size > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(passes).cast("long"))))
              .select(place_of(F.col("copy")).alias("key"), "size"))
    budget = sized.agg(F.sum("size")).first()[0] or 0
    sent = running_total(copies, [F.col("key").asc()], ["size"])
    last = sent.where(F.col("size_to") <= budget).agg(F.max("key").alias("key")).first()["key"]
    if last is None:
        taken = F.lit(0)
    else:
        cut = F.struct(*[F.lit(last[f.name]).cast(f.dataType).alias(f.name) for f in copies.schema["key"].dataType.fields])
        taken = sum((F.when(place_of(F.lit(c).cast("long")) <= cut, 1).otherwise(0) for c in range(1, passes + 1)), F.lit(0))
    taken = F.when(F.col("size") > 0, taken).otherwise(0).cast("long")
    return queued.select("doc_id", "source", "size", "source_size", "target", taken.alias("copies"),
                         (taken * F.col("size")).alias("taken"), *([F.col("_key").alias(key)] if key else []))


def mixed_documents(docs: DataFrame, passes: int = PASSES) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it (``copy`` from 1, in place of
    a column of that name). Every row has a key of its own, so repeated rows are taken one by one."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = cut_lineage(docs.select(row, F.monotonically_increasing_id().alias("key")))
    taken = mix(rows.select("row.doc_id", "row.source", "row.text", "key"), passes, "key").where("copies > 0").select("key", "copies")
    out = rows.select("key", "row").join(taken, "key").select(
        "row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return out.select(*[F.col(f"row.`{c}`") for c in docs.columns if c != "copy"], "copy")
