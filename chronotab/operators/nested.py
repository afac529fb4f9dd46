"""Nested requests: history as arrays and back.

A request is one entity row plus its history as ``array<struct>`` columns, the shape a scoring
service receives. Building requests is a join + ``collect_list`` per (selected entity, part):
history elements are numbered in their sort order within the entity (P1 numbering, so no task
holds a whole entity) and cut into parts of at most ``max_elements``, so a hot entity's request
spans several rows (``part`` 0, 1, ...) instead of one unbounded array. Reading the parts in
order gives the sorted history. Rebuilding tables from requests is ``explode``; the same feature
code then runs on them, which is what the parity checks (D11) compare against the batch features.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotab.functions.timecols import MICROS_PER_DAY, micros
from chronotab.operators.order import global_row_number
from chronotab.operators.windows import with_time_buckets

MAX_ELEMENTS = 100_000  # history elements per request row


def _parts(rows: DataFrame, key: str, order: Sequence[str], max_elements: int) -> DataFrame:
    """``part`` = position of the row in ``order`` within its key, div ``max_elements``.

    When no key has more than ``max_elements`` rows (one map-side-combined count per key and a
    read of at most one row), every row is part 0 and the numbering pass is skipped."""
    big = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > int(max_elements))
    if big.limit(1).count() == 0:
        return rows.withColumn("part", F.lit(0))
    first = order[0]
    kind = rows.schema[first].dataType.typeName()
    if kind.startswith("timestamp") or kind == "date":
        # the range key must be numeric: microseconds of the first sort column
        rows = rows.withColumn("_o0", micros(first))
        order = ["_o0", *order]
    ranked = global_row_number(rows, list(order), "_pos", partition_by=[key])
    return (ranked.withColumn("part", F.floor(F.col("_pos") / F.lit(int(max_elements))).cast("int"))
            .drop("_pos", "_o0"))


def _with_parts(base: DataFrame, key: str, arrays: DataFrame, names: Sequence[str]) -> DataFrame:
    """Base rows x their parts; an entity without history gets part 0 with empty arrays."""
    out = base.join(arrays, key, "left").withColumn("part", F.coalesce(F.col("part"), F.lit(0)))
    for n in names:
        out = out.withColumn(n, F.coalesce(F.col(n), F.array().cast(arrays.schema[n].dataType)))
    return out


def range_history_join(selected: DataFrame, history: DataFrame, card: str, ts: str,
                       key: str, hist_cols: Sequence[str], history_days: int = 30,
                       bucket_days: int | None = None, name: str = "history",
                       max_elements: int = MAX_ELEMENTS) -> DataFrame:
    """For each selected event, its card's rows with time in ``[t - w, t)`` as an array of
    structs in time order (empty when none), in parts of at most ``max_elements``.

    The join is on ``(card, time bucket)``: history rows are copied into each later bucket
    within the look-back (as for the window features), so a hot card is split by time and no
    task holds a whole card. Events whose bucket fits one array are cut out of it; only those of
    fuller buckets, and repeated keys, whose rows share one history, go by pairs."""
    w_us = history_days * MICROS_PER_DAY
    b_us = (bucket_days or 2 * history_days) * MICROS_PER_DAY
    sel = selected.withColumn("_t", micros(ts)).withColumn(
        "_bk", F.floor(F.col("_t") / F.lit(b_us)).cast("bigint"))
    h = with_time_buckets(history.select(card, *hist_cols).withColumn("_ht", micros(ts)),
                          "_ht", w_us, b_us).drop("_home")
    h = h.select(card, "_bk", "_ht", F.struct(*hist_cols).alias("_h"))

    # keys that take the paired path: those with a bucket too big for one array, and repeated ones
    full = h.groupBy(card, "_bk").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > int(max_elements))
    again = sel.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(key)
    paired = sel.join(full, [card, "_bk"], "left_semi").select(key).unionByName(again).where(F.col(key).isNotNull()).distinct()
    some = paired.limit(1).count() > 0
    whole = _by_slices(sel.join(paired, key, "left_anti") if some else sel, h, card, key, w_us, name)
    whole = whole.select(*selected.columns, "part", name)
    if not some:
        return whole
    return whole.unionByName(_by_pairs(selected.join(paired, key, "left_semi"), sel.join(paired, key, "left_semi"),
                                       h, card, key, w_us, name, max_elements).select(*whole.columns))


def _by_slices(sel: DataFrame, h: DataFrame, card: str, key: str, w_us: int, name: str) -> DataFrame:
    """One sorted array per (card, bucket), of which each selected event keeps its own stretch: no
    pair of event and history row is shuffled, sorted or written before the request itself is."""
    arrays = h.groupBy(card, "_bk").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_ht").alias("t"), F.col("_h").alias("h")))).alias("_a"))
    own = F.transform(F.filter("_a", lambda x: (x["t"] < F.col("_t")) & (x["t"] >= F.col("_t") - F.lit(w_us))), lambda x: x["h"])
    out = sel.join(arrays, [card, "_bk"], "left")
    none = F.array().cast(out.select(own.alias("_o")).schema["_o"].dataType)
    return out.withColumn("part", F.lit(0)).withColumn(
        name, F.coalesce(F.when(F.col(key).isNotNull(), own), none)).drop("_a", "_t", "_bk")


def _by_pairs(selected: DataFrame, sel: DataFrame, h: DataFrame, card: str, key: str, w_us: int, name: str,
              max_elements: int) -> DataFrame:
    """Each selected event with each of its history rows, numbered and cut into parts."""
    j = sel.select(key, card, "_bk", "_t").join(h, [card, "_bk"]).where(
        (F.col("_ht") < F.col("_t")) & (F.col("_ht") >= F.col("_t") - F.lit(w_us)))
    j = _parts(j.select(key, "_ht", "_h"), key, ["_ht", "_h"], max_elements)
    arrays = j.groupBy(key, "part").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("_ht").alias("t"), F.col("_h").alias("h")))),
                    lambda x: x["h"]).alias(name))
    return _with_parts(selected, key, arrays, [name])


def nested_history(entities: DataFrame, key: str, tables: dict[str, tuple[DataFrame, Sequence[str]]],
                   grand: dict[str, tuple[DataFrame, str, Sequence[str], str]] | None = None,
                   max_elements: int = MAX_ELEMENTS) -> DataFrame:
    """One row per (entity, part) with one array per history table (rows keyed by ``key``)
    and, for grand-history, the rows whose parent id belongs to the entity; each array holds
    the part's slice of that table's sorted rows (empty when it has none).

    ``tables``: name -> (history df with ``key``, columns);
    ``grand``: name -> (grand df, parent id column, columns, parent table name in ``tables``)."""
    ids = entities.select(key)
    rows = {}
    for name, (df, cols) in tables.items():
        rows[name] = (df.join(ids, key, "left_semi").select(key, *cols), cols)
    for name, (gdf, parent_id, cols, parent_table) in (grand or {}).items():
        parents = tables[parent_table][0].join(ids, key, "left_semi").select(key, parent_id)
        rows[name] = (gdf.join(parents, parent_id).select(key, *cols), cols)
    parts = None
    for name, (df, cols) in rows.items():
        arr = (_parts(df, key, list(cols), max_elements).groupBy(key, "part")
               .agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name)))
        parts = arr if parts is None else parts.join(arr, [key, "part"], "full")
    return _with_parts(entities, key, parts, list(rows))


def explode_history(requests: DataFrame, array_col: str, keep: Sequence[str]) -> DataFrame:
    """One table per history array, each row tagged with the request's ``keep`` columns."""
    return requests.select(*keep, F.explode(array_col).alias("_r")).select(*keep, "_r.*")


def history_before_decision(history: str, hist_ts: str, decision_ts: str):
    """True when any history row is at or after the decision (the request is refused)."""
    return F.exists(F.col(history), lambda h: h[hist_ts] >= F.col(decision_ts))


def event_request_rows(requests: DataFrame, request_key: str, txn: str, history: str,
                       shared: Sequence[str]) -> DataFrame:
    """The transaction and its history as rows of one table, each row carrying the
    request's shared columns (card, home location); ``_is_txn`` marks the transaction."""
    first = requests.where(F.col("part") == 0) if "part" in requests.columns else requests
    t = first.select(request_key, F.lit(True).alias("_is_txn"), F.col(f"{txn}.*"))
    h = requests.select(request_key, *[F.col(f"{txn}.{c}").alias(c) for c in shared],
                        F.explode(history).alias("_h"))
    h = h.select(request_key, F.lit(False).alias("_is_txn"), *shared, "_h.*")
    return t.unionByName(h, allowMissingColumns=True)
