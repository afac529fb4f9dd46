"""Global order without one task (P1), and the operators built on it.

A running total or a row number over a whole table normally needs ``Window.orderBy`` with no
partition, which sends every row to one task. Here rows are dealt to ranges of the whole sort key
(groups first, then every order column), so a burst at one time, a hot group or a common first
key spreads over as many ranges as its rows need. The ranged table is written once to the shared
checkpoint folder; totals are taken inside each range and the totals of the ranges before come
from a small per-range table. Rows equal in the whole key share a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotab.functions.timecols import from_micros, micros
from chronotab.session import cut_lineage

_BUCKET = "_rng"


def _n_buckets(df: DataFrame, n_buckets: int | None) -> int:
    if n_buckets:
        return int(n_buckets)
    spark = df.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(shuffle, spark.sparkContext.defaultParallelism, 2)


def count_below(arr: str, value, max_len: int) -> Column:
    """How many elements of a sorted array column (``max_len`` long at most) are strictly below
    ``value``: unrolled comparisons, so it stays in generated code."""
    v = F.col(value) if isinstance(value, str) else value
    terms = [F.when(F.coalesce(F.try_element_at(F.col(arr), F.lit(i + 1)) < v, F.lit(False)), 1).otherwise(0)
             for i in range(max_len)]
    out = terms[0] if terms else F.lit(0)
    for t in terms[1:]:
        out = out + t
    return out


def dealt_to_ranges(df: DataFrame, keys: Sequence[Column], name: str, n_buckets: int | None = None) -> DataFrame:
    """``df`` dealt to ranges of ``keys``, numbered in their order by the column ``name``, written once to
    the shared checkpoint folder; rows equal in all keys share a range."""
    return cut_lineage(df.repartitionByRange(_n_buckets(df, n_buckets), *keys).withColumn(name, F.spark_partition_id()))


def prefix_totals(df: DataFrame, order: Sequence[str], sums: dict[str, Column] | None = None,
                  partition_by: Sequence[str] = (), descending: bool = False,
                  position: str | None = None, n_buckets: int | None = None,
                  maxes: dict[str, Column] | None = None) -> DataFrame:
    """Add inclusive running totals of ``sums`` (name -> column), running maxima of ``maxes``
    and, if ``position`` is given, a 0-based row number, in ``order`` within ``partition_by``.

    Give a complete order where rows may tie; rows alike in all its columns are numbered in any
    order. Nulls come first ascending, last descending; a null group is a group of its own.
    """
    sums, maxes = dict(sums or {}), dict(maxes or {})
    values = {**sums, **maxes} | ({"_rows": F.lit(1).cast("bigint")} if position else {})
    names = [*sums, *(["_rows"] if position else [])]
    way = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    groups = [*partition_by, _BUCKET]
    ranged = dealt_to_ranges(df.withColumns({f"_v_{n}": c for n, c in values.items()}),
                             [*[F.col(c).asc() for c in partition_by], *way], _BUCKET, n_buckets)
    per = ranged.groupBy(*groups).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names],
                                      *[F.max(f"_v_{n}").alias(f"_t_{n}") for n in maxes])
    # a group lies in neighbouring ranges: one row each
    before = Window.partitionBy(*partition_by).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(groups)],
                     *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in names],
                     *[F.max(f"_t_{n}").over(before).alias(f"_off_{n}") for n in maxes])
    same = [ranged[k].eqNullSafe(per[f"_k_{i}"]) for i, k in enumerate(groups)]
    out = ranged.join(per, same, "left")
    upto = Window.partitionBy(*groups).orderBy(*way).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    made = {n: F.sum(f"_v_{n}").over(upto) + F.col(f"_off_{n}") for n in sums}
    made |= {n: F.greatest(F.max(f"_v_{n}").over(upto), F.col(f"_off_{n}")) for n in maxes}  # greatest skips nulls
    if position:
        made[position] = F.sum("_v__rows").over(upto) + F.col("_off__rows") - 1
    own = [c for c in df.columns if c not in made]
    return out.select(*own, *[c.alias(n) for n, c in made.items()])


def global_row_number(df: DataFrame, order: Sequence[str], name: str = "position",
                      partition_by: Sequence[str] = (), descending: bool = False,
                      n_buckets: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (ties broken by the later order columns)."""
    return prefix_totals(df, order, {}, partition_by, descending, position=name,
                         n_buckets=n_buckets)


def rank_to_date_anchor(entities: DataFrame, key: str, start, end,
                        name: str = "DECISION_TS", n_buckets: int | None = None) -> DataFrame:
    """Order entities by id; date = start + rank * span / (n - 1), in whole seconds (T6);
    a single entity gets ``start``. Returns ``(key, name)``.

    The integer seconds are ``(rank * span_seconds) div (n - 1)`` in BIGINT (T23).
    """
    from chronotab.functions.timecols import literal_micros

    start_us = literal_micros(start)
    span_s = (literal_micros(end) - start_us) // 1_000_000
    ids = entities.select(key)
    ranked = global_row_number(ids, [key], "_rank", n_buckets=n_buckets)
    # the entity count is a scalar subquery: evaluated once, no driver round trip, no join
    n = ids.agg(F.count(F.lit(1))).scalar()
    ranked = ranked.withColumn("_n", n)
    secs = F.when(F.col("_n") <= 1, F.lit(0).cast("bigint")).otherwise(
        F.expr(f"(CAST(_rank AS BIGINT) * CAST({span_s} AS BIGINT)) div (_n - 1)"))
    return ranked.select(
        key, from_micros(F.lit(start_us) + secs * F.lit(1_000_000)).alias(name))


def _linspace_member(pos: Column, total: Column, n: int) -> Column:
    """True when 0-based ``pos`` is one of rint(linspace(0, total - 1, n)) (numpy's formula:
    i * step, last point = total - 1, rounding half to even, duplicates merged)."""
    if n <= 0:
        return F.lit(False)
    if n == 1:
        return pos == 0
    step = (total - 1).cast("double") / F.lit(float(n - 1))
    approx = F.floor(pos.cast("double") / step)
    hits = []
    for d in (-1, 0, 1):
        i = approx + d
        at = F.when(i == n - 1, (total - 1).cast("double")).otherwise(F.rint(i * step))
        hits.append((i >= 0) & (i <= n - 1) & (at == pos.cast("double")))
    member = hits[0] | hits[1] | hits[2]
    return F.when(total <= n, F.lit(True)).otherwise(member)


def spaced_sample(df: DataFrame, order: Sequence[str], n: int, partition_by: Sequence[str] = (),
                  position: str = "position", n_buckets: int | None = None) -> DataFrame:
    """N rows evenly spaced by position in ``order`` (endpoints included, positions
    rounded half-even and deduplicated); n >= N keeps every row. Membership is a predicate on
    the global position, so no list of positions is built or joined."""
    ranked = global_row_number(df, order, position, partition_by=partition_by, n_buckets=n_buckets)
    if partition_by:
        # one small row per group, joined back (never a window over a whole group)
        totals = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_total"))
        ranked = ranked.join(totals, list(partition_by))
    else:
        ranked = ranked.withColumn("_total", df.agg(F.count(F.lit(1)).cast("bigint")).scalar())
    return ranked.where(_linspace_member(F.col(position), F.col("_total"), n)).drop("_total")


def stratified_spaced_sample(df: DataFrame, order: Sequence[str], outcome: str, count: int,
                             positives: int, position: str = "position",
                             n_buckets: int | None = None) -> DataFrame:
    """Up to ``positives`` positive rows and ``count - chosen positives`` negative rows,
    each group evenly spaced by position; the result keeps the file order column."""
    ranked = global_row_number(df, order, "_cls_pos", partition_by=[outcome], n_buckets=n_buckets)
    totals = df.groupBy(outcome).agg(F.count(F.lit(1)).alias("_total"))
    n_pos = totals.where(F.col(outcome) == 1).select("_total").first()
    n_pos = int(n_pos[0]) if n_pos else 0
    chosen_pos = min(positives, n_pos)
    n_neg = count - chosen_pos
    ranked = ranked.join(F.broadcast(totals), outcome)  # one row per outcome value
    want = F.when(F.col(outcome) == 1, _linspace_member(F.col("_cls_pos"), F.col("_total"), positives)) \
        .otherwise(_linspace_member(F.col("_cls_pos"), F.col("_total"), n_neg))
    return ranked.where(want).drop("_cls_pos", "_total")


def cursor_batch(df: DataFrame, position: str, total: int, cursor: int, k: int,
                 name: str = "batch_order") -> DataFrame:
    """The next k rows from ``cursor``, wrapping at the end, never one row twice;
    ``batch_order`` gives the send order. The next cursor is (cursor + min(k, total)) % total."""
    if total <= 0:
        return df.limit(0).withColumn(name, F.lit(0).cast("bigint"))
    take = min(k, total)
    order = F.pmod(F.col(position) - F.lit(cursor), F.lit(total))
    return df.withColumn(name, order.cast("bigint")).where(F.col(name) < take)


def next_cursor(total: int, cursor: int, k: int) -> int:
    return 0 if total <= 0 else (cursor + min(k, total)) % total


__all__ = [
    "prefix_totals", "global_row_number", "rank_to_date_anchor", "spaced_sample",
    "stratified_spaced_sample", "cursor_batch", "next_cursor", "micros",
]


def numpy_q(q: float) -> float:
    """The quantile numpy actually uses when pandas passes ``q * 100`` to ``percentile``."""
    return (q * 100.0) / 100.0


def lerp(a: Column, b: Column, g: Column) -> Column:
    """numpy's linear interpolation (the form that is exact at both ends)."""
    diff = b - a
    return F.when(g >= 0.5, b - diff * (F.lit(1.0) - g)).otherwise(a + diff * g)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    by: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas / numpy ``linear``) per group, without a
    per-group value map: distinct values with counts get global running counts (P1), and each
    requested position is looked up in the range of the value that holds it.

    Returns ``(*by, q_index, q, value)``; groups with no non-null value give no rows."""
    by = list(by)
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    pt = prefix_totals(counted, [value], {"_cum": F.col("_c")}, partition_by=by, n_buckets=n_buckets)
    if by:  # one row a group
        pt = pt.join(counted.groupBy(*by).agg(F.sum("_c").alias("_T")), by)
    else:
        pt = pt.withColumn("_T", counted.agg(F.sum("_c")).scalar())
    start = F.col("_cum") - F.col("_c")

    def asked(i: int, q: float) -> Column:
        at = (F.col("_T") - 1).cast("double") * F.lit(float(numpy_q(q)))
        lo = F.floor(at).cast("bigint")
        hi = F.least(lo + 1, F.col("_T") - 1)
        here = lambda x: (start <= x) & (x < F.col("_cum"))
        return F.when(here(lo) | here(hi), F.struct(
            F.lit(i).alias("q_index"), F.lit(float(numpy_q(q))).alias("q"), (at - lo.cast("double")).alias("_gm"),
            here(lo).alias("_is_lo"), here(hi).alias("_is_hi")))

    # a value answers the quantiles whose positions fall into its own run: no value meets all quantiles
    hits = pt.select(*by, F.col(value).alias("_v"), F.inline(F.array_compact(F.array(*[asked(i, q) for i, q in enumerate(probs)]))))
    ends = hits.groupBy(*by, "q_index", "q", "_gm").agg(F.max(F.when(F.col("_is_lo"), F.col("_v"))).alias("_vlo"),
                                                        F.max(F.when(F.col("_is_hi"), F.col("_v"))).alias("_vhi"))
    return ends.select(*by, "q_index", "q",
                       lerp(F.col("_vlo").cast("double"), F.col("_vhi").cast("double"), F.col("_gm")).alias("value"))
