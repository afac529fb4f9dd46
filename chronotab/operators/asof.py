"""As-of aggregation over history tables (C1, C2, D1-D7 as declarations).

``asof_aggregate(history, decisions, key, ts, aggs)`` keeps a history row iff its own time is
strictly before its entity's decision time (T1), then aggregates per entity. Every aggregate is
declared in decomposable form (counts and exact sums), so Spark combines it map-side before the
shuffle and a hot entity never ships its raw rows to one task.

Join strategy, decided once per decision table:

* ``adaptive`` (default) - a plain equi-join left to AQE: it broadcasts the decision side when
  its measured shuffle output is under the broadcast threshold, and otherwise splits skewed
  partitions of the sort-merge join (``forceOptimizeSkewedJoin``), so a hot entity is spread
  over several tasks. The partial aggregate runs before the shuffle that follows.
* ``broadcast`` - the caller proved a row bound (``fits_broadcast``); history is not shuffled
  before the partial aggregate.
* ``salt`` - otherwise history rows get a salt in ``[0, S)`` from a hash of the row, each decision
  row is repeated S times and the join runs on ``(key, salt)``; each of the S tasks holding a
  share of a hot key pre-aggregates it before the shuffle on the key. For engines or clusters
  without AQE skew handling.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotab.functions.fixedpoint import EXACT, mean_from, scaled, std_from, sum_from

BROADCAST_MAX_ROWS = 2_000_000  # decision rows; about 2 columns each
DEFAULT_SALT = 16


@dataclass(frozen=True)
class Agg:
    """One output column. ``kind``: count (non-null ``col``), count_if (``cond``), sum / mean /
    std (exact, ``col`` scaled by 10^scale), fsum / fmean (plain doubles), max, min."""

    name: str
    kind: str
    col: object = None
    scale: int = 2
    cond: object = None


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _partials(a: Agg) -> list[tuple[str, Column, str]]:
    """(state name, per-row expression, combine function) for one aggregate."""
    p = f"_{a.name}"
    if a.kind == "count":
        return [(p + "_n", F.when(_c(a.col).isNotNull(), 1).otherwise(0).cast("bigint"), "sum")]
    if a.kind == "count_if":
        return [(p + "_n", F.when(_c(a.cond), 1).otherwise(0).cast("bigint"), "sum")]
    if a.kind == "sum":
        return [(p + "_s", scaled(a.col, a.scale), "sum")]
    if a.kind in ("mean", "std"):
        out = [(p + "_s", scaled(a.col, a.scale), "sum"),
               (p + "_n", F.when(_c(a.col).isNotNull(), 1).otherwise(0).cast("bigint"), "sum")]
        if a.kind == "std":
            s = scaled(a.col, a.scale)
            out.append((p + "_q", (s * s).cast(EXACT), "sum"))
        return out
    if a.kind == "fsum":
        return [(p + "_s", _c(a.col).cast("double"), "sum")]
    if a.kind == "fmean":
        return [(p + "_s", _c(a.col).cast("double"), "sum"),
                (p + "_n", F.when(_c(a.col).isNotNull(), 1).otherwise(0).cast("bigint"), "sum")]
    if a.kind in ("max", "min"):
        return [(p + "_m", _c(a.col), a.kind)]
    raise ValueError(f"unknown aggregate kind {a.kind}")


def _final(a: Agg) -> Column:
    p = f"_{a.name}"
    if a.kind in ("count", "count_if"):
        col = F.col(p + "_n").cast("bigint")
    elif a.kind == "sum":
        col = sum_from(p + "_s", a.scale)
    elif a.kind == "mean":
        col = mean_from(p + "_s", p + "_n", a.scale)
    elif a.kind == "std":
        col = std_from(p + "_s", p + "_q", p + "_n", a.scale)
    elif a.kind == "fsum":
        col = F.col(p + "_s")
    elif a.kind == "fmean":
        col = F.when(F.col(p + "_n") > 0, F.col(p + "_s") / F.col(p + "_n"))
    else:
        col = F.col(p + "_m")
    return col.alias(a.name)


def _combine(fn: str, name: str) -> Column:
    return getattr(F, fn)(name).alias(name)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Proven size bound: reads at most ``max_rows + 1`` rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def choose_strategy(decisions: DataFrame, max_rows: int | None = None) -> str:
    """``adaptive`` unless a row bound is asked for: then ``broadcast`` when the decision
    table is proven to fit it, else ``salt``."""
    if max_rows is None:
        return "adaptive"
    return "broadcast" if fits_broadcast(decisions, max_rows) else "salt"


def asof_aggregate(history: DataFrame, decisions: DataFrame, key: str,
                   ts: Column | Callable[[], Column], aggs: Sequence[Agg],
                   decision_ts: str = "DECISION_TS", prefilter: Column | None = None,
                   strategy: str = "auto", salt: int = DEFAULT_SALT) -> DataFrame:
    """C1 + D-form. ``ts`` is the history row's own time; it may use ``decision_ts`` (B3's
    offset form). Rows of unknown entities or with a null time drop out. Returns one row per
    entity that has at least one valid history row: ``(key, *agg names)``."""
    if strategy == "auto":
        strategy = choose_strategy(decisions)
    h = history.where(prefilter) if prefilter is not None else history
    dec = decisions.select(key, decision_ts)
    parts = [p for a in aggs for p in _partials(a)]
    if strategy == "broadcast":
        joined = h.join(F.broadcast(dec), key)
        group = [key]
    elif strategy == "adaptive":
        # AQE decides at run time from the measured size of the decision side: a broadcast
        # join when it is small, otherwise a sort-merge join whose oversized partitions (a hot
        # entity) are split across tasks (skew join, forced even though the aggregate after it
        # then needs its own shuffle). The aggregate is partial before that shuffle.
        joined = h.join(dec, key)
        group = [key]
    elif strategy in ("salt", "shuffle"):
        n_salt = salt if strategy == "salt" else 1
        h = h.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in h.columns]), F.lit(n_salt)))
        dec = dec.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n_salt - 1)).cast("array<bigint>")))
        joined = h.join(dec, [key, "_salt"]).drop("_salt")
        group = [key]  # each salted task pre-aggregates its share of a hot key before the shuffle
    else:
        raise ValueError(f"unknown strategy {strategy}")
    tcol = ts() if callable(ts) else ts
    valid = joined.where(tcol < F.col(decision_ts))
    state = valid.groupBy(*group).agg(*[fn_alias(fn, expr, name) for name, expr, fn in parts])
    return state.select(key, *[_final(a) for a in aggs])


def fn_alias(fn: str, expr: Column, name: str) -> Column:
    return getattr(F, fn)(expr).alias(name)


def resolve_via(grand: DataFrame, parents: DataFrame, parent_key: str, key: str) -> DataFrame:
    """Give grand-history rows their entity through the parent table. The parent is not
    time-filtered for this (owning is not leakage); rows without a parent are dropped."""
    return grand.join(parents.select(parent_key, key), parent_key)


def left_join_features(base: DataFrame, key: str, tables: Sequence[DataFrame]) -> DataFrame:
    """Base left-joined to aggregate tables, all keyed (and so partitioned) by entity."""
    out = base
    for t in tables:
        out = out.join(t, key, "left")
    return out
