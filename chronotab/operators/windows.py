"""Trailing time-window features over an event stream.

Every feature of an event uses only the same card's events strictly before it (T1, T4) and no
older than the window (left edge closed, T2): RANGE frames over whole microseconds,
``rangeBetween(-w, -1)``.

Skew (P4). A plain ``Window.partitionBy(card)`` sends all of a card's events to one task. Here
each event belongs to a time bucket of ``bucket_days``; the window partition is
``(card, bucket)``, and an event is also copied, as context only, into each later bucket whose
start is within the look-back of it. A bucket therefore sees every event its own rows can
reach, results are exact, and a card's history is spread over as many tasks as it has buckets.
Copies per event: ``1 + ceil(history / bucket)`` at most (1.5 on average at the default
``bucket = 2 x history``).

All frames that share ``(card, bucket, t)`` are computed by one sort and one window node (P2);
the per-category frames add one more sort on ``(card, category, bucket, t)``. Each trailing
frame is a difference of two running totals (P3), so a window costs O(events), not
O(events x events per 30 days).

Sums are exact fixed-point (``functions.fixedpoint``): amounts to four decimal places,
coordinates in micro-degrees (more places are an error); means and the sample std are derived from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronotab.functions.fixedpoint import EXACT, mean_from, scaled, std_from, sum_from
from chronotab.functions.scalar import haversine_km, zscore_guarded
from chronotab.functions.timecols import (
    MICROS_PER_DAY,
    MICROS_PER_HOUR,
    day_of_week_monday0,
    hour_of_day,
    micros,
)

HISTORY_DAYS = 30  # longest look-back of any feature
AMOUNT_SCALE = 4  # decimal places an amount may have
COORD_SCALE = 6  # micro-degrees
# cards above this many events take the range path (a (card, bucket) window would be too big)
HOT_CARD_ROWS = 2_000_000

# The names of the history features, in the order of the feature table.
FEATURE_COLUMNS = [
    "DISTANCE_FROM_HOME_KM", "DISTANCE_FROM_USUAL_MERCHANT_KM", "CC_TXN_COUNT_1H",
    "CC_TXN_COUNT_24H", "CC_AMT_SUM_24H", "CC_AMT_AVG_30D", "AMT_DEVIATION_FROM_CC_AVG",
    "AMT_ZSCORE_30D", "CC_CATEGORY_TXN_COUNT_30D", "AMT_DEVIATION_FROM_CC_CATEGORY_AVG",
    "CC_SECONDS_SINCE_LAST_TXN", "TRANSACTION_HOUR", "TRANSACTION_DAYOFWEEK",
]


def with_time_buckets(df: DataFrame, t: str, history_us: int, bucket_us: int) -> DataFrame:
    """Add ``_bk`` (window partition bucket) and ``_home`` (true for the event's own bucket,
    false for a context copy)."""
    own = F.floor(F.col(t) / F.lit(bucket_us)).cast("bigint")
    last = F.floor((F.col(t) + F.lit(history_us)) / F.lit(bucket_us)).cast("bigint")
    return (df.withColumn("_own", own)
            .withColumn("_bk", F.explode(F.sequence(own, last)))
            .withColumn("_home", F.col("_bk") == F.col("_own"))
            .drop("_own"))


def _with_units(tx: DataFrame, amt: str, merch_lat: str, merch_long: str) -> DataFrame:
    """Add the fixed-point columns that the frames sum."""
    tx = tx.withColumns({"_c": scaled(amt, AMOUNT_SCALE), "_la": scaled(merch_lat, COORD_SCALE),
                         "_lo": scaled(merch_long, COORD_SCALE)})
    return tx.withColumn("_c2", (F.col("_c") * F.col("_c")).cast(EXACT))


def _frames_by_buckets(w_tx: DataFrame, keep: list[str], card: str, category: str, amt: str,
                       merch: tuple[str, str], hist_us: int, bucket_us: int) -> DataFrame:
    """Frame totals with windows on ``(card, time bucket)`` and context copies (P4). One shuffle
    serves both windows, before the fixed-point columns are there to be carried."""
    b = with_time_buckets(w_tx, "_t", hist_us, bucket_us)
    return _frames_by_windows(b, [*keep, "_home"], card, category, "_bk", amt, merch, hist_us).where("_home").drop("_home")


def _frames_by_windows(tx: DataFrame, keep: list[str], card: str, category: str, part: str, amt: str,
                       merch: tuple[str, str], hist_us: int) -> DataFrame:
    """Frame totals of every row among the rows of its ``(card, part)``."""
    b = _with_units(tx.repartition(card, part), amt, *merch)

    # Every frame [t - w, t) is the difference of two running totals, (-inf, t) minus
    # (-inf, t - w), both UNBOUNDED PRECEDING frames that Spark evaluates incrementally, so the
    # cost is linear in the events of a (card, bucket) however many fall in 30 days. Sums are
    # exact integers, so the difference is exact too.
    by_card = Window.partitionBy(card, part).orderBy("_t")
    before = by_card.rangeBetween(Window.unboundedPreceding, -1)
    by_cat = Window.partitionBy(card, category, part).orderBy("_t")
    cat_before = by_cat.rangeBetween(Window.unboundedPreceding, -1)
    cat_older = by_cat.rangeBetween(Window.unboundedPreceding, -hist_us - 1)

    def older(w_us):
        return by_card.rangeBetween(Window.unboundedPreceding, -w_us - 1)

    def cnt(c, w):
        return F.count(c).over(w)

    def tot(c, w):
        return F.coalesce(F.sum(c).over(w), F.lit(0).cast(EXACT))

    o1, o24, o30 = older(MICROS_PER_HOUR), older(24 * MICROS_PER_HOUR), older(hist_us)
    return b.select(
        *keep, "_t",
        (cnt(amt, before) - cnt(amt, o1)).alias("_n1h"),
        (cnt(amt, before) - cnt(amt, o24)).alias("_n24"),
        (tot("_c", before) - tot("_c", o24)).alias("_s24"),
        (cnt(amt, before) - cnt(amt, o30)).alias("_n30"),
        (tot("_c", before) - tot("_c", o30)).alias("_s30"),
        (tot("_c2", before) - tot("_c2", o30)).alias("_q30"),
        (cnt("_la", before) - cnt("_la", o30)).alias("_nl30"),
        (tot("_la", before) - tot("_la", o30)).alias("_la30"),
        (tot("_lo", before) - tot("_lo", o30)).alias("_lo30"),
        F.max("_t").over(before).alias("_last_t"),
        (cnt(amt, cat_before) - cnt(amt, cat_older)).alias("_ncat"),
        (tot("_c", cat_before) - tot("_c", cat_older)).alias("_scat"))


def _probe_totals(data: DataFrame, part: list[str], sums: dict[str, Column], edges: dict[str, int],
                  maxes: dict[str, Column] | None = None, n_buckets: int | None = None) -> DataFrame:
    """Per distinct ``(*part, _t)``: for each edge ``e`` -> ``d``, the totals of ``sums`` (and
    maxima of ``maxes``) over the rows of the same ``part`` with time <= t - d, as columns
    ``{name}_{e}``.

    Each distinct time adds one zero-weight probe row per edge; probes sort after data rows of
    the same time, and the running totals come from ``prefix_totals`` (windows per
    ``(part, global time range)`` plus a small per-range offset table), so no task holds a
    whole key however many rows it has."""
    from chronotab.operators.order import prefix_totals

    maxes = dict(maxes or {})
    rows = data.select(*part, "_t", F.lit(0).alias("_kind"),
                       *[c.alias(f"_x_{n}") for n, c in {**sums, **maxes}.items()])
    pts = data.select(*part, "_t").distinct()
    spec = F.array(*[F.struct(F.lit(e).alias("e"), F.lit(int(d)).cast("bigint").alias("d"))
                     for e, d in edges.items()])
    probes = pts.select(*part, F.col("_t").alias("_at"), F.explode(spec).alias("_p")).select(
        *part, (F.col("_at") - F.col("_p.d")).alias("_t"), F.lit(1).alias("_kind"), "_at",
        F.col("_p.e").alias("_edge"))
    u = rows.unionByName(probes, allowMissingColumns=True)
    # probes (and null inputs) add a typed zero, so a running total is never null and keeps the
    # offset of earlier ranges
    types = {f.name: f.dataType for f in u.schema.fields}
    u = u.withColumns({f"_x_{n}": F.coalesce(F.col(f"_x_{n}"), F.lit(0).cast(types[f"_x_{n}"]))
                       for n in sums})
    pt = prefix_totals(u, ["_t", "_kind"], {f"_r_{n}": F.col(f"_x_{n}") for n in sums}, partition_by=part,
                       n_buckets=n_buckets, maxes={f"_r_{n}": F.col(f"_x_{n}") for n in maxes})
    at = pt.where(F.col("_kind") == 1)
    cols = [F.max(F.when(F.col("_edge") == e, F.col(f"_r_{n}"))).alias(f"{n}_{e}")
            for e in edges for n in [*sums, *maxes]]
    return at.groupBy(*part, F.col("_at").alias("_t")).agg(*cols)


def _frames_by_ranges(w_tx: DataFrame, keep: list[str], card: str, category: str, amt: str,
                      merch: tuple[str, str], hist_us: int, n_buckets: int | None = None) -> DataFrame:
    """The same frame totals as ``_frames_by_buckets`` for hot cards: rows are dealt to global ranges of
    ``(card, t)``. A card whose rows lie in one range has its totals and all its frame edges there and is
    read in place; the cards cut by a range's end (at most one an end) are read at probe rows. No event is
    copied, and no task holds more of a card than a range of it."""
    from chronotab.operators.order import dealt_to_ranges

    ranged = dealt_to_ranges(w_tx.select(*keep, "_t"), [F.col(card).asc(), F.col("_t").asc()], "_rng", n_buckets)
    cut = ranged.groupBy(card).agg(F.min("_rng").alias("_from"), F.max("_rng").alias("_to")) \
        .where("_from < _to").select(F.col(card).alias("_cut"))
    is_cut = ranged[card].eqNullSafe(cut["_cut"])
    whole = ranged.join(F.broadcast(cut), is_cut, "left_anti")  # fewer cut cards than ranges
    parts = ranged.join(F.broadcast(cut), is_cut, "left_semi")
    frames = _frames_by_windows(whole, keep, card, category, "_rng", amt, merch, hist_us)
    return frames.unionByName(_frames_at_probes(parts.drop("_rng"), keep, card, category, amt, merch, hist_us, n_buckets))


def _frames_at_probes(w_tx: DataFrame, keep: list[str], card: str, category: str, amt: str,
                      merch: tuple[str, str], hist_us: int, n_buckets: int | None = None) -> DataFrame:
    """Frame totals of cards that span ranges: every frame [t - w, t) is
    total(<= t - 1) - total(<= t - w - 1), read at probe rows from running totals over global
    time ranges, and joined back on ``(card, t)`` / ``(card, category, t)`` (all events of a
    card at one time share their frames, ties excluded, T4)."""

    def one(c):
        return F.when(F.col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    data = _with_units(w_tx, amt, *merch)
    edges = {"b": 1, "h1": MICROS_PER_HOUR + 1, "h24": 24 * MICROS_PER_HOUR + 1, "d30": hist_us + 1}
    cardf = _probe_totals(data, [card], {"n": one(amt), "c": F.col("_c"), "q": F.col("_c2"),
                                         "nl": one("_la"), "la": F.col("_la"), "lo": F.col("_lo")},
                          edges, maxes={"m": F.col("_t")}, n_buckets=n_buckets)
    catf = _probe_totals(data, [card, category], {"n": one(amt), "c": F.col("_c")},
                         {"b": 1, "d30": hist_us + 1}, n_buckets=n_buckets)

    def cnt(n, e, src="card"):
        return F.coalesce(F.col(f"{src}.{n}_b"), F.lit(0)).cast("bigint") - \
            F.coalesce(F.col(f"{src}.{n}_{e}"), F.lit(0)).cast("bigint")

    def tot(n, e, src="card"):
        return F.coalesce(F.col(f"{src}.{n}_b").cast(EXACT), F.lit(0).cast(EXACT)) - \
            F.coalesce(F.col(f"{src}.{n}_{e}").cast(EXACT), F.lit(0).cast(EXACT))

    ev = w_tx.alias("ev")
    j = ev.join(cardf.alias("card"), F.col(f"ev.{card}").eqNullSafe(F.col(f"card.{card}")) &
                (F.col("ev._t") == F.col("card._t")), "left")
    j = j.join(catf.alias("cat"), F.col(f"ev.{card}").eqNullSafe(F.col(f"cat.{card}")) &
               F.col(f"ev.{category}").eqNullSafe(F.col(f"cat.{category}")) &
               (F.col("ev._t") == F.col("cat._t")), "left")
    return j.select(
        *[F.col(f"ev.{c}").alias(c) for c in keep], F.col("ev._t").alias("_t"),
        cnt("n", "h1").alias("_n1h"), cnt("n", "h24").alias("_n24"), tot("c", "h24").alias("_s24"),
        cnt("n", "d30").alias("_n30"), tot("c", "d30").alias("_s30"), tot("q", "d30").alias("_q30"),
        cnt("nl", "d30").alias("_nl30"), tot("la", "d30").alias("_la30"), tot("lo", "d30").alias("_lo30"),
        F.col("card.m_b").alias("_last_t"),
        cnt("n", "d30", "cat").alias("_ncat"), tot("c", "d30", "cat").alias("_scat"))


def hot_cards(tx: DataFrame, card: str, max_rows: int) -> DataFrame:
    """Cards with more than ``max_rows`` events (a partial count per card, combined map-side)."""
    return tx.groupBy(card).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows).select(card)


def event_features(tx: DataFrame, card: str = "card", ts: str = "trans_ts", amt: str = "amt",
                   category: str = "category", lat: str = "lat", long: str = "long",
                   merch_lat: str = "merch_lat", merch_long: str = "merch_long",
                   history_days: int = HISTORY_DAYS, bucket_days: int | None = None,
                   keep_intermediate: bool = False, hot_card_rows: int | None = HOT_CARD_ROWS,
                   n_buckets: int | None = None) -> DataFrame:
    """The input columns plus every history feature, one row per event.

    Cards with more than ``hot_card_rows`` events take the range path (``_frames_by_ranges``),
    the rest the bucket windows; ``hot_card_rows=0`` sends every card to the range path and
    ``None`` none."""
    hist_us = history_days * MICROS_PER_DAY
    bucket_us = (bucket_days or 2 * history_days) * MICROS_PER_DAY
    base_cols = tx.columns
    w_tx = tx.withColumn("_t", micros(ts))
    merch = (merch_lat, merch_long)
    mode = "buckets" if hot_card_rows is None else "ranges" if hot_card_rows <= 0 else "split"
    if mode == "split":
        # the hot-card list is small by construction (at most rows / hot_card_rows cards); the
        # semi / anti joins are left to AQE, which broadcasts it after measuring it. Whether
        # there is any hot card at all is one bounded read (at most one row to the driver).
        hot = hot_cards(w_tx, card, hot_card_rows)
        if hot.limit(1).count() == 0:
            mode = "buckets"
    # an event without a time has no history and is nobody's history: kept, with empty frames
    untimed = w_tx.where(F.col("_t").isNull())
    w_tx = w_tx.where(F.col("_t").isNotNull())
    if mode == "buckets":
        feats = _frames_by_buckets(w_tx, base_cols, card, category, amt, merch, hist_us, bucket_us)
    elif mode == "ranges":
        feats = _frames_by_ranges(w_tx, base_cols, card, category, amt, merch, hist_us, n_buckets)
    else:
        hot = hot.withColumnRenamed(card, "_hot")
        is_hot = w_tx[card].eqNullSafe(hot["_hot"])  # events without a card are one group too
        cold = _frames_by_buckets(w_tx.join(hot, is_hot, "left_anti"), base_cols, card, category, amt,
                                  merch, hist_us, bucket_us)
        warm = _frames_by_ranges(w_tx.join(hot, is_hot, "left_semi"), base_cols, card, category, amt,
                                 merch, hist_us, n_buckets)
        feats = cold.unionByName(warm.select(*cold.columns))
    kinds = {f.name: f.dataType for f in feats.schema.fields}
    none = {"_t", "_last_t"}
    feats = feats.unionByName(untimed.select(*[
        F.col(c) if c in base_cols else F.lit(None if c in none else 0).cast(kinds[c]).alias(c) for c in feats.columns]))
    # the last earlier event counts only when it is inside the window (left edge closed)
    feats = feats.withColumn("_prev_t", F.when(F.col("_last_t") >= F.col("_t") - F.lit(hist_us), F.col("_last_t")))

    avg30 = mean_from("_s30", "_n30", AMOUNT_SCALE)
    usual_lat = mean_from("_la30", "_nl30", COORD_SCALE)
    usual_long = mean_from("_lo30", "_nl30", COORD_SCALE)
    out = feats.withColumns({
        "CC_TXN_COUNT_1H": F.col("_n1h").cast("bigint"),
        "CC_TXN_COUNT_24H": F.col("_n24").cast("bigint"),
        "CC_AMT_SUM_24H": F.coalesce(sum_from("_s24", AMOUNT_SCALE), F.lit(0.0)),
        "CC_AMT_AVG_30D": avg30,
        "CC_AMT_STD_30D": std_from("_s30", "_q30", "_n30", AMOUNT_SCALE),
        "CC_USUAL_MERCH_LAT": usual_lat,
        "CC_USUAL_MERCH_LONG": usual_long,
        "CC_CATEGORY_TXN_COUNT_30D": F.col("_ncat").cast("bigint"),
        "CC_CATEGORY_AMT_AVG_30D": mean_from("_scat", "_ncat", AMOUNT_SCALE),
        "CC_SECONDS_SINCE_LAST_TXN": ((F.col("_t") - F.col("_prev_t")).cast("double") / 1e6),
        "DISTANCE_FROM_HOME_KM": haversine_km(lat, long, merch_lat, merch_long),
        "TRANSACTION_HOUR": hour_of_day(ts).cast("bigint"),
        "TRANSACTION_DAYOFWEEK": day_of_week_monday0(ts).cast("bigint"),
    })
    out = out.withColumns({
        "AMT_DEVIATION_FROM_CC_AVG": F.col(amt) - F.col("CC_AMT_AVG_30D"),
        "AMT_DEVIATION_FROM_CC_CATEGORY_AVG": F.col(amt) - F.col("CC_CATEGORY_AMT_AVG_30D"),
        "DISTANCE_FROM_USUAL_MERCHANT_KM": haversine_km("CC_USUAL_MERCH_LAT", "CC_USUAL_MERCH_LONG",
                                                        merch_lat, merch_long),
    })
    out = out.withColumn("AMT_ZSCORE_30D", zscore_guarded("AMT_DEVIATION_FROM_CC_AVG", "CC_AMT_STD_30D"))
    extra = ["CC_AMT_STD_30D", "CC_USUAL_MERCH_LAT", "CC_USUAL_MERCH_LONG",
             "CC_CATEGORY_AMT_AVG_30D"] if keep_intermediate else []
    return out.select(*base_cols, *FEATURE_COLUMNS, *extra)
