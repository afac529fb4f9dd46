"""Every history feature of every event computed again from the event's own past.

An independent way to the features of ``operators.windows``: each event meets the earlier events of
its card one by one, by a join on (card, time band), and its features are plain aggregates over them;
no running totals, window frames or buckets are shared with the batch operator. A past event is
copied into the bands that look back on it, so a card's history spreads over tasks by time and the
pairs are those of the look-back, however long the card's history. Sums are the same exact integers,
so equal features are equal to the bit.

An event without a time has no past. Nulls in card, category, amount and place count as in the batch
operator. The cost is events x events in the look-back: a check, not a feature build.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotab.functions.fixedpoint import mean_from, scaled, std_from, sum_from
from chronotab.functions.scalar import haversine_km, zscore_guarded
from chronotab.functions.timecols import MICROS_PER_DAY, MICROS_PER_HOUR, day_of_week_monday0, hour_of_day, micros
from chronotab.operators.windows import AMOUNT_SCALE, COORD_SCALE, FEATURE_COLUMNS, HISTORY_DAYS


def recompute_features(tx: DataFrame, key: str = "trans_num", history_days: int = HISTORY_DAYS, band_days: int = 10) -> DataFrame:
    """(key, features): one row an event; ``key`` must name events."""
    look, band = history_days * MICROS_PER_DAY, band_days * MICROS_PER_DAY
    rows = tx.select(key, "card", "category", "amt", "trans_ts", "lat", "long", "merch_lat", "merch_long", micros("trans_ts").alias("_t"),
                     scaled("amt", AMOUNT_SCALE).alias("_c"), scaled("merch_lat", COORD_SCALE).alias("_la"), scaled("merch_long", COORD_SCALE).alias("_lo"))
    at = F.floor(F.col("_t") / F.lit(band)).cast("bigint")
    own = rows.where("_t is not null").select(F.col(key).alias("_key"), F.col("card").alias("_card"), F.col("category").alias("_kind"),
                                              F.col("_t").alias("_now"), at.alias("_band"))
    last = F.floor((F.col("_t") + F.lit(look)) / F.lit(band)).cast("bigint")
    past = rows.where("_t is not null").select("card", "category", "_t", "_c", "_la", "_lo", F.explode(F.sequence(at, last)).alias("_in"))
    pairs = own.join(past, own["_card"].eqNullSafe(past["card"]) & (own["_band"] == past["_in"])).where(
        (F.col("_t") < F.col("_now")) & (F.col("_t") >= F.col("_now") - F.lit(look)))
    back = F.col("_now") - F.col("_t")
    same = F.col("category").eqNullSafe(F.col("_kind"))
    known = F.col("_c").isNotNull()
    sums = pairs.groupBy("_key").agg(
        F.count_if(known & (back <= MICROS_PER_HOUR)).alias("_n1h"), F.count_if(known & (back <= 24 * MICROS_PER_HOUR)).alias("_n24"),
        F.sum(F.when(back <= 24 * MICROS_PER_HOUR, F.col("_c"))).alias("_s24"), F.count("_c").alias("_n30"), F.sum("_c").alias("_s30"),
        F.sum((F.col("_c") * F.col("_c")).cast("decimal(38,0)")).alias("_q30"), F.count("_la").alias("_nl"), F.sum("_la").alias("_sla"),
        F.sum("_lo").alias("_slo"), F.max("_t").alias("_last"), F.count_if(known & same).alias("_ncat"), F.sum(F.when(same, F.col("_c"))).alias("_scat"))
    f = rows.join(sums, rows[key] == sums["_key"], "left")
    none = F.lit(0).cast("bigint")
    n = {c: F.coalesce(F.col(c), none) for c in ("_n1h", "_n24", "_n30", "_nl", "_ncat")}
    average = mean_from("_s30", n["_n30"], AMOUNT_SCALE)
    std = std_from("_s30", "_q30", n["_n30"], AMOUNT_SCALE)
    features = {
        "DISTANCE_FROM_HOME_KM": haversine_km("lat", "long", "merch_lat", "merch_long"),
        "DISTANCE_FROM_USUAL_MERCHANT_KM": haversine_km(mean_from("_sla", n["_nl"], COORD_SCALE), mean_from("_slo", n["_nl"], COORD_SCALE), "merch_lat", "merch_long"),
        "CC_TXN_COUNT_1H": n["_n1h"], "CC_TXN_COUNT_24H": n["_n24"], "CC_AMT_SUM_24H": F.coalesce(sum_from("_s24", AMOUNT_SCALE), F.lit(0.0)),
        "CC_AMT_AVG_30D": average, "AMT_DEVIATION_FROM_CC_AVG": F.col("amt") - average,
        "AMT_ZSCORE_30D": zscore_guarded(F.col("amt") - average, std), "CC_CATEGORY_TXN_COUNT_30D": n["_ncat"],
        "AMT_DEVIATION_FROM_CC_CATEGORY_AVG": F.col("amt") - mean_from("_scat", n["_ncat"], AMOUNT_SCALE),
        "CC_SECONDS_SINCE_LAST_TXN": (F.col("_t") - F.col("_last")).cast("double") / 1e6,
        "TRANSACTION_HOUR": hour_of_day("trans_ts").cast("bigint"), "TRANSACTION_DAYOFWEEK": day_of_week_monday0("trans_ts").cast("bigint")}
    return f.select(key, *[features[c].alias(c) for c in FEATURE_COLUMNS])


def feature_differences(features: DataFrame, again: DataFrame, key: str = "trans_num", columns: Sequence[str] = tuple(FEATURE_COLUMNS)) -> DataFrame:
    """(feature, n_events, n_different): a feature differs where the two tables hold other values, or
    where one of them lacks the event."""
    a = features.select(F.col(key).alias("_key"), F.struct(*columns).alias("_a"))
    b = again.select(F.col(key).alias("_other"), F.struct(*columns).alias("_b"))
    both = a.join(b, a["_key"] == b["_other"], "full_outer")
    lone = F.col("_a").isNull() | F.col("_b").isNull()
    counts = both.agg(F.count(F.lit(1)).alias("n_events"), *[
        F.count_if(lone | ~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}"))).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col("n_events"), F.col(c).alias("n_different")) for c in columns])))
