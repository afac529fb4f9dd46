"""Registered event-window queries: events as card transactions."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronotab.operators.recompute import feature_differences, recompute_features
from chronotab.operators.windows import FEATURE_COLUMNS, HOT_CARD_ROWS, event_features
from chronotab.plans import driver as D
from chronotab.plans.catalog import register

H = 3_600_000_000
DAY = 24 * H
W30 = 30 * DAY


def _frame(lo: int) -> str:
    return f"PARTITION BY card ORDER BY t RANGE BETWEEN {lo} PRECEDING AND 1 PRECEDING"


CAT = f"PARTITION BY card, category ORDER BY t RANGE BETWEEN {W30} PRECEDING AND 1 PRECEDING"

HAV = ("6371.0 * 2 * asin(sqrt(pow(sin((radians({la2}) - radians({la1})) / 2), 2) + "
       "cos(radians({la1})) * cos(radians({la2})) * pow(sin((radians({lo2}) - radians({lo1})) / 2), 2)))")

FEATURE_SQL = f"""b AS (SELECT *, epoch_us(trans_ts) AS t, CAST(round(amt * 10000.0) AS HUGEINT) AS c,
        CAST(round(merch_lat * 1000000.0) AS HUGEINT) AS la6,
        CAST(round(merch_long * 1000000.0) AS HUGEINT) AS lo6 FROM tx),
w AS (SELECT *,
  count(amt) OVER ({_frame(H)}) AS n1h,
  count(amt) OVER ({_frame(DAY)}) AS n24, sum(c) OVER ({_frame(DAY)}) AS s24,
  count(amt) OVER ({_frame(W30)}) AS n30, sum(c) OVER ({_frame(W30)}) AS s30,
  sum(c * c) OVER ({_frame(W30)}) AS q30,
  count(la6) OVER ({_frame(W30)}) AS nl30, sum(la6) OVER ({_frame(W30)}) AS la30,
  sum(lo6) OVER ({_frame(W30)}) AS lo30, max(t) OVER ({_frame(W30)}) AS prev_t,
  count(amt) OVER ({CAT}) AS ncat, sum(c) OVER ({CAT}) AS scat
  FROM b),
d AS (SELECT *,
  CASE WHEN n30 > 0 THEN CAST(s30 AS DOUBLE) / CAST(n30 AS DOUBLE) / 10000.0 END AS avg30,
  CASE WHEN n30 > 1 THEN sqrt(CAST(n30 * q30 - s30 * s30 AS DOUBLE) / CAST(n30 * (n30 - 1) AS DOUBLE) / 100000000.0) END AS std30,
  CASE WHEN nl30 > 0 THEN CAST(la30 AS DOUBLE) / CAST(nl30 AS DOUBLE) / 1000000.0 END AS ulat,
  CASE WHEN nl30 > 0 THEN CAST(lo30 AS DOUBLE) / CAST(nl30 AS DOUBLE) / 1000000.0 END AS ulong,
  CASE WHEN ncat > 0 THEN CAST(scat AS DOUBLE) / CAST(ncat AS DOUBLE) / 10000.0 END AS avgcat
  FROM w)
SELECT trans_num, trans_ts, card, category, amt, lat, long, merch_lat, merch_long, is_fraud,
  round({HAV.format(la1='lat', lo1='long', la2='merch_lat', lo2='merch_long')}, 6) AS DISTANCE_FROM_HOME_KM,
  round({HAV.format(la1='ulat', lo1='ulong', la2='merch_lat', lo2='merch_long')}, 6) AS DISTANCE_FROM_USUAL_MERCHANT_KM,
  CAST(n1h AS BIGINT) AS CC_TXN_COUNT_1H, CAST(n24 AS BIGINT) AS CC_TXN_COUNT_24H,
  coalesce(CAST(s24 AS DOUBLE) / 10000.0, 0.0) AS CC_AMT_SUM_24H,
  avg30 AS CC_AMT_AVG_30D, amt - avg30 AS AMT_DEVIATION_FROM_CC_AVG,
  CASE WHEN std30 > 0 THEN (amt - avg30) / std30 END AS AMT_ZSCORE_30D,
  CAST(ncat AS BIGINT) AS CC_CATEGORY_TXN_COUNT_30D, amt - avgcat AS AMT_DEVIATION_FROM_CC_CATEGORY_AVG,
  CAST(t - prev_t AS DOUBLE) / 1000000.0 AS CC_SECONDS_SINCE_LAST_TXN,
  CAST(hour(trans_ts) AS BIGINT) AS TRANSACTION_HOUR, CAST(isodow(trans_ts) - 1 AS BIGINT) AS TRANSACTION_DAYOFWEEK,
  std30 AS CC_AMT_STD_30D, avgcat AS CC_CATEGORY_AMT_AVG_30D
FROM d
"""


def event_sql(where: str = "true") -> str:
    """The features of the events for which ``where`` holds, among themselves."""
    return f"WITH tx AS (SELECT * FROM ({D.CARD_SQL}) WHERE {where}), {FEATURE_SQL}"


EVENT_SQL = event_sql()

ROUNDED = ("DISTANCE_FROM_HOME_KM", "DISTANCE_FROM_USUAL_MERCHANT_KM")


def _features(t, bucket_days=None, hot_card_rows=HOT_CARD_ROWS):
    f = event_features(D.card_transactions(t), keep_intermediate=True, bucket_days=bucket_days,
                       hot_card_rows=hot_card_rows)
    # distances go through sin/cos/asin, whose last bit differs between math libraries
    return f.withColumns({c: F.round(c, 6) for c in ROUNDED})


def _pick(cols):
    return f"SELECT {', '.join(cols)} FROM ({EVENT_SQL})"


ALL = ["trans_num", "trans_ts", "card", "category", "amt", "lat", "long", "merch_lat", "merch_long",
       "is_fraud", "DISTANCE_FROM_HOME_KM", "DISTANCE_FROM_USUAL_MERCHANT_KM", "CC_TXN_COUNT_1H",
       "CC_TXN_COUNT_24H", "CC_AMT_SUM_24H", "CC_AMT_AVG_30D", "AMT_DEVIATION_FROM_CC_AVG",
       "AMT_ZSCORE_30D", "CC_CATEGORY_TXN_COUNT_30D", "AMT_DEVIATION_FROM_CC_CATEGORY_AVG",
       "CC_SECONDS_SINCE_LAST_TXN", "TRANSACTION_HOUR", "TRANSACTION_DAYOFWEEK"]
VELOCITY = ["trans_num", "CC_TXN_COUNT_1H", "CC_TXN_COUNT_24H", "CC_AMT_SUM_24H", "CC_AMT_AVG_30D",
            "CC_AMT_STD_30D"]
CATEGORY = ["trans_num", "CC_CATEGORY_TXN_COUNT_30D", "CC_CATEGORY_AMT_AVG_30D",
            "AMT_DEVIATION_FROM_CC_CATEGORY_AVG"]
RECENCY = ["trans_num", "CC_SECONDS_SINCE_LAST_TXN"]
ZSCORE = ["trans_num", "AMT_DEVIATION_FROM_CC_AVG", "AMT_ZSCORE_30D"]
GEO = ["trans_num", "DISTANCE_FROM_HOME_KM", "DISTANCE_FROM_USUAL_MERCHANT_KM", "TRANSACTION_HOUR",
       "TRANSACTION_DAYOFWEEK"]


@register("event_features", _pick(ALL), "E12 E2-E11 B5-B8 B6 N1 P2 P4")
def q_event_features(t):
    """All 17 history features of every event, from the card's strictly earlier events."""
    return _features(t).select(*ALL)


@register("event_features_fine_buckets", _pick(ALL), "E12 P4 (7-day buckets, 5 copies per event)")
def q_event_features_fine(t):
    """Same features with 7-day window buckets: the split used for very hot cards."""
    return _features(t, bucket_days=7).select(*ALL)


# a low hot-card threshold for the registered check, so that the driver tables put cards on
# both paths (the library default is HOT_CARD_ROWS)
HOT_CHECK_ROWS = 64


@register("event_features_hot_cards", _pick(ALL), "E12 P4 (hot cards by global time ranges)")
def q_event_features_hot(t):
    """Same features with cards of more than 64 events on the range path (read in place
    within global ranges, at probe rows where a range's end cuts a card), the rest on bucket windows."""
    return _features(t, hot_card_rows=HOT_CHECK_ROWS).select(*ALL)


@register("event_velocity", _pick(VELOCITY), "E2 E3 E4 E5 E6")
def q_event_velocity(t):
    """Counts in 1 h / 24 h, sum in 24 h, mean and sample std in 30 days."""
    return _features(t).select(*VELOCITY)


@register("event_category_history", _pick(CATEGORY), "E10 B7")
def q_event_category(t):
    """Per (card, category) 30-day count and average, and the deviation from it."""
    return _features(t).select(*CATEGORY)


@register("event_seconds_since_last", _pick(RECENCY), "E11 T4")
def q_event_recency(t):
    """Seconds since the card's previous event; null beyond 30 days."""
    return _features(t).select(*RECENCY)


@register("event_zscore", _pick(ZSCORE), "B7 B8")
def q_event_zscore(t):
    """Deviation from the 30-day mean and the guarded z-score."""
    return _features(t).select(*ZSCORE)


@register("event_haversine", _pick(GEO), "B5 B6 E7 E8 E9")
def q_event_geo(t):
    """Distance from home, from the usual merchant location, hour and weekday."""
    return _features(t).select(*GEO)


@register("recompute_check", f"""SELECT feature, (SELECT count(*) FROM events) AS n_events, CAST(0 AS BIGINT) AS n_different
FROM (SELECT unnest([{', '.join(f"'{c}'" for c in FEATURE_COLUMNS)}]) AS feature)""", "D10")
def q_recompute(t):
    """All thirteen features of every event against their recomputation from the event's own past:
    the number of events that differ, by feature (none)."""
    tx = D.card_transactions(t)
    return feature_differences(event_features(tx), recompute_features(tx))


# Fixed values of a planted leak: every 50th event also sees itself.
LEAK_EVERY = 50


@register("recompute_check_planted_leak", f"""SELECT feature, (SELECT count(*) FROM events) AS n_events,
  CASE WHEN feature IN ('CC_TXN_COUNT_1H', 'CC_TXN_COUNT_24H') THEN (SELECT count(*) FROM events WHERE event_id % {LEAK_EVERY} = 0 AND value IS NOT NULL)
    ELSE 0 END AS n_different
FROM (SELECT unnest([{', '.join(f"'{c}'" for c in FEATURE_COLUMNS)}]) AS feature)""", "D10")
def q_recompute_leak(t):
    """The same check on features in which two counts of every 50th event take the event itself in."""
    tx = D.card_transactions(t)
    leaks = ((F.col("trans_num") % LEAK_EVERY == 0) & F.col("amt").isNotNull()).cast("bigint")
    leaky = event_features(tx).withColumns({c: F.col(c) + leaks for c in ("CC_TXN_COUNT_1H", "CC_TXN_COUNT_24H")})
    return feature_differences(leaky, recompute_features(tx))
