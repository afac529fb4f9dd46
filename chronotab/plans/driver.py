"""How the driver tables play the reference's data, and the configs used for them.

* ``customer`` = applications (entity ``c_custkey``), ``orders`` = history with a time
  (``o_orderdate``), ``lineitem`` through ``orders`` = grand-history (``l_shipdate``).
* ``events`` = card transactions: ``user_id`` = card, ``event_type`` = category,
  ``value`` = amount; coordinates are derived from ids by a fixed rule.
* ``orders`` = a scored table: score = ``o_totalprice``, y = urgent priority, slice = status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotab.config import EvalConfig, LabelConfig, SliceConfig, SplitConfig, Window
from chronotab.functions.scalar import missing_policy
from chronotab.operators.asof import Agg, asof_aggregate, choose_strategy, resolve_via
from chronotab.operators.order import rank_to_date_anchor
from chronotab.operators.splits import add_split_and_maturity
from chronotab.sources.tables import Tables

# Fixed values of the driver-table mapping.
CUSTOMER_ANCHOR = Window.of("1997-01-01", "2000-12-31")
CUSTOMER_SPLIT = SplitConfig.of(("1997-01-01", "1999-06-30"), ("1999-08-01", "1999-12-31"),
                                ("2000-01-01", "2000-12-31"), gap_days=30)
CUSTOMER_LABEL = LabelConfig.of(540, "2001-06-30")
URGENT = "1-URGENT"

EVENTS_SPLIT = SplitConfig.of(("2024-01-01", "2024-01-15"), ("2024-01-18", "2024-01-22"),
                              ("2024-01-23", "2024-01-31"), gap_days=2)
EVENTS_LABEL = LabelConfig.of(3, "2024-01-31")

ORDERS_EVAL = EvalConfig(cost_of_miss=10, cost_of_review=1, target_fpr=0.05,
                         alert_budget_fraction=0.10,
                         slices=(SliceConfig("o_orderstatus", 0.05),),
                         min_pr_auc=0.15, max_pr_auc_regression=0.005)


def customer_decisions(t: Tables, n_buckets: int | None = None) -> DataFrame:
    """E1 on customers: ``(c_custkey, DECISION_TS)``, materialised once per query (every
    history aggregate and the base table join it)."""
    return t.derived(f"customer_decisions:{n_buckets}", lambda: rank_to_date_anchor(
        t.customer, "c_custkey", CUSTOMER_ANCHOR.start, CUSTOMER_ANCHOR.end, n_buckets=n_buckets))


def customer_history_aggregates(t: Tables | None, decisions: DataFrame, strategy: str = "auto",
                                orders: DataFrame | None = None,
                                lineitem: DataFrame | None = None,
                                owners: DataFrame | None = None) -> DataFrame:
    """D1/D2 shape: order aggregates as of each decision, with the lineitem count and sum
    resolved through orders (C2) and left-joined onto the order aggregate (T7)."""
    orders = t.orders if orders is None else orders
    lineitem = t.lineitem if lineitem is None else lineitem
    if strategy == "auto":
        strategy = choose_strategy(decisions)
    o = orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice",
                      "o_orderpriority", "o_orderdate")
    order_aggs = asof_aggregate(
        o, decisions, "c_custkey", F.col("o_orderdate"),
        [Agg("ORDERS_COUNT", "count", "o_orderkey"),
         Agg("ORDERS_TOTALPRICE_MEAN", "mean", "o_totalprice", scale=2),
         Agg("ORDERS_URGENT_COUNT", "count_if", cond=F.col("o_orderpriority") == URGENT)],
        strategy=strategy)
    owners = orders if owners is None else owners  # who owns an order is not time-dependent
    parents = owners.select(F.col("o_orderkey").alias("l_orderkey"),
                            F.col("o_custkey").alias("c_custkey"))
    li = resolve_via(lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"),
                     parents, "l_orderkey", "c_custkey")
    line_aggs = asof_aggregate(
        li, decisions, "c_custkey", F.col("l_shipdate"),
        [Agg("LINEITEM_COUNT", "count", "l_linenumber"),
         Agg("LINEITEM_EXTENDEDPRICE_SUM", "sum", "l_extendedprice", scale=2)],
        strategy=strategy)
    return order_aggs.join(line_aggs, "c_custkey", "left")


def customer_target() -> Column:
    return (F.col("c_acctbal") < 0).cast("int")


BASE_COLUMNS = ["c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"]


def assemble_customer_features(base: DataFrame, decisions: DataFrame, orders: DataFrame,
                               lineitem: DataFrame, strategy: str = "auto",
                               owners: DataFrame | None = None) -> DataFrame:
    """Base columns + as-of aggregates for any ``(c_custkey, DECISION_TS)``; the same call
    serves the batch tables and tables rebuilt from requests (G10)."""
    aggs = customer_history_aggregates(None, decisions, strategy, orders=orders, lineitem=lineitem,
                                       owners=owners)
    feats = base.join(decisions, "c_custkey").join(aggs, "c_custkey", "left")
    return missing_policy(feats)


def asof_customer_features(t: Tables, strategy: str = "auto", n_buckets: int | None = None,
                           decisions: DataFrame | None = None) -> DataFrame:
    """F5 on the driver tables: E1 -> C1/C2/D-form -> C3 -> B9 -> C4 -> F1 -> F3."""
    dec = customer_decisions(t, n_buckets) if decisions is None else decisions
    base = t.customer.select(*BASE_COLUMNS, customer_target().alias("TARGET"))
    feats = assemble_customer_features(base, dec, t.orders, t.lineitem, strategy)
    return add_split_and_maturity(feats, "DECISION_TS", CUSTOMER_SPLIT, CUSTOMER_LABEL)


# ---------------------------------------------------------------- events as card transactions

def card_transactions(t: Tables) -> DataFrame:
    """Events as transactions. Coordinates follow a fixed rule from the ids so that both
    engines derive the same values: home = (30 + user % 17 / 2, -90 - user % 13 / 2),
    merchant = home + ((event % 101) - 50) / 100, ((event % 103) - 51) / 100."""
    e = t.events
    lat = F.lit(30.0) + (F.col("user_id") % 17).cast("double") / 2.0
    lon = F.lit(-90.0) - (F.col("user_id") % 13).cast("double") / 2.0
    return e.select(
        F.col("event_id").alias("trans_num"),
        F.col("ts").alias("trans_ts"),
        F.col("user_id").alias("card"),
        F.col("event_type").alias("category"),
        F.col("value").alias("amt"),
        lat.alias("lat"), lon.alias("long"),
        (lat + ((F.col("event_id") % 101) - 50).cast("double") / 100.0).alias("merch_lat"),
        (lon + ((F.col("event_id") % 103) - 51).cast("double") / 100.0).alias("merch_long"),
        (F.col("event_type") == "error").cast("int").alias("is_fraud"),
    )


CARD_SQL = """SELECT event_id AS trans_num, ts AS trans_ts, user_id AS card,
  event_type AS category, value AS amt,
  30.0 + CAST(user_id % 17 AS DOUBLE) / 2.0 AS lat,
  -90.0 - CAST(user_id % 13 AS DOUBLE) / 2.0 AS long,
  30.0 + CAST(user_id % 17 AS DOUBLE) / 2.0 + CAST(event_id % 101 - 50 AS DOUBLE) / 100.0 AS merch_lat,
  -90.0 - CAST(user_id % 13 AS DOUBLE) / 2.0 + CAST(event_id % 103 - 51 AS DOUBLE) / 100.0 AS merch_long,
  CAST(event_type = 'error' AS INTEGER) AS is_fraud
FROM events"""


# ---------------------------------------------------------------- events as a prediction log

# Fixed values of the log mapping: the local copy stops when the host restarted, a new model
# version was promoted, and the score threshold.
LOCAL_COPY_UNTIL = "2024-01-20"
PROMOTED_AT = "2024-01-16"
SCORE_THRESHOLD = 0.5
LOG_AS_OF = "2024-01-31"


def traffic_source() -> Column:
    """view -> test bench, click / purchase -> replay, signup -> live, error -> field missing."""
    t = F.col("event_type")
    return (F.when(t == "view", "test").when(t.isin("click", "purchase"), "replay")
            .when(t == "signup", "live"))


def prediction_log(t: Tables) -> DataFrame:
    """Two copies of a prediction log built from events (copy 0 = local, 1 = durable);
    consecutive events share a request id, so each copy holds duplicates."""
    from chronotab.functions.scalar import decide
    from chronotab.functions.timecols import ts_literal

    e = t.events
    score = F.col("value") / F.lit(500.0)
    rec = e.select(
        F.concat(F.lit("r"), F.expr("CAST(event_id div 2 AS STRING)")).alias("request_id"),
        F.col("event_id").cast("string").alias("entity_id"),
        F.lit("events").alias("model_name"),
        F.when(F.col("ts") < ts_literal(PROMOTED_AT), "v1").otherwise("v2").alias("model_version"),
        score.alias("score"), decide(score, SCORE_THRESHOLD).alias("decision"),
        F.lit(SCORE_THRESHOLD).alias("threshold"),
        F.create_map(F.lit("value"), F.col("value").cast("string"),
                     F.lit("k"), F.get_json_object("props", "$.k"),
                     F.lit("event_type"), F.col("event_type")).alias("feature_vector"),
        traffic_source().alias("traffic_source"),
        F.col("ts").alias("timestamp"), F.col("event_id").alias("_line"))
    local = rec.where(F.col("timestamp") < ts_literal(LOCAL_COPY_UNTIL)).withColumns(
        {"client": F.lit("local"), "_copy": F.lit(0)})
    blob = rec.withColumns({"client": F.lit("blob"), "_copy": F.lit(1)})
    return local.unionByName(blob)


LOG_SQL = f"""SELECT 'r' || CAST(event_id // 2 AS VARCHAR) AS request_id, CAST(event_id AS VARCHAR) AS entity_id,
  CASE WHEN ts < TIMESTAMP '{PROMOTED_AT}' THEN 'v1' ELSE 'v2' END AS model_version,
  value / 500.0 AS score, CASE WHEN value / 500.0 >= {SCORE_THRESHOLD} THEN 'flag' ELSE 'pass' END AS decision,
  value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type,
  CASE WHEN event_type = 'view' THEN 'test' WHEN event_type IN ('click', 'purchase') THEN 'replay'
       WHEN event_type = 'signup' THEN 'live' END AS traffic_source,
  ts AS timestamp, event_id AS line, c.client, c.copy
FROM events, (VALUES ('local', 0), ('blob', 1)) c(client, copy)
WHERE c.copy = 1 OR ts < TIMESTAMP '{LOCAL_COPY_UNTIL}'"""

DEDUP_SQL = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY request_id
  ORDER BY copy, timestamp DESC, line DESC) AS rn FROM ({LOG_SQL})) WHERE rn = 1"""
