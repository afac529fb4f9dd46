"""Registered nested-request, parity and leakage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronotab.functions.fixedpoint import scaled
from chronotab.operators import nested as N
from chronotab.operators.splits import split_label
from chronotab.operators.windows import event_features
from chronotab.plans import driver as D
from chronotab.plans.catalog import register
from chronotab.plans.q_asof import DEC_CTE, FEATURES_SQL
from chronotab.plans.q_events import ALL as EVENT_COLUMNS
from chronotab.plans.q_events import EVENT_SQL, ROUNDED
from chronotab.plans.q_quality import TEST_SQL
from chronotab.plans.sqlparts import split_case

ORDER_FIELDS = ["o_orderdate", "o_orderkey", "o_totalprice", "o_orderpriority"]
LINE_FIELDS = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]
TXN_FIELDS = ["trans_ts", "category", "amt", "merch_lat", "merch_long"]

SELECTED_CUSTOMERS_SQL = f"SELECT c_custkey, DECISION_TS FROM ({TEST_SQL})"

SELECTED_EVENTS_SQL = f"SELECT trans_num FROM ({D.CARD_SQL}) WHERE {split_case('trans_ts', D.EVENTS_SPLIT)} = 'test'"


def selected_customers(t):
    dec = D.customer_decisions(t)
    return dec.where(split_label("DECISION_TS", D.CUSTOMER_SPLIT) == "test").select("c_custkey", "DECISION_TS")


def credit_requests(t):
    """The selected customers with their whole order and lineitem history as arrays
    (materialised once: it is the request file every consumer reads)."""
    return t.derived("credit_requests", lambda: _credit_requests(t))


def _credit_requests(t):
    sel = selected_customers(t).join(t.customer.select(*D.BASE_COLUMNS), "c_custkey")
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return N.nested_history(
        sel, "c_custkey", {"orders": (orders, ORDER_FIELDS)},
        {"lineitems": (t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey",
                       ["l_shipdate", "o_orderkey", "l_linenumber", "l_extendedprice"], "orders")})


@register("nested_history_counts", f"""WITH s AS ({SELECTED_CUSTOMERS_SQL}),
o AS (SELECT o_custkey AS c_custkey, count(*) AS n, min(o_orderdate) AS first_ts FROM orders GROUP BY 1),
l AS (SELECT od.o_custkey AS c_custkey, count(*) AS n FROM lineitem li JOIN orders od ON li.l_orderkey = od.o_orderkey GROUP BY 1)
SELECT s.c_custkey, CAST(coalesce(o.n, 0) AS BIGINT) AS n_orders, CAST(coalesce(l.n, 0) AS BIGINT) AS n_lineitems,
  o.first_ts AS first_order_ts
FROM s LEFT JOIN o USING (c_custkey) LEFT JOIN l USING (c_custkey)""", "C10 A9 E13")
def q_nested_counts(t):
    """Selected customers' requests: array sizes and the first element of the sorted order
    array, over all parts of each request."""
    r = credit_requests(t)
    per = r.select("c_custkey", F.size("orders").alias("n_orders"), F.size("lineitems").alias("n_lineitems"),
                   F.try_element_at("orders", F.lit(1))["o_orderdate"].alias("first_order_ts"))
    return per.groupBy("c_custkey").agg(
        F.sum("n_orders").cast("bigint").alias("n_orders"), F.sum("n_lineitems").cast("bigint").alias("n_lineitems"),
        F.min("first_order_ts").alias("first_order_ts"))


PARITY_COLS = ["c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal", "DECISION_TS", "ORDERS_COUNT",
               "ORDERS_TOTALPRICE_MEAN", "ORDERS_URGENT_COUNT", "LINEITEM_COUNT", "LINEITEM_EXTENDEDPRICE_SUM"]


@register("credit_request_parity", f"""SELECT {', '.join(PARITY_COLS)} FROM ({FEATURES_SQL})
WHERE c_custkey IN (SELECT c_custkey FROM ({SELECTED_CUSTOMERS_SQL}))""", "D11 G9 G10 D7")
def q_credit_parity(t):
    """Features rebuilt from each nested request (arrays exploded back into tables) - the
    oracle is the batch feature table for the same customers."""
    r = credit_requests(t)
    head = r.where(F.col("part") == 0)  # entity columns are repeated on every part
    base = head.select(*D.BASE_COLUMNS)
    dec = head.select("c_custkey", "DECISION_TS")
    orders = N.explode_history(r, "orders", ["c_custkey"]).withColumnRenamed("c_custkey", "o_custkey")
    lines = N.explode_history(r, "lineitems", ["c_custkey"]).withColumnRenamed("o_orderkey", "l_orderkey").drop("c_custkey")
    feats = D.assemble_customer_features(base, dec, orders, lines)
    return feats.select(*PARITY_COLS)


def event_requests(t):
    """Selected test events with the card's rows in the 30 days before as a sorted array
    (materialised once, like the request file)."""
    return t.derived("event_requests", lambda: _event_requests(t))


def _event_requests(t):
    tx = D.card_transactions(t)
    sel = tx.where(split_label("trans_ts", D.EVENTS_SPLIT) == "test")
    req = N.range_history_join(sel, tx, "card", "trans_ts", "trans_num", TXN_FIELDS)
    return req.select("trans_num", "card", F.struct("trans_ts", "category", "amt", "lat", "long",
                                                     "merch_lat", "merch_long", "is_fraud").alias("transaction"),
                      "part", "history")


@register("event_request_history", f"""WITH tx AS ({D.CARD_SQL}), s AS ({SELECTED_EVENTS_SQL})
SELECT a.trans_num, CAST(count(h.trans_num) AS BIGINT) AS n_history,
  CAST(coalesce(sum(CAST(round(h.amt * 100.0) AS BIGINT)), 0) AS BIGINT) AS history_cents,
  min(h.trans_ts) AS first_ts, max(h.trans_ts) AS last_ts,
  coalesce(bool_or(h.trans_ts >= a.trans_ts), false) AS refused
FROM tx a JOIN s USING (trans_num) LEFT JOIN tx h ON h.card = a.card AND h.trans_ts < a.trans_ts
  AND epoch_us(h.trans_ts) >= epoch_us(a.trans_ts) - {30 * 86_400_000_000}
GROUP BY a.trans_num""", "C9 G8 E13")
def q_event_history(t):
    """Each selected event's 30-day card history: size, total cents, first and last time, and
    whether the request would be refused for history at or after the event (G8)."""
    r = event_requests(t)
    per = r.select(
        "trans_num", F.size("history").cast("bigint").alias("n_history"),
        F.aggregate(F.transform("history", lambda h: F.round(h["amt"] * 100.0).cast("bigint")),
                    F.lit(0).cast("bigint"), lambda a, b: a + b).alias("history_cents"),
        F.try_element_at("history", F.lit(1))["trans_ts"].alias("first_ts"),
        F.try_element_at("history", F.lit(-1))["trans_ts"].alias("last_ts"),
        N.history_before_decision("history", "trans_ts", "transaction.trans_ts").alias("refused"))
    return per.groupBy("trans_num").agg(  # over the parts of each request
        F.sum("n_history").cast("bigint").alias("n_history"),
        F.sum("history_cents").cast("bigint").alias("history_cents"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        F.bool_or("refused").alias("refused"))


@register("fraud_request_parity", f"""SELECT {', '.join(EVENT_COLUMNS)} FROM ({EVENT_SQL})
WHERE trans_num IN (SELECT trans_num FROM ({SELECTED_EVENTS_SQL}))""", "D11 G11 E12")
def q_fraud_parity(t):
    """Event features rebuilt from each request's own rows (transaction + history, card and
    home shared); the oracle is the batch feature table for the same events."""
    r = event_requests(t)
    rows = N.event_request_rows(r.withColumnRenamed("trans_num", "request"), "request", "transaction",
                                "history", ["lat", "long"])
    rows = rows.withColumn("card_req", F.col("request"))
    f = event_features(rows, card="card_req")
    f = f.where("_is_txn").withColumns({c: F.round(c, 6) for c in ROUNDED})
    card = r.where(F.col("part") == 0).select(F.col("trans_num").alias("request"), "card")
    return f.join(card, "request").withColumnRenamed("request", "trans_num").select(*EVENT_COLUMNS)


@register("leakage_twin_diff", """SELECT CAST(count(*) AS BIGINT) AS n_full, CAST(count(*) AS BIGINT) AS n_truncated,
  CAST(0 AS BIGINT) AS n_only_full, CAST(0 AS BIGINT) AS n_only_truncated FROM customer""", "D9 T1 T7")
def q_leakage(t):
    """Features from whole tables vs from tables cut at each customer's decision time (each
    history row by its own time, ownership of orders kept whole): row counts and rows found
    on one side only. No leakage means the last two are 0."""
    dec = D.customer_decisions(t)
    full = D.asof_customer_features(t, decisions=dec).drop("SPLIT", "IS_MATURE")
    own = dec.withColumnRenamed("c_custkey", "o_custkey")
    orders_cut = t.orders.join(own, "o_custkey").where(F.col("o_orderdate") < F.col("DECISION_TS")).drop("DECISION_TS")
    owner = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(own, "o_custkey")
    lines_cut = (t.lineitem.join(owner, "l_orderkey").where(F.col("l_shipdate") < F.col("DECISION_TS"))
                 .drop("o_custkey", "DECISION_TS"))
    base = t.customer.select(*D.BASE_COLUMNS, D.customer_target().alias("TARGET"))
    cut = D.assemble_customer_features(base, dec, orders_cut, lines_cut, owners=t.orders)
    cut = cut.select(*full.columns)
    both = full.withColumn("_side", F.lit(1)).unionByName(cut.withColumn("_side", F.lit(-1)))
    rows = both.groupBy(*full.columns).agg(F.sum("_side").alias("_d"), F.count_if(F.col("_side") == 1).alias("_f"),
                                           F.count_if(F.col("_side") == -1).alias("_c"))
    return rows.agg(F.coalesce(F.sum("_f"), F.lit(0)).cast("bigint").alias("n_full"),
                    F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("n_truncated"),
                    F.coalesce(F.sum(F.greatest("_d", F.lit(0))), F.lit(0)).cast("bigint").alias("n_only_full"),
                    F.coalesce(F.sum(F.greatest(-F.col("_d"), F.lit(0))), F.lit(0)).cast("bigint").alias("n_only_truncated"))
