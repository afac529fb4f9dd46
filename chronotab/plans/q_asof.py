"""Registered as-of, anchor, split and maturity queries on customer / orders / lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronotab.operators.asof import Agg, asof_aggregate
from chronotab.operators.splits import split_label, maturity_flag, split_profile
from chronotab.plans import driver as D
from chronotab.plans.catalog import register
from chronotab.plans.sqlparts import anchor_cte, exact_mean, exact_sum, mature_expr, split_case

DEC_CTE = anchor_cte("customer", "c_custkey", D.CUSTOMER_ANCHOR)

FEATURES_SQL = f"""
WITH dec AS ({DEC_CTE}),
o AS (SELECT o.* FROM orders o JOIN dec d ON o.o_custkey = d.c_custkey
      WHERE o.o_orderdate < d.DECISION_TS),
oagg AS (SELECT o_custkey AS c_custkey, count(o_orderkey) AS ORDERS_COUNT,
         {exact_mean('o_totalprice')} AS ORDERS_TOTALPRICE_MEAN,
         count(*) FILTER (WHERE o_orderpriority = '{D.URGENT}') AS ORDERS_URGENT_COUNT
         FROM o GROUP BY o_custkey),
l AS (SELECT od.o_custkey AS c_custkey, l.l_linenumber, l.l_extendedprice
      FROM lineitem l JOIN orders od ON l.l_orderkey = od.o_orderkey
      JOIN dec d ON od.o_custkey = d.c_custkey WHERE l.l_shipdate < d.DECISION_TS),
lagg AS (SELECT c_custkey, count(l_linenumber) AS LINEITEM_COUNT,
         {exact_sum('l_extendedprice')} AS LINEITEM_EXTENDEDPRICE_SUM FROM l GROUP BY c_custkey),
agg AS (SELECT oagg.*, lagg.LINEITEM_COUNT, lagg.LINEITEM_EXTENDEDPRICE_SUM
        FROM oagg LEFT JOIN lagg USING (c_custkey))
SELECT c.c_custkey, c.c_nationkey, c.c_mktsegment, c.c_acctbal,
  CAST(c.c_acctbal < 0 AS INTEGER) AS TARGET, d.DECISION_TS,
  CAST(coalesce(a.ORDERS_COUNT, 0) AS BIGINT) AS ORDERS_COUNT,
  CAST(a.ORDERS_TOTALPRICE_MEAN AS DOUBLE) AS ORDERS_TOTALPRICE_MEAN,
  CAST(coalesce(a.ORDERS_URGENT_COUNT, 0) AS BIGINT) AS ORDERS_URGENT_COUNT,
  CAST(coalesce(a.LINEITEM_COUNT, 0) AS BIGINT) AS LINEITEM_COUNT,
  CAST(coalesce(a.LINEITEM_EXTENDEDPRICE_SUM, 0.0) AS DOUBLE) AS LINEITEM_EXTENDEDPRICE_SUM,
  {split_case('d.DECISION_TS', D.CUSTOMER_SPLIT)} AS SPLIT,
  {mature_expr('d.DECISION_TS', D.CUSTOMER_LABEL)} AS IS_MATURE
FROM customer c JOIN dec d USING (c_custkey) LEFT JOIN agg a USING (c_custkey)
"""


@register("asof_customer_features", FEATURES_SQL, "E1 C1 C2 C3 C4 D1 D2 D7 B9 F1 F3 F5 T7")
def asof_customer_features(t):
    """Customer features strictly before each customer's anchored decision time."""
    return D.asof_customer_features(t)


@register("asof_customer_features_salted", FEATURES_SQL, "C1 D7 (salted join path)")
def asof_customer_features_salted(t):
    """Same features through the salted shuffle join used when decisions cannot broadcast."""
    return D.asof_customer_features(t, strategy="salt")


@register("asof_grand_history_count", f"""
WITH dec AS ({DEC_CTE})
SELECT od.o_custkey AS c_custkey, count(*) AS LINEITEM_COUNT,
       CAST(max(l.l_shipdate) AS TIMESTAMP) AS LAST_SHIP_TS
FROM lineitem l JOIN orders od ON l.l_orderkey = od.o_orderkey
JOIN dec d ON od.o_custkey = d.c_custkey
WHERE l.l_shipdate < d.DECISION_TS GROUP BY od.o_custkey
""", "C2 D2")
def asof_grand_history_count(t):
    """Lineitem rows resolved to customers through orders (parent not time-filtered),
    kept strictly before the decision; count and latest ship time."""
    from chronotab.operators.asof import resolve_via
    dec = D.customer_decisions(t)
    parents = t.orders.select(F.col("o_orderkey").alias("l_orderkey"),
                              F.col("o_custkey").alias("c_custkey"))
    li = resolve_via(t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate"),
                     parents, "l_orderkey", "c_custkey")
    return asof_aggregate(li, dec, "c_custkey", F.col("l_shipdate"),
                          [Agg("LINEITEM_COUNT", "count", "l_linenumber"),
                           Agg("LAST_SHIP_TS", "max", "l_shipdate")])


@register("rank_to_date_anchor", f"SELECT * FROM ({DEC_CTE})", "E1 P1 T6 T23")
def rank_to_date_anchor(t):
    """Customers ranked by key, mapped linearly onto the anchor window in whole seconds."""
    return D.customer_decisions(t)


@register("chronological_split", f"""
SELECT o_orderkey, {split_case('o_orderdate', D.CUSTOMER_SPLIT)} AS SPLIT FROM orders
""", "F1 F2 T11")
def chronological_split(t):
    """Every order labelled train/validation/test/excluded by its order date."""
    return t.orders.select("o_orderkey", split_label("o_orderdate", D.CUSTOMER_SPLIT).alias("SPLIT"))


@register("label_maturity", f"""
SELECT o_orderkey, {mature_expr('o_orderdate', D.CUSTOMER_LABEL)} AS IS_MATURE,
  CAST(floor(epoch(TIMESTAMP '{D.CUSTOMER_LABEL.as_of.isoformat(sep=' ')}' - o_orderdate) / 86400) AS BIGINT) AS AGE_DAYS
FROM orders
""", "F3")
def label_maturity(t):
    """Maturity flag and whole-day age of every order at the configured as-of time."""
    from chronotab.functions.timecols import literal_micros, micros
    as_of = literal_micros(D.CUSTOMER_LABEL.as_of)
    age = F.floor((F.lit(as_of) - micros("o_orderdate")) / F.lit(86_400_000_000)).cast("bigint")
    return t.orders.select("o_orderkey", maturity_flag("o_orderdate", D.CUSTOMER_LABEL).alias("IS_MATURE"),
                           age.alias("AGE_DAYS"))


@register("split_profile", f"""
SELECT SPLIT, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(sum(TARGET) AS DOUBLE) / CAST(count(TARGET) AS DOUBLE) AS positive_rate
FROM ({FEATURES_SQL}) f WHERE IS_MATURE GROUP BY SPLIT
""", "D8 F4")
def split_profile_q(t):
    """Rows and positive rate per split over mature customer rows."""
    feats = D.asof_customer_features(t)
    return split_profile(feats.where("IS_MATURE"), "TARGET")


@register("categorical_levels", f"""
WITH f AS ({FEATURES_SQL}), lv AS (
  SELECT 'c_mktsegment' AS column_name, c_mktsegment AS level FROM f WHERE IS_MATURE AND c_mktsegment IS NOT NULL
  UNION SELECT 'SPLIT', SPLIT FROM f WHERE IS_MATURE)
SELECT column_name, CAST(row_number() OVER (PARTITION BY column_name ORDER BY level) - 1 AS BIGINT) AS level_index, level
FROM lv
""", "B10")
def categorical_levels(t):
    """Sorted distinct non-null levels of each string column over mature rows, one row per
    level with its index (the index B11 encodes to)."""
    from chronotab.operators.contracts import capture_categories, levels_long
    feats = D.asof_customer_features(t).where("IS_MATURE")
    return levels_long(capture_categories(feats, ["c_mktsegment", "SPLIT"]))
