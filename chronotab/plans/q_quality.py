"""Registered sampling (E13-E15) and contract (G1-G12) queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotab.functions.timecols import micros
from chronotab.operators import contracts as G
from chronotab.operators import order as O
from chronotab.operators.splits import split_label
from chronotab.plans import driver as D
from chronotab.plans.catalog import register
from chronotab.plans.q_asof import DEC_CTE
from chronotab.plans.sqlparts import split_case

# Fixed values of the reference's replay and example selection.
EXAMPLES_COUNT = 50
EXAMPLES_POSITIVES = 15
BATCH_SIZE = 200
CURSOR = 300
# Size of the registered spaced-sample query (a sampling operator: the count is its parameter).
SPACED_N = 200


def _test_decisions(t):
    dec = D.customer_decisions(t)
    test = dec.where(split_label("DECISION_TS", D.CUSTOMER_SPLIT) == "test")
    return test.withColumn("_t", micros("DECISION_TS"))


TEST_SQL = f"""SELECT *, row_number() OVER (ORDER BY DECISION_TS, c_custkey) - 1 AS position,
  count(*) OVER () AS total FROM ({DEC_CTE}) WHERE {split_case('DECISION_TS', D.CUSTOMER_SPLIT)} = 'test'"""


def _positions_sql(src: str, n: int, total: str = "total") -> str:
    """rint(linspace(0, total - 1, n)) as explicit rows (an independent form of the predicate)."""
    return f"""SELECT DISTINCT CAST(CASE WHEN i = {n - 1} THEN {total} - 1
  ELSE round_even(CAST(i AS DOUBLE) * (CAST({total} - 1 AS DOUBLE) / CAST({n - 1} AS DOUBLE)), 0) END AS BIGINT) AS p
FROM range({n}) r(i), (SELECT max({total}) AS {total} FROM ({src}))"""


@register("spaced_sample", f"""WITH t AS ({TEST_SQL}), pos AS ({_positions_sql('t', SPACED_N)})
SELECT c_custkey, DECISION_TS, CAST(position AS BIGINT) AS position FROM t
WHERE total <= {SPACED_N} OR position IN (SELECT p FROM pos)""", "E13 T15 P1")
def q_spaced(t):
    """200 test-split customers evenly spaced through the test window in date order."""
    s = O.spaced_sample(_test_decisions(t), ["_t", "c_custkey"], SPACED_N)
    return s.select("c_custkey", "DECISION_TS", F.col("position").cast("bigint"))


STRAT_SQL = f"""WITH f AS (SELECT t.c_custkey, t.position, CAST(c.c_acctbal < 0 AS INTEGER) AS outcome
  FROM ({TEST_SQL}) t JOIN customer c USING (c_custkey)),
k AS (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY position) - 1 AS cp,
  count(*) OVER (PARTITION BY outcome) AS ct FROM f),
np AS (SELECT least({EXAMPLES_POSITIVES}, coalesce(max(ct) FILTER (WHERE outcome = 1), 0)) AS chosen FROM k),
pp AS ({_positions_sql("SELECT ct FROM k WHERE outcome = 1", EXAMPLES_POSITIVES, "ct")}),
pn AS (SELECT DISTINCT CAST(CASE WHEN i = nn - 1 THEN ct - 1 ELSE round_even(CAST(i AS DOUBLE) *
  (CAST(ct - 1 AS DOUBLE) / CAST(nn - 1 AS DOUBLE)), 0) END AS BIGINT) AS p
  FROM (SELECT {EXAMPLES_COUNT} - chosen AS nn FROM np), (SELECT max(ct) AS ct FROM k WHERE outcome = 0),
  LATERAL range(nn) r(i) WHERE nn > 1),
nn AS (SELECT {EXAMPLES_COUNT} - chosen AS nn FROM np)
SELECT c_custkey, CAST(position AS BIGINT) AS position, outcome FROM k, nn WHERE
  (outcome = 1 AND (ct <= {EXAMPLES_POSITIVES} OR cp IN (SELECT p FROM pp))) OR
  (outcome = 0 AND (ct <= nn.nn OR (nn.nn = 1 AND cp = 0) OR (nn.nn > 1 AND cp IN (SELECT p FROM pn))))"""


@register("stratified_spaced_sample", STRAT_SQL, "E14")
def q_stratified(t):
    """Up to 15 positive and the rest of 50 negative test customers, each evenly spaced, in
    file (date) order; outcome = negative account balance."""
    test = O.global_row_number(_test_decisions(t), ["_t", "c_custkey"], "position")
    f = test.join(t.customer.select("c_custkey", (F.col("c_acctbal") < 0).cast("int").alias("outcome")),
                  "c_custkey")
    s = O.stratified_spaced_sample(f, ["position"], "outcome", EXAMPLES_COUNT, EXAMPLES_POSITIVES)
    return s.select("c_custkey", F.col("position").cast("bigint"), "outcome")


@register("cursor_batch", f"""WITH t AS ({TEST_SQL})
SELECT c_custkey, CAST(position AS BIGINT) AS position,
  CAST(((position - {CURSOR}) % total + total) % total AS BIGINT) AS batch_order FROM t
WHERE ((position - {CURSOR}) % total + total) % total < least({BATCH_SIZE}, total)""", "E15")
def q_cursor(t):
    """The next 200 replay requests from cursor 300, wrapping at the end of the file."""
    test = O.global_row_number(_test_decisions(t), ["_t", "c_custkey"], "position")
    total = test.count()
    b = O.cursor_batch(test, "position", total, CURSOR, BATCH_SIZE)
    return b.select("c_custkey", F.col("position").cast("bigint"), "batch_order")


ORDERS_CONTRACT = G.Contract("orders", (
    G.Field("o_orderkey", T.LongType(), unique=True),
    G.Field("o_custkey", T.LongType()),
    G.Field("o_orderstatus", T.StringType(), isin=("F", "O", "P")),
    G.Field("o_totalprice", T.DoubleType(), ge=0.0, le=400000.0),
    G.Field("o_orderdate", T.TimestampNTZType()),
    G.Field("o_orderpriority", T.StringType(), isin=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")),
))
CUSTOMER_CONTRACT = G.Contract("customer", (
    G.Field("c_custkey", T.LongType(), unique=True),
    G.Field("c_name", T.StringType()),
    G.Field("c_nationkey", T.IntegerType(), ge=0, le=24),
    G.Field("c_acctbal", T.DoubleType(), ge=0.0),
    G.Field("c_mktsegment", T.StringType(), isin=("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")),
    G.Field("c_phone", T.StringType(), nullable=True),
))


def _contract_sql(table: str, c: G.Contract) -> str:
    parts = []
    for f in c.fields:
        if f.name == "c_phone":
            parts.append(f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, 'missing_column' AS check, 1 AS n_failed")
            continue
        if not f.nullable:
            parts.append(f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, 'not_null' AS check, count(*) FILTER (WHERE {f.name} IS NULL) AS n_failed FROM {table}")
        if f.isin is not None:
            vals = ", ".join(f"'{v}'" for v in f.isin)
            parts.append(f"SELECT '{table}', '{f.name}', 'in_set', count(*) FILTER (WHERE {f.name} NOT IN ({vals})) FROM {table}")
        if f.ge is not None:
            parts.append(f"SELECT '{table}', '{f.name}', 'greater_than_or_equal', count(*) FILTER (WHERE {f.name} < {f.ge}) FROM {table}")
        if f.le is not None:
            parts.append(f"SELECT '{table}', '{f.name}', 'less_than_or_equal', count(*) FILTER (WHERE {f.name} > {f.le}) FROM {table}")
        if f.unique:
            parts.append(f"SELECT '{table}', '{f.name}', 'unique', coalesce(sum(n), 0) FROM "
                         f"(SELECT count(*) AS n FROM {table} GROUP BY {f.name} HAVING count(*) > 1)")
    return " UNION ALL ".join(parts)


@register("contract_violations", f"""SELECT table_name, column_name, "check", CAST(n_failed AS BIGINT) AS n_failed
FROM ({_contract_sql('orders', ORDERS_CONTRACT)} UNION ALL {_contract_sql('customer', CUSTOMER_CONTRACT)})
WHERE n_failed > 0""", "G1 G2 G3 G4 G5 G6 G7")
def q_contracts(t):
    """Every failed check of the orders and customer contracts, found in one pass each."""
    out = None
    for name, df, c in (("orders", t.orders, ORDERS_CONTRACT), ("customer", t.customer, CUSTOMER_CONTRACT)):
        v = G.violations(df, c).select(F.lit(name).alias("table_name"), "column_name", "check", "n_failed")
        out = v if out is None else out.unionByName(v)
    return out


@register("unique_key_violations", """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""", "G4")
def q_unique(t):
    """Composite lineitem keys held by more than one row."""
    return G.unique_key_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


def _null_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null, "
        f"CAST(count(*) AS BIGINT) AS n_rows FROM {table}" for c in cols)


NULL_TABLES = {
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
    "pages": ["page_id", "url", "html"],
}


@register("null_profile", " UNION ALL ".join(_null_sql(k, v) for k, v in NULL_TABLES.items()), "G12")
def q_nulls(t):
    """Full-table null count per column (how nullability is decided), four tables."""
    out = None
    for name in NULL_TABLES:
        p = G.null_profile(getattr(t, name)).select(F.lit(name).alias("table_name"), "column_name", "n_null", "n_rows")
        out = p if out is None else out.unionByName(p)
    return out
