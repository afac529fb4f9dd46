"""The two reference domains end to end, on their own table schemas built from the driver tables.

``customer`` gives the applicants, ``orders`` the bureau records and previous applications,
``lineitem`` the balances, instalments and card months; ``events`` give the provider's two files of
card transactions, their month stretched over the two years of the domain's splits. What the driver
tables do not have follows from ids by fixed rules, stated once for both engines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from chronotab.config import CREDIT, FRAUD
from chronotab.operators.windows import FEATURE_COLUMNS
from chronotab.plans import credit, fraud
from chronotab.plans import driver as D
from chronotab.plans.catalog import register
from chronotab.plans.domains import load_domain
from chronotab.plans.q_events import FEATURE_SQL
from chronotab.plans.sqlparts import anchor_cte, mature_expr, split_case

# Each column of the reference's tables as an expression that both engines read alike.
APPLICATION = {
    "SK_ID_CURR": "c_custkey", "TARGET": "CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS BIGINT)",
    "CODE_GENDER": "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END", "DAYS_BIRTH": "-(8000 + c_custkey % 15000)",
    "DAYS_EMPLOYED": "CASE WHEN c_custkey % 7 = 0 THEN 365243 WHEN c_custkey % 13 = 0 THEN NULL ELSE -(c_custkey % 4000) END",
    "AMT_INCOME_TOTAL": "CAST(floor(c_acctbal) + 20000 AS DOUBLE)", "AMT_CREDIT": "CAST(c_custkey * 977 % 500000 AS DOUBLE)",
    "AMT_ANNUITY": "CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey * 37 % 30000 AS DOUBLE) END",
    "NAME_EDUCATION_TYPE": "c_mktsegment", "NAME_FAMILY_STATUS": "CASE WHEN c_nationkey % 3 = 0 THEN 'Married' ELSE 'Single' END",
    "NAME_HOUSING_TYPE": "CASE WHEN c_custkey > 0.97 * (SELECT max(c_custkey) FROM customer) THEN 'New' WHEN c_custkey % 5 = 0 THEN NULL ELSE 'House' END",
    "CNT_CHILDREN": "c_custkey % 4", "EXT_SOURCE_1": "CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey * 7 % 1000 AS DOUBLE) / 1000 END",
    "EXT_SOURCE_2": "CAST(c_custkey * 13 % 1000 AS DOUBLE) / 1000", "EXT_SOURCE_3": "CAST(c_custkey * 29 % 1000 AS DOUBLE) / 1000",
}
BUREAU = {
    "SK_ID_CURR": "o_custkey", "SK_ID_BUREAU": "o_orderkey", "DAYS_CREDIT": "CASE WHEN o_orderkey % 17 <> 0 THEN o_orderkey % 1000 - 900 END",
    "AMT_CREDIT_SUM": "CASE WHEN o_orderkey % 9 <> 0 THEN CAST(floor(o_totalprice) AS DOUBLE) END",
    "CREDIT_ACTIVE": "CASE WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Closed' END",
}
BALANCE = {"SK_ID_BUREAU": "l_orderkey", "MONTHS_BALANCE": "l_linenumber % 5 + l_orderkey % 4 - 6", "STATUS": "l_returnflag"}
PREVIOUS = {
    "SK_ID_CURR": "o_custkey", "SK_ID_PREV": "o_orderkey", "DAYS_DECISION": "o_orderkey % 700 - 650",
    "AMT_CREDIT": "CAST(floor(o_totalprice / 2) AS DOUBLE)", "NAME_CONTRACT_STATUS": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Approved' ELSE 'Refused' END",
}
POS_CASH = {
    "SK_ID_CURR": "o_custkey", "SK_ID_PREV": "l_orderkey", "MONTHS_BALANCE": "l_linenumber - 4",
    "CNT_INSTALMENT": "CASE WHEN l_linenumber <> 2 THEN CAST(floor(l_quantity) AS BIGINT) END",
}
INSTALLMENTS = {
    "SK_ID_CURR": "o_custkey", "SK_ID_PREV": "l_orderkey", "DAYS_INSTALMENT": "l_partkey % 600 - 550",
    "DAYS_ENTRY_PAYMENT": "CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_partkey % 600 - 550 + l_suppkey % 40 - 10 AS DOUBLE) END",
    "AMT_PAYMENT": "CAST(floor(l_extendedprice) AS DOUBLE)",
}
CARD_MONTHS = {
    "SK_ID_CURR": "o_custkey", "SK_ID_PREV": "l_orderkey", "MONTHS_BALANCE": "l_orderkey % 20 - 18",
    "AMT_BALANCE": "CAST(floor(l_extendedprice / 3) AS DOUBLE)",
}
LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
TABLES = {
    "application_train": (APPLICATION, "customer", "true"), "bureau": (BUREAU, "orders", "true"), "bureau_balance": (BALANCE, "lineitem", "true"),
    "previous_application": (PREVIOUS, "orders", "o_orderkey % 2 = 0"), "POS_CASH_balance": (POS_CASH, LINES, "true"),
    "installments_payments": (INSTALLMENTS, LINES, "true"), "credit_card_balance": (CARD_MONTHS, LINES, "l_linenumber = 1"),
}


def table_sql(name: str) -> str:
    columns, source, where = TABLES[name]
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source} WHERE {where}"


def credit_tables(t):
    """The seven tables of the credit domain."""
    for name in ("customer", "orders", "lineitem"):
        getattr(t, name).createOrReplaceTempView(name)
    return {name: t.spark.sql(table_sql(name)) for name in TABLES}


def credit_features(t):
    return t.derived("credit_features", lambda: credit.build_credit_features(credit_tables(t)))


# an offset before the decision is a negative one, in days as in months
CREDIT_SQL = f"""WITH {', '.join(f'{n} AS ({table_sql(n)})' for n in TABLES)},
dates AS ({anchor_cte('application_train', 'SK_ID_CURR', CREDIT.anchor, credit.DECISION)}),
b AS (SELECT SK_ID_CURR, count(SK_ID_BUREAU) AS BUREAU_COUNT, avg(AMT_CREDIT_SUM) AS BUREAU_AMT_CREDIT_SUM_MEAN,
  count(*) FILTER (WHERE CREDIT_ACTIVE = 'Active') AS BUREAU_ACTIVE_COUNT FROM bureau WHERE DAYS_CREDIT < 0 GROUP BY 1),
bb AS (SELECT SK_ID_CURR, count(MONTHS_BALANCE) AS BUREAU_BALANCE_COUNT FROM bureau_balance JOIN bureau USING (SK_ID_BUREAU) WHERE MONTHS_BALANCE < 0 GROUP BY 1),
p AS (SELECT SK_ID_CURR, count(SK_ID_PREV) AS PREV_APP_COUNT, avg(AMT_CREDIT) AS PREV_APP_AMT_CREDIT_MEAN,
  count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Approved') AS PREV_APP_APPROVED_COUNT FROM previous_application WHERE DAYS_DECISION < 0 GROUP BY 1),
pos AS (SELECT SK_ID_CURR, count(SK_ID_PREV) AS POS_CASH_COUNT, avg(CNT_INSTALMENT) AS POS_CASH_CNT_INSTALMENT_MEAN FROM POS_CASH_balance WHERE MONTHS_BALANCE < 0 GROUP BY 1),
i AS (SELECT SK_ID_CURR, count(SK_ID_PREV) AS INSTALLMENTS_COUNT, sum(AMT_PAYMENT) AS INSTALLMENTS_AMT_PAYMENT_SUM
  FROM installments_payments WHERE coalesce(DAYS_ENTRY_PAYMENT, DAYS_INSTALMENT) < 0 GROUP BY 1),
cc AS (SELECT SK_ID_CURR, count(SK_ID_PREV) AS CREDIT_CARD_COUNT, avg(AMT_BALANCE) AS CREDIT_CARD_AMT_BALANCE_MEAN FROM credit_card_balance WHERE MONTHS_BALANCE < 0 GROUP BY 1)
SELECT SK_ID_CURR, CODE_GENDER, DAYS_BIRTH, CASE WHEN DAYS_EMPLOYED <> 365243 THEN CAST(DAYS_EMPLOYED AS DOUBLE) END AS DAYS_EMPLOYED,
  coalesce(DAYS_EMPLOYED = 365243, false) AS DAYS_EMPLOYED_IS_SENTINEL,
  {', '.join(c for c in credit.BASE_APPLICANT_COLUMNS if c not in ('CODE_GENDER', 'DAYS_BIRTH', 'DAYS_EMPLOYED'))}, APPLICATION_DATE, TARGET,
  coalesce(BUREAU_COUNT, 0) AS BUREAU_COUNT, BUREAU_AMT_CREDIT_SUM_MEAN, coalesce(BUREAU_ACTIVE_COUNT, 0) AS BUREAU_ACTIVE_COUNT,
  CASE WHEN BUREAU_COUNT IS NULL THEN 0 ELSE coalesce(BUREAU_BALANCE_COUNT, 0) END AS BUREAU_BALANCE_COUNT,
  coalesce(PREV_APP_COUNT, 0) AS PREV_APP_COUNT, PREV_APP_AMT_CREDIT_MEAN, coalesce(PREV_APP_APPROVED_COUNT, 0) AS PREV_APP_APPROVED_COUNT,
  coalesce(POS_CASH_COUNT, 0) AS POS_CASH_COUNT, POS_CASH_CNT_INSTALMENT_MEAN,
  coalesce(INSTALLMENTS_COUNT, 0) AS INSTALLMENTS_COUNT, coalesce(INSTALLMENTS_AMT_PAYMENT_SUM, 0.0) AS INSTALLMENTS_AMT_PAYMENT_SUM,
  coalesce(CREDIT_CARD_COUNT, 0) AS CREDIT_CARD_COUNT, CREDIT_CARD_AMT_BALANCE_MEAN,
  {split_case('APPLICATION_DATE', CREDIT.split)} AS SPLIT, {mature_expr('APPLICATION_DATE', CREDIT.label)} AS IS_MATURE
FROM application_train JOIN dates USING (SK_ID_CURR) LEFT JOIN b USING (SK_ID_CURR) LEFT JOIN bb USING (SK_ID_CURR) LEFT JOIN p USING (SK_ID_CURR)
LEFT JOIN pos USING (SK_ID_CURR) LEFT JOIN i USING (SK_ID_CURR) LEFT JOIN cc USING (SK_ID_CURR)"""


@register("credit_features", CREDIT_SQL, "F5 E1 B2 B3 B4 B9 C1 C2 C3 C4 D1 D2 D3 D4 D5 D6 D7 F1 F3 T7")
def q_credit(t):
    """The credit domain's feature table: anchored decision times, five as-of aggregates over six
    history tables, sentinel flag, target, split and maturity."""
    return credit_features(t)


INPUTS = [c for c in CREDIT.inputs([
    "SK_ID_CURR", *credit.BASE_APPLICANT_COLUMNS[:3], "DAYS_EMPLOYED_IS_SENTINEL", *credit.BASE_APPLICANT_COLUMNS[3:], "APPLICATION_DATE", "TARGET",
    "BUREAU_COUNT", "INSTALLMENTS_AMT_PAYMENT_SUM", "SPLIT", "IS_MATURE"])]


@register("credit_model_inputs", f"""WITH f AS ({CREDIT_SQL})
SELECT SPLIT, {', '.join(c if c not in ('NAME_EDUCATION_TYPE', 'NAME_FAMILY_STATUS', 'NAME_HOUSING_TYPE') else
    f"CASE WHEN {c} IN (SELECT {c} FROM f WHERE IS_MATURE) THEN {c} END AS {c}" for c in INPUTS)}
FROM f""", "B1 B10 B11 N2")
def q_inputs(t):
    """The domain, resolved by name, names its inputs among the columns given, captures the levels of
    mature rows and encodes every row with them: levels that only later rows hold become null."""
    domain, f = load_domain("credit"), credit_features(t)
    given = f.select("SK_ID_CURR", *[c for c in f.columns if c in INPUTS], "APPLICATION_DATE", "CODE_GENDER", "TARGET", "SPLIT", "IS_MATURE")
    columns = domain.feature_columns(given)
    levels = domain.capture_categories(given, columns)
    return domain.prepare_features(given, [*columns, "SPLIT"], levels.where("column_name <> 'SPLIT'").unionByName(
        given.select(F.lit("SPLIT").alias("column_name"), F.col("SPLIT").alias("level")).distinct()))


STRETCH, EVENTS_FROM, FILES_FROM = 24, "2024-01-01", "2019-01-01"


def transaction_files(t):
    """The provider's two files: every third transaction is in the second one."""
    at = F.timestamp_micros((F.unix_micros(F.col("trans_ts").cast("timestamp")) - F.unix_micros(F.to_timestamp(F.lit(EVENTS_FROM)))) * STRETCH
                            + F.unix_micros(F.to_timestamp(F.lit(FILES_FROM)))).cast("timestamp_ntz")
    rows = D.card_transactions(t).select(
        F.col("trans_num").cast("string").alias("trans_num"), at.cast("string").alias(fraud.TS), F.col("card").alias("cc_num"),
        "category", "amt", "lat", "long", "merch_lat", "merch_long", "is_fraud")
    second = F.col("trans_num").cast("long") % 3 == 0
    return [rows.where(~second), rows.where(second)]


FRAUD_SQL = f"""WITH tx AS (SELECT * REPLACE (TIMESTAMP '{FILES_FROM}' + to_microseconds((epoch_us(trans_ts) - epoch_us(TIMESTAMP '{EVENTS_FROM}')) * {STRETCH}) AS trans_ts)
  FROM ({D.CARD_SQL})), f AS (WITH {FEATURE_SQL})
SELECT CAST(trans_num AS VARCHAR) AS trans_num, trans_ts AS {fraud.TS}, category, amt, {', '.join(FEATURE_COLUMNS)}, is_fraud AS TARGET,
  {split_case('trans_ts', FRAUD.split)} AS SPLIT, {mature_expr('trans_ts', FRAUD.label)} AS IS_MATURE
FROM f"""


@register("fraud_features", FRAUD_SQL, "F6 B1 C5 C11 E12 F1 F3")
def q_fraud(t):
    """The fraud domain's feature table: two files as one universe, card history features, target by
    transaction, split and maturity."""
    out = fraud.build_fraud_features(transaction_files(t))
    # distances go through sin/cos/asin, whose last bit differs between math libraries
    return out.withColumns({c: F.round(c, 6) for c in ("DISTANCE_FROM_HOME_KM", "DISTANCE_FROM_USUAL_MERCHANT_KM")})
