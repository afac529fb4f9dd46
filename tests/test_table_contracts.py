"""One valid row per contract, then one field broken at a time."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from chronotab.operators.contracts import empty_typed, violations
from chronotab.plans.table_contracts import CONTRACTS

SIZES = {"application_train": 122, "application_request": 14, "bureau": 17, "bureau_balance": 3, "previous_application": 37,
         "POS_CASH_balance": 8, "installments_payments": 8, "credit_card_balance": 23, "transaction": 22, "transaction_request": 9}
VALUES = {T.LongType(): 1, T.DoubleType(): 1.5, T.StringType(): "x", T.TimestampNTZType(): dt.datetime(2020, 1, 1)}


def valid(contract):
    return [f.isin[0] if f.isin else VALUES[f.dtype] for f in contract.fields]


def failed(spark, contract, rows, schema=None):
    df = spark.createDataFrame(rows, schema or T.StructType([T.StructField(f.name, f.dtype) for f in contract.fields]))
    return {(r.column_name, r.check) for r in violations(df, contract).collect()}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_valid_row_and_nulls(spark, name):
    c = CONTRACTS[name]
    assert len(c.fields) == SIZES[name]
    good = valid(c)
    assert failed(spark, c, [tuple(good)]) == set()
    nulls = [None if f.nullable else v for f, v in zip(c.fields, good)]
    assert failed(spark, c, [tuple(nulls)]) == set()
    assert failed(spark, c, [tuple([None] * len(good))]) == {(f.name, "not_null") for f in c.fields if not f.nullable}
    assert empty_typed(spark, c).columns == c.columns


def test_broken_fields(spark):
    c = CONTRACTS["transaction"]
    at = c.columns.index

    def broken(**values):
        row = valid(c)
        for k, v in values.items():
            row[at(k)] = v
        return tuple(row)

    assert failed(spark, c, [broken(amt=-0.01)]) == {("amt", "greater_than_or_equal")}
    assert failed(spark, c, [broken(merch_lat=90.5, long=-181.0)]) == {("merch_lat", "less_than_or_equal"), ("long", "greater_than_or_equal")}
    assert failed(spark, c, [broken(gender="X", is_fraud=2)]) == {("gender", "in_set"), ("is_fraud", "in_set")}
    assert failed(spark, c, [broken(), broken()]) == {("trans_num", "unique")}
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in c.fields])
    row = [str(v) for v in valid(c)]
    row[at("zip")] = "12a"
    assert failed(spark, c, [tuple(row)], text) == {("zip", "type")}


def test_sentinel_is_accepted(spark):
    c = CONTRACTS["application_train"]
    row = valid(c)
    row[c.columns.index("DAYS_EMPLOYED")] = 365243
    assert failed(spark, c, [tuple(row)]) == set()
