"""Fixture rows re-created from the reference's tests (see FIXTURES.md)."""

import datetime as dt

from pyspark.sql import types as T

from chronotab.config import EvalConfig, LabelConfig, SliceConfig, SplitConfig, Window
from chronotab.config import DomainConfig

CREDIT_FIXTURE_CFG = DomainConfig(
    name="credit", entity_key="SK_ID_CURR", target="TARGET",
    anchor=Window.of("2020-01-01", "2020-01-11"),
    split=SplitConfig.of(("2020-01-01", "2020-01-05"), ("2020-01-06", "2020-01-08"), ("2020-01-09", "2020-01-15"), gap_days=1),
    label=LabelConfig.of(1, "2020-01-15"),
    evaluation=EvalConfig(10, 1, 0.05, 0.1),
    sentinels={"application_train": {"DAYS_EMPLOYED": 365243}},
)

APP_SCHEMA = ("SK_ID_CURR long, TARGET long, CODE_GENDER string, DAYS_BIRTH long, DAYS_EMPLOYED long, "
              "AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double, NAME_EDUCATION_TYPE string, "
              "NAME_FAMILY_STATUS string, NAME_HOUSING_TYPE string, CNT_CHILDREN long, EXT_SOURCE_1 double, "
              "EXT_SOURCE_2 double, EXT_SOURCE_3 double")


def credit_tables(spark, extra=False):
    app = [(1, 0, "M", -12000, -2000, 150000.0, 500000.0, 25000.0, "Higher education", "Married", "House / apartment", 1, 0.5, 0.6, 0.7),
           (2, 1, "F", -15000, 365243, 90000.0, 300000.0, 15000.0, "Secondary", "Single", "With parents", 0, None, 0.4, 0.3)]
    bureau = [(1, 10, -100, 1000.0, "Closed"), (1, 11, 50, 99999.0, "Active"), (2, 12, -30, 500.0, "Active")]
    bal = [(10, -2, "C"), (11, 0, "0")]
    prev = [(1, 200, -50, 5000.0, "Approved"), (2, 201, -20, 3000.0, "Refused")]
    pos = [(1, 200, -1, 12), (2, 201, -1, 6)]
    inst = [(1, 200, -40, -41.0, 416.0), (2, 201, -10, None, 500.0)]
    cc = [(1, 200, -1, 100.0), (2, 201, -1, 200.0)]
    if extra:
        # [ours] 3: balance rows but only a future bureau row (T7); 4: no history at all;
        # 99 appears only in history and is dropped
        app += [(3, 0, "F", -11000, -100, 50000.0, 100000.0, 5000.0, "Secondary", "Single", "Rented apartment", 0, 0.1, 0.2, 0.3),
                (4, 0, "M", -10000, -50, 60000.0, 120000.0, 6000.0, "Secondary", "Single", "Rented apartment", 0, 0.1, 0.2, 0.3)]
        bureau += [(3, 13, 400, 10.0, "Active"), (99, 14, -10, 10.0, "Active")]
        bal += [(13, -30, "C"), (13, -31, "C")]
    t = {
        "application_train": spark.createDataFrame(app, APP_SCHEMA),
        "bureau": spark.createDataFrame(bureau, "SK_ID_CURR long, SK_ID_BUREAU long, DAYS_CREDIT long, AMT_CREDIT_SUM double, CREDIT_ACTIVE string"),
        "bureau_balance": spark.createDataFrame(bal, "SK_ID_BUREAU long, MONTHS_BALANCE long, STATUS string"),
        "previous_application": spark.createDataFrame(prev, "SK_ID_CURR long, SK_ID_PREV long, DAYS_DECISION long, AMT_CREDIT double, NAME_CONTRACT_STATUS string"),
        "POS_CASH_balance": spark.createDataFrame(pos, "SK_ID_CURR long, SK_ID_PREV long, MONTHS_BALANCE long, CNT_INSTALMENT long"),
        "installments_payments": spark.createDataFrame(inst, "SK_ID_CURR long, SK_ID_PREV long, DAYS_INSTALMENT long, DAYS_ENTRY_PAYMENT double, AMT_PAYMENT double"),
        "credit_card_balance": spark.createDataFrame(cc, "SK_ID_CURR long, SK_ID_PREV long, MONTHS_BALANCE long, AMT_BALANCE double"),
    }
    return t


FRAUD_FIXTURE_CFG = DomainConfig(
    name="fraud", entity_key="trans_num", target="TARGET",
    split=SplitConfig.of(("2020-01-01", "2020-01-01"), ("2020-01-02", "2020-01-02"), ("2020-01-03", "2020-02-29"), gap_days=0),
    label=LabelConfig.of(0, "2020-02-29"),
    evaluation=EvalConfig(50, 1, 0.01, 0.01, slices=(SliceConfig("category", 0.05),)),
)

TX_SCHEMA = ("trans_num string, trans_date_trans_time string, cc_num long, amt double, category string, "
             "lat double, long double, merch_lat double, merch_long double, is_fraud long")


def fraud_rows(extra=False):
    rows = [
        ("t0", "2020-01-01 00:00:00", 1, 10.0, "misc_net", 36.0, -81.0, 36.01, -81.01, 0),
        ("t1", "2020-01-01 00:30:00", 1, 20.0, "grocery_pos", 36.0, -81.0, 36.02, -81.02, 0),
        ("t2", "2020-01-01 02:00:00", 1, 30.0, "misc_net", 36.0, -81.0, 36.03, -81.03, 0),
        ("t3", "2020-01-02 01:00:00", 1, 40.0, "travel", 36.0, -81.0, 36.04, -81.04, 1),
        ("t4", "2020-02-15 01:00:00", 1, 50.0, "travel", 36.0, -81.0, 36.05, -81.05, 0),
        ("s0", "2020-01-01 00:00:00", 2, 5.0, "misc_net", 40.0, -75.0, 40.01, -75.01, 0),
        ("s1", "2020-01-01 00:10:00", 2, 7.0, "misc_net", 40.0, -75.0, 40.02, -75.02, 0),
    ]
    if extra:
        # [ours] card 3: a tie on time (T4), rows exactly 1 h, 24 h and 30 d old (T2), two
        # equal amounts so the std is 0
        rows += [
            ("u0", "2020-01-01 00:00:00", 3, 8.0, "misc_net", 30.0, -90.0, 30.0, -90.0, 0),
            ("u1", "2020-01-31 00:00:00", 3, 8.0, "misc_net", 30.0, -90.0, 30.0, -90.0, 0),
            ("u2", "2020-01-31 00:00:00", 3, 9.0, "travel", 30.0, -90.0, 30.0, -90.0, 0),
            ("u3", "2020-01-31 01:00:00", 3, 8.0, "misc_net", 30.0, -90.0, 30.0, -90.0, 0),
            ("u4", "2020-02-01 00:00:00", 3, 8.0, "misc_net", 30.0, -90.0, 30.0, -90.0, 0),
        ]
    return rows


def ts(s):
    return dt.datetime.fromisoformat(s)


__all__ = ["T"]
