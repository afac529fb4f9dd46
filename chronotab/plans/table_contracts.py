"""Contracts of the two domains' tables (G1-G9, A1, A2), declared as text.

A line is ``name type``; ``?`` allows nulls, ``!`` marks a unique key, ``[a b]`` a set of values,
``lo..hi`` a closed range (either end may be left out).
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

from chronotab.operators.contracts import Contract, Field

_TYPES = {"int": T.LongType(), "float": T.DoubleType(), "text": T.StringType(), "time": T.TimestampNTZType()}
_LINE = re.compile(r"(\w+) (\w+)([?!]?)(?: \[(.*)\])?(?: (\S*)\.\.(\S*))?$")


def declare(name: str, text: str) -> Contract:
    fields = []
    for line in filter(None, map(str.strip, text.splitlines())):
        column, kind, mark, values, lo, hi = _LINE.match(line).groups()
        allowed = None if values is None else tuple(int(v) if kind == "int" else v for v in values.split())
        fields.append(Field(column, _TYPES[kind], mark == "?", mark == "!", allowed,
                            float(lo) if lo else None, float(hi) if hi else None))
    return Contract(name, tuple(fields))


# Columns, types and checks of the tables, in the tables' own order.
TRANSACTION = declare("transaction", """
    trans_date_trans_time text
    cc_num int
    merchant text
    category text
    amt float 0..
    first text
    last text
    gender text [F M]
    street text
    city text
    state text
    zip int
    lat float -90..90
    long float -180..180
    city_pop int 0..
    job text
    dob text
    trans_num text!
    unix_time int
    merch_lat float -90..90
    merch_long float -180..180
    is_fraud int [0 1]
""")
TRANSACTION_REQUEST = declare("transaction_request", """
    trans_num text!
    trans_date_trans_time time
    cc_num int
    category text
    amt float 0..
    lat float -90..90
    long float -180..180
    merch_lat float -90..90
    merch_long float -180..180
""")
BUREAU = declare("bureau", """
    SK_ID_CURR int
    SK_ID_BUREAU int!
    CREDIT_ACTIVE text
    CREDIT_CURRENCY text
    DAYS_CREDIT int
    CREDIT_DAY_OVERDUE int
    DAYS_CREDIT_ENDDATE float?
    DAYS_ENDDATE_FACT float?
    AMT_CREDIT_MAX_OVERDUE float?
    CNT_CREDIT_PROLONG int
    AMT_CREDIT_SUM float?
    AMT_CREDIT_SUM_DEBT float?
    AMT_CREDIT_SUM_LIMIT float?
    AMT_CREDIT_SUM_OVERDUE float
    CREDIT_TYPE text
    DAYS_CREDIT_UPDATE int
    AMT_ANNUITY float?
""")
BUREAU_BALANCE = declare("bureau_balance", """
    SK_ID_BUREAU int
    MONTHS_BALANCE int
    STATUS text
""")
POS_CASH_BALANCE = declare("POS_CASH_balance", """
    SK_ID_PREV int
    SK_ID_CURR int
    MONTHS_BALANCE int
    CNT_INSTALMENT float?
    CNT_INSTALMENT_FUTURE float?
    NAME_CONTRACT_STATUS text
    SK_DPD int
    SK_DPD_DEF int
""")
INSTALLMENTS_PAYMENTS = declare("installments_payments", """
    SK_ID_PREV int
    SK_ID_CURR int
    NUM_INSTALMENT_VERSION float
    NUM_INSTALMENT_NUMBER int
    DAYS_INSTALMENT float
    DAYS_ENTRY_PAYMENT float?
    AMT_INSTALMENT float
    AMT_PAYMENT float?
""")
CREDIT_CARD_BALANCE = declare("credit_card_balance", """
    SK_ID_PREV int
    SK_ID_CURR int
    MONTHS_BALANCE int
    AMT_BALANCE float
    AMT_CREDIT_LIMIT_ACTUAL int
    AMT_DRAWINGS_ATM_CURRENT float?
    AMT_DRAWINGS_CURRENT float
    AMT_DRAWINGS_OTHER_CURRENT float?
    AMT_DRAWINGS_POS_CURRENT float?
    AMT_INST_MIN_REGULARITY float?
    AMT_PAYMENT_CURRENT float?
    AMT_PAYMENT_TOTAL_CURRENT float
    AMT_RECEIVABLE_PRINCIPAL float
    AMT_RECIVABLE float
    AMT_TOTAL_RECEIVABLE float
    CNT_DRAWINGS_ATM_CURRENT float?
    CNT_DRAWINGS_CURRENT int
    CNT_DRAWINGS_OTHER_CURRENT float?
    CNT_DRAWINGS_POS_CURRENT float?
    CNT_INSTALMENT_MATURE_CUM float?
    NAME_CONTRACT_STATUS text
    SK_DPD int
    SK_DPD_DEF int
""")
PREVIOUS_APPLICATION = declare("previous_application", """
    SK_ID_PREV int!
    SK_ID_CURR int
    NAME_CONTRACT_TYPE text
    AMT_ANNUITY float?
    AMT_APPLICATION float
    AMT_CREDIT float?
    AMT_DOWN_PAYMENT float?
    AMT_GOODS_PRICE float?
    WEEKDAY_APPR_PROCESS_START text
    HOUR_APPR_PROCESS_START int
    FLAG_LAST_APPL_PER_CONTRACT text
    NFLAG_LAST_APPL_IN_DAY int
    RATE_DOWN_PAYMENT float?
    RATE_INTEREST_PRIMARY float?
    RATE_INTEREST_PRIVILEGED float?
    NAME_CASH_LOAN_PURPOSE text
    NAME_CONTRACT_STATUS text
    DAYS_DECISION int
    NAME_PAYMENT_TYPE text
    CODE_REJECT_REASON text
    NAME_TYPE_SUITE text?
    NAME_CLIENT_TYPE text
    NAME_GOODS_CATEGORY text
    NAME_PORTFOLIO text
    NAME_PRODUCT_TYPE text
    CHANNEL_TYPE text
    SELLERPLACE_AREA int
    NAME_SELLER_INDUSTRY text
    CNT_PAYMENT float?
    NAME_YIELD_GROUP text
    PRODUCT_COMBINATION text?
    DAYS_FIRST_DRAWING float?
    DAYS_FIRST_DUE float?
    DAYS_LAST_DUE_1ST_VERSION float?
    DAYS_LAST_DUE float?
    DAYS_TERMINATION float?
    NFLAG_INSURED_ON_APPROVAL float?
""")
APPLICATION_REQUEST = declare("application_request", """
    SK_ID_CURR int!
    CODE_GENDER text
    DAYS_BIRTH int
    DAYS_EMPLOYED int
    AMT_INCOME_TOTAL float
    AMT_CREDIT float
    AMT_ANNUITY float?
    NAME_EDUCATION_TYPE text
    NAME_FAMILY_STATUS text
    NAME_HOUSING_TYPE text
    CNT_CHILDREN int
    EXT_SOURCE_1 float?
    EXT_SOURCE_2 float?
    EXT_SOURCE_3 float?
""")
_AREAS = """APARTMENTS BASEMENTAREA YEARS_BEGINEXPLUATATION YEARS_BUILD COMMONAREA ELEVATORS ENTRANCES FLOORSMAX FLOORSMIN
    LANDAREA LIVINGAPARTMENTS LIVINGAREA NONLIVINGAPARTMENTS NONLIVINGAREA""".split()
APPLICATION = declare("application_train", """
    SK_ID_CURR int!
    TARGET int [0 1]
    NAME_CONTRACT_TYPE text
    CODE_GENDER text
    FLAG_OWN_CAR text
    FLAG_OWN_REALTY text
    CNT_CHILDREN int
    AMT_INCOME_TOTAL float
    AMT_CREDIT float
    AMT_ANNUITY float?
    AMT_GOODS_PRICE float?
    NAME_TYPE_SUITE text?
    NAME_INCOME_TYPE text
    NAME_EDUCATION_TYPE text
    NAME_FAMILY_STATUS text
    NAME_HOUSING_TYPE text
    REGION_POPULATION_RELATIVE float
    DAYS_BIRTH int
    DAYS_EMPLOYED int
    DAYS_REGISTRATION float
    DAYS_ID_PUBLISH int
    OWN_CAR_AGE float?
    FLAG_MOBIL int
    FLAG_EMP_PHONE int
    FLAG_WORK_PHONE int
    FLAG_CONT_MOBILE int
    FLAG_PHONE int
    FLAG_EMAIL int
    OCCUPATION_TYPE text?
    CNT_FAM_MEMBERS float?
    REGION_RATING_CLIENT int
    REGION_RATING_CLIENT_W_CITY int
    WEEKDAY_APPR_PROCESS_START text
    HOUR_APPR_PROCESS_START int
    REG_REGION_NOT_LIVE_REGION int
    REG_REGION_NOT_WORK_REGION int
    LIVE_REGION_NOT_WORK_REGION int
    REG_CITY_NOT_LIVE_CITY int
    REG_CITY_NOT_WORK_CITY int
    LIVE_CITY_NOT_WORK_CITY int
    ORGANIZATION_TYPE text
    EXT_SOURCE_1 float?
    EXT_SOURCE_2 float?
    EXT_SOURCE_3 float?
""" + "\n".join(f"{a}_{kind} float?" for kind in ("AVG", "MODE", "MEDI") for a in _AREAS) + """
    FONDKAPREMONT_MODE text?
    HOUSETYPE_MODE text?
    TOTALAREA_MODE float?
    WALLSMATERIAL_MODE text?
    EMERGENCYSTATE_MODE text?
    OBS_30_CNT_SOCIAL_CIRCLE float?
    DEF_30_CNT_SOCIAL_CIRCLE float?
    OBS_60_CNT_SOCIAL_CIRCLE float?
    DEF_60_CNT_SOCIAL_CIRCLE float?
    DAYS_LAST_PHONE_CHANGE float?
""" + "\n".join(f"FLAG_DOCUMENT_{i} int" for i in range(2, 22)) + """
    AMT_REQ_CREDIT_BUREAU_HOUR float?
    AMT_REQ_CREDIT_BUREAU_DAY float?
    AMT_REQ_CREDIT_BUREAU_WEEK float?
    AMT_REQ_CREDIT_BUREAU_MON float?
    AMT_REQ_CREDIT_BUREAU_QRT float?
    AMT_REQ_CREDIT_BUREAU_YEAR float?
""")
CONTRACTS = {c.name: c for c in (APPLICATION, APPLICATION_REQUEST, BUREAU, BUREAU_BALANCE, PREVIOUS_APPLICATION, POS_CASH_BALANCE,
                                 INSTALLMENTS_PAYMENTS, CREDIT_CARD_BALANCE, TRANSACTION, TRANSACTION_REQUEST)}
