"""F6 on the reference's own card-transaction files.

``build_fraud_features(files, cfg)``: C11 union of the files -> E12 window features (per card,
strictly earlier, at most 30 days) -> C5 target by transaction id -> F1 split -> F3 maturity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotab.config import FRAUD, DomainConfig
from chronotab.operators.splits import add_split_and_maturity
from chronotab.operators.windows import FEATURE_COLUMNS, HOT_CARD_ROWS, event_features

TS = "trans_date_trans_time"
# Transaction columns kept beside the history features.
BASE_TRANSACTION_COLUMNS = ["category", "amt"]


def union_files(files: Sequence[DataFrame]) -> DataFrame:
    """C11: the provider's files concatenated back into one universe of transactions."""
    out = files[0]
    for f in files[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def assemble_fraud_features(raw: DataFrame, bucket_days: int | None = None,
                            hot_card_rows: int | None = HOT_CARD_ROWS) -> DataFrame:
    """The 17 feature-table columns for every transaction in ``raw``."""
    tx = raw.withColumn(TS, F.col(TS).cast("timestamp_ntz"))
    feats = event_features(tx.select("trans_num", TS, "cc_num", "category", "amt", "lat", "long",
                                     "merch_lat", "merch_long"),
                           card="cc_num", ts=TS, bucket_days=bucket_days, hot_card_rows=hot_card_rows)
    return feats.select("trans_num", TS, *BASE_TRANSACTION_COLUMNS, *FEATURE_COLUMNS)


def build_fraud_features(files: Sequence[DataFrame], cfg: DomainConfig = FRAUD) -> DataFrame:
    """union -> features -> target (left join on the transaction id) -> split -> maturity."""
    raw = union_files(files)
    feats = assemble_fraud_features(raw)
    target = raw.select("trans_num", F.col("is_fraud").alias("TARGET"))
    feats = feats.join(target, "trans_num", "left")
    return add_split_and_maturity(feats, TS, cfg.split, cfg.label)
