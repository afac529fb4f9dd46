"""Chronological splits and label maturity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotab.config import LabelConfig, SplitConfig
from chronotab.functions.timecols import ts_literal

TRAIN, VALIDATION, TEST, EXCLUDED = "train", "validation", "test", "excluded"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_label(ts, cfg: SplitConfig) -> Column:
    """inclusive instant bounds (T11); on overlap test wins over validation over train.
    Raises (F2) when the configured gap is narrower than ``gap_days``."""
    cfg.check_gap()
    t = _col(ts)

    def inside(w):
        return t.between(ts_literal(w.start), ts_literal(w.end))

    return (F.when(inside(cfg.test), F.lit(TEST))
            .when(inside(cfg.validation), F.lit(VALIDATION))
            .when(inside(cfg.train), F.lit(TRAIN))
            .otherwise(F.lit(EXCLUDED)))


def maturity_flag(ts, cfg: LabelConfig) -> Column:
    """mature iff floor(days(as_of - ts)) >= maturity_days; null time -> false.

    floor of whole days >= m is the same as ts <= as_of - m days, a plain comparison that
    pushes down to the scan."""
    cutoff = cfg.as_of - dt.timedelta(days=cfg.maturity_days)
    return F.coalesce(_col(ts) <= ts_literal(cutoff), F.lit(False))


def add_split_and_maturity(df: DataFrame, ts: str, split: SplitConfig, label: LabelConfig,
                           split_col: str = "SPLIT", mature_col: str = "IS_MATURE") -> DataFrame:
    return df.withColumns({split_col: split_label(ts, split), mature_col: maturity_flag(ts, label)})


def mature_splits(df: DataFrame, split_col: str = "SPLIT", mature_col: str = "IS_MATURE",
                  non_empty: bool = True) -> dict[str, DataFrame]:
    """train / validation / test frames from mature rows only; with ``non_empty`` an empty
    split is omitted (one small aggregate decides which exist)."""
    mature = df.where(F.col(mature_col))
    names = [TRAIN, VALIDATION, TEST]
    if non_empty:
        present = {r[0] for r in mature.where(F.col(split_col).isin(names))
                   .select(split_col).distinct().collect()}
        names = [n for n in names if n in present]
    return {n: mature.where(F.col(split_col) == n) for n in names}


def split_profile(df: DataFrame, target: str, split_col: str = "SPLIT") -> DataFrame:
    """Rows and positive rate per split."""
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        (F.sum(F.col(target).cast("bigint")).cast("double") /
         F.count(F.col(target)).cast("double")).alias("positive_rate"),
    )
