"""SQL text for the DuckDB oracles, built from the same config objects as the Spark side."""

from __future__ import annotations

import datetime as dt

from chronotab.config import LabelConfig, SplitConfig, Window


def ts(value: dt.datetime) -> str:
    return f"TIMESTAMP '{value.isoformat(sep=' ')}'"


def split_case(col: str, cfg: SplitConfig) -> str:
    def inside(w):
        return f"{col} BETWEEN {ts(w.start)} AND {ts(w.end)}"
    return (f"CASE WHEN {inside(cfg.test)} THEN 'test' WHEN {inside(cfg.validation)} THEN "
            f"'validation' WHEN {inside(cfg.train)} THEN 'train' ELSE 'excluded' END")


def mature_expr(col: str, cfg: LabelConfig) -> str:
    cutoff = cfg.as_of - dt.timedelta(days=cfg.maturity_days)
    return f"coalesce({col} <= {ts(cutoff)}, false)"


def anchor_cte(table: str, key: str, w: Window, name: str = "DECISION_TS") -> str:
    """E1 in SQL: integer seconds (rank * span) // (n - 1) after the start."""
    span = int((w.end - w.start).total_seconds())
    return f"""SELECT {key}, {ts(w.start)} + to_seconds(CASE WHEN n <= 1 THEN 0
  ELSE (CAST(rk AS BIGINT) * {span}) // (n - 1) END) AS {name}
FROM (SELECT {key}, row_number() OVER (ORDER BY {key}) - 1 AS rk, count(*) OVER () AS n FROM {table})"""


def exact_mean(col: str, scale: int = 2) -> str:
    f = float(10 ** scale)
    return (f"CASE WHEN count({col}) > 0 THEN CAST(sum(CAST(round({col} * {f}) AS HUGEINT)) AS DOUBLE)"
            f" / CAST(count({col}) AS DOUBLE) / {f} END")


def exact_sum(col: str, scale: int = 2) -> str:
    f = float(10 ** scale)
    return f"CAST(sum(CAST(round({col} * {f}) AS HUGEINT)) AS DOUBLE) / {f}"
