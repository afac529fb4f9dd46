"""Registered queries: each name maps to a Spark callable ``(spark, sf_dir) -> DataFrame`` and,
where the operator is expressible in SQL, an independent DuckDB oracle over the same tables.

Every query reads whole driver tables (or what Spark derives from them); nothing is capped,
sampled or filtered to keep the check cheap. A ``limit`` appears only where it is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronotab.session import prepare_session
from chronotab.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DOCS: dict[str, str] = {}


def register(name: str, sql: str | None = None, ids: str = ""):
    def deco(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_session(spark)
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = f"[{ids}] {fn.__doc__ or ''}"
        QUERIES[name] = run
        DOCS[name] = ids
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from chronotab.plans import (  # noqa: F401
        q_asof,
        q_events,
        q_eval,
        q_quality,
        q_nested,
        q_monitor,
        q_series,
        q_govern,
        q_stream,
        q_files,
        q_domains,
        q_ops,
    )
