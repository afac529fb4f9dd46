"""A domain plugs in as a config plus three functions, resolved by name."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame

from chronotab.config import CREDIT, FRAUD, DomainConfig
from chronotab.operators.contracts import capture_categories, encode_levels


class Domain(Protocol):
    config: DomainConfig

    def feature_columns(self, df: DataFrame) -> list[str]: ...

    def capture_categories(self, df: DataFrame, columns: list[str]) -> DataFrame: ...

    def prepare_features(self, df: DataFrame, columns: list[str], categories: DataFrame) -> DataFrame: ...


def _texts(df: DataFrame, columns: list[str]) -> list[str]:
    kinds = dict(df.dtypes)
    return [c for c in columns if kinds[c] == "string"]


@dataclass(frozen=True)
class ConfiguredDomain:
    config: DomainConfig

    def feature_columns(self, df: DataFrame) -> list[str]:
        return self.config.inputs(df.columns)

    def capture_categories(self, df: DataFrame, columns: list[str]) -> DataFrame:
        """(column_name, level) of the text columns over mature rows."""
        texts = _texts(df, columns)
        if not texts:
            return df.sparkSession.createDataFrame([], "column_name string, level string")
        return capture_categories(df.where("IS_MATURE"), texts)

    def prepare_features(self, df: DataFrame, columns: list[str], categories: DataFrame) -> DataFrame:
        """The columns, text restricted to captured levels (unseen -> null, T19)."""
        return encode_levels(df.select(*columns), _texts(df, columns), categories)


DOMAINS: dict[str, Domain] = {c.name: ConfiguredDomain(c) for c in (CREDIT, FRAUD)}


def load_domain(name: str) -> Domain:
    return DOMAINS[name]
