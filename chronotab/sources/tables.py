"""Table sources and sinks: driver Parquet tables, contract-typed CSV (A1, A2), the feature
table (A3, A4) and the filtered scan (A5)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from chronotab.functions.scalar import nan_to_null_all

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, as it stands: filters and column choices reach the scan (NaN becomes
    null where text files are read, T3; see ``read_csv_contract``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy access to the tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def derived(self, name: str, build) -> DataFrame:
        """A table derived from these tables and read by several branches of a query (the
        request file, the deduplicated log, a monitoring window): built once, materialised in
        the shared checkpoint folder, then read back by every consumer."""
        key = f"derived:{name}"
        if key not in self._cache:
            from chronotab.session import cut_lineage
            self._cache[key] = cut_lineage(build())
        return self._cache[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]


def read_csv_contract(spark: SparkSession, paths: str | list[str], schema: StructType,
                      drop_leading_index: bool = False) -> DataFrame:
    """A1 / A2: CSV read with the contract schema (no inference). With
    ``drop_leading_index`` the file carries an unnamed first column, read and dropped."""
    if drop_leading_index:
        schema = StructType([StructField("_index", schema.fields[0].dataType.__class__(), True)]
                            + list(schema.fields))
        from pyspark.sql.types import LongType
        schema.fields[0] = StructField("_index", LongType(), True)
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(paths)
    if drop_leading_index:
        df = df.drop("_index")
    return nan_to_null_all(df)


def write_features(df: DataFrame, path: str, split_col: str = "SPLIT", mode: str = "overwrite") -> None:
    """A3 sink: Parquet partitioned by split, so a split read prunes files."""
    df.write.mode(mode).partitionBy(split_col).parquet(path)


def read_features(spark: SparkSession, path: str, columns: Iterable[str] | None = None,
                  split: str | None = None, split_col: str = "SPLIT") -> DataFrame:
    """A3 source / A4 pruned read: only the named columns reach the scan, a split filter
    prunes partitions."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.where(F.col(split_col) == split)
    if columns is not None:
        df = df.select(*columns)
    return df


def filtered_scan(big: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``big`` whose key is in ``ids``. Spark broadcasts the id set if it measures
    it small enough and shuffles both sides otherwise."""
    return big.join(ids.select(key).distinct(), key, "left_semi")
