"""Table contracts (G1-G12) and categorical levels.

A contract is a list of typed fields with checks. ``violations`` evaluates every check of every
column in one aggregate pass (plus one grouped pass per unique key) and returns the lazy-mode
long table ``(column_name, check, n_failed, example_min, example_max)`` (G7).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from chronotab.operators.order import global_row_number


@dataclass(frozen=True)
class Field:
    name: str
    dtype: DataType
    nullable: bool = False
    unique: bool = False
    isin: tuple | None = None
    ge: float | None = None
    le: float | None = None


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    strict: bool = True
    coerce: bool = True
    extra: dict = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType([StructField(f.name, f.dtype, f.nullable) for f in self.fields])

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]


VIOLATION_SCHEMA = ("column_name string, check string, n_failed bigint, "
                    "example_min string, example_max string")


def column_violations(df: DataFrame, contract: Contract) -> list[tuple[str, str]]:
    """G1: missing and extra columns (strict mode), as (column, check) pairs."""
    have = set(df.columns)
    out = [(c, "missing_column") for c in contract.columns if c not in have]
    if contract.strict:
        out += [(c, "extra_column") for c in df.columns if c not in set(contract.columns)]
    return out


def coerce(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast every contract column with ``try_cast`` (an uncastable value becomes null and
    is reported by ``violations``); extra columns are dropped."""
    return df.select(*[F.col(f.name).try_cast(f.dtype).alias(f.name) for f in contract.fields
                       if f.name in df.columns])


def _checks(df: DataFrame, contract: Contract) -> list[tuple[str, str, Column, Column]]:
    """(column, check, failure predicate, value shown as example)."""
    out = []
    for f in contract.fields:
        if f.name not in df.columns:
            continue
        raw = F.col(f.name)
        typed = raw.try_cast(f.dtype) if contract.coerce else raw
        shown = raw.cast("string")
        out.append((f.name, "type", raw.isNotNull() & typed.isNull(), shown))
        if not f.nullable:
            out.append((f.name, "not_null", raw.isNull(), shown))
        if f.isin is not None:
            out.append((f.name, "in_set", typed.isNotNull() & ~typed.isin(list(f.isin)), shown))
        if f.ge is not None:
            out.append((f.name, "greater_than_or_equal", typed.isNotNull() & (typed < F.lit(f.ge)), shown))
        if f.le is not None:
            out.append((f.name, "less_than_or_equal", typed.isNotNull() & (typed > F.lit(f.le)), shown))
    return out


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Every failed check at once. Row checks share one aggregate; each unique key adds one
    grouped count (partial aggregation keeps a hot key to one row per task)."""
    spark = df.sparkSession
    checks = _checks(df, contract)
    aggs = []
    for i, (_, _, fail, shown) in enumerate(checks):
        aggs += [F.count_if(fail).alias(f"n{i}"),
                 F.min(F.when(fail, shown)).alias(f"lo{i}"),
                 F.max(F.when(fail, shown)).alias(f"hi{i}")]
    parts = []
    if aggs:
        wide = df.agg(*aggs)
        stack = ", ".join(f"'{c}', '{k}', n{i}, lo{i}, hi{i}" for i, (c, k, _, _) in enumerate(checks))
        parts.append(wide.selectExpr(
            f"stack({len(checks)}, {stack}) AS (column_name, check, n_failed, example_min, example_max)"))
    for f in contract.fields:
        if f.unique and f.name in df.columns:
            dup = (df.where(F.col(f.name).isNotNull()).groupBy(f.name).count().where("count > 1")
                   .agg(F.sum("count").cast("bigint").alias("n_failed"),
                        F.min(F.col(f.name).cast("string")).alias("example_min"),
                        F.max(F.col(f.name).cast("string")).alias("example_max")))
            parts.append(dup.select(F.lit(f.name).alias("column_name"), F.lit("unique").alias("check"),
                                    F.coalesce("n_failed", F.lit(0).cast("bigint")).alias("n_failed"),
                                    "example_min", "example_max"))
    cols = column_violations(df, contract)
    if cols:
        parts.append(spark.createDataFrame(
            [(c, k, 1, None, None) for c, k in cols], VIOLATION_SCHEMA))
    if not parts:
        return spark.createDataFrame([], VIOLATION_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("n_failed") > 0).select(
        "column_name", "check", F.col("n_failed").cast("bigint").alias("n_failed"),
        "example_min", "example_max")


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    """Raise on any violation; else return the coerced table."""
    bad = violations(df, contract).collect()  # bounded: at most a few rows per check
    if bad:
        detail = "; ".join(f"{r.column_name}:{r.check} x{r.n_failed}" for r in bad)
        raise ValueError(f"contract {contract.name} failed: {detail}")
    return coerce(df, contract)


def unique_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """G4 for a (possibly composite) key: every key value held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).where("n_rows > 1")


def null_profile(df: DataFrame) -> DataFrame:
    """Full-table null count per column, one aggregate then unpivot."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).cast("bigint").alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"_n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, n_null)", "_rows AS n_rows")


def empty_typed(spark: SparkSession, contract: Contract) -> DataFrame:
    """No rows -> an empty table with the contract's columns and types."""
    return spark.createDataFrame([], contract.schema)


def capture_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-null levels per column, as ``(column_name, level)`` rows. Computed as
    a distributed distinct over the unpivoted columns, never as one collected set."""
    stack = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    return (df.selectExpr(f"stack({len(columns)}, {stack}) AS (column_name, level)")
            .where(F.col("level").isNotNull()).distinct())


def levels_long(levels: DataFrame) -> DataFrame:
    """Index each column's sorted levels (0-based), however many there are."""
    numbered = global_row_number(levels.select("column_name", "level"), ["level"], "level_index", ["column_name"])
    return numbered.select("column_name", F.col("level_index").cast("bigint").alias("level_index"), "level")


def encode_levels(df: DataFrame, columns: list[str], levels: DataFrame) -> DataFrame:
    """``columns`` keep a value only if it is a captured level of theirs (unseen -> null,
    T19). Levels stay a table: one join a column, which Spark broadcasts if it measures it small."""
    out = df
    for c in columns:
        own = levels.where(F.col("column_name") == c).select(F.col("level").alias("_level"))
        out = out.join(own, F.col(f"`{c}`").cast("string") == F.col("_level"), "left")
        out = out.withColumn(c, F.when(F.col("_level").isNotNull(), F.col(f"`{c}`"))).drop("_level")
    return out


def history_before_decision(history: DataFrame, ts: str, decision_ts: str) -> Column:
    """G8 on nested requests: true when any history element is at or after the decision."""
    return F.exists(F.col(history), lambda h: h[ts] >= F.col(decision_ts))
