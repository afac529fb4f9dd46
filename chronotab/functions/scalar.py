"""Scalar column expressions: B2, B5, B8, B9, B11-B15."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: mean Earth radius used by the great-circle distance.
EARTH_RADIUS_KM = 6371.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_to_null(df: DataFrame, column: str, sentinel) -> DataFrame:
    """B2: ``column`` equal to ``sentinel`` becomes null (as double) plus a boolean
    ``<column>_IS_SENTINEL`` flag; a null input is not a sentinel."""
    is_sentinel = F.coalesce(F.col(column) == F.lit(sentinel), F.lit(False))
    return df.withColumn(f"{column}_IS_SENTINEL", is_sentinel).withColumn(
        column, F.when(is_sentinel, F.lit(None)).otherwise(F.col(column)).cast("double")
    )


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; null if any coordinate is null."""
    la1, lo1, la2, lo2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((la2 - la1) / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2)
    return F.lit(EARTH_RADIUS_KM) * 2 * F.asin(F.sqrt(a))


def zscore_guarded(deviation, std) -> Column:
    """Deviation / std, null when std is null or 0."""
    return F.when(_col(std) > 0, _col(deviation) / _col(std))


def missing_policy(df: DataFrame) -> DataFrame:
    """By suffix, ``_COUNT`` -> 0 (bigint), ``_SUM`` -> 0.0, ``_MEAN`` stays null (double)."""
    out = []
    for name in df.columns:
        if name.endswith("_COUNT"):
            out.append(F.coalesce(F.col(name).cast("bigint"), F.lit(0).cast("bigint")).alias(name))
        elif name.endswith("_SUM"):
            out.append(F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name))
        elif name.endswith("_MEAN"):
            out.append(F.col(name).cast("double").alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def id_as_string(c) -> Column:
    """One id type for integer and hash ids."""
    return _col(c).cast("string")


def nan_to_null(c) -> Column:
    """NaN becomes null (pandas treats it as missing, Spark does not)."""
    return F.when(~F.isnan(_col(c)), _col(c))


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """T3 at ingest: every float/double column NaN -> null."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            cols.append(nan_to_null(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def traffic_filter(version_col, traffic_col, model_version=None) -> Column:
    """Drop test-bench rows (a missing source counts as not test); keep one model version,
    compared as strings (T14)."""
    cond = ~F.coalesce(_col(traffic_col) == F.lit("test"), F.lit(False))
    if model_version is not None:
        cond = cond & (_col(version_col).cast("string") == F.lit(str(model_version)))
    return cond


def decide(score, threshold) -> Column:
    """``flag`` when score >= threshold, else ``pass``."""
    th = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(_col(score) >= th, F.lit("flag")).otherwise(F.lit("pass"))


def fixed_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """N rows, fixed seed, chosen by a hash of the key (a top-k, so Spark plans
    TakeOrderedAndProject: each task keeps n rows, never the whole table)."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key)).limit(n)
