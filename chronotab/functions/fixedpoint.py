"""Exact sums for fixed-point inputs (money in cents, coordinates in micro-degrees).

Means and standard deviations are derived from three exact integer sums (n, sum x, sum x^2) of
the value scaled to an integer. The sums are decomposable, so they combine map-side (partial
aggregation) and in RANGE frames, and the final double is computed by one division, which makes
the result independent of the order rows were added in (T24).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,0)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scaled(c, scale: int) -> Column:
    """``c`` as an exact integer number of 10^-scale units; a value with more decimal places than
    ``scale`` is an error, never rounded away."""
    value = _col(c).cast("double")
    whole = F.round(value * F.lit(float(10 ** scale)))
    back = whole / F.lit(float(10 ** scale))
    fits = F.abs(back - value) <= F.abs(value) * F.lit(4e-16)
    return F.when(value.isNull() | fits, whole).otherwise(
        F.raise_error(F.format_string(f"%s has more than {scale} decimal places", value.cast("string"))).cast("double")).cast(EXACT)


def scaled_sq(c, scale: int) -> Column:
    s = scaled(c, scale)
    return (s * s).cast(EXACT)


def mean_from(total, count, scale: int) -> Column:
    """Mean from an exact scaled sum and a count; null when the count is 0."""
    return F.when(
        _col(count) > 0,
        _col(total).cast("double") / _col(count).cast("double") / F.lit(float(10 ** scale)),
    )


def sum_from(total, scale: int) -> Column:
    return _col(total).cast("double") / F.lit(float(10 ** scale))


def std_from(total, total_sq, count, scale: int) -> Column:
    """Sample standard deviation; null under two rows (as pandas and ``stddev_samp``)."""
    n = _col(count).cast(EXACT)
    num = (n * _col(total_sq) - _col(total) * _col(total)).cast(EXACT)
    var = num.cast("double") / (n * (n - 1)).cast("double") / F.lit(float(10 ** (2 * scale)))
    return F.when(_col(count) > 1, F.sqrt(var))
