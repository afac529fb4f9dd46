"""Time columns as whole microseconds (T5), record timestamps (B3) and calendar parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_HOUR = 3_600 * MICROS_PER_SECOND
MICROS_PER_DAY = 24 * MICROS_PER_HOUR
# Fixed value: months are turned into days at this average length.
AVERAGE_DAYS_PER_MONTH = 30.44


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(c) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column (UTC session)."""
    return F.unix_micros(_col(c).cast("timestamp"))


def from_micros(c) -> Column:
    """Back to TIMESTAMP_NTZ."""
    return F.timestamp_micros(_col(c)).cast("timestamp_ntz")


def ts_literal(value) -> Column:
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def literal_micros(value) -> int:
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    epoch = dt.datetime(1970, 1, 1)
    delta = value.replace(tzinfo=None) - epoch
    return (delta.days * 86_400 + delta.seconds) * MICROS_PER_SECOND + delta.microseconds


def record_timestamp(decision_ts, *, days=None, months=None) -> Column:
    """The record's own time = decision time + an offset in days, or in months of
    30.44 days. Exactly one offset column is allowed. A null offset gives a null time."""
    if (days is None) == (months is None):
        raise ValueError("exactly one of days or months must be given")
    if days is not None:
        offset = _col(days).cast("double") * float(MICROS_PER_DAY)
    else:
        offset = _col(months).cast("double") * AVERAGE_DAYS_PER_MONTH * float(MICROS_PER_DAY)
    return from_micros(micros(decision_ts) + F.round(offset).cast("long"))


def effective_offset(paid, due) -> Column:
    """The payment day, else the due day."""
    return F.coalesce(_col(paid).cast("double"), _col(due).cast("double"))


def hour_of_day(c) -> Column:
    """Hour 0-23."""
    return F.hour(_col(c))


def day_of_week_monday0(c) -> Column:
    """Day of week with Monday = 0 (``weekday``, not ``dayofweek``)."""
    return F.weekday(_col(c))
