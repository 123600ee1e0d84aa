"""Zone-independent conversions between ``timestamp_ntz`` and epoch numbers.

The test tables carry ``timestamp_ntz``. Streaming watermarks need
``timestamp``; converting through epoch microseconds keeps the wall clock
unchanged whatever ``spark.sql.session.timeZone`` is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_micros(col: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz`` (or ``timestamp``) value."""
    c = _c(col)
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c.cast("timestamp_ntz"))


def epoch_millis(col: Column | str) -> Column:
    """Milliseconds since the epoch, floored (as Spark ``unix_millis``)."""
    return F.floor(epoch_micros(col) / F.lit(1000)).cast("long")


def from_epoch_micros(col: Column | str) -> Column:
    """``timestamp_ntz`` from epoch microseconds."""
    return F.timestamp_add("MICROSECOND", _c(col), F.expr(_EPOCH_NTZ))


def to_event_time(col: Column | str) -> Column:
    """``timestamp`` with the same UTC wall clock as a ``timestamp_ntz``, for watermarks."""
    return F.timestamp_micros(epoch_micros(col))


def instant_to_ntz(col: Column | str) -> Column:
    """Inverse of :func:`to_event_time`."""
    return from_epoch_micros(F.unix_micros(_c(col)))


def clock_text(col: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a ``timestamp_ntz`` wall clock, without any
    time-zone conversion (``date_format`` goes through the session zone)."""
    return F.substring(_c(col).cast("timestamp_ntz").cast("string"), 1, 19)
