"""Time and shift columns."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def elapsed_minutes(start: str | Column, end: str | Column) -> Column:
    """Minutes from ``start`` to ``end`` as a double, counted in whole seconds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60)


def shift_label(hour: str | Column, noon: int = 12) -> Column:
    """``M`` before ``noon``, ``T`` from then on, null for a null hour."""
    hour = F.col(hour) if isinstance(hour, str) else hour
    return F.when(hour.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(hour < noon, F.lit("M")).otherwise(F.lit("T"))
    )


def instant(value: datetime | str | Column, kind: T.DataType | None = None) -> Column:
    """A typed timestamp literal, so that comparisons with it are pushed down.

    A string or a naive datetime is read in the session's time zone.
    """
    if isinstance(value, Column):
        column = value
    elif isinstance(value, datetime) and value.tzinfo is not None:
        micros = (value - _EPOCH) // timedelta(microseconds=1)
        column = F.timestamp_micros(F.lit(micros).cast("bigint"))
    else:
        text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
        column = F.lit(text).cast("timestamp")
    return column if kind is None else column.cast(kind)


def from_micros(micros: int) -> datetime:
    """Aware UTC datetime of a count of microseconds since the epoch."""
    return _EPOCH + timedelta(microseconds=micros)


def to_micros(value: datetime) -> int:
    """Microseconds since the epoch of an aware datetime."""
    return (value - _EPOCH) // timedelta(microseconds=1)
