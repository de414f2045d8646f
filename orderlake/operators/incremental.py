"""Slices of new rows with fixed bounds."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.times import from_micros, instant


def incremental_slice(
    df: DataFrame,
    column: str,
    low: datetime | str | Column | None = None,
    high: datetime | str | Column | None = None,
) -> DataFrame:
    """Rows with ``low < column <= high``; a bound of ``None`` is open.

    Bounds are literals of the column's type and reach the scan as pushed filters.
    """
    kind = df.schema[column].dataType
    if low is not None:
        df = df.filter(F.col(column) > instant(low, kind))
    if high is not None:
        df = df.filter(F.col(column) <= instant(high, kind))
    return df


def slice_high(
    df: DataFrame,
    column: str,
    low: datetime | str | None = None,
    span: timedelta | None = None,
) -> datetime | None:
    """Upper bound of the next slice: the largest value above ``low``, or ``None``.

    With ``span`` a long backlog is cut: the bound is the largest value at most
    ``span`` after the first one. Reads one column; the aggregate is one row.
    """
    above = incremental_slice(df, column, low)
    first, last = _extremes(above, column)
    if last is None or span is None or last - first <= span:
        return last
    return _extremes(incremental_slice(above, column, high=first + span), column)[1]


def _extremes(df: DataFrame, column: str) -> tuple[datetime | None, datetime | None]:
    micros = F.unix_micros(F.col(column).cast("timestamp"))
    row = df.agg(F.min(micros).alias("first"), F.max(micros).alias("last")).first()
    return tuple(None if v is None else from_micros(v) for v in row)

