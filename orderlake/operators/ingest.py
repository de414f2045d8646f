"""Columns added to raw lines on arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamp_ingest(lines: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add the ingest time; in a stream it is constant within a micro-batch."""
    return lines.withColumn(ts, F.current_timestamp())


def ingest_partitions(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add year, month and day of ``ts``, the raw table's partition columns."""
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})
