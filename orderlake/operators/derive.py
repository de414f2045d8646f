"""Derived order columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.times import elapsed_minutes, instant, shift_label


def derive_times(orders: DataFrame) -> DataFrame:
    """Add order hour, order minute and delivery minutes."""
    return orders.withColumns(
        {
            "order_hour": F.hour("order_date"),
            "order_minute": F.minute("order_date"),
            "time_delivery": elapsed_minutes("dispatch_date", "delivery_date"),
        }
    )


def working_day(orders: DataFrame, hour: str = "order_hour", noon: int = 12) -> DataFrame:
    """Add the shift label."""
    return orders.withColumn("working_day", shift_label(hour, noon))


def stamp_processed(orders: DataFrame, at: datetime | str) -> DataFrame:
    """Add ``processed_date``, a literal fixed once per run.

    ``current_timestamp()`` would differ between two actions of the same run.
    """
    return orders.withColumn("processed_date", instant(at))
