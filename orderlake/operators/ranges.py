"""Expected delivery minutes of an area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.operators.enrich import BROADCAST_BYTES, lookup_join


def delivery_range_check(
    orders: DataFrame,
    ranges: DataFrame,
    area: str = "area_id",
    minutes: str = "time_delivery",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add t_min, t_max and in_range (bounds included); null without a range.

    ``ranges`` has area_id, t_min, t_max and ``ord``; the first row of an area
    counts.
    """
    first = (
        ranges.groupBy(F.col("area_id").alias(area))
        .agg(F.min_by(F.struct("t_min", "t_max"), "ord").alias("_range"))
        .select(area, "_range.t_min", "_range.t_max")
    )
    joined = lookup_join(orders, first, [area], broadcast_bytes)
    return joined.select(
        *orders.columns,
        "t_min",
        "t_max",
        F.col(minutes).between(F.col("t_min"), F.col("t_max")).alias("in_range"),
    )
