"""Daily sales by area and shift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.operators.enrich import BROADCAST_BYTES, payload_bytes
from orderlake.schemas import GOLD_KEYS, GOLD_SCHEMA

# The slice of rows that no later attempt can change.
CLOSED = -(2**63)

_AVERAGES = {
    "average_delivery_time": "time_delivery",
    "latitude": "latitude",
    "longitude": "longitude",
}


def daily_sales(silver: DataFrame, sort: bool = True) -> DataFrame:
    """Quantity, orders, mean delivery minutes and mean position per day, area and shift.

    ``sort`` orders by date and comune; leave it off for a sink without order.
    """
    day = silver.withColumn("order_date", F.to_date("order_date"))
    rolled = day.groupBy(*GOLD_KEYS).agg(
        F.sum("quantity_products").alias("total_quantity"),
        F.count("order_id").alias("order_count"),
        *[F.avg(source).alias(out) for out, source in _AVERAGES.items()],
    )
    return _ordered(rolled, sort)


def daily_partials(silver: DataFrame, by: Sequence[str] = ("slice_id",)) -> DataFrame:
    """Sums and counts of :func:`daily_sales` per key and slice, to be merged later.

    Averages of slices cannot be combined; their sums and counts can.
    """
    day = silver.withColumn("order_date", F.to_date("order_date"))
    sums = [F.sum("quantity_products").alias("quantity_sum"), F.count("order_id").alias("order_count")]
    for out, source in _AVERAGES.items():
        sums += [F.sum(source).alias(f"{out}_sum"), F.count(source).alias(f"{out}_count")]
    return day.groupBy(*GOLD_KEYS, *by).agg(*sums)


def carry_partials(
    old: DataFrame, new: DataFrame, since: int | None, closed_below: int | None = None
) -> DataFrame:
    """Partial rows once the slices from ``since`` on were written (again).

    All old rows of such slices go, whatever days they are of; ``new`` has what
    the slices hold now. ``since=None``: all old rows go. Slices below
    ``closed_below`` can't be written again: they become one row per key, so the
    table grows with its keys and not with the number of slices.
    """
    kept = old.limit(0) if since is None else old.filter(F.col("slice_id") < F.lit(since))
    if closed_below is not None:
        closed = F.col("slice_id") < F.lit(closed_below)
        kept = kept.withColumn("slice_id", F.when(closed, F.lit(CLOSED)).otherwise(F.col("slice_id")))
    both = kept.unionByName(new)
    sums = [c for c in new.columns if c not in (*GOLD_KEYS, "slice_id")]
    return both.groupBy(*GOLD_KEYS, "slice_id").agg(*[F.sum(c).alias(c) for c in sums])


def merge_partials(partials: DataFrame, sort: bool = True) -> DataFrame:
    """The rollup that :func:`daily_sales` gives for all rows behind ``partials``."""
    rolled = partials.groupBy(*GOLD_KEYS).agg(
        F.sum("quantity_sum").alias("total_quantity"),
        F.sum("order_count").alias("order_count"),
        *[
            F.try_divide(F.sum(f"{out}_sum"), F.sum(f"{out}_count")).alias(out)
            for out in _AVERAGES
        ],
    )
    return _ordered(rolled, sort)


def affected_days(changed: DataFrame) -> DataFrame:
    """Distinct days of ``changed``: at most the days of the calendar."""
    return changed.select(F.to_date("order_date").alias("order_date")).distinct()


def keep_days(table: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of ``table`` whose ``order_date`` falls on one of ``days``.

    A missing day counts as a day. The days are measured before they are
    broadcast, as any lookup table.
    """
    wanted = days.select(F.col("order_date").alias("_day"))
    if payload_bytes(wanted) <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    return table.join(wanted, F.to_date(table["order_date"]).eqNullSafe(F.col("_day")), "left_semi")


def rollup_affected_days(silver: DataFrame, changed: DataFrame, sort: bool = True) -> DataFrame:
    """Whole rollup, from all of ``silver``, of the days that occur in ``changed``."""
    return daily_sales(keep_days(silver, affected_days(changed)), sort)


def _ordered(rolled: DataFrame, sort: bool) -> DataFrame:
    if sort:
        rolled = rolled.orderBy("order_date", "comune")
    return rolled.select(*GOLD_SCHEMA.names)
