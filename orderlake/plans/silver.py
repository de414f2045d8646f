"""Raw lines to typed, complete and enriched orders."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.times import to_micros
from orderlake.operators.clean import dedupe, drop_incomplete, require_columns
from orderlake.operators.derive import derive_times, stamp_processed, working_day
from orderlake.operators.enrich import enrich_name
from orderlake.operators.incremental import incremental_slice, slice_high
from orderlake.operators.parse import parse_orders
from orderlake.operators.spatial import AreaIndex, area_lookup
from orderlake.schemas import ORDER_SCHEMA
from orderlake.sinks.claims import STALE, claimed
from orderlake.sinks.parquet import counted, write_slice
from orderlake.sinks.progress import DEFAULT_MARK, Mark, as_mark, last_mark, write_progress
from orderlake.sinks.scratch import delete_folder, scratch_folder
from orderlake.sinks.seen import SeenKeys
from orderlake.sources.tables import between_days, read_bronze, read_slices


def clean_orders(
    raw: DataFrame, schema: T.StructType = ORDER_SCHEMA, once_by: Sequence[str] | None = None
) -> DataFrame:
    """Complete orders of (value, timestamp) rows, equal rows once.

    Year, month and day follow from the timestamp, so comparing these two
    columns compares whole raw rows. With ``once_by`` one order per key stays,
    the one that arrived first.
    """
    require_columns(raw, ["value", "timestamp"])
    if once_by is None:
        lines = dedupe(raw.select("value", "timestamp"), not_null="value")
        return drop_incomplete(parse_orders(lines, schema=schema))
    lines = raw.select("value", F.col("timestamp").alias("_arrived"))
    orders = drop_incomplete(parse_orders(lines, schema=schema, keep=["_arrived"]))
    return dedupe(orders, once_by, order_by=["_arrived"]).drop("_arrived")


def enrich_orders(
    orders: DataFrame,
    employees: DataFrame,
    customers: DataFrame,
    areas: AreaIndex,
    at: datetime | str,
) -> DataFrame:
    """Times, shift, names and area of complete orders."""
    timed = stamp_processed(working_day(derive_times(orders)), at)
    named = enrich_name(timed, employees, "employee_id", "employee_name")
    named = enrich_name(named, customers, "customer_id", "customer_name")
    return area_lookup(named, areas)


def run_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    progress: str,
    employees: DataFrame,
    customers: DataFrame,
    areas: AreaIndex,
    default: datetime | str = DEFAULT_MARK,
    span: timedelta | None = None,
    now: datetime | None = None,
    once_by: Sequence[str] | None = None,
    seen: str | None = None,
    stale: timedelta = STALE,
) -> dict[str, object]:
    """Process the raw rows that arrived since the last mark; returns metrics.

    The slice's bounds are fixed before it is read: rows that arrive meanwhile
    belong to the next one. The slice replaces what a failed attempt left, and
    the mark moves last. Nothing new is no work and leaves the mark. ``span``
    bounds the slice of a long backlog; call again until ``rows`` is ``None``.

    ``once_by`` keeps one order per key in a slice, the first that arrived; with
    ``seen``, a folder for :class:`SeenKeys`, also over all slices since the
    folder was begun. The slice's orders are then written once more, to a
    scratch table.

    One writer of the raw table: ingest times above the mark must not appear
    later. Of two runs that start at one mark the second raises
    ``ConcurrentWrite``; ``stale``: when a killed run's claim is void.
    """
    if seen is not None and once_by is None:
        raise ValueError("seen needs once_by, the key of an order")

    def reached() -> datetime:
        mark = last_mark(spark, progress)
        return as_mark(spark, default) if mark is None else mark.processed_date

    low = reached()
    raw = read_bronze(spark, bronze, low)
    high = None if raw is None else slice_high(raw, "timestamp", low, span)
    if high is None:
        return {"rows": None, "low": low, "high": None}
    with claimed(spark, progress, str(to_micros(low)), lambda: str(to_micros(reached())), stale) as check:
        # the next layer reads by this stamp, so it must grow whatever the clock does
        at = now or datetime.now(timezone.utc)
        mark, attempt = last_mark(spark, progress), read_slices(spark, silver, to_micros(low))
        failed = None if attempt is None else slice_high(attempt, "processed_date")
        for earlier in (None if mark is None else mark.run_at, failed):
            if earlier is not None:
                at = max(at, earlier + timedelta(microseconds=1))
        # of the files listed above: what arrives meanwhile is the next slice's
        raw = incremental_slice(between_days(raw, high=high), "timestamp", low, high)
        orders = clean_orders(raw, once_by=once_by)

        def write(rows: DataFrame) -> int:
            done = enrich_orders(rows, employees, customers, areas, at)
            check()
            return write_slice(done, silver, to_micros(low))

        rows = write(orders) if seen is None else _write_unseen(orders, SeenKeys(spark, seen), once_by, to_micros(low), write)
        check()
        write_progress(spark, progress, Mark(high, at))
    return {"rows": rows, "low": low, "high": high}


def _write_unseen(
    orders: DataFrame, seen: SeenKeys, keys: Sequence[str], slice_id: int, write: Callable[[DataFrame], int]
) -> int:
    """Write the orders that no earlier slice held and keep their keys; the caller moves the mark after both."""
    spark, schema = orders.sparkSession, orders.schema
    folder = scratch_folder(spark, "slice")
    try:
        n = counted(orders, lambda rows: rows.write.parquet(folder))
        new, enter = seen.unseen(spark.read.schema(schema).parquet(folder), keys, slice_id, n)
        rows = write(new)
        enter()
        return rows
    finally:
        delete_folder(spark, folder)
