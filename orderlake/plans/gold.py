"""Orders to daily sales."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.times import from_micros, instant, to_micros
from orderlake.operators.contract import gold_contract
from orderlake.operators.rollup import carry_partials, daily_partials, merge_partials
from orderlake.sinks.parquet import counted
from orderlake.sinks.progress import DEFAULT_MARK, Mark, as_mark, last_mark, write_progress
from orderlake.sinks.versions import NULL_DAY, Versions, day_name
from orderlake.sources.tables import read_if_present, read_slices, read_table


def gold_versions(spark: SparkSession, partials: str, gold: str) -> Versions:
    """The two tables of the layer, which change together; manifests lie beside the rollup."""
    return Versions(spark, gold, {"partials": partials, "gold": gold})


def read_gold(spark: SparkSession, gold: str) -> DataFrame | None:
    """The rollup as of its last complete version, or ``None`` before the first."""
    versions = Versions(spark, gold, {"gold": gold})
    base = versions.latest()
    return versions.read("gold", base.tables["gold"], ROLLUP_SCHEMA) if base.number else None


def read_partials(spark: SparkSession, partials: str, gold: str, schema: T.StructType) -> DataFrame:
    """Sums and counts as of the last complete version."""
    versions = gold_versions(spark, partials, gold)
    return versions.read("partials", versions.latest().tables["partials"], schema)


#: Columns of the rollup as they are stored, before the contract narrows them.
ROLLUP_SCHEMA = T.StructType(
    [
        T.StructField("order_date", T.DateType()),
        *[T.StructField(c, T.StringType()) for c in ("neighborhood", "comune", "working_day")],
        *[T.StructField(c, T.LongType()) for c in ("total_quantity", "order_count")],
        *[T.StructField(c, T.DoubleType()) for c in ("average_delivery_time", "latitude", "longitude")],
    ]
)


def run_gold(
    spark: SparkSession,
    silver: str,
    partials: str,
    gold: str,
    progress: str,
    publish: Callable[[DataFrame, DataFrame], None] | None = None,
    default: datetime | str = DEFAULT_MARK,
    publish_days: Callable[[DataFrame, DataFrame, DataFrame], None] | None = None,
    publish_batch: Callable[[str, DataFrame, DataFrame, DataFrame], object] | None = None,
) -> dict[str, object]:
    """Roll up the slices written since the last mark; returns metrics.

    Only slices from the last one seen on are read, once: their sums and counts
    per day go to ``<partials>_new``, and all else follows from these few rows.
    ``partials`` keeps per day one row per key for the slices that are done and
    the rows of each slice that may be written again. A slice that was, or that
    is empty now, loses its old rows on all days that they are of.

    Both tables are versioned: the touched days are written to new folders, and
    a manifest makes them and the loss of days without orders visible at one
    stroke, after they were published. A run that stops anywhere leaves the
    version before; the next one publishes its days again. The mark moves last.

    ``publish(valid, rejected)`` gets the whole table split by the contract, to
    refill a copy. ``publish_days(days, valid, rejected)`` gets the touched days
    (order_date) and their rows only, to delete the days and insert the rows;
    ``publish_batch(batch, days, valid, rejected)`` the same with a name that a
    repeated attempt at the same rows has, too, as a ledger needs it.
    """
    mark = last_mark(spark, progress)
    low = as_mark(spark, default) if mark is None else mark.processed_date
    # only the newest slice seen can have been written again: older ones are done
    seen = None if mark is None else mark.slice_id
    versions = gold_versions(spark, partials, gold)
    base = versions.latest()
    orders = read_slices(spark, silver, seen)
    if orders is None and (seen is None or not _holds(spark, versions, base, partials, seen)):
        return {"rows": None, "low": low, "high": None}
    if orders is not None:
        staged = daily_partials(orders, ("slice_id", "processed_date"))
        staged.write.mode("overwrite").parquet(f"{partials}_new")
    staged = read_table(spark, f"{partials}_new")
    if orders is None:  # the last slice is gone, and there is no other
        staged = staged.limit(0)
    fresh = staged.filter(F.col("processed_date") > instant(low, staged.schema["processed_date"].dataType))
    found = fresh.agg(
        F.max(F.unix_micros(F.col("processed_date").cast("timestamp"))).alias("high"),
        F.max("slice_id").alias("newest"),
        F.min("slice_id").alias("first"),
    ).first()
    emptied = seen is not None and not staged.filter(F.col("slice_id") == seen).take(1)
    emptied = emptied and _holds(spark, versions, base, partials, seen)
    if found["high"] is None and not emptied:
        return {"rows": None, "low": low, "high": None}

    high = low if found["high"] is None else max(low, from_micros(found["high"]))
    since = None if seen is None else seen if emptied or found["first"] == seen else seen + 1
    fresh = fresh.drop("processed_date")

    old = versions.read("partials", base.tables["partials"], fresh.schema)
    going = old if since is None else old.filter(F.col("slice_id") >= F.lit(since))
    touched = fresh.select("order_date").union(going.select("order_date")).distinct().select(day_name().alias("day"))
    days = {r["day"] for r in touched.collect()} | versions.unfinished(base)  # days of the calendar
    token = versions.token(base)
    mine = {d: t for d, t in base.tables["partials"].items() if d in days}
    carried = carry_partials(versions.read("partials", mine, fresh.schema), fresh, since, seen)
    _write_days(carried, versions.place("partials", token))
    tables = versions.changed(base, token, days)
    sums = versions.read("partials", {d: t for d, t in tables["partials"].items() if t == token}, fresh.schema)
    rows = _write_days(merge_partials(sums, sort=False), versions.place("gold", token))
    tables = versions.changed(base, token, days)

    if publish is not None:
        publish(*gold_contract(versions.read("gold", tables["gold"], ROLLUP_SCHEMA)))
    if publish_days is not None or publish_batch is not None:
        versions.note(token, days)
        table = versions.read("gold", {d: t for d, t in tables["gold"].items() if t == token}, ROLLUP_SCHEMA)
        named = [(None if d == NULL_DAY else d,) for d in sorted(days)]
        changed = spark.createDataFrame(named, "order_date string").select(F.col("order_date").cast("date"))
        if publish_days is not None:
            publish_days(changed, *gold_contract(table))
        if publish_batch is not None:
            batch = f"{base.number + 1}:{to_micros(low)}:{to_micros(high)}:{len(days)}"
            publish_batch(batch, changed, *gold_contract(table))
    versions.commit(base, tables)
    newest = found["newest"] if seen is None else max(seen, found["newest"] or seen)
    write_progress(spark, progress, Mark(high, slice_id=newest))
    versions.clean()
    return {"rows": rows, "low": low, "high": high}


def _write_days(rolled: DataFrame, place: str) -> int:
    """Write the (small) rollup by day, so that each gets few files; returns the rows."""
    return counted(rolled.hint("rebalance", "order_date"), lambda rows: rows.write.partitionBy("order_date").parquet(place))


def _holds(spark: SparkSession, versions: Versions, base, partials: str, slice_id: int) -> bool:
    staged = read_if_present(spark, f"{partials}_new")
    if staged is None:
        return False
    table = versions.read("partials", base.tables["partials"], staged.drop("processed_date").schema)
    return bool(table.filter(F.col("slice_id") == slice_id).take(1))
