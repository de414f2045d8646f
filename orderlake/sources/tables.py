"""Batch readers."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.times import from_micros, instant
from orderlake.schemas import BRONZE_SCHEMA, RANGE_SCHEMA

# Days by which the ingest date of one instant can differ between two zones.
_ZONE_DAYS = 2


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet table; ``schema`` saves the inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_if_present(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """As :func:`read_table`, or ``None`` where nothing was written yet.

    Only an absent path counts; a damaged or unreadable table raises.
    """
    return read_table(spark, path, schema) if path_exists(spark, path) else None


def path_exists(spark: SparkSession, path: str) -> bool:
    system, place = file_system(spark, path)
    return system.exists(place)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def partition_values(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values in the names of the partition directories right below ``root``: one listing, nothing deeper."""
    system, place = file_system(spark, root)
    names = [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{column}="))


def read_bronze(
    spark: SparkSession,
    root: str,
    low: datetime | str | None = None,
    high: datetime | str | None = None,
) -> DataFrame | None:
    """Raw lines, or ``None`` where none were written yet.

    ``low`` and ``high`` bound the ingest time and prune day directories. The
    day bounds are two days wider, so they hold whatever the session zones of
    writer and reader; exact bounds are ``incremental_slice``'s.
    """
    raw = read_if_present(spark, root, BRONZE_SCHEMA)
    if raw is None:
        return None
    return between_days(raw, low, high)


def between_days(
    raw: DataFrame, low: datetime | str | None = None, high: datetime | str | None = None
) -> DataFrame:
    """Prune the day directories of raw lines to those that can hold the ingest times."""
    day = F.make_date("year", "month", "day")
    if low is not None:
        raw = raw.filter(day >= F.date_sub(F.to_date(instant(low)), _ZONE_DAYS))
    if high is not None:
        raw = raw.filter(day <= F.date_add(F.to_date(instant(high)), _ZONE_DAYS))
    return raw


def read_slices(spark: SparkSession, root: str, since: int | None = None) -> DataFrame | None:
    """Slices from the one that begins at ``since`` on, or ``None`` without any.

    The days that exist are listed by name and only those from there on are
    looked into, so reading what is new costs the same after years as on the
    first day. No clock is asked: a slice may begin at any time.
    """
    if since is None:
        return read_if_present(spark, root)
    first = from_micros(since).date()
    days = [d for d in partition_values(spark, root, "slice_day") if date.fromisoformat(d) >= first]
    if not days:
        return None
    table = spark.read.option("basePath", root).parquet(*[f"{root}/slice_day={d}" for d in days])
    return table.filter(F.col("slice_id") >= F.lit(since))


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Expected delivery minutes per area from a ``;`` separated file with header.

    Columns: area_id, t_min, t_max and ``ord``, the place in the file, files by
    name. A header that doesn't name the columns in their order, or a value that
    is no number, raises.
    """
    table = spark.read.csv(path, sep=";", header=True, schema=RANGE_SCHEMA, enforceSchema=False, mode="FAILFAST")
    place = (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row"))
    return table.select(F.col("objec_id").alias("area_id"), "t_min", "t_max", F.struct(*place).alias("ord"))
