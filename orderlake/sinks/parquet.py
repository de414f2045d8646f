"""Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.times import from_micros
from orderlake.sources.tables import file_system


def append_table(df: DataFrame, path: str) -> int:
    """Append; returns the number of rows, counted while they are written."""
    return counted(df, lambda rows: rows.write.mode("append").parquet(path))


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> int:
    """Replace the partitions that occur in ``df``, leave all others.

    Running it again with the same rows changes nothing.
    """

    def write(rows: DataFrame) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partitions).parquet(path)

    return counted(df, write)


def write_slice(df: DataFrame, path: str, slice_id: int) -> int:
    """Write a slice into its own partition, replacing a failed attempt at it.

    ``slice_id`` is the slice's lower bound in microseconds. A second attempt may
    see other rows, so its upper bound differs, but it starts at the same place.
    The slice's directory is overwritten as a whole: an attempt without a row
    leaves an empty slice, not the rows of the attempt before it. Slices lie
    under the day of their bound; see ``sources.tables.read_slices``.
    """
    place = f"{path}/slice_day={from_micros(slice_id).date()}/slice_id={slice_id}"
    return counted(df, lambda rows: rows.write.mode("overwrite").parquet(place))


def drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable[str]) -> None:
    """Delete partition directories that have no rows any more; absent ones don't matter."""
    for value in values:
        system, place = file_system(spark, f"{path}/{column}={value}")
        system.delete(place, True)


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Let ``write`` write the rows; returns their number, counted on the way."""
    observation = Observation()
    write(df.observe(observation, F.count(F.lit(1)).alias("rows")))
    return observation.get.get("rows", 0)
