"""Progress marks: how far a layer has read its input.

A mark is one row. Two slots are written in turn, so while one is replaced the
other still holds the mark before it; a crash then costs a repeated slice, never
a lost mark. Reading takes the largest.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.times import from_micros, instant
from orderlake.sources.tables import read_if_present

# Fixed value: the mark of a layer that never ran.
DEFAULT_MARK = "2024-01-01"

_SCHEMA = T.StructType(
    [
        T.StructField("processed_date", T.TimestampType()),
        T.StructField("run_at", T.TimestampType()),
        T.StructField("slice_id", T.LongType()),
    ]
)
_SLOTS = ("slot_0", "slot_1")


class Mark(NamedTuple):
    """``processed_date`` is the mark; the run time and last slice are kept along."""

    processed_date: datetime
    run_at: datetime | None = None
    slice_id: int | None = None


def latest_mark(marks: DataFrame) -> DataFrame:
    """One row ``mark, run_at`` (microseconds) and ``slice_id``: the largest mark, nulls without any."""
    fields = F.unix_micros("processed_date").alias("mark"), F.unix_micros("run_at").alias("run_at"), "slice_id"
    return marks.agg(F.max(F.struct(*fields)).alias("last")).select("last.*")


def _slots(spark: SparkSession, path: str) -> list[Mark | None]:
    marks: list[Mark | None] = []
    for slot in _SLOTS:
        table = read_if_present(spark, f"{path}/{slot}", _SCHEMA)
        row = None
        if table is not None:
            row = latest_mark(table).first()
        if row is None or row["mark"] is None:
            marks.append(None)
        else:
            run_at = None if row["run_at"] is None else from_micros(row["run_at"])
            marks.append(Mark(from_micros(row["mark"]), run_at, row["slice_id"]))
    return marks


def last_mark(spark: SparkSession, path: str) -> Mark | None:
    """The last mark, or ``None`` if there is none. A damaged one raises."""
    found = [m for m in _slots(spark, path) if m is not None]
    return max(found, key=lambda m: m.processed_date, default=None)


def read_progress(spark: SparkSession, path: str, default: datetime | str = DEFAULT_MARK) -> datetime:
    """The last mark's time as an aware datetime, or ``default`` if there is none."""
    mark = last_mark(spark, path)
    return as_mark(spark, default) if mark is None else mark.processed_date


def as_mark(spark: SparkSession, value: datetime | str) -> datetime:
    """Aware datetime; text and naive datetimes are in the session's zone."""
    if isinstance(value, datetime) and value.tzinfo is not None:
        return value
    return from_micros(spark.range(1).select(F.unix_micros(instant(value)).alias("m")).first()["m"])


def write_progress(spark: SparkSession, path: str, mark: Mark | datetime | str) -> None:
    """Write the mark over the older slot."""
    if not isinstance(mark, Mark):
        mark = Mark(as_mark(spark, mark))
    first, second = _slots(spark, path)
    newest_is_first = first is not None and (second is None or first.processed_date >= second.processed_date)
    # the first mark goes to both, so that later runs find both
    slots = _SLOTS if first is None and second is None else _SLOTS[1:] if newest_is_first else _SLOTS[:1]
    row = spark.range(1).select(
        instant(mark.processed_date).alias("processed_date"),
        (F.lit(None).cast("timestamp") if mark.run_at is None else instant(mark.run_at)).alias("run_at"),
        F.lit(mark.slice_id).cast("bigint").alias("slice_id"),
    )
    for slot in slots:
        row.write.mode("overwrite").parquet(f"{path}/{slot}")
