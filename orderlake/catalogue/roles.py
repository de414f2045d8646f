"""The driver's tables in the roles of orders, dimensions and boundaries."""

from __future__ import annotations

import struct
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.operators.spatial import AreaIndex, build_cells
from orderlake.schemas import order_schema
from orderlake.sources.tables import read_table

# The tables hold times without a zone, so the lines are read as such too.
SCHEMA = order_schema(T.TimestampNTZType())

Ring = list[tuple[float, float]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _minutes(count: Column) -> Column:
    return F.make_dt_interval(mins=count.cast("int"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as typed orders; some have no area, customer or employee."""
    event = F.col("event_id")
    second = F.col("ts") - F.expr("make_dt_interval(0, 0, 0, extract(second from ts) % 1)")
    dated = table(spark, sf_dir, "events").select("event_id", "user_id", second.alias("order_date"))
    sent = dated.withColumn("dispatch_date", F.col("order_date") + _minutes(event % 59 + 2))
    return sent.select(
        ((event * 91 % 5500).cast("double") / 1000.0).alias("latitude"),
        ((event * 37 % 6000).cast("double") / 1000.0 - 0.5).alias("longitude"),
        "order_date",
        "dispatch_date",
        (F.col("dispatch_date") + _minutes(F.col("user_id") * 7 % 346 + 15)).alias("delivery_date"),
        F.col("user_id").cast("int").alias("customer_id"),
        (event % 120).cast("int").alias("employee_id"),
        (event % 100 + 1).cast("int").alias("quantity_products"),
        event.cast("string").alias("order_id"),
    )


def json_line(orders: DataFrame) -> Column:
    fields = []
    for field in SCHEMA.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampNTZType):
            column = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
        fields.append(column.alias(field.name))
    return F.to_json(F.struct(*fields))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as raw lines with the time they came in."""
    source = orders(spark, sf_dir)
    return source.select(json_line(source).alias("value"), F.col("order_date").alias("timestamp"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name")
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("employee_id"), F.col("s_name").alias("name")
    )


def _polygon(rings: list[Ring], order: str) -> bytes:
    out = struct.pack(order + "BII", order == "<", 3, len(rings))
    for ring in rings:
        out += struct.pack(order + "I", len(ring))
        out += b"".join(struct.pack(order + "dd", *point) for point in ring)
    return out


def _encode(parts: list[list[Ring]], order: str) -> bytes:
    if len(parts) == 1:
        return _polygon(parts[0], order)
    head = struct.pack(order + "BII", order == "<", 6, len(parts))
    return head + b"".join(_polygon(rings, order) for rings in parts)


def box(x0: float, y0: float, x1: float, y1: float) -> Ring:
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def square(x: float, y: float) -> list[list[Ring]]:
    return [[box(x, y, x + 1, y + 1)]]


def wide_square(x: float, y: float) -> list[list[Ring]]:
    return [[box(x, y, x + 2, y + 2)]]


def triangle(x: float, y: float) -> list[list[Ring]]:
    return [[[(x, y), (x + 1, y), (x, y + 1), (x, y)]]]


def holed(x: float, y: float) -> list[list[Ring]]:
    return [[box(x, y, x + 1, y + 1), box(x + 0.25, y + 0.25, x + 0.75, y + 0.75)]]


def two_strips(x: float, y: float) -> list[list[Ring]]:
    return [[box(x, y, x + 0.375, y + 1)], [box(x + 0.625, y, x + 1, y + 1)]]


def stairs(x: float, y: float, steps: int = 1024) -> list[list[Ring]]:
    """Some two thousand vertices: columns of a width and of heights that doubles hold exactly."""
    top = [y + (k * 37 % 512 + 256) / 1024 for k in range(steps)]
    ring = [(x, y), (x + 1, y)]
    for k in reversed(range(steps)):
        ring += [(x + (k + 1) / steps, top[k]), (x + k / steps, top[k])]
    return [[[*ring, (x, y)]]]


def areas(
    spark: SparkSession,
    sf_dir: str,
    shape: Callable[[float, float], list[list[Ring]]] = square,
    order: str = "<",
) -> AreaIndex:
    """One area per nation, shaped at the nation's place in a grid five wide."""

    @F.pandas_udf("binary")
    def wkb(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_encode(shape(a, b), order) for a, b in zip(x, y)])

    key = F.col("n_nationkey")
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return build_cells(
        nations.select(
            key.alias("ord"),
            key.alias("area_id"),
            F.col("n_name").alias("neighborhood"),
            F.col("r_name").alias("comune"),
            wkb((key % 5).cast("double"), F.floor(key / 5).cast("double")).alias("geometry"),
        ),
        size=0.25,
    )


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected minutes per nation; every sixth nation has none, some have two rows."""
    key = F.col("n_nationkey")
    nations = table(spark, sf_dir, "nation").filter(key % 6 != 5)
    first = nations.select(
        key.alias("area_id"),
        (key % 4 * 15 + 15).cast("int").alias("t_min"),
        (key % 4 * 60 + 120).cast("int").alias("t_max"),
        F.lit(0).alias("ord"),
    )
    second = first.filter("area_id % 3 = 0").select("area_id", F.lit(0).alias("t_min"), F.lit(999).alias("t_max"), F.lit(1).alias("ord"))
    return first.unionByName(second)
