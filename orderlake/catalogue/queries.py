"""Named queries: (spark, directory of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.catalogue import roles
from orderlake.operators.clean import dedupe, drop_incomplete
from orderlake.operators.contract import gold_contract
from orderlake.operators.derive import derive_times, working_day
from orderlake.operators.enrich import enrich_name
from orderlake.operators.incremental import incremental_slice
from orderlake.operators.ingest import ingest_partitions
from orderlake.operators.parse import parse_orders
from orderlake.operators.ranges import delivery_range_check
from orderlake.operators.rollup import (
    carry_partials,
    daily_partials,
    daily_sales,
    merge_partials,
    rollup_affected_days,
)
from orderlake.operators.spatial import area_lookup
from orderlake.plans.silver import clean_orders, enrich_orders
from orderlake.sinks.parquet import counted
from orderlake.sinks.progress import latest_mark

Query = Callable[[SparkSession, str], DataFrame]

_NTZ = T.TimestampNTZType()


def _silver(spark: SparkSession, d: str) -> DataFrame:
    """The whole silver layer: from JSON lines to enriched orders."""
    orders = clean_orders(roles.raw(spark, d), roles.SCHEMA)
    return enrich_orders(
        orders,
        roles.employees(spark, d),
        roles.customers(spark, d),
        roles.areas(spark, d),
        "2024-02-01 00:00:00",
    )


def _located(spark: SparkSession, d: str) -> DataFrame:
    """Orders with times and area, as the rollup needs them."""
    timed = working_day(derive_times(roles.orders(spark, d)))
    return area_lookup(timed, roles.areas(spark, d))


def _rounded(rollup: DataFrame) -> DataFrame:
    """Sums of doubles depend on their order in the last digits; compare nine."""
    doubles = [f.name for f in rollup.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return rollup.withColumns({c: F.round(c, 9) for c in doubles})


def ingest_day(spark: SparkSession, d: str) -> DataFrame:
    stamped = ingest_partitions(roles.table(spark, d, "events"), "ts")
    return stamped.select("event_id", "year", "month", "day")


def parse(spark: SparkSession, d: str) -> DataFrame:
    return parse_orders(roles.raw(spark, d), schema=roles.SCHEMA)


def parse_broken(spark: SparkSession, d: str) -> DataFrame:
    """Every way in which a line can be wrong, spread over all events."""
    key = F.col("order_id").cast("bigint") % 9
    orders = roles.orders(spark, d)
    good = roles.json_line(orders)
    line = (
        F.when(key == 0, F.lit("garbage"))
        .when(key == 1, F.lit(""))
        .when(key == 2, F.lit("[]"))
        .when(key == 3, F.regexp_replace(good, '"order_date":"[^"]*"', '"order_date":"soon"'))
        .when(key == 4, F.regexp_replace(good, '"customer_id":[0-9]+', '"customer_id":99999999999'))
        .when(key == 5, F.regexp_replace(good, '"latitude":[^,]*', '"latitude":"6.2"'))
        .when(key == 6, F.regexp_replace(good, '"employee_id":[0-9]+,', ""))
        .when(key == 7, F.regexp_replace(good, "^\\{", '{"extra":{"a":[1]},'))
        .otherwise(good)
    )
    lines = orders.select(F.col("order_id").alias("line_id"), line.alias("line"))
    return parse_orders(lines, "line", roles.SCHEMA, keep=["line_id"])


def parse_props(spark: SparkSession, d: str) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return parse_orders(roles.table(spark, d, "events"), "props", schema, keep=["event_id"])


def drop_nulls(spark: SparkSession, d: str) -> DataFrame:
    events = roles.table(spark, d, "events").select("event_id", "event_type", "user_id", "value")
    kind = F.col("event_id") % 7
    holes = events.withColumns(
        {
            "event_type": F.when(kind != 1, F.col("event_type")),
            "user_id": F.when(kind != 2, F.col("user_id")),
            "value": F.when(kind != 3, F.col("value")),
        }
    )
    return drop_incomplete(holes)


def dedupe_rows(spark: SparkSession, d: str) -> DataFrame:
    """Whole rows of (type, hour of arrival): most events are copies here."""
    events = roles.table(spark, d, "events")
    hour = F.make_timestamp_ntz(
        F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts"), F.lit(0), F.lit(0)
    )
    kind = F.when(F.col("event_id") % 11 != 0, F.col("event_type"))
    return dedupe(events.select(kind.alias("value"), hour.alias("timestamp")), not_null="value")


def dedupe_by_key(spark: SparkSession, d: str) -> DataFrame:
    events = roles.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return dedupe(events, keys=["user_id"], order_by=["ts"])


def times(spark: SparkSession, d: str) -> DataFrame:
    derived = derive_times(roles.orders(spark, d))
    return derived.select("order_id", "order_hour", "order_minute", "time_delivery")


def shift(spark: SparkSession, d: str) -> DataFrame:
    derived = working_day(derive_times(roles.orders(spark, d)))
    return derived.select("order_id", "order_hour", "working_day")


def with_employee(spark: SparkSession, d: str) -> DataFrame:
    orders = roles.orders(spark, d).select("order_id", "employee_id")
    return enrich_name(orders, roles.employees(spark, d), "employee_id", "employee_name")


def with_customer(spark: SparkSession, d: str) -> DataFrame:
    orders = roles.orders(spark, d).select("order_id", "customer_id")
    return enrich_name(orders, roles.customers(spark, d), "customer_id", "customer_name")


def with_both(spark: SparkSession, d: str) -> DataFrame:
    orders = roles.orders(spark, d).select("order_id", "employee_id", "customer_id")
    named = enrich_name(orders, roles.employees(spark, d), "employee_id", "employee_name")
    return enrich_name(named, roles.customers(spark, d), "customer_id", "customer_name")


def with_repeated_employee(spark: SparkSession, d: str) -> DataFrame:
    """A dimension in which every tenth key occurs twice."""
    employees = roles.employees(spark, d)
    twice = employees.filter("employee_id % 10 = 0").withColumn("name", F.concat("name", F.lit(" bis")))
    orders = roles.orders(spark, d).select("order_id", "employee_id")
    return enrich_name(orders, employees.unionByName(twice), "employee_id", "employee_name")


def with_customer_by_shuffle(spark: SparkSession, d: str) -> DataFrame:
    """The same lookup for a dimension too big to broadcast."""
    orders = roles.orders(spark, d).select("order_id", "customer_id")
    return enrich_name(
        orders, roles.customers(spark, d), "customer_id", "customer_name", broadcast_bytes=0
    )


def _areas_of(shape: Callable, order: str = "<", **options: object) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        points = roles.orders(spark, d).select("order_id", "latitude", "longitude")
        return area_lookup(points, roles.areas(spark, d, shape, order), **options)

    return query


def range_check(spark: SparkSession, d: str) -> DataFrame:
    orders = derive_times(roles.orders(spark, d))
    located = area_lookup(orders, roles.areas(spark, d), outputs={"area_id": "area_id"})
    checked = delivery_range_check(located, roles.ranges(spark, d))
    return checked.select("order_id", "area_id", "time_delivery", "t_min", "t_max", "in_range")


def new_rows(spark: SparkSession, d: str) -> DataFrame:
    events = roles.table(spark, d, "events").select("event_id", "ts", "value")
    return incremental_slice(events, "ts", "2024-01-05 00:00:00", "2024-01-20 12:00:00")


def mark(spark: SparkSession, d: str) -> DataFrame:
    """The events as marks: the last one as a layer finds it."""
    events = roles.table(spark, d, "events")
    marks = events.select(
        F.col("ts").cast("timestamp").alias("processed_date"),
        F.lit(None).cast("timestamp").alias("run_at"),
        F.col("event_id").alias("slice_id"),
    )
    return latest_mark(marks).select(F.timestamp_micros("mark").cast(_NTZ).alias("processed_date"))


def rows(spark: SparkSession, d: str) -> DataFrame:
    """The events counted while they are written, as the jobs count theirs."""
    events = roles.table(spark, d, "events")
    written = counted(events, lambda df: df.write.format("noop").mode("overwrite").save())
    return spark.createDataFrame([(written,)], "row_count bigint")


def silver_orders(spark: SparkSession, d: str) -> DataFrame:
    return _silver(spark, d).withColumn("processed_date", F.col("processed_date").cast(_NTZ))


def sales(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(daily_sales(_silver(spark, d)))


def affected_days(spark: SparkSession, d: str) -> DataFrame:
    """Days with large late orders, rolled up again from all orders."""
    silver = _located(spark, d)
    changed = roles.orders(spark, d).filter(
        (F.col("quantity_products") > 97) & (F.hour("order_date") == 3)
    )
    return _rounded(rollup_affected_days(silver, changed))


def merged_slices(spark: SparkSession, d: str) -> DataFrame:
    """Orders in five interleaved slices, rolled up apart and merged."""
    silver = _located(spark, d).withColumn("slice_id", F.col("order_id").cast("bigint") % 5)
    return _rounded(merge_partials(daily_partials(silver)))


def replaced_slice(spark: SparkSession, d: str) -> DataFrame:
    """Partials of a slice whose first attempt held more days than the second: the rest came with a later slice."""
    silver = _located(spark, d)
    first = silver.withColumn("slice_id", F.when(F.col("customer_id") % 3 == 0, 0).otherwise(1).cast("bigint"))
    again = silver.withColumn("slice_id", (F.col("customer_id") % 3).cast("bigint")).filter("slice_id > 0")
    return _rounded(merge_partials(carry_partials(daily_partials(first), daily_partials(again), since=1, closed_below=1)))


def _checked(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The contract on averages five times as long, so that some overflow."""
    rollup = daily_sales(_located(spark, d), sort=False)
    return gold_contract(rollup.withColumn("average_delivery_time", F.col("average_delivery_time") * 5))


def contract(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_checked(spark, d)[0])


def rejected(spark: SparkSession, d: str) -> DataFrame:
    bad = _checked(spark, d)[1]
    return bad.select("order_date", "neighborhood", "comune", "working_day", "order_count", "reject_reason")


QUERIES: dict[str, Query] = {
    "ingest_partitions": ingest_day,
    "parse_orders": parse,
    "parse_broken_lines": parse_broken,
    "parse_props": parse_props,
    "drop_incomplete": drop_nulls,
    "dedupe_rows": dedupe_rows,
    "dedupe_by_key": dedupe_by_key,
    "derive_times": times,
    "working_day": shift,
    "enrich_employee": with_employee,
    "enrich_customer": with_customer,
    "enrich_both": with_both,
    "enrich_repeated_key": with_repeated_employee,
    "enrich_by_shuffle": with_customer_by_shuffle,
    "area_lookup": _areas_of(roles.square),
    "area_lookup_by_shuffle": _areas_of(roles.square, broadcast_bytes=0),
    "area_first_of_overlapping": _areas_of(roles.wide_square),
    "area_triangles": _areas_of(roles.triangle, ">"),
    "area_holes": _areas_of(roles.holed),
    "area_multipolygons": _areas_of(roles.two_strips, ">"),
    "area_many_vertices": _areas_of(roles.stairs),
    "area_many_vertices_by_shuffle": _areas_of(roles.stairs, broadcast_bytes=0),
    "delivery_range_check": range_check,
    "incremental_slice": new_rows,
    "progress_mark": mark,
    "row_count": rows,
    "silver_orders": silver_orders,
    "daily_sales": sales,
    "rollup_affected_days": affected_days,
    "merge_partials": merged_slices,
    "merge_replaced_slice": replaced_slice,
    "gold_contract": contract,
    "gold_rejected": rejected,
}
