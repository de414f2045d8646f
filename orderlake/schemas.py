"""Fixed schemas of the three layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the order payload.
_PAYLOAD = [
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("order_date", T.TimestampType()),
    ("dispatch_date", T.TimestampType()),
    ("delivery_date", T.TimestampType()),
    ("customer_id", T.IntegerType()),
    ("employee_id", T.IntegerType()),
    ("quantity_products", T.IntegerType()),
    ("order_id", T.StringType()),
]


def order_schema(timestamp: T.DataType | None = None) -> T.StructType:
    """Payload schema; ``timestamp`` replaces the type of the three times."""
    return T.StructType(
        [
            T.StructField(
                name,
                timestamp if timestamp is not None and isinstance(kind, T.TimestampType) else kind,
            )
            for name, kind in _PAYLOAD
        ]
    )


ORDER_SCHEMA = order_schema()

# The raw layer, partitioned by ingest day.
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
    ]
)
BRONZE_PARTITIONS = ("year", "month", "day")

# One row per boundary, geometry as WKB.
BOUNDARY_COLUMNS = ("OBJECTID", "NOMBRE", "IDENTIFICACION", "geometry")

# Header of the delivery-time range file.
RANGE_SCHEMA = T.StructType(
    [
        T.StructField("objec_id", T.IntegerType()),
        T.StructField("t_min", T.IntegerType()),
        T.StructField("t_max", T.IntegerType()),
    ]
)

# Columns, order and declared types of the daily sales table.
GOLD_SCHEMA = T.StructType(
    [
        T.StructField("order_date", T.DateType(), False),
        T.StructField("neighborhood", T.VarcharType(255), False),
        T.StructField("comune", T.VarcharType(100), False),
        T.StructField("working_day", T.VarcharType(2), False),
        T.StructField("total_quantity", T.IntegerType(), False),
        T.StructField("order_count", T.IntegerType(), False),
        T.StructField("average_delivery_time", T.DecimalType(5, 2), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
    ]
)
GOLD_KEYS = ("order_date", "comune", "neighborhood", "working_day")
