"""Lookups in dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Measured payload up to which a lookup table is sent to every executor.
BROADCAST_BYTES = 128 * 1024 * 1024


def payload_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df``: one aggregation, nothing but the sum returns."""
    width = F.lit(16)
    for field in df.schema.fields:
        width = width + _width(F.col(field.name), field.dataType)
    return df.agg(F.sum(width.cast("bigint")).alias("bytes")).first()["bytes"] or 0


def _width(value, kind: T.DataType):
    if isinstance(kind, T.StringType):
        return F.coalesce(F.octet_length(value), F.lit(0)) + F.lit(8)
    if isinstance(kind, T.BinaryType):
        return F.coalesce(F.octet_length(value), F.lit(0)) + F.lit(8)
    if isinstance(kind, T.ArrayType):
        total = F.aggregate(
            F.coalesce(value, F.array().cast(kind)),
            F.lit(0).cast("bigint"),
            lambda acc, item: acc + _width(item, kind.elementType).cast("bigint"),
        )
        return total + F.lit(16)
    if isinstance(kind, T.StructType):
        total = F.lit(16)
        for field in kind.fields:
            total = total + _width(value[field.name], field.dataType)
        return total
    return F.lit(8)


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    measured_bytes: int | None = None,
) -> DataFrame:
    """Left equi-join of a big table with a lookup table.

    The lookup table is measured first, as plan statistics are no bound of the
    rows: a column of few values unpacks to any multiple of its file. Up to the
    limit it is broadcast and the facts are not moved. A bigger one is joined by a shuffle
    on the keys; a key that holds a large share of the facts is then split by
    size at run time (``spark.sql.adaptive.skewJoin``, on by default), which
    scales with the data where a fixed number of salts does not.
    """
    size = payload_bytes(table) if measured_bytes is None else measured_bytes
    if size <= broadcast_bytes:
        table = F.broadcast(table)
    else:
        table = table.hint("merge")
    return facts.join(table, list(keys), "left")


def enrich_name(
    orders: DataFrame,
    dimension: DataFrame,
    key: str,
    out: str,
    name: str = "name",
    dimension_key: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``out``, the dimension's name for ``key``; null without a match.

    A key that occurs twice in the dimension repeats the order.
    """
    table = dimension.select(F.col(dimension_key or key).alias(key), F.col(name).alias(out))
    joined = lookup_join(orders, table, [key], broadcast_bytes)
    return joined.select(*orders.columns, out)
