"""Check of rolled-up rows against the declared output table."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.schemas import GOLD_SCHEMA


def gold_contract(rollup: DataFrame, schema: T.StructType = GOLD_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, rejected).

    Valid rows have the declared types and no null columns. Rejected rows keep
    their values and get ``reject_reason``, the columns that are null, too long,
    not finite or out of range. ``schema`` may have any types that a cast gives.
    """
    typed = {f.name: _typed(F.col(f.name), f.dataType) for f in schema.fields}
    broken = F.concat_ws(", ", *[F.when(c.isNull(), F.lit(n)) for n, c in typed.items()])
    checked = rollup.withColumn("reject_reason", broken)
    valid = checked.filter(F.col("reject_reason") == "").select(
        *[
            F.coalesce(typed[f.name], *_never(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )
    return valid, checked.filter(F.col("reject_reason") != "")


def _never(kind: T.DataType) -> list[Column]:
    """A value that a valid row never shows: coalescing with it tells Spark that the column has no nulls.

    None for types without a plain literal; Spark then takes the column as nullable.
    """
    if isinstance(kind, T.DecimalType):
        return [F.lit(Decimal(0)).cast(kind)]
    if isinstance(kind, T.NumericType):
        return [F.lit(0).cast(kind)]
    literals = {T.DateType: date(1970, 1, 1), T.TimestampType: datetime(1970, 1, 1), T.BooleanType: False}
    if isinstance(kind, (T.StringType, T.VarcharType)):
        return [F.lit("")]
    return [F.lit(literals[type(kind)])] if type(kind) in literals else []


def _typed(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.VarcharType):
        return F.when(F.char_length(column) <= kind.length, column)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        number = column.try_cast(kind)
        return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    return column.try_cast(kind)
