"""Copy of a table in a database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderlake.schemas import GOLD_SCHEMA


def column_types(columns: list[str], schema: T.StructType = GOLD_SCHEMA) -> str:
    """Declared types of the text columns, which Spark would create unbounded."""
    return ", ".join(
        f"{f.name} VARCHAR({f.dataType.length})"
        for f in schema.fields
        if f.name in columns and isinstance(f.dataType, T.VarcharType)
    )


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    connections: int = 8,
) -> None:
    """Write to ``table``, creating it if it is absent.

    ``overwrite`` empties the table and keeps its definition, so a second run
    leaves one copy; ``append`` repeats the rows. Columns that Spark knows to be
    free of nulls are created NOT NULL. User, password and driver go in
    ``options``; at most ``connections`` tasks write at a time.
    """
    writer = (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("numPartitions", connections)
        .mode(mode)
    )
    if mode == "overwrite":
        writer = writer.option("truncate", True)
    types = column_types(df.columns)
    if types:
        writer = writer.option("createTableColumnTypes", types)
    writer.options(**(options or {})).save()
