"""Typed JSON."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.schemas import ORDER_SCHEMA


def parse_orders(
    lines: DataFrame,
    value: str = "value",
    schema: T.StructType = ORDER_SCHEMA,
    keep: Iterable[str] = (),
) -> DataFrame:
    """One row per line with the schema's fields, plus the ``keep`` columns.

    What cannot be read as its type is null; an unreadable line is all null.
    ``inline`` is a generator, so the optimizer parses a line once. With
    ``select("j.*")`` it would inline the parse into every later filter and run
    it again for each field named there.
    """
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return lines.select(*keep, F.inline(F.array(parsed)))
