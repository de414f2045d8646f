"""Checks, deduplication and removal of incomplete rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Return ``df``, or raise ``ValueError`` naming the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def dedupe(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    not_null: str | None = None,
) -> DataFrame:
    """Drop repeated rows.

    Without ``keys`` whole rows are compared. With ``keys`` one row per key
    stays: the first by ``order_by`` and then by all other columns, so the
    result does not depend on the order of arrival. Nulls equal each other.

    Both forms aggregate, hence copies collapse before the shuffle and a key
    that holds most rows costs one row per task. A window would bring them all
    to one task.
    """
    if not_null is not None:
        df = df.filter(F.col(not_null).isNotNull())
    if keys is None:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    if not rest and not order_by:
        return df.select(*keys).distinct()
    ranked = [c for c in order_by if c not in keys] + rest
    first = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of ``columns``, by default in any."""
    return df.dropna("any", subset=list(columns) if columns is not None else None)
