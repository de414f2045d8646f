"""All three layers in order."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from orderlake.operators.spatial import AreaIndex
from orderlake.plans.gold import run_gold
from orderlake.plans.silver import run_silver
from orderlake.sinks.progress import DEFAULT_MARK
from orderlake.streaming.bronze import run_bronze


class Layout(NamedTuple):
    """Where the tables lie. Marks and checkpoint stay beside the tables, not in them."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    bronze = property(lambda self: self.path("bronze"))
    checkpoint = property(lambda self: self.path("bronze_checkpoint"))
    silver = property(lambda self: self.path("silver"))
    silver_progress = property(lambda self: self.path("silver_progress"))
    silver_seen = property(lambda self: self.path("silver_seen"))
    partials = property(lambda self: self.path("gold_partials"))
    gold = property(lambda self: self.path("gold"))
    gold_progress = property(lambda self: self.path("gold_progress"))


def run_pipeline(
    spark: SparkSession,
    lines: DataFrame,
    layout: Layout,
    employees: DataFrame,
    customers: DataFrame,
    areas: AreaIndex,
    publish: Callable[[DataFrame, DataFrame], None] | None = None,
    default: datetime | str = DEFAULT_MARK,
    span: timedelta | None = None,
    publish_days: Callable[[DataFrame, DataFrame, DataFrame], None] | None = None,
    publish_batch: Callable[[str, DataFrame, DataFrame, DataFrame], object] | None = None,
    once_by: Sequence[str] | None = None,
) -> dict[str, dict[str, object]]:
    """Ingest what the stream holds now, then silver until it is done, then gold.

    Meant for a scheduler: call it at the wanted interval. Errors are raised,
    and the next call goes on where this one stopped. ``publish`` and the like:
    see :func:`run_gold`. ``once_by``: an order of one key stays once over all
    slices.
    """
    query = run_bronze(lines, layout.bronze, layout.checkpoint, {"availableNow": True})
    query.awaitTermination()
    total: dict[str, object] = {"rows": None, "slices": 0}
    while True:
        done = run_silver(
            spark,
            layout.bronze,
            layout.silver,
            layout.silver_progress,
            employees,
            customers,
            areas,
            default,
            span,
            once_by=once_by,
            seen=None if once_by is None else layout.silver_seen,
        )
        if done["rows"] is None:
            break
        total = {"rows": (total["rows"] or 0) + done["rows"], "slices": total["slices"] + 1}
    gold = run_gold(
        spark,
        layout.silver,
        layout.partials,
        layout.gold,
        layout.gold_progress,
        publish,
        default,
        publish_days,
        publish_batch,
    )
    return {"silver": total, "gold": gold}
