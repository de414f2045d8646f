"""The layers as commands for ``spark-submit`` or ``python -m orderlake.jobs``.

bronze  ingest a line stream        areas  prepare the boundary index
silver  process the new raw rows    gold   roll up the new orders and publish them
pipeline  all three layers once, for a scheduler to repeat
"""

from __future__ import annotations

import argparse
import importlib
import json
from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from orderlake.operators.spatial import AreaIndex, build_cells
from orderlake.plans.gold import run_gold
from orderlake.plans.pipeline import Layout, run_pipeline
from orderlake.plans.silver import run_silver
from orderlake.sinks.jdbc import write_jdbc
from orderlake.sinks.ledger import LedgerTable
from orderlake.sinks.progress import DEFAULT_MARK
from orderlake.sources.boundaries import read_boundaries
from orderlake.sources.lines import stream_lines
from orderlake.sources.tables import read_table
from orderlake.streaming.bronze import run_bronze


def _pairs(values: Sequence[str]) -> dict[str, str]:
    return dict(value.split("=", 1) for value in values)


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="orderlake.jobs", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    bronze = jobs.add_parser("bronze")
    bronze.add_argument("--available-now", action="store_true", help="stop when the source is read up")
    bronze.add_argument("--interval", default="2 minutes")
    bronze.add_argument("--files", type=int, help="most files per batch")

    areas = jobs.add_parser("areas")
    areas.add_argument("--boundaries", required=True)
    areas.add_argument("--out", required=True)
    areas.add_argument("--order", help="column that ranks overlapping areas (default: file order)")
    areas.add_argument("--size", type=float, help="cell side (default: from the boundaries)")

    silver = jobs.add_parser("silver")
    gold = jobs.add_parser("gold")
    whole = jobs.add_parser("pipeline")

    for job in (bronze, silver, gold, whole):
        job.add_argument("--root", required=True)
    for job in (bronze, whole):
        job.add_argument("--source", default="text", help="streaming format, such as text, kafka or socket")
        job.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    for job in (silver, whole):
        for name in ("employees", "customers", "areas"):
            job.add_argument(f"--{name}", required=True)
        job.add_argument("--span-hours", type=float, help="longest slice of a backlog")
        job.add_argument("--once-by", action="append", metavar="COLUMN", help="key by which an order stays once over all slices")
    for job in (gold, whole):
        job.add_argument("--jdbc-url")
        job.add_argument("--jdbc-table", default="daily_sales")
        job.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
        job.add_argument(
            "--connect",
            metavar="MODULE:FUNCTION",
            help="gives a DB-API connection to the same database: changed days only, each batch once (default: refill)",
        )
    for job in (silver, gold, whole):
        job.add_argument("--default", default=DEFAULT_MARK, help="mark of a layer that never ran")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    """Run one job; a failure is raised, so the exit status tells it."""
    args = _arguments(argv)
    spark = spark or SparkSession.builder.appName(f"orderlake-{args.job}").getOrCreate()
    if args.job == "areas":
        index = build_cells(read_boundaries(spark, args.boundaries, args.order), args.size)
        index.save(args.out)
        done = {"size": index.size, "levels": index.levels, "bytes": index.bytes}
    else:
        done = _LAYERS[args.job](spark, Layout(args.root), args)
    print(json.dumps({"job": args.job, **done}, default=str))


def _bronze(spark: SparkSession, layout: Layout, args: argparse.Namespace) -> dict[str, object]:
    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.interval}
    lines = stream_lines(spark, args.source, **_pairs(args.option))
    run_bronze(lines, layout.bronze, layout.checkpoint, trigger, args.files).awaitTermination()
    return {}


def _dimensions(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame, AreaIndex]:
    return read_table(spark, args.employees), read_table(spark, args.customers), AreaIndex.load(spark, args.areas)


def _span(args: argparse.Namespace) -> timedelta | None:
    return None if args.span_hours is None else timedelta(hours=args.span_hours)


def _silver(spark: SparkSession, layout: Layout, args: argparse.Namespace) -> dict[str, object]:
    return run_silver(
        spark,
        layout.bronze,
        layout.silver,
        layout.silver_progress,
        *_dimensions(spark, args),
        default=args.default,
        span=_span(args),
        once_by=args.once_by,
        seen=layout.silver_seen if args.once_by else None,
    )


def _publishers(layout: Layout, args: argparse.Namespace) -> dict[str, Callable]:
    """How the rollup goes on: with a connection function changed days alone, else the whole table."""
    rejects, options = layout.path("gold_rejected"), _pairs(args.jdbc_option)

    def refill(valid: DataFrame, rejected: DataFrame) -> None:
        rejected.write.mode("overwrite").parquet(rejects)
        if args.jdbc_url:
            write_jdbc(valid, args.jdbc_url, args.jdbc_table, options)

    if not args.connect:
        return {"publish": refill}
    if not args.jdbc_url:
        raise SystemExit("--connect needs --jdbc-url, by which the rows are staged")
    module, _, function = args.connect.partition(":")
    connect = getattr(importlib.import_module(module), function)
    table = LedgerTable.by_jdbc(connect, args.jdbc_url, args.jdbc_table, options)

    def batch(name: str, days: DataFrame, valid: DataFrame, rejected: DataFrame) -> None:
        # a folder per batch: written again as a whole if the batch comes again
        rejected.write.mode("overwrite").parquet(f"{rejects}/batch={name.replace(':', '-')}")
        table.publish(name, days, valid)

    return {"publish_batch": batch}


def _gold(spark: SparkSession, layout: Layout, args: argparse.Namespace) -> dict[str, object]:
    tables = layout.silver, layout.partials, layout.gold, layout.gold_progress
    return run_gold(spark, *tables, default=args.default, **_publishers(layout, args))


def _pipeline(spark: SparkSession, layout: Layout, args: argparse.Namespace) -> dict[str, object]:
    lines = stream_lines(spark, args.source, **_pairs(args.option))
    people = _dimensions(spark, args)
    return run_pipeline(spark, lines, layout, *people, default=args.default, span=_span(args), once_by=args.once_by, **_publishers(layout, args))


_LAYERS = {"bronze": _bronze, "silver": _silver, "gold": _gold, "pipeline": _pipeline}


if __name__ == "__main__":
    main()
