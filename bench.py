"""Times the queries; prints one JSON line.

BENCH_SF_DIR: directory of the tables (default /root/testdata/sf0.1).
BENCH_CPUS: local cores (default all). BENCH_RUNS: timed runs, the best counts.
Arguments: names of the queries to time (default all, and the three layers).
BENCH_ROOT: URI of a folder that the executors share, where the layers run once
over the orders as text lines (default a temporary folder, for local masters).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from orderlake.catalogue import roles  # noqa: E402
from orderlake.catalogue.queries import QUERIES  # noqa: E402
from orderlake.operators.spatial import AreaIndex  # noqa: E402
from orderlake.plans.gold import run_gold  # noqa: E402
from orderlake.plans.pipeline import Layout  # noqa: E402
from orderlake.plans.silver import run_silver  # noqa: E402
from orderlake.sources.lines import stream_lines  # noqa: E402
from orderlake.streaming.bronze import run_bronze  # noqa: E402


def bench_root() -> str:
    """A new folder for the layers' tables under BENCH_ROOT, a URI that all executors share."""
    shared = os.environ.get("BENCH_ROOT")
    if shared:
        return f"{shared.rstrip('/')}/run-{time.time_ns()}"
    return tempfile.mkdtemp(prefix="run-")  # one machine: any folder is shared


def layers(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Seconds of one run of each layer, from text lines to the rollup."""
    layout = Layout(bench_root())
    lines, cells = layout.path("lines"), layout.path("cells")
    roles.raw(spark, sf_dir).select("value").write.text(lines)
    roles.areas(spark, sf_dir).save(cells)

    def silver() -> None:
        areas = AreaIndex.load(spark, cells)
        people = roles.employees(spark, sf_dir), roles.customers(spark, sf_dir)
        run_silver(spark, layout.bronze, layout.silver, layout.silver_progress, *people, areas)

    steps = {
        "layer_bronze": lambda: run_bronze(
            stream_lines(spark, path=lines), layout.bronze, layout.checkpoint, {"availableNow": True}
        ).awaitTermination(),
        "layer_silver": silver,
        "layer_gold": lambda: run_gold(
            spark, layout.silver, layout.partials, layout.gold, layout.gold_progress
        ),
    }
    seconds = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 4)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or "*"
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("orderlake-bench")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    seconds: dict[str, float] = {}
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 4)
    if not only:
        seconds.update(layers(spark, sf_dir))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of best query times",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
