"""Raw lines into the date-partitioned table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from orderlake.operators.ingest import ingest_partitions, stamp_ingest
from orderlake.schemas import BRONZE_PARTITIONS

# Fixed value: time between two micro-batches.
DEFAULT_TRIGGER = {"processingTime": "2 minutes"}


class BatchTarget(Protocol):
    """Keeps a ledger of the batches that it holds, such as ``sinks.ledger.LedgerTable``."""

    def append(self, batch: str, rows: DataFrame) -> bool:
        """Add the rows and the batch's name at one stroke, unless it is entered."""


def run_bronze(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    files: int | None = None,
    write_batch: Callable[[DataFrame, int], None] | None = None,
    target: BatchTarget | None = None,
) -> StreamingQuery:
    """Start the ingest and return its query; waiting is the caller's.

    The file sink commits each micro-batch once, also after a restart, and
    writes nothing for an empty one. Every task writes its own files; ``files``
    limits them per batch where batches are small. An error stops the query and
    the batch is read again on restart.

    ``target`` replaces the file sink by one with a ledger: a batch that comes
    again, after a crash between its write and the checkpoint, changes nothing.
    Batches are named by the query's id in the checkpoint and their number, so
    several streams may share a target. ``write_batch(batch, batch_id)`` is for
    anything else; it may be called again for a batch and has to allow for that.
    """
    if target is not None and write_batch is not None:
        raise ValueError("either target or write_batch")
    stamped = ingest_partitions(stamp_ingest(lines))
    if files is not None:
        stamped = stamped.coalesce(files)
    writer = (
        stamped.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
    )
    if target is not None:
        write_batch = _appender(target)
    if write_batch is not None:
        return writer.foreachBatch(write_batch).start()
    return writer.format("parquet").partitionBy(*BRONZE_PARTITIONS).start(out)


def _appender(target: BatchTarget) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("the batch does not tell its query")
        target.append(f"{query}:{batch_id}", batch)

    return write
