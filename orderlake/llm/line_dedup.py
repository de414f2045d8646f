"""Removal of lines that many documents share, over levelled sorted runs of line hashes.

A run is a table of line hashes, bucketed and sorted by hash, with the number of
documents of its batch that hold the line. Batches come from the largest ids
down. Each is merge-joined with the live runs: a hash that no run knows is new,
and its line stays in the largest document of this batch; then the batch becomes
a run. ``fanout`` runs of a level are compacted into one of the next, so a batch
meets few runs and a hash is rewritten once per level.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ASCII_SPACE, ascii_lower, shared_folder, written

HASH = ["h1", "h2"]
NO_ID = -(2**63)


class LineRuns:
    """Live runs in ``folder``, by level."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = 3):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []

    def _run(self, rows: DataFrame) -> DataFrame:
        name = f"orderlake_run_{uuid.uuid4().hex}"
        rows = rows.repartition(self.buckets, *HASH)
        rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", f"{self.folder}/{name}").saveAsTable(name)
        return self.spark.table(name)

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch ``id, h1, h2`` as a run; its new hashes have ``keeper``, others null."""
        own = lines.groupBy(*HASH, "id").agg(F.lit(1).alias("one"))
        own = own.groupBy(*HASH).agg(F.count("*").alias("n_docs"), F.max("id").alias("keeper"))
        for run in [r for level in self.levels for r in level]:
            known = run.select(*HASH, F.lit(True).alias("known"))
            own = own.join(known, HASH, "left")
            own = own.withColumn("keeper", F.when(F.col("known").isNull(), F.col("keeper"))).drop("known")
        run = self._run(own)
        self._push(run, 0)
        return run

    def _push(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._run(self._merged(self.levels[level]))
            self.levels[level] = []
            self._push(merged, level + 1)

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        """Runs merged by hash: equally bucketed, so nothing is shuffled.

        Not by union and groupBy: over bucketed tables of equal layout Spark 4.1
        then leaves out a shuffle that it needs.
        """
        rows = runs[0]
        for run in runs[1:]:
            other = run.select(*HASH, F.col("n_docs").alias("n_more"), F.col("keeper").alias("keeper_more"))
            rows = rows.join(other, HASH, "full_outer").select(
                *HASH,
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n_more", F.lit(0))).alias("n_docs"),
                F.greatest("keeper", "keeper_more").alias("keeper"),
            )
        return rows

    def totals(self) -> DataFrame:
        """``h1, h2, n_docs, keeper`` over all runs."""
        runs = [r for level in self.levels for r in level]
        return runs[0] if len(runs) == 1 else self._merged(runs)


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def drop_common_lines(
    docs: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``n_lines, n_dropped, kept_text``.

    A line whose key has ``min_chars`` code points or more and is found in
    ``min_docs`` documents or more stays only in the largest id that holds it.
    Null and empty texts have one empty line. Rows with the same id are one
    document; a null id is the least of all. Keys are compared by 128 bits of
    hash. Repeated rows and further columns stay as they are; columns named as
    the three new ones are replaced.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "lines")
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "kept_text")]
    text = F.coalesce(docs[text_column], F.lit(""))
    # the id and the text's hash name a row's lines; equal rows lose the same ones
    base = docs.select(
        F.coalesce(docs[id_column].cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_row"), text.alias("_text"),
        F.struct(*[docs[c] for c in names]).alias("_doc"),
    )
    lines = base.select("_id", "_row", F.posexplode(F.split("_text", "\n", -1)).alias("pos", "line"))
    lines = lines.filter(F.length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
    lines = lines.filter(F.length("key") >= min_chars)
    h2 = F.xxhash64(F.lit(7), "key")
    lines = lines.select(F.col("_id").alias("id"), F.col("_row").alias("row"), "pos", F.xxhash64("key").alias("h1"), h2.alias("h2"))
    lines = written(lines, f"{folder}/lines")

    runs = LineRuns(spark, folder)
    cuts = lines.agg(F.percentile_approx("id", [i / batches for i in range(1, batches)], 10_000)).first()[0] or []
    edges = [None, *sorted(set(cuts)), None]
    for low, high in reversed(list(zip(edges, edges[1:]))):
        batch = lines
        if low is not None:
            batch = batch.filter(F.col("id") > low)
        if high is not None:
            batch = batch.filter(F.col("id") <= high)
        runs.add(batch.select("id", *HASH))
    common = runs.totals().filter(F.col("n_docs") >= min_docs).select(*HASH, "keeper")

    dropped = lines.join(common, HASH).filter(F.col("id") != F.col("keeper"))
    dropped = dropped.groupBy(F.col("id").alias("_id"), F.col("row").alias("_row")).agg(F.collect_set("pos").alias("_dropped"))
    all_lines = F.split("_text", "\n", -1)
    kept = F.filter(all_lines, lambda line, i: ~F.array_contains("_dropped", i))
    return base.join(dropped, ["_id", "_row"], "left").select(
        "_doc.*",
        F.size(all_lines).cast("long").alias("n_lines"),
        F.when(F.col("_dropped").isNull(), 0).otherwise(F.size("_dropped")).cast("long").alias("n_dropped"),
        F.when(F.col("_dropped").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )
