"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def components(links: DataFrame, folder: str) -> DataFrame:
    """``node, component``: for each node of ``links`` (a, b) the smallest node that it reaches.

    Each round gives a node the smallest label around it and then that label's
    own label, so chains halve. Rounds are written below ``folder``; only a
    count comes back to the driver. Repeated links and loops are harmless.
    """
    edges = links.select("a", "b").union(links.select("b", "a")).distinct()
    edges = written(edges, f"{folder}/edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), f"{folder}/labels-0")
    turn = 0
    while True:
        turn += 1
        spark = links.sparkSession
        around = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
        nearer = labels.join(around, labels.node == around.a, "left").select(
            "node", F.col("component").alias("was"), F.least("component", F.coalesce("near", "component")).alias("component")
        )
        nearer = written(nearer, f"{folder}/near-{turn}")
        own = spark.read.schema(nearer.schema).parquet(f"{folder}/near-{turn}").select(F.col("node").alias("of"), F.col("component").alias("further"))
        jumped = nearer.join(own, nearer.component == own.of, "left").select(
            "node", F.least("component", F.coalesce("further", "component")).alias("component"), "was"
        )
        jumped = written(jumped, f"{folder}/labels-{turn}")
        labels = jumped.select("node", "component")
        if not jumped.filter("component <> was").limit(1).count():
            return labels
