"""Exact top-k by inner product with a KD-tree per shard.

Vectors are dealt to shards of bounded size by hash. A tree halves a shard at
the median of its widest component and keeps for each node the tight box of its
vectors and the smallest id. A query goes through nodes from the highest bound
(the largest inner product that any point of the box can have) down, and stops
when no bound can beat its kth score. It first searches its own shard; the kth
score found there goes with it to the other shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import shared_folder, written


def usable(vector: Column) -> Column:
    """Not null, and neither a null nor a non-finite component."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 256.0,
    shard_rows: int = 8192,
    block_rows: int = 2048,
    leaf_rows: int = 128,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k highest integer inner products.

    Components count as ``floor(scale * x)``. Candidates are all rows but those
    with the query's own id; ties go to the smaller id. Rows without id and
    unusable vectors take no part; vectors of different length don't meet.
    Repeated query rows count once, repeated candidates each. Shards and query
    blocks are bounded by ``shard_rows`` and ``block_rows`` on average; each
    block meets each shard in one task that keeps at most k results a query.
    """
    rows = vectors.select(vectors[id_column].cast("long").alias("id"), vectors[vector_column].cast("array<double>").alias("v"), is_query.alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v")))
    folder = shared_folder(vectors.sparkSession, "vectors")
    rows = written(rows.withColumn("h", F.xxhash64("id", "v")).withColumn("dim", F.size("v")), f"{folder}/rows")
    counts = rows.agg(F.count("*"), F.count(F.when(F.col("q"), 1))).first()
    shards, blocks = max(1, -(-counts[0] // shard_rows)), max(1, -(-counts[1] // block_rows))
    shard, block = F.pmod("h", F.lit(shards)).cast("int"), F.pmod(F.shiftright("h", 17), F.lit(blocks)).cast("int")
    queries = rows.filter("q").select("dim", "id", "h", "v").dropDuplicates(["id", "h"])
    queries = queries.select("dim", F.col("id").alias("query_id"), F.col("h").alias("query_h"), "v", shard.alias("home"), block.alias("block"))
    again = vectors.sparkSession.read.schema(rows.schema).parquet(f"{folder}/rows")  # other columns to Spark than the queries'
    candidates = again.select("dim", "id", "v", shard.alias("shard"))
    candidates = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    schema = "query_id long, query_h long, id long, score long"
    search = _search(k, scale, leaf_rows)

    def met(asked: DataFrame) -> DataFrame:
        return asked.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(search, schema)

    least = F.lit(None).cast("long")
    at_home = written(met(queries.select("dim", F.col("home").alias("shard"), "block", "query_id", "query_h", "v", least.alias("least"))), f"{folder}/home")
    own = ["query_id", "query_h"]
    kth = at_home.groupBy(*own).agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    away = queries.join(kth, own, "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    away = away.filter(F.col("shard") != F.col("home")).select(*keys, *own, "v", "least")
    found = at_home.unionByName(met(away))
    rank = F.row_number().over(Window.partitionBy(*own).orderBy(F.desc("score"), "id"))
    found = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def _search(k: int, scale: float, leaf_rows: int):
    def integers(column):
        import numpy as np

        return np.floor(scale * np.stack(column.to_numpy())) if len(column) else np.zeros((0, 0))

    def build(points, ids):
        """Nodes of (low, high, smallest id, children or rows)."""
        import numpy as np

        nodes = []

        def node(rows):
            low, high = points[rows].min(0), points[rows].max(0)
            spread = high - low
            at = len(nodes)
            nodes.append(None)
            widest = int(spread.argmax()) if spread.size else 0
            if len(rows) <= leaf_rows or not spread.size or spread[widest] == 0:
                nodes[at] = (low, high, ids[rows].min(), None, rows)
            else:
                order = rows[np.argsort(points[rows, widest], kind="stable")]
                half = len(rows) // 2
                nodes[at] = (low, high, ids[rows].min(), (node(order[:half]), node(order[half:])), None)
            return at

        node(np.arange(len(ids)))
        return nodes

    def search(asked, there):
        import heapq

        import numpy as np
        import pandas as pd

        out = []
        if len(asked) and len(there):
            queries, points, ids = integers(asked.v), integers(there.v), there.id.to_numpy()
            largest = np.abs(queries).max(initial=0) * np.abs(points).max(initial=0) * max(1, points.shape[1])
            if largest >= 2**53:  # beyond what doubles add up exactly
                exact = np.vectorize(int, otypes=[object])
                queries, points = exact(queries), exact(points)
            nodes = build(points, ids)
            lows, highs = np.stack([n[0] for n in nodes]), np.stack([n[1] for n in nodes])
            for i in range(len(asked)):
                q, own = queries[i], asked.query_id.iloc[i]
                least = asked.least.iloc[i]
                # bounds of all boxes at once: each component takes its better end
                bounds = highs @ np.where(q > 0, q, 0) + lows @ np.where(q < 0, q, 0)
                best = []  # (score, -id), the kth first
                floor = None if pd.isna(least) else int(least)
                heap = [(-bounds[0], 0)]
                while heap:
                    bound, at = heapq.heappop(heap)
                    bound = -bound
                    if floor is not None and bound < floor:
                        break
                    _, _, smallest, children, rows = nodes[at]
                    if len(best) == k and (bound, -smallest) < best[0]:
                        continue
                    if children:
                        for c in children:
                            heapq.heappush(heap, (-bounds[c], c))
                        continue
                    scores = points[rows] @ q
                    names = ids[rows]
                    keep = names != own
                    if floor is not None:
                        keep &= scores >= floor
                    scores, names = scores[keep], names[keep]
                    for j in np.lexsort((names, -scores))[:k]:
                        item = (int(scores[j]), -int(names[j]))
                        if len(best) < k:
                            heapq.heappush(best, item)
                        elif item > best[0]:
                            heapq.heapreplace(best, item)
                    if len(best) == k:
                        floor = best[0][0] if floor is None else max(floor, best[0][0])
                out += [(own, asked.query_h.iloc[i], -name, score) for score, name in best]
        return pd.DataFrame(out, columns=["query_id", "query_h", "id", "score"]).astype("int64")

    return search
