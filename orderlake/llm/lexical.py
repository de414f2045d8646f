"""Ranked lexical search with Block-Max MaxScore over document shards.

Index: each task cuts its documents into shards of bounded size. A shard numbers
its documents by length and holds one row per term: postings in blocks of 64, as
gaps and frequencies in variable-length bytes, and for each block its last
document, greatest frequency and least length. As a block's documents are of
almost one length, these two bound its scores closely, whatever the corpus
statistics will be. Nothing is shuffled, and any queries can be asked later.

Search: statistics of the corpus are sums over shards. In each shard a query
passes its documents range by range. Lists whose global bounds together stay
below the k-th score so far are non-essential: they can't bring in a document.
The documents of the essential lists are scored, and those go that the block
maxima of the non-essential lists can't lift to the k-th score, before any of
these blocks is decompressed. The shards' heaps are merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .positional_index import words_of
from .shared import only, written
from .terms import TermCounts, starts_of, term_table

BLOCK = 64
#: A shard is closed at so many documents or words: some 100 MB while it is built.
SHARD_DOCS, SHARD_WORDS = 65_536, 2_000_000
#: Documents that are scored at once.
RANGE = 2_048
#: Queries that a task asks a shard for, about.
QUERY_BLOCK = 512
#: Bytes of query terms up to which they go to all tasks.
BROADCAST_BYTES = 64 << 20

INDEX_SCHEMA = (
    "shard long, term string, n long, last array<int>, top_tf array<int>, least_length array<long>, at array<int>, postings binary, "
    "doc_ids array<long>, lengths array<long>, words long"
)


def pack(values):
    """Whole numbers as bytes of seven bits, the least first; returns them and where each number ends."""
    import numpy as np

    sizes = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        sizes += values >= 1 << bits
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for j in range(5):
        longer = np.flatnonzero(sizes > j)
        more = np.where(sizes[longer] > j + 1, 128, 0)
        out[ends[longer] - sizes[longer] + j] = (values[longer] >> (7 * j)) & 127 | more
    return out, ends


def unpack(data):
    """The numbers that ``pack`` wrote."""
    import numpy as np

    raw = np.frombuffer(data, np.uint8)
    closing = raw < 128
    starts = np.concatenate([[0], np.flatnonzero(closing)[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)


def _shard(shard: int, counts: TermCounts, doc_ids: list):
    """The rows of one shard: its documents with terms, by length, and the lists of its terms."""
    import numpy as np
    import pyarrow as pa

    lengths = np.array(counts.lengths, np.int64)
    by_length = np.argsort(lengths, kind="stable")
    by_length = by_length[lengths[by_length] > 0]
    if not len(by_length):
        return
    number = np.zeros(len(lengths), np.int64)
    number[by_length] = np.arange(len(by_length))
    lengths = lengths[by_length]
    term, doc, times = counts.counted()
    order = np.argsort(term * len(lengths) + number[doc], kind="stable")
    term, doc, times = term[order], number[doc[order]], times[order]
    first = starts_of(term)
    sizes = np.diff(np.append(first, len(term)))
    gaps = np.diff(doc, prepend=-1)
    gaps[first] = doc[first] + 1
    data, ends = pack(np.stack([gaps - 1, times - 1], 1).ravel())
    ends = ends[1::2]  # of postings

    blocks_of = -(-sizes // BLOCK)
    block_first = np.repeat(first, blocks_of) + BLOCK * (np.arange(blocks_of.sum()) - np.repeat(np.cumsum(blocks_of) - blocks_of, blocks_of))
    block_end = np.append(block_first[1:], len(term))
    begin = np.concatenate([[0], ends])
    blocks = pa.array(np.concatenate([[0], np.cumsum(blocks_of)]), pa.int32())
    lists = lambda values, kind: pa.ListArray.from_arrays(blocks, pa.array(values, kind))
    at = begin[block_first] - np.repeat(begin[first], blocks_of)
    offsets = np.append(begin[first], ends[-1]).astype(np.int32)
    postings = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    columns = {
        "shard": pa.array(np.full(len(first), shard), pa.int64()),
        "term": pa.array(counts.terms(), pa.binary()).cast(pa.string()),
        "n": pa.array(sizes, pa.int64()),
        "last": lists(doc[block_end - 1], pa.int32()),
        "top_tf": lists(np.maximum.reduceat(times, block_first), pa.int32()),
        "least_length": lists(lengths[doc[block_first]], pa.int64()),
        "at": lists(at, pa.int32()),
        "postings": postings,
        "doc_ids": pa.nulls(len(first), pa.list_(pa.int64())),
        "lengths": pa.nulls(len(first), pa.list_(pa.int64())),
        "words": pa.nulls(len(first), pa.int64()),
    }
    table = pa.table(columns)
    head = {name: pa.nulls(1, kind) for name, kind in zip(table.schema.names, table.schema.types)}
    head["shard"], head["n"] = pa.array([shard], pa.int64()), pa.array([len(lengths)], pa.int64())
    head["doc_ids"] = pa.array([[doc_ids[i] for i in by_length]], pa.list_(pa.int64()))
    head["lengths"], head["words"] = pa.array([lengths], pa.list_(pa.int64())), pa.array([int(lengths.sum())], pa.int64())
    yield from pa.table(head).to_batches()
    yield from table.to_batches(max_chunksize=20_000)


def _indexer(shard_docs: int, shard_words: int):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        table, shard = term_table("0123456789"), TaskContext.get().partitionId() << 32
        counts, doc_ids = TermCounts(table), []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                counts.add(text.as_py() or b"")
                doc_ids.append(doc_id)
                if len(doc_ids) >= shard_docs or counts.words >= shard_words:
                    yield from _shard(shard, counts, doc_ids)
                    shard, counts, doc_ids = shard + 1, TermCounts(table), []
        yield from _shard(shard, counts, doc_ids)

    return run


def document_mass(lengths, docs: int, words: int):
    """m of documents: 75 and a quarter of their length against the mean, in hundredths."""
    return 75 + (25 * lengths * docs) // words


def impact(tf, mass):
    """What one term adds for each point of its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * mass)


class ShardList:
    """One term's postings in a shard; blocks are decompressed once, when they are first asked for."""

    def __init__(self, row: dict, mass, docs: int, words: int):
        import numpy as np

        self.size, self.data, self.mass = row["n"], row["postings"], mass
        self.last, self.at = (np.array(row[c], np.int64) for c in ("last", "at"))
        self.at = np.append(self.at, len(self.data))
        self.bounds = impact(np.array(row["top_tf"], np.int64), document_mass(np.array(row["least_length"], np.int64), docs, words))
        self.bound = int(self.bounds.max())
        self.open = np.zeros(len(self.last), bool)
        self.docs, self.impacts = np.empty(self.size, np.int64), np.empty(self.size, np.int64)

    def decompress(self, low: int, high: int) -> None:
        """Blocks ``low`` to ``high - 1``, those not open yet."""
        import numpy as np

        while low < high:
            if self.open[low]:
                low += 1
                continue
            end = low
            while end < high and not self.open[end]:
                end += 1
            values = unpack(self.data[self.at[low] : self.at[end]])
            before = int(self.last[low - 1]) if low else -1
            docs = before + np.cumsum(values[0::2] + 1)
            span = slice(low * BLOCK, low * BLOCK + len(docs))
            self.docs[span], self.impacts[span] = docs, impact(values[1::2] + 1, self.mass[docs])
            self.open[low:end] = True
            low = end

    def between(self, low: int, high: int):
        """Documents from ``low`` to ``high - 1`` and their impacts."""
        import numpy as np

        b, e = np.searchsorted(self.last, (low, high - 1))
        e = min(int(e) + 1, len(self.last))
        self.decompress(int(b), e)
        docs = self.docs[b * BLOCK : min(e * BLOCK, self.size)]
        s, t = np.searchsorted(docs, (low, high))
        return docs[s:t], self.impacts[b * BLOCK + s : b * BLOCK + t]

    def block_bounds(self, docs):
        """For each document the greatest impact that its block allows."""
        import numpy as np

        return np.append(self.bounds, 0)[np.searchsorted(self.last, docs)]

    def impacts_of(self, docs):
        """The impacts of ``docs`` (rising), 0 where the term is absent; opens their blocks only."""
        import numpy as np

        blocks = np.unique(np.searchsorted(self.last, docs))
        blocks = blocks[blocks < len(self.last)]
        out = np.zeros(len(docs), np.int64)
        for b in blocks:
            self.decompress(int(b), int(b) + 1)
            span = slice(b * BLOCK, min((b + 1) * BLOCK, self.size))
            at = np.searchsorted(self.docs[span], docs)
            at[at == span.stop - span.start] = 0
            there = self.docs[span][at] == docs
            out[there] = self.impacts[span][at[there]]
        return out


def best_of_shard(lists: list[tuple[ShardList, int]], n_docs: int, rank_ids, k: int, doc_range: int = RANGE):
    """Numbers and scores of the ``k`` best documents of a shard for (list, weight) pairs; equal scores by ``rank_ids``."""
    import numpy as np

    lists = sorted(lists, key=lambda x: x[0].bound * x[1])
    sums = np.cumsum([x.bound * w for x, w in lists])
    best, scores, least = np.empty(0, np.int64), np.empty(0, np.int64), 1
    for low in range(0, n_docs, doc_range):
        high = min(low + doc_range, n_docs)
        e = int(np.searchsorted(sums, least))  # lists before e can't reach ``least`` together
        if e == len(lists):
            break
        total = np.zeros(high - low, np.int64)
        for one, w in lists[e:]:
            docs, impacts = one.between(low, high)
            total[docs - low] += w * impacts
        found = np.flatnonzero(total)
        if e:
            found = found[total[found] + sums[e - 1] >= least]
        score, docs = total[found], found + low
        if e and len(docs):
            bounds = [w * one.block_bounds(docs) for one, w in lists[:e]]
            reach = score + np.sum(bounds, axis=0)
            for i in range(e - 1, -1, -1):
                stay = reach >= least
                docs, score, reach, bounds = docs[stay], score[stay], reach[stay], [b[stay] for b in bounds[: i + 1]]
                if not len(docs):
                    break
                there = lists[i][1] * lists[i][0].impacts_of(docs)
                score, reach = score + there, reach - bounds[i] + there
        stay = score >= least
        best, scores = np.concatenate([best, docs[stay]]), np.concatenate([scores, score[stay]])
        if len(best) > k:
            order = np.lexsort((rank_ids[best], -scores))[:k]
            best, scores = best[order], scores[order]
        if len(best) == k:
            least = max(1, int(scores.min()))
    return best, scores


def _searcher(n: int, words: int, k: int):
    def run(table):
        import numpy as np
        import pyarrow as pa

        rows = table.to_pylist()
        queries: dict[int, list] = {}
        lists, ids, mass = [], [], None
        for row in rows:
            if row["term"] is None:
                ids, mass = row["doc_ids"], document_mass(np.array(row["lengths"], np.int64), n, words)
        # a null id comes before all others; equal ones in any order
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i]))
        rank_ids = np.empty(len(ids), np.int64)
        rank_ids[order] = np.arange(len(ids))
        for row in rows:
            if row["term"] is not None:
                one = ShardList(row, mass, n, words)
                for asked in row["queries"]:
                    queries.setdefault(asked["query"], []).append((one, row["w"] * asked["times"]))
        out = []
        for query, lists in queries.items():
            best, scores = best_of_shard(lists, len(ids), rank_ids, k)
            out += [(query, ids[d], s) for d, s in zip(best.tolist(), scores.tolist())]
        return pa.table([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["query", "doc_id", "score"])

    return run


class LexicalIndex:
    """An index in ``folder``, to be opened again at any time.

    ``docs``: a null text has no term; documents without terms are in no result
    and not in the statistics. Null and repeated ids and repeated rows are
    documents of their own. Ids are whole numbers. Further columns of any name
    are left out.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._rows = spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/shards")
        self._folder = folder

    @classmethod
    def write(
        cls, docs: DataFrame, folder: str, id_column: str = "doc_id", text_column: str = "text", shard_docs: int = SHARD_DOCS, shard_words: int = SHARD_WORDS
    ) -> LexicalIndex:
        rows = only(docs, id_column, text_column).select(F.col(id_column).cast("long"), F.col(text_column))
        rows.mapInArrow(_indexer(shard_docs, shard_words), INDEX_SCHEMA).write.parquet(f"{folder}/shards")
        return cls(docs.sparkSession, folder)

    def statistics(self) -> tuple[int, int]:
        """Documents with terms, and their words."""
        row = self._rows.filter("term IS NULL").agg(F.sum("n"), F.sum("words")).first()
        return row[0] or 0, row[1] or 0

    def search(self, items: DataFrame, folder: str, k: int = 20, item_column: str = "item_id", text_column: str = "text") -> DataFrame:
        """``item, rank, doc_id, score``: the ``k`` best documents of each row of ``items`` with a score above 0.

        Equal scores by rising id, a null id first, equal ids in any order. Each
        row of ``items`` is a query of its own, also under a null or repeated
        id; one without terms has no result. Query terms and what the shards
        found are written in ``folder``.
        """
        spark = items.sparkSession
        asked = only(items, item_column, text_column).select(
            F.monotonically_increasing_id().alias("query"), F.col(item_column).alias("item"), words_of(F.col(text_column)).alias("words")
        )
        asked = written(asked, f"{folder}/queries")
        docs, words = self.statistics()
        blocks = max(1, -(-asked.count() // QUERY_BLOCK))
        block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")
        terms = asked.select("query", F.explode("words").alias("term")).groupBy("query", "term").agg(F.count("*").alias("times"))
        terms = terms.groupBy(block.alias("block"), "term").agg(F.collect_list(F.struct("query", "times")).alias("queries"))
        terms = written(terms, f"{folder}/terms")
        rows = self._rows.filter("term IS NOT NULL")
        df = rows.select("term", "n").join(self._small(terms.select("term").distinct()), "term").groupBy("term").agg(F.sum("n").alias("df"))
        weight = F.floor(1000 * F.log((F.lit(2 * docs + 2).cast("double")) / (2 * F.col("df") + 1).cast("double"))).cast("long")
        weighted = written(terms.join(df.select("term", weight.alias("w")), "term").select("block", "term", "queries", "w"), f"{folder}/weighted")
        lists = rows.select("shard", "term", "n", "last", "top_tf", "least_length", "at", "postings").join(self._small(weighted), "term")
        heads = self._rows.filter("term IS NULL").select("shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "doc_ids", "lengths")
        found = lists.unionByName(heads, allowMissingColumns=True).groupBy("shard", "block").applyInArrow(
            _searcher(docs, words, k), "query long, doc_id long, score long"
        )
        order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
        top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return top.join(asked.select("query", "item"), "query").select("item", "rank", "doc_id", "score")

    @staticmethod
    def _small(terms: DataFrame) -> DataFrame:
        """With a broadcast hint if the bytes, added up, allow it; else to be joined by shuffle."""
        size = F.octet_length("term") + 32
        if "queries" in terms.columns:
            size = size + 32 * F.size("queries")
        total = terms.agg(F.sum(size.cast("long"))).first()[0] or 0
        return F.broadcast(terms) if total <= BROADCAST_BYTES else terms
