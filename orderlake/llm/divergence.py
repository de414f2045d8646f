"""How the sources of a language differ in their terms, with texts of terms joined in late.

1. Each task cuts its documents into terms and writes what it has counted as a
   run: term, a digest of 64 bits, documents, and occurrences by source. Nothing
   is shuffled.
2. Only digests with numbers are shuffled, to find those in enough documents.
   Terms that share a digest are counted together here, so none is missed.
3. For these few digests the least and the greatest text are looked up. Where
   they differ, terms collide: their texts are numbered, and they are counted
   again by digest and number.
4. Occurrences by source follow for kept terms, under a number of eight bytes.
   Distances between sources are sums over blocks of sources and terms.
5. Texts come back for the rows that a result shows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import only, shared_folder, written
from .terms import TermCounts, starts_of, term_table

#: Words that a task counts before it writes them: some 100 MB.
RUN_WORDS = 2_000_000
#: A task compares two blocks of about so many sources over about so many terms.
SOURCE_BLOCK, TERM_CHUNK = 128, 1_024
#: Up to so many kept terms, 24 bytes each, go to all tasks.
BROADCAST_TERMS = 1_000_000

RUN_SCHEMA = "lang string, digest long, term string, docs long, by_source array<struct<source:string,count:long>>"


def _runs(run_words: int, digest_bits: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        table, mask = term_table(), (1 << digest_bits) - 1
        signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x

        def flush(counts, of_doc):
            names = sorted(set(of_doc))
            langs = sorted({n[0] for n in names})
            sources = sorted({n[1] for n in names})
            lang_no, source_no = {x: i for i, x in enumerate(langs)}, {x: i for i, x in enumerate(sources)}
            doc_lang = np.array([lang_no[x] for x, _ in of_doc], np.int64)
            doc_source = np.array([source_no[x] for _, x in of_doc], np.int64)
            term, doc, times = counts.counted()
            if not len(term):
                return
            cell = (term * len(langs) + doc_lang[doc]) * len(sources) + doc_source[doc]
            order = np.argsort(cell, kind="stable")
            cell, times = cell[order], times[order]
            first = starts_of(cell)
            docs, times, cell = np.diff(np.append(first, len(cell))), np.add.reduceat(times, first), cell[first]
            pair = cell // len(sources)
            first = starts_of(pair)
            docs, pair = np.add.reduceat(docs, first), pair[first]
            terms = counts.terms()
            digests = np.array([signed(xxhash.xxh64_intdigest(t) & mask) for t in terms], np.int64)
            texts = pa.array(terms, pa.binary()).cast(pa.string())
            by_source = pa.StructArray.from_arrays([pa.array(sources, pa.string()).take(pa.array(cell % len(sources))), pa.array(times, pa.int64())], ["source", "count"])
            offsets = pa.array(np.append(first, len(cell)), pa.int32())
            columns = [
                pa.array(langs, pa.string()).take(pa.array(pair % len(langs))),
                pa.array(digests[pair // len(langs)]),
                texts.take(pa.array(pair // len(langs))),
                pa.array(docs, pa.int64()),
                pa.ListArray.from_arrays(offsets, by_source),
            ]
            yield from pa.table(columns, ["lang", "digest", "term", "docs", "by_source"]).to_batches(max_chunksize=20_000)

        counts, of_doc = TermCounts(table), []
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                counts.add(text.as_py())
                of_doc.append((lang, source))
                if counts.words >= run_words:
                    yield from flush(counts, of_doc)
                    counts, of_doc = TermCounts(table), []
        yield from flush(counts, of_doc)

    return run


def share(count: Column, total: Column) -> Column:
    """``1 + floor(10^9 * (count + 5) / total)``, exact at any size that a long can count."""
    part = (count + 5).cast("decimal(19,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", part, total.cast("decimal(19,0)"))


def _distances(table):
    """Sums of absolute differences of each pair of sources of two blocks over the terms of a chunk; terms that a source lacks have its ``least`` share."""
    import numpy as np
    import pyarrow as pa

    lang, low, high = (table.column(c)[0].as_py() for c in ("lang", "low", "high"))
    sources = table.column("source").combine_chunks().dictionary_encode()
    names, at = sources.dictionary.to_pylist(), sources.indices.to_numpy()
    shares, blocks = table.column("p").to_numpy(), table.column("block").to_numpy()
    empty = table.column("term_no").is_null().to_numpy()
    terms, term_at = np.unique(table.column("term_no").drop_null().to_numpy(), return_inverse=True)
    least, block = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    least[at[empty]], block[at] = shares[empty], blocks
    matrix = np.repeat(least[:, None], len(terms), axis=1)
    matrix[at[~empty], term_at] = shares[~empty]
    rows = []
    for a in np.flatnonzero(block == low):
        others = np.flatnonzero(block == high)
        if low == high:
            others = others[others > a]
        sums = np.abs(matrix[others] - matrix[a]).sum(axis=1)
        for b, s in zip(others, sums):
            rows.append((lang, min(names[a], names[b]), max(names[a], names[b]), int(s), len(terms), abs(int(least[a] - least[b]))))
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("s", pa.int64()), ("terms", pa.int64()), ("apart", pa.int64())])
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


class SourceAudit:
    """Terms that each language keeps, and how its sources use them.

    ``docs``: rows with text, lang and source; nulls count as ''. Terms are runs
    of letters and of characters beyond ASCII, A-Z in lower case. Repeated rows
    are documents of their own; further columns of any name are left out.

    Tables: ``kept`` (lang, term_no, digest, variant), ``texts`` (lang, term_no,
    term), ``counts`` (lang, source, term_no, count), ``groups`` (lang, source,
    n, v). A group without terms is in ``groups`` with n = 0. ``digest_bits``
    narrows the digests; results are the same for any width.
    """

    def __init__(self, docs: DataFrame, least_docs: int = 30, run_words: int = RUN_WORDS, digest_bits: int = 64):
        spark = docs.sparkSession
        folder = shared_folder(spark, "audit")
        named = only(docs, "lang", "source", "text").select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
        runs = written(named.mapInArrow(_runs(run_words, digest_bits), RUN_SCHEMA), f"{folder}/runs")

        often = runs.groupBy("lang", "digest").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least_docs)
        often = written(often.select("lang", "digest", "docs"), f"{folder}/often")
        mine = runs.join(self._small(often.select("lang", "digest")), ["lang", "digest"], "left_semi")
        ends = mine.groupBy("lang", "digest").agg(F.min("term").alias("least"), F.max("term").alias("most"))
        ends = written(ends, f"{folder}/ends")

        kept = ends.filter("least = most").select("lang", "digest", F.lit(0).alias("variant"), F.col("least").alias("term"))
        collided = ends.filter("least <> most").select("lang", "digest")
        variants = None
        if collided.limit(1).count():
            alike = runs.join(self._small(collided), ["lang", "digest"], "left_semi").groupBy("lang", "digest", "term").agg(F.sum("docs").alias("docs"))
            numbered = alike.withColumn("variant", F.row_number().over(Window.partitionBy("lang", "digest").orderBy("term")))
            variants = written(numbered.filter(F.col("docs") >= least_docs).select("lang", "digest", "variant", "term"), f"{folder}/variants")
            kept = kept.unionByName(variants)
        kept = written(kept.withColumn("term_no", F.monotonically_increasing_id()), f"{folder}/kept")
        self.texts = kept.select("lang", "term_no", "term")
        self.kept = kept.select("lang", "term_no", "digest", "variant")

        plain = runs.join(self._small(self.kept.filter("variant = 0").drop("variant")), ["lang", "digest"]).select("lang", "term_no", "by_source")
        if variants is not None:
            again = self._small(kept.filter("variant > 0").select("lang", "digest", "term", "term_no"))
            plain = plain.unionByName(runs.join(again, ["lang", "digest", "term"]).select("lang", "term_no", "by_source"))
        counts = plain.select("lang", "term_no", F.inline("by_source")).groupBy("lang", "source", "term_no").agg(F.sum("count").alias("count"))
        self.counts = written(counts, f"{folder}/counts")

        v = self.kept.groupBy("lang").agg(F.count("*").alias("v"))
        n = self.counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
        groups = named.select("lang", "source").distinct().join(n, ["lang", "source"], "left").join(v, "lang", "left")
        self.groups = written(groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v")]), f"{folder}/groups")

    @staticmethod
    def _small(df: DataFrame) -> DataFrame:
        """With a broadcast hint if its rows, counted, allow it; else to be joined by shuffle."""
        return F.broadcast(df) if df.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS else df

    def shares(self) -> DataFrame:
        """``lang, source, term_no, p``: for terms that occur in a source, its smoothed share in billionths."""
        totals = self.groups.select("lang", "source", (F.col("n") + 5 * F.col("v")).alias("total"))
        return self.counts.join(totals, ["lang", "source"]).select("lang", "source", "term_no", share(F.col("count"), F.col("total")).alias("p"))

    def distances(self, source_block: int = SOURCE_BLOCK, term_chunk: int = TERM_CHUNK) -> DataFrame:
        """``lang, source, item, value``: for each two sources of a language the summed differences of their shares."""
        shape = self.groups.groupBy("lang").agg(
            F.ceil(F.count("*") / source_block).cast("int").alias("blocks"), F.greatest(F.lit(1), F.ceil(F.max("v") / term_chunk)).cast("int").alias("chunks")
        )
        total = F.col("n") + 5 * F.col("v")
        groups = self.groups.join(shape, "lang").select(
            "lang", "source", "v", "blocks", "chunks", F.pmod(F.xxhash64("source"), "blocks").cast("int").alias("block"),
            F.when(F.col("v") > 0, share(F.lit(0), F.when(F.col("v") > 0, total))).otherwise(0).alias("p"),
        )
        marks = groups.select("lang", "source", "blocks", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(None).cast("long").alias("term_no"), "p")
        cells = self.shares().join(groups.select("lang", "source", "blocks", "chunks", "block"), ["lang", "source"]).select(
            "lang", "source", "blocks", "block", F.pmod(F.xxhash64("term_no"), "chunks").cast("int").alias("chunk"), "term_no", "p"
        )
        paired = cells.unionByName(marks).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        paired = paired.select("lang", "chunk", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "source", "term_no", "p")
        sums = paired.groupBy("lang", "chunk", "low", "high").applyInArrow(_distances, "lang string, a string, b string, s long, terms long, apart long")
        sums = sums.groupBy("lang", "a", "b").agg(F.sum("s").alias("s"), F.sum("terms").alias("terms"), F.first("apart").alias("apart"))
        sums = sums.join(self.groups.groupBy("lang").agg(F.max("v").alias("v")), "lang")
        # terms of the language that no source of the two blocks has
        sums = sums.withColumn("value", F.col("s") + (F.col("v") - F.col("terms")) * F.col("apart"))
        sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
        return sums.select("lang", sides.alias("side"), "value").select("lang", "side.source", "side.item", "value")

    def overused(self, top: int = 50) -> DataFrame:
        """``lang, source, item, value, rank``: the terms that a source uses more than its language does, the ``top`` of them."""
        v = self.kept.groupBy("lang").agg(F.count("*").alias("v"))
        whole = self.counts.groupBy("lang", "term_no").agg(F.sum("count").alias("count"))
        totals = self.groups.groupBy("lang").agg(F.sum("n").alias("n")).join(v, "lang").select("lang", (F.col("n") + 5 * F.col("v")).alias("total"))
        usual = whole.join(totals, "lang").select("lang", "term_no", share(F.col("count"), F.col("total")).alias("q"))
        above = self.shares().join(usual, ["lang", "term_no"]).filter("p > q").select("lang", "source", "term_no", (F.col("p") - F.col("q")).alias("value"))
        by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
        near = above.withColumn("place", F.rank().over(by_value)).filter(F.col("place") <= top)
        named = near.join(self.texts, ["lang", "term_no"]).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")))
        return named.filter(F.col("rank") <= top).select("lang", "source", F.col("term").alias("item"), "value", "rank")

    def report(self, top: int = 50) -> DataFrame:
        """Both parts: ``lang, source, part, item, value, rank``; by falling value, equal ones by item."""
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        pairs = self.distances().withColumn("rank", F.row_number().over(order))
        columns: Callable[[str], list[Column]] = lambda part: [F.col("lang"), F.col("source"), F.lit(part).alias("part"), F.col("item"), F.col("value"), F.col("rank")]
        return pairs.select(columns("pair")).unionByName(self.overused(top).select(columns("term")))
