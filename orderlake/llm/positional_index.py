"""A positional inverted index over training text, asked for benchmark passages.

DataFrame functions only. The index stores a posting (row, position, term) for
each word of the texts that occurs in any test item; nothing else can be part of
a match. It is written in the order of the scan, without a shuffle, and holds
one closing posting per row that gives its number of words.

For each window of an item the rarest terms of the corpus are looked up: lists
moved by their offsets in the item are intersected from the rarest on, which
leaves few places (row, item, offset). There all words of the item are compared,
and runs of at least a window's length are exact matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import ascii_lower, shared_folder, written

#: Fixed value: what is not part of a word, once A-Z are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The number of the closing posting's term.
CLOSING = 0
#: Rows up to which a table of test terms is broadcast: at most some 60 MB.
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, -1), lambda w: w != "")


def _small(df: DataFrame) -> DataFrame:
    """With a broadcast hint if its rows, counted, allow it; else to be joined by shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


class PositionalIndex:
    """Postings of the terms of ``items`` in ``docs``.

    ``items``: rows (item_id, text); repeated rows count once, null texts and
    texts without words are in no document. ``docs``: any rows; null ids and
    repeated rows are kept as rows of their own.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 13):
        spark, folder = docs.sparkSession, shared_folder(docs.sparkSession, "postings")
        self.folder, self.window, self.id_column = folder, window, id_column
        items = items.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
        items = items.dropDuplicates().withColumn("variant", F.xxhash64("item", "words"))
        items = written(items, f"{folder}/items")
        terms = items.select(F.explode("words").alias("word")).distinct()
        order = Window.orderBy("word")  # over the test terms only
        terms = written(terms.select("word", F.row_number().over(order).alias("term")).union(spark.createDataFrame([("", CLOSING)], "word string, term int")), f"{folder}/terms")

        text = F.concat(words_of(docs[text_column]), F.array(F.lit("")))
        rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_column].alias("id"), text.alias("words"))
        places = rows.select("row", "id", F.posexplode("words").alias("pos", "word"))
        self.postings = written(places.join(_small(terms), "word").select("row", "id", "pos", "term"), f"{folder}/postings")

        item_words = items.select("item", "variant", F.size("words").alias("length"), F.posexplode("words").alias("at", "word"))
        counts = self.postings.groupBy("term").agg(F.count("*").alias("times"))
        item_words = item_words.join(terms, "word").join(counts, "term", "left")
        self.item_words = written(item_words.select("item", "variant", "length", "at", "term", F.coalesce("times", F.lit(0)).alias("times")), f"{folder}/item_words")
        grouped = self.item_words.groupBy("item", "variant", "length").agg(F.sort_array(F.collect_list(F.struct("at", "term", "times"))).alias("w"))
        self.items = written(grouped, f"{folder}/grouped")

    def anchors(self, rarest: int = 3) -> DataFrame:
        """``variant, at1, term1, ...``: the rarest terms of each window that can occur at all, once for all windows that share them."""
        width = F.least("length", F.lit(self.window))
        starts = self.items.select("variant", "w", width.alias("width"), F.explode(F.sequence(F.lit(1), F.col("length") - width + 1)).alias("s"))
        ranked = F.sort_array(F.transform(F.slice("w", F.col("s"), F.col("width")), lambda x: F.struct(x["times"].alias("times"), x["at"].alias("at"), x["term"].alias("term"))))
        starts = starts.select("variant", ranked.alias("r")).filter(F.col("r")[0]["times"] > 0)
        columns = []
        for i in range(rarest):
            one = F.col("r")[F.least(F.lit(i), F.size("r") - 1)]
            columns += [one["at"].alias(f"at{i + 1}"), one["term"].alias(f"term{i + 1}")]
        return starts.select("variant", *columns).distinct()

    def places(self, rarest: int = 3) -> DataFrame:
        """``row, variant, offset``: where the rarest terms of a window lie at their distances."""
        anchors = written(self.anchors(rarest), f"{self.folder}/anchors")
        wanted = anchors.select(F.explode(F.array(*[f"term{i + 1}" for i in range(rarest)])).alias("term")).distinct()
        lists = written(self.postings.join(_small(wanted), "term").select("row", "pos", "term"), f"{self.folder}/lists")
        spark = lists.sparkSession
        found = anchors.join(lists, anchors.term1 == lists.term).withColumn("offset", F.col("pos") - F.col("at1")).drop("pos", "term")
        for i in range(2, rarest + 1):
            other = spark.read.schema(lists.schema).parquet(f"{self.folder}/lists").select(F.col("row").alias("row_"), F.col("pos").alias("pos_"), F.col("term").alias("term_"))
            at = (F.col("row") == F.col("row_")) & (F.col("offset") + F.col(f"at{i}") == F.col("pos_")) & (F.col(f"term{i}") == F.col("term_"))
            found = found.join(other, at, "left_semi")
        return found.select("row", "variant", "offset").distinct()

    def phrases(self, rarest: int = 3) -> DataFrame:
        """``row, item, pos``: the positions of each row that lie in an occurrence of a window of an item."""
        places = written(self.places(rarest), f"{self.folder}/places")
        expected = places.join(_small(self.item_words.select("item", "variant", "length", "at", "term")), "variant")
        expected = expected.select("row", "item", "variant", "length", "offset", "term", (F.col("offset") + F.col("at")).alias("pos"))
        # the rows' other postings are left out first: those of rows without a place can't match
        rows = places.select("row").distinct()
        there = self.postings.filter(F.col("term") != CLOSING).join(rows, "row", "left_semi").select("row", "pos", "term")
        met = expected.join(there, ["row", "pos", "term"])
        line = ["row", "item", "variant", "offset"]
        met = met.withColumn("run", F.col("pos") - F.row_number().over(Window.partitionBy(*line).orderBy("pos")))
        met = met.withColumn("together", F.count("*").over(Window.partitionBy(*line, "run")))
        return met.filter(F.col("together") >= F.least("length", F.lit(self.window))).select("row", "item", "pos")

    def proximity(self, within: int = 20, rarest: int = 3) -> DataFrame:
        """``id, item, span``: rows where the rarest terms of an item's window lie within ``within`` words, in any order; span is the least such width."""
        anchors = self.anchors(rarest)
        wanted = anchors.select(F.explode(F.array(*[f"term{i + 1}" for i in range(rarest)])).alias("term")).distinct()
        lists = written(self.postings.join(_small(wanted), "term").select("row", "pos", "term"), f"{shared_folder(self.postings.sparkSession, 'near')}/lists")
        found = anchors.join(lists, anchors.term1 == lists.term).drop("term")
        found = found.withColumn("low", F.col("pos")).withColumn("high", F.col("pos")).withColumn("cell", F.floor(F.col("pos") / within))
        for i in range(2, rarest + 1):
            other = lists.select(F.col("row").alias("row_"), F.col("pos").alias("pos_"), F.col("term").alias("term_"))
            other = other.withColumn("cell_", F.explode(F.array(*[F.floor(F.col("pos_") / within) + d for d in (-1, 0, 1)])))
            near = (F.col("row") == F.col("row_")) & (F.col(f"term{i}") == F.col("term_")) & (F.col("cell") == F.col("cell_"))
            found = found.join(other, near).withColumn("low", F.least("low", "pos_")).withColumn("high", F.greatest("high", "pos_"))
            found = found.filter(F.col("high") - F.col("low") < within).drop("row_", "pos_", "term_", "cell_")
        spans = found.join(_small(self.items.select("variant", "item")), "variant").groupBy("row", "item").agg(F.min(F.col("high") - F.col("low") + 1).alias("span"))
        ids = self.postings.filter(F.col("term") == CLOSING).select("row", "id")
        return spans.join(ids, "row").select(F.col("id").alias(self.id_column), "item", "span")

    def contamination(self, percent_parts: int = 20) -> DataFrame:
        """One row for each row of the documents: ``id, n_words, n_hit, n_items, items`` (sorted, comma-joined) and ``contaminated``.

        Contaminated: some word is hit, and ``percent_parts * n_hit >= n_words``.
        """
        hits = written(self.phrases(), f"{self.folder}/hits")
        places = hits.groupBy("row", "pos").agg(F.lit(1).alias("one")).groupBy("row").agg(F.count("*").alias("n_hit"))
        named = hits.groupBy("row", "item").agg(F.lit(1).alias("one")).groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
        rows = self.postings.filter(F.col("term") == CLOSING).select("row", F.col("id").alias(self.id_column), F.col("pos").cast("long").alias("n_words"))
        rows = rows.join(places.join(named, "row"), "row", "left")
        n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
        return rows.select(
            self.id_column, "n_words", n_hit.alias("n_hit"),
            F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
            F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"),
            ((n_hit > 0) & (percent_parts * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
