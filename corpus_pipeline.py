"""Corpus pipeline over ``documents``: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.bpe import encode_digests
from orderlake.llm.line_dedup import drop_common_lines
from orderlake.llm.near_dedup import ROW_KEY, near_rows, with_row_key
from orderlake.llm.positional_index import PositionalIndex
from orderlake.llm.quality import fit_quality, score_quality
from orderlake.llm.queries import table, vocabulary
from orderlake.llm.shared import shared_folder, written

def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.5; learned from labels outside the held-out third."""
    labels = table(spark, sf_dir, "labels").filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    return score_quality(docs, fit_quality(docs, labels)).filter("score >= 0.5").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that five or more share; the last one keeps them."""
    kept = drop_common_lines(docs).withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("kept_text").cast("long"))
    return kept.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 80 %): that with the least id.

    A document is an id with its text: null and repeated ids are told apart by
    the texts' hashes, which also decide between equal ids. A null id is the
    least of all; documents without words all stay; equal rows count once.
    """
    rows = near_rows(docs)
    own = (F.col("id") == F.col("least.id")) & (F.col("h1") == F.col("least.h1")) & (F.col("h2") == F.col("least.h2"))
    kept = rows.filter(F.col("least").isNull() | own).select(*[F.col(k[1:]).alias(k) for k in ROW_KEY]).distinct()
    return with_row_key(docs).join(kept, ROW_KEY, "left_semi").dropDuplicates(ROW_KEY).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in passages of the benchmark.

    Each row is judged by its own text, also under a null or repeated id.
    """
    keyed = with_row_key(docs)
    found = PositionalIndex(keyed.select(F.struct(*ROW_KEY).alias("_key"), "text"), table(spark, sf_dir, "benchmark"), "_key").contamination()
    hit = found.filter("contaminated").select("_key.*").distinct()
    return keyed.join(hit, ROW_KEY, "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text and the text decoded from them, as digests."""
    return encode_digests(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("bpe", encode),
]

#: Neither the classifier nor the tokenizer can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    folder = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
