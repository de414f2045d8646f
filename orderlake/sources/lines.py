"""Stream of text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_lines(spark: SparkSession, source: str = "text", **options: object) -> DataFrame:
    """Streaming DataFrame with the one column ``value``.

    ``source`` is any streaming format with a value column: ``text`` (a directory
    in ``path``) and ``kafka`` can replay what a failed batch had read, ``socket``
    (``host``, ``port``) cannot and loses it.
    """
    stream = spark.readStream.format(source).options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))
