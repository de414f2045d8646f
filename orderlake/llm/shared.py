"""Folders that driver and executors share, written tables, and worker-wide caches."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that keys and words are cut at.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Where the session has no such setting (as in tests, where all runs on one
    machine) a temporary folder is made and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="orderlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/orderlake-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str) -> DataFrame:
    """``df`` as a written table: later reads don't repeat the work that made it."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def worker_store(name: str, make):
    """What ``make`` gives, made once in each Python worker and kept between its tasks."""
    holder = sys.modules.setdefault("_orderlake_worker", types.ModuleType("_orderlake_worker"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else.

    ``lower`` has a fast way for pure ASCII; other texts are translated, as
    ``lower`` would change letters beyond ASCII too.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns; others may be there, in any case and number."""
    return df.select(*[df[c] for c in columns])
