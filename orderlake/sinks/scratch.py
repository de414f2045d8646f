"""Tables that a job needs for itself, in a folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from orderlake.sources.tables import file_system


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Where the session has no such setting, a temporary folder is made and set if
    the master is local; on a cluster, whose executors would not see it, this
    raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="orderlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/orderlake-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str) -> DataFrame:
    """``df`` as a written table: later reads don't repeat the work that made it."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that no table reads any more; an absent one doesn't matter."""
    system, place = file_system(spark, folder)
    system.delete(place, True)
