"""Tables that change together, version by version, without a moment in between.

A version's files lie in folders of their own, ``<table>/v=<token>/<day>``, and
are never changed. A manifest tells for each table which folder holds each day;
a new version writes the changed days only and takes over the others. It counts
once its manifest is there, which is created at one stroke and only if no other
writer has made the same version: a reader sees the old tables or the new ones.

Before a version is told to anybody else, a note with its changed days is left,
so that the next attempt after a crash knows what may have been published.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.sources.tables import file_system, partition_values

#: Fixed value: the directory name of a null partition.
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"

Days = Mapping[str, str]


class ConcurrentWrite(RuntimeError):
    """Another writer has made the version; nothing of this one is visible."""


class Version(NamedTuple):
    """``tables``: for each table the token of the folder that holds a day."""

    number: int
    tables: Mapping[str, Days]


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content, unless it is there; ``False`` if it is.

    The content is written beside it first. HDFS renames at one stroke and never
    over a file; local files are linked. An object store whose rename is a copy
    needs one writer at a time.
    """
    system, place = file_system(spark, path)
    if system.exists(place):
        return False
    draft = place.suffix(f".{uuid.uuid4().hex}.draft")
    draft = spark._jvm.org.apache.hadoop.fs.Path(draft.getParent(), f"_{draft.getName()}")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    try:
        if system.getScheme() != "file":
            return bool(system.rename(draft, place))
        local = lambda p: spark._jvm.java.io.File(p.toUri().getPath()).toPath()
        try:
            spark._jvm.java.nio.file.Files.createLink(local(place), local(draft))
        except Exception:
            if system.exists(place):
                return False
            raise
        return True
    finally:
        system.delete(draft, False)


def read_text(spark: SparkSession, path: str) -> str:
    system, place = file_system(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def day_name(day: str = "order_date"):
    """The directory name of a day: a column expression."""
    return F.coalesce(F.col(day).cast("string"), F.lit(NULL_DAY))


class Versions:
    """The versions of some tables, each partitioned by ``column``; manifests lie in ``home``."""

    def __init__(self, spark: SparkSession, home: str, tables: Mapping[str, str], column: str = "order_date"):
        self._spark, self._folder, self._tables, self._column = spark, f"{home.rstrip('/')}/_versions", dict(tables), column

    def _listed(self, start: str) -> list[str]:
        system, place = file_system(self._spark, self._folder)
        names = [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []
        return sorted(n for n in names if n.startswith(start) and n.endswith(".json"))

    def latest(self) -> Version:
        """The last complete version; number 0 and no days without any."""
        found = self._listed("version-")
        return self._load(found[-1]) if found else Version(0, {name: {} for name in self._tables})

    def _load(self, name: str) -> Version:
        told = json.loads(read_text(self._spark, f"{self._folder}/{name}"))
        return Version(told["number"], told["tables"])

    def token(self, base: Version) -> str:
        """A name for the folders of the attempt at the version after ``base``."""
        return f"{base.number + 1:010d}-{uuid.uuid4().hex[:12]}"

    def place(self, table: str, token: str) -> str:
        """Where an attempt writes the changed days of a table."""
        return f"{self._tables[table]}/v={token}"

    def read(self, table: str, days: Days, schema: T.StructType) -> DataFrame:
        """The rows of some days, wherever they lie."""
        if not days:
            return self._spark.createDataFrame([], schema)
        root = self._tables[table]
        paths = [f"{root}/v={token}/{self._column}={day}" for day, token in sorted(days.items())]
        whole = T.StructType([*schema.fields, T.StructField("v", T.StringType())])
        return self._spark.read.schema(whole).option("basePath", root).parquet(*paths).select(*schema.names)

    def changed(self, base: Version, token: str, days: Iterable[str]) -> dict[str, dict[str, str]]:
        """The tables of the next version: ``days`` from the attempt's folders, where they have rows, others as before."""
        gone = set(days)
        out = {}
        for name in self._tables:
            kept = {d: t for d, t in base.tables.get(name, {}).items() if d not in gone}
            out[name] = kept | dict.fromkeys(partition_values(self._spark, self.place(name, token), self._column), token)
        return out

    def note(self, token: str, days: Iterable[str]) -> None:
        """Leave the changed days of an attempt that is about to be published."""
        create_once(self._spark, f"{self._folder}/begun-{token}.json", json.dumps({"days": sorted(days)}))

    def unfinished(self, base: Version) -> set[str]:
        """Days of attempts after ``base`` that did not become a version."""
        days: set[str] = set()
        for name in self._listed("begun-"):
            if int(name[len("begun-") :].split("-")[0]) > base.number:
                days.update(json.loads(read_text(self._spark, f"{self._folder}/{name}"))["days"])
        return days

    def commit(self, base: Version, tables: Mapping[str, Days]) -> Version:
        """Make the version after ``base``; raises if another writer has."""
        new = Version(base.number + 1, tables)
        text = json.dumps({"number": new.number, "tables": tables}, sort_keys=True)
        if not create_once(self._spark, f"{self._folder}/version-{new.number:010d}.json", text):
            raise ConcurrentWrite(f"version {new.number} of {self._folder} was made by another writer")
        return new

    def clean(self, keep: int = 2) -> None:
        """Delete what only versions before the last ``keep`` use, and their manifests and notes."""
        manifests = self._listed("version-")
        if not manifests:
            return
        last = [self._load(name) for name in manifests[-keep:]]
        system, folder = file_system(self._spark, self._folder)
        delete = lambda path: system.delete(self._spark._jvm.org.apache.hadoop.fs.Path(path), True)
        for name in manifests[:-keep]:
            delete(f"{self._folder}/{name}")
        for name in self._listed("begun-"):
            if int(name[len("begun-") :].split("-")[0]) <= last[-1].number:
                delete(f"{self._folder}/{name}")
        for table, root in self._tables.items():
            used = {token for version in last for token in version.tables.get(table, {}).values()}
            for token in partition_values(self._spark, root, "v"):
                if token not in used and int(token.split("-")[0]) <= last[-1].number:
                    delete(f"{root}/v={token}")
