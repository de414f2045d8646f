"""Keys that earlier slices held, kept as levelled runs between them.

A run is a folder of 128-bit digests. Each slice adds one run; once ``fan_in`` of
a level are there they are written as one of the next level, so a key is copied
some log(slices) times and no slice is read again. Runs have no key in common,
as a slice adds only what no earlier one held.

A slice is checked in one pass over the runs. Two bitmaps of the slice's digests,
a Bloom filter with a bound on its size, go to the tasks that read the runs: only
digests that may be in the slice leave these tasks, so history is never shuffled.

A manifest per state tells which runs count, made at one stroke and only if no
other writer has made it. A repeated attempt at a slice does not see what the
failed one added, and replaces it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.sinks.scratch import written
from orderlake.sinks.versions import ConcurrentWrite, create_once, read_text
from orderlake.sources.tables import file_system

_SCHEMA = "_k1 long, _k2 long"
#: Fixed value: bits in one bitmap of Spark's bitmap functions.
_BITMAP = 32768


class Run(NamedTuple):
    """Digests of the slices ``first`` to ``last``, in a folder of that name."""

    name: str
    level: int
    first: int
    last: int


def digests(keys: Sequence[str]) -> list[Column]:
    """Two hashes of a key; a null is a value of its own."""
    parts = [c for key in keys for c in (F.col(key), F.isnull(key))]
    return [F.xxhash64(*parts).alias("_k1"), F.xxhash64(F.lit("second"), *parts).alias("_k2")]


class SeenKeys:
    """The keys of all slices so far, in ``folder``.

    ``filter_bits`` bounds each of the two bitmaps that are broadcast, by default
    to 32 MB. A slice of more than a sixteenth as many keys still gives the same
    result; more of the history is then shuffled.
    """

    def __init__(self, spark: SparkSession, folder: str, fan_in: int = 8, filter_bits: int = 1 << 28):
        if fan_in < 2:
            raise ValueError("fan_in must be 2 or more")
        self._spark, self._folder, self._fan_in, self._filter_bits = spark, folder.rstrip("/"), fan_in, filter_bits

    def _manifests(self) -> list[str]:
        system, place = file_system(self._spark, f"{self._folder}/states")
        names = [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []
        return sorted(n for n in names if n.startswith("state-") and n.endswith(".json"))

    def _state(self) -> tuple[int, list[Run]]:
        names = self._manifests()
        if not names:
            return 0, []
        told = json.loads(read_text(self._spark, f"{self._folder}/states/{names[-1]}"))
        return told["number"], [Run(*run) for run in told["runs"]]

    def runs(self) -> list[Run]:
        """The runs that count, oldest first."""
        return sorted(self._state()[1], key=lambda run: run.first)

    def _earlier(self, runs: Sequence[Run], slice_id: int) -> list[Run]:
        for run in runs:
            if run.first < slice_id <= run.last:
                raise ValueError(f"slice {slice_id} lies within the merged run {run.name}: begin {self._folder} anew")
        return [run for run in runs if run.last < slice_id]

    def _read(self, runs: Sequence[Run]) -> DataFrame:
        return self._spark.read.schema(_SCHEMA).parquet(*[f"{self._folder}/{run.name}" for run in runs])

    def unseen(
        self, rows: DataFrame, keys: Sequence[str], slice_id: int, count: int | None = None
    ) -> tuple[DataFrame, Callable[[], None]]:
        """``rows`` whose key no slice before ``slice_id`` held, and a function that enters their keys.

        ``rows`` is read several times: let it be a written table. ``count``:
        its rows, if known. Rows of one key all stay or all go. What failed
        attempts at this slice, or at later ones, entered is replaced. Nothing
        counts before the function is called, once the slice is written.
        """
        number, runs = self._state()
        earlier = self._earlier(runs, slice_id)
        marked = rows.select("*", *digests(keys))
        new = marked.select("_k1", "_k2").distinct()
        if earlier:
            n = rows.count() if count is None else count
            new = new.join(self._may_hold(self._read(earlier), marked.select("_k1", "_k2"), n), ["_k1", "_k2"], "left_anti")
        run = Run(self._name(number), 0, slice_id, slice_id)
        # the history is read for this write alone
        new = written(new, f"{self._folder}/{run.name}")
        first = marked.join(new, ["_k1", "_k2"], "left_semi").select(*rows.columns)
        return first, lambda: self._enter(number, earlier, run)

    def _may_hold(self, history: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
        """Rows of ``history`` that may be among the ``n`` rows of ``wanted``; none that is goes."""
        bits = _BITMAP
        while bits < 16 * n and bits < self._filter_bits:
            bits *= 2
        for key in ("_k1", "_k2"):
            # from 1 on, where bucket and bit number each other without gaps
            place = F.pmod(F.col(key), F.lit(bits)) + 1
            bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
            maps = wanted.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
            byte = F.conv(F.hex(F.substring("_bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            held = history.withColumn("_bucket", bucket).withColumn("_bit", bit)
            # at most filter_bits / 8 bytes
            held = held.join(F.broadcast(maps), "_bucket")
            history = held.filter(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1).select("_k1", "_k2")
        return history

    def _enter(self, number: int, runs: list[Run], new: Run) -> None:
        # the newest slice may be written again, so only those before it are merged
        level = 0
        while len(full := [run for run in runs if run.level == level]) >= self._fan_in:
            merged = Run(self._name(number), level + 1, min(r.first for r in full), max(r.last for r in full))
            written(self._read(full), f"{self._folder}/{merged.name}")
            runs = [run for run in runs if run not in full] + [merged]
            level += 1
        runs = [*runs, new]
        told = json.dumps({"number": number + 1, "runs": [list(run) for run in runs]})
        if not create_once(self._spark, f"{self._folder}/states/state-{number + 1:010d}.json", told):
            raise ConcurrentWrite(f"state {number + 1} of {self._folder} was made by another writer")
        self._clean(number + 1, {run.name for run in runs})

    @staticmethod
    def _name(number: int) -> str:
        return f"run-{number + 1:010d}-{uuid.uuid4().hex[:12]}"

    def _clean(self, number: int, used: set[str]) -> None:
        """Delete the runs of attempts up to ``number`` that don't count, and older manifests."""
        system, root = file_system(self._spark, self._folder)
        path = self._spark._jvm.org.apache.hadoop.fs.Path
        for status in system.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("run-") and name not in used and int(name.split("-")[1]) <= number:
                system.delete(status.getPath(), True)
        for name in self._manifests()[:-1]:
            system.delete(path(f"{self._folder}/states/{name}"), False)
