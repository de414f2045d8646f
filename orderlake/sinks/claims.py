"""One run at a time on what follows a mark.

Before a run starts on the mark it has read, it creates a claim file of that
mark's name, which only one of several runs can. A run that fails releases its
claim; the claim of one that was killed is taken over once it is ``stale``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import SparkSession

from orderlake.sinks.versions import ConcurrentWrite, create_once
from orderlake.sources.tables import file_system

#: A claim this old is taken for that of a killed run.
STALE = timedelta(hours=6)


def _attempts(spark: SparkSession, folder: str) -> dict[str, dict[int, object]]:
    """For each mark its attempts' claim files."""
    system, place = file_system(spark, folder)
    out: dict[str, dict[int, object]] = {}
    for status in system.listStatus(place) if system.exists(place) else []:
        kind, _, rest = status.getPath().getName().partition("-")
        if kind == "claim":
            version, _, attempt = rest.rpartition("-")
            out.setdefault(version, {})[int(attempt)] = status
    return out


@contextmanager
def claimed(
    spark: SparkSession,
    home: str,
    version: str,
    current: Callable[[], str],
    stale: timedelta = STALE,
) -> Iterator[Callable[[], None]]:
    """Hold the work on ``version`` alone, or raise :class:`ConcurrentWrite`.

    ``current()`` reads the version again after the claim: one that moved on
    meanwhile was another run's. The value is a check to call before the mark is
    moved: it raises if the claim was taken over, that is if the run outlived
    ``stale``. A version's claims are deleted once it is done.
    """
    folder = f"{home.rstrip('/')}/_claims"
    system, _ = file_system(spark, folder)
    mine = _attempts(spark, folder).get(version, {})
    attempt = max(mine, default=-1)
    if attempt >= 0:
        released = system.exists(file_system(spark, f"{folder}/released-{version}-{attempt}")[1])
        age = time.time() - mine[attempt].getModificationTime() / 1000
        if not released and age < stale.total_seconds():
            raise ConcurrentWrite(f"another run has been at {version} for {age:.0f} s, see {folder}")
    attempt += 1
    if not create_once(spark, f"{folder}/claim-{version}-{attempt}", ""):
        raise ConcurrentWrite(f"another run has just begun at {version}, see {folder}")

    def check() -> None:
        if max(_attempts(spark, folder).get(version, {}), default=-1) != attempt:
            raise ConcurrentWrite(f"the work on {version} was taken over by another run, see {folder}")

    try:
        if current() != version:
            raise ConcurrentWrite(f"another run has done {version}, see {folder}")
        yield check
    finally:
        if current() == version:  # not done: the next run may try again
            create_once(spark, f"{folder}/released-{version}-{attempt}", "")
        else:
            _, place = file_system(spark, folder)
            for status in system.listStatus(place):
                if status.getPath().getName().partition("-")[2].rpartition("-")[0] == version:
                    system.delete(status.getPath(), False)
