"""Changed days, or new rows, of a table in a database, each batch exactly once.

The batch's rows go to staging tables first, by as many tasks as wanted. One
transaction then asks a ledger for the batch, replaces the days from the staged
rows and enters the batch. A batch that comes again finds its entry and changes
nothing; one that fails anywhere leaves the table as it was.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping
from functools import partial
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.schemas import GOLD_SCHEMA
from orderlake.sinks.jdbc import write_jdbc

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*")
_BATCH = re.compile(r"[A-Za-z0-9_.:-]{1,200}")


class LedgerTable:
    """A table whose days are replaced batch by batch.

    ``connect`` gives a new connection of any DB-API module, in manual commit
    mode; only the driver calls it. ``stage(rows, table)`` appends rows to a
    table of the same database and creates it if it is absent, as
    :func:`write_jdbc` does. A repeated task may stage rows twice: rows are keyed,
    so equal ones are one.
    """

    def __init__(self, connect: Callable[[], Any], stage: Callable[[DataFrame, str], None], table: str = "daily_sales", day: str = "order_date"):
        for name in (table, day):
            if not _NAME.fullmatch(name):
                raise ValueError(f"not a plain name: {name!r}")
        self._connect, self._stage, self.table, self._day = connect, stage, table, day
        self.ledger, self._rows, self._days = f"{table}_batches", f"{table}_staged", f"{table}_staged_days"
        self._new = f"{table}_staged_new"

    @classmethod
    def by_jdbc(cls, connect: Callable[[], Any], url: str, table: str, options: Mapping[str, str] | None = None) -> LedgerTable:
        """Staged by Spark's JDBC writer, which has to reach the same database as ``connect``."""
        return cls(connect, lambda rows, name: write_jdbc(rows, url, name, options, mode="append"), table)

    def _transaction(self, work: Callable[[Any], Any]) -> Any:
        connection = self._connect()
        try:
            cursor = connection.cursor()
            try:
                done = work(cursor)
            except BaseException:
                connection.rollback()
                raise
            finally:
                cursor.close()
            connection.commit()
            return done
        finally:
            connection.close()

    def _entered(self, batch: str, cursor: Any) -> bool:
        cursor.execute(f"SELECT count(*) FROM {self.ledger} WHERE batch = '{batch}'")
        return cursor.fetchone()[0] > 0

    def _begun(self, batch: str) -> bool:
        """Make the ledger if it is absent; whether the batch is in it."""
        if not _BATCH.fullmatch(batch):
            raise ValueError(f"not a batch name: {batch!r}")
        self._transaction(lambda c: c.execute(f"CREATE TABLE IF NOT EXISTS {self.ledger} (batch VARCHAR(200) NOT NULL PRIMARY KEY)"))
        return self._transaction(partial(self._entered, batch))

    def publish(self, batch: str, days: DataFrame, valid: DataFrame) -> bool:
        """Replace ``days`` (order_date) by the rows of ``valid``; ``False`` if the batch was published before."""
        if self._begun(batch):
            return False
        attempt = uuid.uuid4().hex
        columns = [c for c in GOLD_SCHEMA.names if c in valid.columns] or valid.columns
        mark = F.lit(attempt).cast("varchar(32)").alias("attempt")
        self._stage(valid.select(*columns).limit(0), self.table)
        self._stage(valid.select(*columns, mark), self._rows)
        self._stage(days.select(F.col(self._day), mark).filter(F.col(self._day).isNotNull()), self._days)
        return self._transaction(partial(self._replace, batch, attempt, columns))

    def _replace(self, batch: str, attempt: str, columns: list[str], cursor: Any) -> bool:
        mine, names = f"WHERE attempt = '{attempt}'", ", ".join(columns)
        published = not self._entered(batch, cursor)
        if published:
            # first, so that of two writers the second one waits or fails here
            cursor.execute(f"INSERT INTO {self.ledger} (batch) VALUES ('{batch}')")
            cursor.execute(f"DELETE FROM {self.table} WHERE {self._day} IN (SELECT {self._day} FROM {self._days} {mine})")
            cursor.execute(f"INSERT INTO {self.table} ({names}) SELECT DISTINCT {names} FROM {self._rows} {mine}")
        cursor.execute(f"DELETE FROM {self._rows} {mine}")
        cursor.execute(f"DELETE FROM {self._days} {mine}")
        return published

    def append(self, batch: str, rows: DataFrame) -> bool:
        """Add ``rows``, equal ones too; ``False`` if the batch was added before.

        Staged rows carry their place in their partition. A repeated task gives
        equal places to equal rows if it reads the same input, as tasks that read
        files or offsets do, so what it stages again counts once.
        """
        if self._begun(batch):
            return False
        attempt = uuid.uuid4().hex
        place = F.monotonically_increasing_id().alias("place")
        self._stage(rows.limit(0), self.table)
        self._stage(rows.select("*", place, F.lit(attempt).cast("varchar(32)").alias("attempt")), self._new)
        return self._transaction(partial(self._add, batch, attempt, ", ".join(rows.columns)))

    def _add(self, batch: str, attempt: str, names: str, cursor: Any) -> bool:
        mine = f"WHERE attempt = '{attempt}'"
        added = not self._entered(batch, cursor)
        if added:
            cursor.execute(f"INSERT INTO {self.ledger} (batch) VALUES ('{batch}')")
            once = f"SELECT DISTINCT place, {names} FROM {self._new} {mine}"
            cursor.execute(f"INSERT INTO {self.table} ({names}) SELECT {names} FROM ({once}) AS once")
        cursor.execute(f"DELETE FROM {self._new} {mine}")
        return added
