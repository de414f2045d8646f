"""Versioned gold tables and the batch ledger: whatever fails, readers see a whole state and no batch counts twice."""

import copy
import re
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest

from orderlake import jobs
from orderlake.operators.contract import gold_contract
from orderlake.operators.rollup import daily_sales
from orderlake.plans import gold as gold_plan
from orderlake.plans.gold import gold_versions, read_gold
from orderlake.plans.pipeline import Layout
from orderlake.schemas import GOLD_SCHEMA
from orderlake.sinks.ledger import LedgerTable
from orderlake.sinks.versions import ConcurrentWrite, Versions, create_once, read_text
from tests.helpers import dimensions, order
from tests.test_layers import gold, put, rows_of, silver


class Database:
    """Tables as lists of dicts; understands the ledger's statements and records them."""

    def __init__(self):
        self.tables, self.log, self.fail_at = {}, [], None

    def connect(self):
        return Connection(self)

    def stage(self, rows, table):
        self.tables.setdefault(table, []).extend(r.asDict() for r in rows.collect())

    def ledger_table(self):
        return LedgerTable(self.connect, self.stage)


class Connection:
    def __init__(self, database):
        self._database, self._open = database, copy.deepcopy(database.tables)

    def cursor(self):
        return self

    def execute(self, sql):
        database, t = self._database, self._open
        database.log.append(sql.split(" WHERE")[0])
        if database.fail_at is not None and re.match(database.fail_at, sql):
            raise ConnectionError("the database is gone")
        if m := re.fullmatch(r"CREATE TABLE IF NOT EXISTS (\w+) .*", sql):
            t.setdefault(m[1], [])
        elif m := re.fullmatch(r"SELECT count\(\*\) FROM (\w+) WHERE batch = '(.*)'", sql):
            self._row = (sum(r["batch"] == m[2] for r in t[m[1]]),)
        elif m := re.fullmatch(r"INSERT INTO (\w+) \(batch\) VALUES \('(.*)'\)", sql):
            t[m[1]].append({"batch": m[2]})
        elif m := re.fullmatch(r"DELETE FROM (\w+) WHERE (\w+) IN \(SELECT \2 FROM (\w+) WHERE attempt = '(\w+)'\)", sql):
            gone = {r[m[2]] for r in t[m[3]] if r["attempt"] == m[4]}
            t[m[1]] = [r for r in t[m[1]] if r[m[2]] not in gone]
        elif m := re.fullmatch(r"INSERT INTO (\w+) \((.*)\) SELECT DISTINCT \2 FROM (\w+) WHERE attempt = '(\w+)'", sql):
            names = m[2].split(", ")
            t[m[1]] += [dict(zip(names, k)) for k in {tuple(r[n] for n in names) for r in t[m[3]] if r["attempt"] == m[4]}]
        elif m := re.fullmatch(r"INSERT INTO (\w+) \((.*)\) SELECT \2 FROM \(SELECT DISTINCT place, \2 FROM (\w+) WHERE attempt = '(\w+)'\) AS once", sql):
            names = m[2].split(", ")
            rows = {tuple(r[n] for n in ["place", *names]) for r in t[m[3]] if r["attempt"] == m[4]}
            t[m[1]] += [dict(zip(names, row[1:])) for row in rows]
        elif m := re.fullmatch(r"DELETE FROM (\w+) WHERE attempt = '(\w+)'", sql):
            t[m[1]] = [r for r in t[m[1]] if r["attempt"] != m[2]]
        else:
            raise AssertionError(sql)

    def fetchone(self):
        return self._row

    def commit(self):
        self._database.log.append("COMMIT")
        self._database.tables = self._open

    def rollback(self):
        self._database.log.append("ROLLBACK")

    def close(self):
        pass


def published(database):
    return sorted((tuple(r[c] for c in GOLD_SCHEMA.names) for r in database.tables.get("daily_sales", [])), key=str)


def rollup(spark, layout):
    valid, _ = gold_contract(read_gold(spark, layout.gold))
    return sorted((tuple(r[c] for c in GOLD_SCHEMA.names) for r in valid.collect()), key=str)


def to(database):
    table = database.ledger_table()
    return {"publish_batch": lambda batch, days, valid, rejected: table.publish(batch, days, valid)}


@pytest.fixture(scope="module")
def dims(spark):
    return dimensions(spark)


def test_a_batch_is_one_transaction_and_counts_once(spark):
    database = Database()
    table = database.ledger_table()
    schema = "order_date date, neighborhood string, comune string, working_day string, total_quantity int, order_count int, average_delivery_time double, latitude double, longitude double"
    row = lambda day, n: (date(2024, 3, day), "n", "c", "M", n, 1, 1.0, 2.0, 3.0)
    days = lambda *d: spark.createDataFrame([(date(2024, 3, x),) for x in d], "order_date date")
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    assert table.publish("b1", days(1, 2), rows(row(1, 5), row(2, 6), row(2, 6)))  # a task that wrote twice
    assert published(database) == [row(1, 5), row(2, 6)]
    database.log.clear()
    assert table.publish("b2", days(2, 3), rows(row(3, 7)))  # day 2 has lost its rows
    assert published(database) == [row(1, 5), row(3, 7)]
    assert database.log[-7:] == [
        "SELECT count(*) FROM daily_sales_batches",
        "INSERT INTO daily_sales_batches (batch) VALUES ('b2')",
        "DELETE FROM daily_sales",
        "INSERT INTO daily_sales (" + ", ".join(GOLD_SCHEMA.names) + ") SELECT DISTINCT " + ", ".join(GOLD_SCHEMA.names) + " FROM daily_sales_staged",
        "DELETE FROM daily_sales_staged",
        "DELETE FROM daily_sales_staged_days",
        "COMMIT",
    ]
    before = copy.deepcopy(database.tables)
    assert not table.publish("b2", days(2, 3), rows(row(3, 8)))
    assert database.tables == before and not before["daily_sales_staged"]
    for step in ("INSERT INTO daily_sales_batches", "DELETE FROM daily_sales ", "INSERT INTO daily_sales ", "DELETE FROM daily_sales_staged_days"):
        database.fail_at = step
        with pytest.raises(ConnectionError):
            table.publish("b3", days(1), rows(row(1, 9)))
        assert published(database) == [row(1, 5), row(3, 7)] and database.log[-1] == "ROLLBACK"
        database.fail_at = None
    assert table.publish("b3", days(1), rows(row(1, 9))) and published(database) == [row(1, 9), row(3, 7)]
    with pytest.raises(ValueError):
        table.publish("'; --", days(1), rows())
    with pytest.raises(ValueError):
        LedgerTable(database.connect, database.stage, "a b")


STEPS = ["partials", "gold", "note", "before", "after", "commit", "committed", "progress", "clean"]


@pytest.mark.parametrize("step", STEPS)
def test_failure_at_any_step(spark, tmp_path, dims, monkeypatch, step):
    """A day loses all its rows and another one gets some: never is one of the two changes seen alone."""
    layout, database = Layout(str(tmp_path)), Database()
    put(spark, layout.bronze, [order(1), order(2, day=1)], "2024-03-05 10:00:00")
    silver(spark, layout, dims)
    gold(spark, layout, **to(database))
    first = rows_of(read_gold(spark, layout.gold))
    assert published(database) == rollup(spark, layout)
    # the slice comes again with other days
    for mark in (tmp_path / "silver_progress").rglob("*"):
        if mark.is_file():
            mark.unlink()
    for slot in (tmp_path / "silver_progress").iterdir():
        slot.rmdir()
    for old in (tmp_path / "bronze").rglob("*.parquet"):
        old.unlink()
        (old.parent / f".{old.name}.crc").unlink()
    put(spark, layout.bronze, [order(1), order(3, day=2)], "2024-03-05 10:00:00")
    silver(spark, layout, dims)
    second = rows_of(daily_sales(spark.read.parquet(layout.silver)))
    assert second != first
    options, seen, writes = to(database), [], []

    def failing(*args, **kwargs):
        raise RuntimeError(step)

    with monkeypatch.context() as patch:
        write = gold_plan._write_days
        if step in ("partials", "gold"):
            patch.setattr(gold_plan, "_write_days", lambda df, place: failing() if len(writes) == (step == "gold") else writes.append(place) or write(df, place))
        elif step in ("note", "commit", "clean"):
            patch.setattr(Versions, step, failing)
        elif step == "committed":
            commit = Versions.commit
            patch.setattr(Versions, "commit", lambda *a: (commit(*a), failing()))
        elif step == "progress":
            patch.setattr(gold_plan, "write_progress", failing)
        elif step == "before":
            options = {"publish_batch": failing}
        elif step == "after":
            publish = options["publish_batch"]
            options = {"publish_batch": lambda *a: (publish(*a), failing())}
        with pytest.raises(RuntimeError, match=step):
            gold(spark, layout, **options)
    seen = rows_of(read_gold(spark, layout.gold))
    assert seen == (second if step in ("committed", "progress", "clean") else first)
    entered = len(database.tables["daily_sales_batches"])
    done = gold(spark, layout, **to(database))
    assert done["rows"] == (None if step == "clean" else 2)
    assert rows_of(read_gold(spark, layout.gold)) == second and published(database) == rollup(spark, layout)
    if step in ("after", "commit"):  # told to the database before: the same batch again
        assert len(database.tables["daily_sales_batches"]) == entered == 2


def test_days_of_a_dead_attempt_are_published_again(spark, tmp_path, dims):
    """An attempt told a day to the database and died; then its slice came again without that day."""
    layout, database = Layout(str(tmp_path)), Database()
    put(spark, layout.bronze, [order(1)], "2024-03-05 10:00:00")
    silver(spark, layout, dims)
    versions = gold_versions(spark, layout.partials, layout.gold)
    base = versions.latest()
    versions.note(versions.token(base), ["2024-03-09"])
    database.tables["daily_sales"] = [dict(zip(GOLD_SCHEMA.names, (date(2024, 3, 9), "n", "c", "M", 1, 1, 1.0, 1.0, 1.0)))]
    gold(spark, layout, **to(database))
    assert published(database) == rollup(spark, layout) and len(published(database)) == 1
    assert versions.unfinished(versions.latest()) == set()


def test_of_two_writers_one_goes_on(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "t"), {"t": str(tmp_path / "t")})
    base = versions.latest()
    assert base == (0, {"t": {}})

    def write(i):
        try:
            return versions.commit(base, {"t": {"2024-03-01": f"0000000001-{i}"}})
        except ConcurrentWrite:
            return None

    with ThreadPoolExecutor(8) as pool:
        done = [v for v in pool.map(write, range(8)) if v is not None]
    assert len(done) == 1 and versions.latest() == done[0]


def test_create_once(spark, tmp_path):
    path = str(tmp_path / "folder" / "a.json")
    assert create_once(spark, path, "é one") and not create_once(spark, path, "two")
    assert read_text(spark, path) == "é one"
    assert sorted(p.name for p in (tmp_path / "folder").iterdir() if not p.name.endswith(".crc")) == ["a.json"]


def test_old_versions_are_deleted(spark, tmp_path, dims):
    layout = Layout(str(tmp_path))
    for day in range(4):
        put(spark, layout.bronze, [order(day, day=day % 2)], f"2024-03-05 1{day}:00:00")
        silver(spark, layout, dims)
        before = read_gold(spark, layout.gold)
        expected = None if before is None else rows_of(before)
        gold(spark, layout)
        if before is not None:  # a reader that began before
            assert rows_of(before) == expected
    assert len(list((tmp_path / "gold").glob("v=*"))) == 3 and len(list((tmp_path / "gold" / "_versions").glob("version-*.json"))) == 2
    assert rows_of(read_gold(spark, layout.gold)) == rows_of(daily_sales(spark.read.parquet(layout.silver)))


DATABASE = Database()


def connect():
    return DATABASE.connect()


def test_the_command_publishes_changed_days(spark, tmp_path, dims, monkeypatch):
    layout = Layout(str(tmp_path))
    monkeypatch.setattr("orderlake.sinks.ledger.write_jdbc", lambda rows, url, name, options, mode: DATABASE.stage(rows, name))
    argv = ["gold", "--root", str(tmp_path), "--connect", "tests.test_versions:connect"]
    with pytest.raises(SystemExit):
        jobs.main(argv, spark)
    for hour, lines in ((10, [order(1), order(2, day=1)]), (11, [order(3, day=1), order(4, x=9.5)])):
        put(spark, layout.bronze, lines, f"2024-03-05 {hour}:00:00")
        silver(spark, layout, dims)
        jobs.main([*argv, "--jdbc-url", "jdbc:x"], spark)
    assert published(DATABASE) == rollup(spark, layout) and len(DATABASE.tables["daily_sales_batches"]) == 2
    rejected = spark.read.parquet(str(tmp_path / "gold_rejected"))
    assert rejected.count() == 1 and "batch" in rejected.columns
