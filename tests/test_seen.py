"""Keys over slices, claims of runs and batches of a stream: repeated and rival attempts leave one copy."""

import os
import random
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from orderlake.plans import silver as silver_plan
from orderlake.plans.pipeline import Layout, run_pipeline
from orderlake.sinks import claims
from orderlake.sinks.claims import claimed
from orderlake.sinks.ledger import LedgerTable
from orderlake.sinks.seen import SeenKeys
from orderlake.sinks.versions import ConcurrentWrite
from orderlake.sources.lines import stream_lines
from orderlake.streaming.bronze import run_bronze
from tests.helpers import dimensions, order
from tests.test_layers import put, silver
from tests.test_versions import Database


@pytest.fixture(scope="module")
def dims(spark):
    return dimensions(spark)


def keys_of(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("filter_bits", [1 << 15, 1 << 20])
def test_runs_of_keys_against_a_set(spark, tmp_path, filter_bits):
    """A filter with room, and one so full that it lets everything through, give the same rows."""
    draw = random.Random(filter_bits)
    state = lambda: SeenKeys(spark, str(tmp_path / "seen"), fan_in=2, filter_bits=filter_bits)
    held, copied = set(), []
    for i in range(7):
        # negative and null parts, keys of one slice twice
        wanted = [(draw.choice([None, "a", "b", ""]), draw.randrange(-400, 400)) for _ in range(6000 if i == 3 else 300)]
        rows = spark.createDataFrame(wanted, "a string, n int")
        first, enter = state().unseen(rows, ["a", "n"], i * 10)
        assert keys_of(first) == sorted([tuple(w) for w in wanted if w not in held], key=str)
        # entered twice: a failed attempt saw other rows
        if i == 4:
            enter()
            first, enter = state().unseen(rows.filter("n > 0"), ["a", "n"], i * 10)
            wanted = [w for w in wanted if w[1] > 0]
            assert keys_of(first) == sorted([w for w in wanted if w not in held], key=str)
        enter()
        held |= set(wanted)
        copied.append([(r.level, r.first, r.last) for r in state().runs()])
    assert copied[2:4] == [[(1, 0, 10), (0, 20, 20)], [(1, 0, 10), (0, 20, 20), (0, 30, 30)]]
    runs = state().runs()
    assert state()._read(runs).count() == state()._read(runs).distinct().count() == len(held)
    # nothing else is left in the folder
    assert {p.name for p in (tmp_path / "seen").iterdir()} == {"states", *[r.name for r in runs]}
    with pytest.raises(ValueError):
        state().unseen(rows, ["a", "n"], 10)


def test_history_is_read_but_not_shuffled(spark, tmp_path):
    seen = SeenKeys(spark, str(tmp_path / "seen"))
    _, enter = seen.unseen(spark.range(200_000), ["id"], 0)
    enter()
    rows = spark.range(199_000, 201_000)
    from orderlake.sinks.seen import digests

    may = seen._may_hold(seen._read(seen.runs()), rows.select(*digests(["id"])), 2000)
    assert 1000 <= may.count() <= 1000 + 200_000 / 100
    plan = may._jdf.queryExecution().executedPlan().toString()
    # the bitmaps are exchanged, the runs are not
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan and "Python" not in plan
    assert seen.unseen(rows, ["id"], 1)[0].count() == 1000


def test_two_slices_hold_an_order_once(spark, tmp_path, dims, monkeypatch):
    layout = Layout(str(tmp_path))
    once = {"once_by": ["order_id"], "seen": layout.silver_seen}
    ids = lambda: sorted((r.order_id, r.quantity_products) for r in spark.read.parquet(layout.silver).collect())
    put(spark, layout.bronze, [order(1), order(1, quantity_products=9), order(2)], "2024-03-01 10:00:00")
    put(spark, layout.bronze, [order(1, quantity_products=50)], "2024-03-01 09:00:00")
    assert silver(spark, layout, dims, **once)["rows"] == 2
    assert ids() == [("o1", 50), ("o2", 3)]  # the one that arrived first
    put(spark, layout.bronze, [order(2), order(3), "junk"], "2024-03-02 10:00:00")

    def crash(*args):
        raise RuntimeError("lost")

    # keys are entered but the mark does not move: the slice comes again, with one order more
    with monkeypatch.context() as patch:
        patch.setattr(silver_plan, "write_progress", crash)
        with pytest.raises(RuntimeError):
            silver(spark, layout, dims, **once)
    put(spark, layout.bronze, [order(4)], "2024-03-02 11:00:00")
    assert silver(spark, layout, dims, **once)["rows"] == 2
    assert ids() == [("o1", 50), ("o2", 3), ("o3", 4), ("o4", 5)]
    put(spark, layout.bronze, [order(i) for i in range(1, 5)], "2024-03-03 10:00:00")
    assert silver(spark, layout, dims, **once)["rows"] == 0
    assert len(ids()) == 4
    with pytest.raises(ValueError):
        silver(spark, layout, dims, seen=layout.silver_seen)


def test_pipeline_with_orders_sent_again(spark, tmp_path, dims):
    (tmp_path / "in").mkdir()
    layout = Layout(str(tmp_path / "lake"))
    for i, lines in enumerate([[order(1), order(2)], [order(2), order(3)]]):
        (tmp_path / "in" / f"{i}.txt").write_text("\n".join(lines))
        run_pipeline(spark, stream_lines(spark, path=str(tmp_path / "in")), layout, *dims, once_by=["order_id"])
    assert spark.read.parquet(layout.silver).count() == 3


def test_of_two_runs_started_together_one_goes_on(spark, tmp_path, dims, monkeypatch):
    layout = Layout(str(tmp_path))
    put(spark, layout.bronze, [order(i) for i in range(20)], "2024-03-01 10:00:00")

    def run(_):
        try:
            return silver(spark, layout, dims)
        except ConcurrentWrite as error:
            return str(error)

    with ThreadPoolExecutor(3) as pool:
        done = list(pool.map(run, range(3)))
    # a run that starts after the end of another finds nothing new
    worked = [d for d in done if isinstance(d, dict) and d["rows"] == 20]
    assert len(worked) == 1 and all(isinstance(d, str) or d["rows"] in (20, None) for d in done)
    assert spark.read.parquet(layout.silver).count() == 20
    assert [p for p in os.listdir(f"{layout.silver_progress}/_claims") if not p.startswith(".")] == []


def test_claims(spark, tmp_path):
    home, at = str(tmp_path / "home"), ["5"]
    claim = lambda version="5", stale=claims.STALE: claimed(spark, home, version, lambda: at[0], stale)
    with claim():
        for _ in range(2):
            with pytest.raises(ConcurrentWrite, match="another run has been"):
                with claim():
                    pass
    # ended without moving the mark, or failed: free again
    with pytest.raises(KeyError):
        with claim():
            raise KeyError
    with claim() as check:
        check()
        # a killed run never releases; its claim is taken over when it is stale
        with claim(stale=timedelta(0)) as other:
            other()
            with pytest.raises(ConcurrentWrite, match="taken over"):
                check()
            at[0] = "6"
    with pytest.raises(ConcurrentWrite, match="has done 5"):
        with claim():
            pass
    assert [p for p in os.listdir(f"{home}/_claims") if not p.startswith(".")] == []
    at[0] = "-7"
    with claim("-7"):
        with pytest.raises(ConcurrentWrite):
            with claim("-7"):
                pass


def test_a_batch_handed_twice_leaves_one_copy(spark, tmp_path):
    database = Database()
    stages = []

    def stage(rows, table):
        stages.append(table)
        database.stage(rows, table)
        if table.endswith("_new"):  # a task that wrote twice
            database.stage(rows, table)

    target = LedgerTable(database.connect, stage, "raw_lines")
    values = lambda: sorted(r["value"] for r in database.tables["raw_lines"])
    (tmp_path / "in").mkdir()
    check = tmp_path / "check"

    def run():
        lines = stream_lines(spark, path=str(tmp_path / "in"))
        run_bronze(lines, "", str(check), {"availableNow": True}, target=target).awaitTermination()

    (tmp_path / "in" / "a.txt").write_text("one\ntwo\ntwo\n")  # equal lines are two rows
    run()
    assert values() == ["one", "two", "two"]
    # the batch is in the table but not in the checkpoint, as after a crash between the two
    for name in os.listdir(check / "commits"):
        if name.strip(".").startswith("0"):
            os.remove(check / "commits" / name)
    staged = len(stages)
    run()
    assert values() == ["one", "two", "two"] and len(stages) == staged
    # a failure in the transaction leaves the batch out as a whole; it comes again on restart
    (tmp_path / "in" / "b.txt").write_text("three\n")
    database.fail_at = "INSERT INTO raw_lines "
    with pytest.raises(StreamingQueryException):
        run()
    assert values() == ["one", "two", "two"]
    database.fail_at = None
    run()
    assert values() == ["one", "three", "two", "two"]
    # another stream has batches of its own
    other = stream_lines(spark, path=str(tmp_path / "in"))
    run_bronze(other, "", str(tmp_path / "check2"), {"availableNow": True}, target=target).awaitTermination()
    assert len(values()) == 8
    with pytest.raises(ValueError):
        run_bronze(other, "", str(check), target=target, write_batch=lambda *_: None)
