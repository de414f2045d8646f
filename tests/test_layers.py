import time
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from orderlake.functions.times import to_micros
from orderlake.operators.contract import gold_contract
from orderlake.operators.ingest import ingest_partitions
from orderlake.operators.rollup import daily_partials, daily_sales, merge_partials, rollup_affected_days
from orderlake.plans.gold import read_gold, read_partials, run_gold
from orderlake.plans.pipeline import Layout, run_pipeline
from orderlake.plans.silver import run_silver
from orderlake.schemas import GOLD_SCHEMA
from orderlake.sinks.progress import Mark, last_mark, write_progress
from orderlake.sources.lines import stream_lines
from orderlake.sinks.parquet import write_slice
from orderlake.sources.tables import read_bronze, read_ranges, read_slices
from orderlake.streaming.bronze import run_bronze
from tests.helpers import dimensions, order

UTC = timezone.utc


@pytest.fixture(scope="module")
def dims(spark):
    return dimensions(spark)


def put(spark, root, lines, at):
    """Append raw rows as if they had been ingested at ``at``."""
    df = spark.createDataFrame([(l,) for l in lines], "value string").withColumn(
        "timestamp", F.lit(at).cast("timestamp")
    )
    ingest_partitions(df).coalesce(1).write.mode("append").partitionBy("year", "month", "day").parquet(root)


def silver(spark, layout, dims, **options):
    return run_silver(spark, layout.bronze, layout.silver, layout.silver_progress, *dims, **options)


def gold(spark, layout, **options):
    return run_gold(spark, layout.silver, layout.partials, layout.gold, layout.gold_progress, **options)


def rows_of(df):
    out = []
    for r in df.select(*GOLD_SCHEMA.names).collect():
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(out, key=str)


def test_stream_ingest_is_exactly_once_over_restarts(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "bronze", "check"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\n\ntwo\n")
    run = lambda: run_bronze(stream_lines(spark, path=source), out, check, {"availableNow": True}).awaitTermination()
    run()
    run()
    (tmp_path / "in" / "b.txt").write_text("two\n")
    run()
    raw = read_bronze(spark, out)
    assert sorted(r["value"] for r in raw.collect()) == ["", "one", "two", "two"]
    assert raw.columns == ["value", "timestamp", "year", "month", "day"]
    assert raw.filter("year = year(timestamp) and month = month(timestamp) and day = day(timestamp)").count() == 4
    # one ingest time per micro-batch
    assert raw.select("timestamp").distinct().count() == 2
    assert raw.filter("value = 'two'").select("timestamp").distinct().count() == 2


def test_failing_batch_is_read_again(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\ntwo\n")
    seen = []

    def failing(batch, batch_id):
        raise RuntimeError("target is down")

    def working(batch, batch_id):
        seen.append((batch_id, sorted(r["value"] for r in batch.collect())))

    def run(write):
        lines = stream_lines(spark, path=str(tmp_path / "in"))
        query = run_bronze(lines, "", str(tmp_path / "check"), {"availableNow": True}, write_batch=write)
        query.awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(failing)
    run(working)
    assert seen == [(0, ["one", "two"])]


def test_default_trigger_and_file_limit(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(12):
        (tmp_path / "in" / f"{i}.txt").write_text(f"{i}\n")
    lines = stream_lines(spark, path=str(tmp_path / "in"))
    query = run_bronze(lines, str(tmp_path / "out"), str(tmp_path / "check"), files=1)
    try:
        # the first batch starts at once, the next after two minutes
        deadline = time.time() + 60
        while query.lastProgress is None and time.time() < deadline:
            time.sleep(0.2)
    finally:
        query.stop()
    raw = read_bronze(spark, str(tmp_path / "out"))
    assert raw.count() == 12 and len(raw.inputFiles()) == 1


def test_socket_and_other_sources_have_one_value_column(spark):
    lines = stream_lines(spark, "socket", host="localhost", port=1)
    assert lines.isStreaming and lines.dtypes == [("value", "string")]


def test_bronze_days_are_pruned(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for day in (1, 10, 20, 28):
        put(spark, root, [f"line {day}"], f"2024-03-{day:02d} 12:00:00")
    kept = read_bronze(spark, root, "2024-03-10 13:00:00", "2024-03-20 12:00:00")
    assert sorted(r["value"] for r in kept.collect()) == ["line 10", "line 20"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "make_date" in plan.split("PartitionFilters")[1]
    assert read_bronze(spark, str(tmp_path / "absent")) is None


def test_bronze_with_partition_columns_also_in_the_files(spark, tmp_path):
    root = str(tmp_path / "bronze")
    df = spark.createDataFrame([("x",)], "value string").withColumn("timestamp", F.lit("2024-03-05 01:00:00").cast("timestamp"))
    ingest_partitions(df).write.parquet(f"{root}/year=2024/month=3/day=5")
    row = read_bronze(spark, root, "2024-03-01").first()
    assert (row["value"], row["year"], row["month"], row["day"]) == ("x", 2024, 3, 5)


def test_silver_rows(spark, tmp_path, dims):
    layout = Layout(str(tmp_path))
    good = order(1, x=1.5)
    put(spark, layout.bronze, [good, good, "", "garbage", "[]", None, order(2, x=0.0), order(3, latitude=None)], "2024-03-01 10:00:00")
    put(spark, layout.bronze, [good], "2024-03-01 10:05:00")
    done = silver(spark, layout, dims)
    assert done["rows"] == 3
    assert done["high"] == datetime(2024, 3, 1, 10, 5, tzinfo=UTC)
    table = spark.read.parquet(layout.silver)
    assert table.columns == [
        "latitude", "longitude", "order_date", "dispatch_date", "delivery_date", "customer_id",
        "employee_id", "quantity_products", "order_id", "order_hour", "order_minute", "time_delivery",
        "working_day", "processed_date", "employee_name", "customer_name", "neighborhood", "comune", "slice_day", "slice_id",
    ]
    rows = sorted(table.collect(), key=lambda r: r["order_id"])
    assert [r["order_id"] for r in rows] == ["o1", "o1", "o2"]
    first, last = rows[0], rows[-1]
    assert (first["order_hour"], first["order_minute"], first["time_delivery"], first["working_day"]) == (9, 1, 31.0, "M")
    assert (first["employee_name"], first["customer_name"], first["neighborhood"], first["comune"]) == ("e1", "c1", "n1", "c1")
    # on an edge: in no area, and kept
    assert (last["employee_name"], last["neighborhood"], last["comune"]) == (None, None, None)


def test_silver_slices_neither_lose_nor_repeat(spark, tmp_path, dims):
    layout = Layout(str(tmp_path))
    assert silver(spark, layout, dims)["rows"] is None
    put(spark, layout.bronze, [order(1)], "2024-03-01 10:00:00")
    assert silver(spark, layout, dims)["rows"] == 1
    assert silver(spark, layout, dims)["rows"] is None
    put(spark, layout.bronze, [order(2), order(3)], "2024-03-01 10:00:00.000001")
    assert silver(spark, layout, dims)["rows"] == 2
    put(spark, layout.bronze, ["garbage"], "2024-03-01 11:00:00")
    assert silver(spark, layout, dims)["rows"] == 0
    assert silver(spark, layout, dims)["rows"] is None
    assert spark.read.parquet(layout.silver).count() == 3


def test_silver_repeats_a_slice_whose_mark_was_not_written(spark, tmp_path, dims):
    layout = Layout(str(tmp_path))
    put(spark, layout.bronze, [order(1)], "2024-03-01 10:00:00")
    silver(spark, layout, dims)
    before = last_mark(spark, layout.silver_progress)
    put(spark, layout.bronze, [order(2)], "2024-03-01 10:10:00")
    silver(spark, layout, dims)
    gold(spark, layout)
    # as if the run had died before its mark, and more had come since
    again = Layout(str(tmp_path))
    lost = str(tmp_path / "lost_progress")
    write_progress(spark, lost, before)
    put(spark, layout.bronze, [order(3)], "2024-03-01 10:20:00")
    done = run_silver(spark, again.bronze, again.silver, lost, *dims, now=datetime(2024, 1, 2, tzinfo=UTC))
    assert done["rows"] == 2
    assert sorted(r["order_id"] for r in spark.read.parquet(layout.silver).collect()) == ["o1", "o2", "o3"]
    gold(spark, layout)
    table = read_gold(spark, layout.gold)
    assert table.agg(F.sum("order_count")).first()[0] == 3


def test_stamp_grows_even_if_the_clock_goes_back(spark, tmp_path, dims):
    layout = Layout(str(tmp_path))
    now = datetime(2024, 3, 5, tzinfo=UTC)
    put(spark, layout.bronze, [order(1)], "2024-03-01 10:00:00")
    silver(spark, layout, dims, now=now)
    gold(spark, layout)
    put(spark, layout.bronze, [order(2)], "2024-03-01 10:10:00")
    silver(spark, layout, dims, now=now - timedelta(hours=1))
    assert gold(spark, layout)["rows"] == 1
    assert read_gold(spark, layout.gold).agg(F.sum("order_count")).first()[0] == 2


def test_long_backlog_is_cut_by_span(spark, tmp_path, dims):
    layout = Layout(str(tmp_path))
    for day in (1, 2, 9):
        put(spark, layout.bronze, [order(day, day)], f"2024-03-{day:02d} 10:00:00")
    highs = []
    while (done := silver(spark, layout, dims, span=timedelta(days=1)))["rows"] is not None:
        highs.append(done["high"].day)
    assert highs == [2, 9]
    assert spark.read.parquet(layout.silver).count() == 3


def test_gold_keeps_one_row_per_key_over_slices(spark, tmp_path, dims):
    layout = Layout(str(tmp_path))
    assert gold(spark, layout)["rows"] is None
    published = {}

    def publish(valid, rejected):
        published["valid"] = rows_of(valid)
        published["rejected"] = [r["reject_reason"] for r in rejected.collect()]

    batches = [
        [order(1), order(2, x=1.5), order(3, day=1)],
        [order(4), order(5, hour=15), order(6, x=9.5)],
        [order(7, day=1), order(8, day=0, x=1.25)],
    ]
    for i, lines in enumerate(batches):
        put(spark, layout.bronze, lines, f"2024-03-02 1{i}:00:00")
        silver(spark, layout, dims)
        gold(spark, layout, publish=publish)
        assert gold(spark, layout)["rows"] is None
    whole = daily_sales(spark.read.parquet(layout.silver))
    assert rows_of(read_gold(spark, layout.gold)) == rows_of(whole)
    assert published["rejected"] == ["neighborhood, comune"]
    assert len(published["valid"]) == whole.count() - 1


def test_gold_does_not_touch_other_days(spark, tmp_path, dims):
    layout = Layout(str(tmp_path))
    put(spark, layout.bronze, [order(1), order(2, day=1)], "2024-03-02 10:00:00")
    silver(spark, layout, dims)
    gold(spark, layout)
    before = set(read_gold(spark, layout.gold).inputFiles())
    put(spark, layout.bronze, [order(3, day=1)], "2024-03-02 11:00:00")
    silver(spark, layout, dims)
    assert gold(spark, layout)["rows"] == 1
    after = set(read_gold(spark, layout.gold).inputFiles())
    assert any("order_date=2024-03-01" in f for f in before & after)
    assert not any("order_date=2024-03-02" in f for f in before & after)


def test_new_slices_are_found_however_many_days_lie_between(spark, tmp_path, dims):
    layout = Layout(str(tmp_path))
    for n, at in enumerate(["2024-03-01 10:00:00", "2024-03-01 23:59:59", "2025-01-07 00:00:01", "2099-01-01 00:00:00", "2099-01-02 00:00:00"]):
        put(spark, layout.bronze, [order(2 * n, day=n), order(2 * n + 1, day=0)], at)
        silver(spark, layout, dims)
        gold(spark, layout)
    assert rows_of(read_gold(spark, layout.gold)) == rows_of(daily_sales(spark.read.parquet(layout.silver)))
    assert read_gold(spark, layout.gold).agg(F.sum("order_count")).first()[0] == 10


def agree(spark, layout, valid):
    """Silver has every valid line once, and gold is its rollup."""
    table = spark.read.parquet(layout.silver)
    assert sorted(r["order_id"] for r in table.collect()) == valid
    whole = daily_sales(table)
    assert rows_of(read_gold(spark, layout.gold)) == rows_of(whole)


def lose(path):
    for file in sorted(Path(path).rglob("*"), reverse=True):
        file.unlink() if file.is_file() else file.rmdir()
    Path(path).rmdir()


def test_lost_mark_and_shorter_span(spark, tmp_path, dims):
    layout = Layout(str(tmp_path))
    put(spark, layout.bronze, [order(1), order(2, day=1)], "2024-03-05 10:00:00")
    put(spark, layout.bronze, [order(3), order(4, day=2)], "2024-03-05 15:00:00")
    assert silver(spark, layout, dims)["rows"] == 4
    gold(spark, layout)
    agree(spark, layout, ["o1", "o2", "o3", "o4"])
    lose(layout.silver_progress)
    assert silver(spark, layout, dims, span=timedelta(hours=1))["rows"] == 2
    gold(spark, layout)
    agree(spark, layout, ["o1", "o2"])
    assert silver(spark, layout, dims, span=timedelta(hours=1))["rows"] == 2
    gold(spark, layout)
    agree(spark, layout, ["o1", "o2", "o3", "o4"])
    put(spark, layout.bronze, [order(5, day=1)], "2024-03-05 16:00:00")
    silver(spark, layout, dims)
    gold(spark, layout)
    agree(spark, layout, ["o1", "o2", "o3", "o4", "o5"])
    # one row per key of what can't change any more
    assert read_partials(spark, layout.partials, layout.gold, spark.read.parquet(f"{layout.partials}_new").drop("processed_date").schema).groupBy("order_date", "neighborhood", "working_day", "slice_id").count().filter("count > 1").count() == 0


def test_second_attempt_without_a_row(spark, tmp_path, dims):
    layout = Layout(str(tmp_path))
    put(spark, layout.bronze, ["unreadable"], "2024-03-05 10:00:00")
    put(spark, layout.bronze, [order(1)], "2024-03-05 15:00:00")
    assert silver(spark, layout, dims)["rows"] == 1
    gold(spark, layout)
    lose(layout.silver_progress)
    assert silver(spark, layout, dims, span=timedelta(hours=1))["rows"] == 0
    gold(spark, layout)
    agree(spark, layout, [])
    silver(spark, layout, dims, span=timedelta(hours=1))
    gold(spark, layout)
    agree(spark, layout, ["o1"])


def test_changed_days_are_published_alone(spark, tmp_path, dims):
    layout, told = Layout(str(tmp_path)), []

    def publish_days(days, valid, rejected):
        told.append((sorted(str(r["order_date"]) for r in days.collect()), sorted(str(r["order_date"]) for r in valid.collect()), rejected.count()))

    for hour, lines in ((10, [order(1), order(2, day=1)]), (11, [order(3, day=1), order(4, day=1, x=9.5)])):
        put(spark, layout.bronze, lines, f"2024-03-05 {hour}:00:00")
        silver(spark, layout, dims)
        gold(spark, layout, publish_days=publish_days)
    assert told == [(["2024-03-01", "2024-03-02"], ["2024-03-01", "2024-03-02"], 0), (["2024-03-02"], ["2024-03-02"], 1)]


def test_range_files(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "b.csv").write_text("objec_id;t_min;t_max\n1;5;6\n" + "2;1;2\n" * 500)
    (tmp_path / "r" / "a.csv").write_text("objec_id;t_min;t_max\n1;10;20\n")
    first = read_ranges(spark, str(tmp_path / "r")).filter("area_id = 1").orderBy("ord").first()
    assert (first["t_min"], first["t_max"]) == (10, 20)
    for name, text in (("order", "t_max;objec_id;t_min\n20;1;10\n"), ("value", "objec_id;t_min;t_max\none;10;20\n")):
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception):
            read_ranges(spark, str(tmp_path / name)).collect()


def test_reading_new_slices_lists_their_days_only(spark, tmp_path):
    root = str(tmp_path / "silver")
    days = [datetime(2024, 3, d, 5, tzinfo=UTC) for d in (1, 2, 3)]
    for day in days:
        write_slice(spark.range(2), root, to_micros(day))
    new = read_slices(spark, root, to_micros(days[1]))
    assert new.count() == 4 and len({f.split("slice_day=")[1][:10] for f in new.inputFiles()}) == 2
    assert read_slices(spark, root, to_micros(datetime(2024, 4, 1, tzinfo=UTC))) is None
    assert read_slices(spark, root).count() == 6


def test_whole_chain_in_two_calls(spark, tmp_path, dims):
    layout = Layout(str(tmp_path / "lake"))
    (tmp_path / "in").mkdir()
    lines = lambda: stream_lines(spark, path=str(tmp_path / "in"))
    assert run_pipeline(spark, lines(), layout, *dims)["gold"]["rows"] is None
    (tmp_path / "in" / "a.txt").write_text("\n".join(order(i, day=i % 2) for i in range(20)))
    done = run_pipeline(spark, lines(), layout, *dims)
    assert done["silver"] == {"rows": 20, "slices": 1} and done["gold"]["rows"] == 2
    (tmp_path / "in" / "b.txt").write_text("\n".join(order(i, day=1) for i in range(20, 30)) + "\nbroken\n")
    done = run_pipeline(spark, lines(), layout, *dims)
    assert done["silver"]["rows"] == 10 and done["gold"]["rows"] == 1
    assert rows_of(read_gold(spark, layout.gold)) == rows_of(daily_sales(spark.read.parquet(layout.silver)))
    counts = {r["order_date"]: r["order_count"] for r in read_gold(spark, layout.gold).collect()}
    assert counts == {date(2024, 3, 1): 10, date(2024, 3, 2): 20}


def test_damaged_mark_raises(spark, tmp_path):
    path = tmp_path / "progress"
    write_progress(spark, str(path), Mark(datetime(2024, 5, 1, tzinfo=UTC)))
    assert last_mark(spark, str(path)).processed_date == datetime(2024, 5, 1, tzinfo=UTC)
    for part in path.glob("slot_0/*.parquet"):
        part.write_bytes(b"not parquet")
        (part.parent / f".{part.name}.crc").unlink()
    with pytest.raises(Exception):
        last_mark(spark, str(path))


# parts in eighths add up exactly in any order
sales = st.tuples(
    st.integers(0, 2), st.integers(0, 23), st.sampled_from(["a", "b", None]), st.integers(0, 50), st.integers(0, 80), st.integers(0, 2)
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(sales, min_size=1, max_size=25))
def test_any_split_into_slices_merges_to_the_same(spark, rows):
    data = [
        (
            datetime(2024, 1, 1 + d, h), area, area, "M" if h < 12 else "T", q, f"o{i}", m / 8, m / 8, -m / 8, s,
        )
        for i, (d, h, area, q, m, s) in enumerate(rows)
    ]
    table = spark.createDataFrame(
        data,
        "order_date timestamp, neighborhood string, comune string, working_day string, quantity_products int,"
        " order_id string, time_delivery double, latitude double, longitude double, slice_id bigint",
    )
    whole = rows_of(daily_sales(table, sort=False))
    assert rows_of(merge_partials(daily_partials(table))) == whole
    assert rows_of(rollup_affected_days(table, table)) == whole


def test_contract_reasons(spark):
    ok = (date(2024, 1, 1), "n", "c", "M", 5, 1, 12.345, 1.0, 2.0)
    cases = {
        "": ok,
        "order_date": (None,) + ok[1:],
        "neighborhood": ok[:1] + ("n" * 256,) + ok[2:],
        "comune": ok[:2] + ("c" * 101,) + ok[3:],
        "working_day": ok[:3] + ("MTN",) + ok[4:],
        "total_quantity": ok[:4] + (2**31,) + ok[5:],
        "order_count": ok[:5] + (2**40,) + ok[6:],
        "average_delivery_time": ok[:6] + (999.995,) + ok[7:],
        "latitude": ok[:7] + (float("nan"),) + ok[8:],
        "longitude": ok[:8] + (float("-inf"),),
        "neighborhood, comune": ok[:1] + (None, None) + ok[3:],
    }
    schema = (
        "order_date date, neighborhood string, comune string, working_day string, total_quantity bigint,"
        " order_count bigint, average_delivery_time double, latitude double, longitude double"
    )
    valid, rejected = gold_contract(spark.createDataFrame(list(cases.values()), schema))
    assert sorted(r["reject_reason"] for r in rejected.collect()) == sorted(c for c in cases if c)
    (row,) = valid.collect()
    assert str(row["average_delivery_time"]) == "12.35"
    assert [f.nullable for f in valid.schema.fields] == [False] * 9
    assert dict(valid.dtypes)["total_quantity"] == "int"


def test_contract_of_other_types(spark):
    fields = "a boolean, b timestamp, c binary, d array<int>, e float, f string"
    declared = spark.createDataFrame([], fields).schema
    rows = spark.createDataFrame([(True, datetime(2024, 1, 1), b"x", [1], 1.0, "s"), (None,) * 6], fields)
    valid, rejected = gold_contract(rows, declared)
    assert valid.count() == 1 and rejected.first()["reject_reason"] == "a, b, c, d, e, f"
