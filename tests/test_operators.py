import json
from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from orderlake.operators.clean import dedupe, drop_incomplete, require_columns
from orderlake.operators.contract import gold_contract
from orderlake.operators.derive import derive_times, stamp_processed, working_day
from orderlake.operators.enrich import enrich_name, payload_bytes
from orderlake.operators.incremental import incremental_slice, slice_high
from orderlake.operators.ingest import ingest_partitions, stamp_ingest
from orderlake.operators.parse import parse_orders
from orderlake.operators.ranges import delivery_range_check
from orderlake.operators.rollup import daily_sales
from orderlake.schemas import ORDER_SCHEMA
from orderlake.sinks.jdbc import write_jdbc
from orderlake.sinks.parquet import append_table
from orderlake.sinks.progress import last_mark, read_progress, write_progress
from orderlake.sources.tables import read_if_present, read_ranges
from tests.helpers import order

UTC = timezone.utc


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


# A sample order and what is derived from it.
SAMPLE = {
    "latitude": 6.2368557753047,
    "longitude": -75.60838556505269,
    "order_date": "2021-01-29T17:33:00",
    "dispatch_date": "2021-01-30T07:15:00",
    "delivery_date": "2021-01-30T08:16:00",
    "customer_id": 5024,
    "employee_id": 9438,
    "quantity_products": 83,
    "order_id": "9af779e2-e082-4698-b48f-856499bc96fd",
}


def test_sample_order(spark):
    orders = parse_orders(lines(spark, json.dumps(SAMPLE)))
    assert orders.schema == ORDER_SCHEMA
    row = working_day(derive_times(orders)).first()
    assert row["order_id"] == SAMPLE["order_id"] and row["latitude"] == SAMPLE["latitude"]
    assert (row["order_hour"], row["order_minute"], row["time_delivery"], row["working_day"]) == (17, 33, 61.0, "T")


@pytest.mark.parametrize(
    "change, lost",
    [
        ({"order_date": "nope"}, "order_date"),
        ({"customer_id": 99999999999}, "customer_id"),
        ({"latitude": "6.2"}, "latitude"),
        ({"employee_id": "7"}, "employee_id"),
        ({"quantity_products": None}, "quantity_products"),
        ({"extra": {"a": 1}}, None),
        ({"order_id": 9}, None),
        ({"order_date": "2021-01-29"}, None),
    ],
)
def test_a_bad_field_is_null_and_drops_the_order(spark, change, lost):
    parsed = parse_orders(lines(spark, json.dumps({**SAMPLE, **change})))
    row = parsed.first().asDict()
    assert [k for k, v in row.items() if v is None] == ([lost] if lost else [])
    assert drop_incomplete(parsed).count() == (0 if lost else 1)


def test_unreadable_lines_are_all_null_and_keep_their_row(spark):
    parsed = parse_orders(lines(spark, "garbage", "[]", "", None, '{"latitude": NaN}').withColumn("n", F.lit(1)), keep=["n"])
    assert parsed.count() == 5 and parsed.columns == ["n"] + ORDER_SCHEMA.names
    assert drop_incomplete(parsed).count() == 0


def test_a_line_is_parsed_once(spark):
    plan = plan_of(drop_incomplete(parse_orders(lines(spark, json.dumps(SAMPLE)))))
    assert plan.count("from_json") == 1


def test_shift_label_at_noon_and_for_null(spark):
    hours = spark.createDataFrame([(0,), (11,), (12,), (23,), (None,)], "order_hour int")
    got = [r["working_day"] for r in working_day(hours).collect()]
    assert got == ["M", "M", "T", "T", None]


def test_delivery_minutes_count_whole_seconds(spark):
    times = spark.sql(
        "select timestamp_ntz '2024-01-01 10:00:00.9' order_date, timestamp_ntz '2024-01-01 10:00:00.9' dispatch_date,"
        " timestamp_ntz '2024-01-01 10:00:31.1' delivery_date"
    )
    assert derive_times(times).first()["time_delivery"] == 31 / 60


def test_stamps(spark):
    stamped = ingest_partitions(stamp_ingest(lines(spark, "a", "b")))
    rows = stamped.filter("year = year(timestamp) and month = month(timestamp) and day = day(timestamp)")
    assert rows.count() == 2 and stamped.select("timestamp").distinct().count() == 1
    at = datetime(2024, 2, 3, 4, 5, 6, 789, tzinfo=UTC)
    micros = stamp_processed(lines(spark, "a"), at).select(F.unix_micros("processed_date")).first()[0]
    assert micros == 1706933106000789


def test_require_columns(spark):
    df = lines(spark, "a")
    assert require_columns(df, ["value"]) is df
    with pytest.raises(ValueError, match="timestamp"):
        require_columns(df, ["value", "timestamp"])


def test_dedupe_forms(spark):
    df = spark.createDataFrame(
        [("a", 3, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 2, "p"), (None, 1, "q"), ("b", None, "n"), ("b", 5, "m")],
        "k string, t int, v string",
    )
    got = sorted(dedupe(df, ["k"], ["t"]).collect(), key=str)
    # earliest, ties by the rest; nulls are one key; a null time comes first
    assert sorted(map(str, got)) == sorted(
        ["Row(k='a', t=1, v='y')", "Row(k=None, t=1, v='q')", "Row(k='b', t=None, v='n')"]
    )
    assert dedupe(df.union(df)).count() == 7
    assert dedupe(df, not_null="k").count() == 5
    assert dedupe(df.select("k"), ["k"]).count() == 3


def test_dedupe_collapses_copies_before_the_shuffle(spark):
    hot = spark.range(0, 50_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    out = dedupe(hot, ["k"], ["t"])
    assert "Window" not in plan_of(out) and "partial_min" in plan_of(out)
    assert out.count() == 50_000 - 16_667 + 1
    assert out.filter("k = -1").first()["t"] == 0


def test_enrich_fans_out_and_keeps_unmatched(spark):
    orders = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "order_id int, customer_id int")
    names = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n")], "customer_id bigint, name string")
    for limit in (1 << 20, 0):
        out = enrich_name(orders, names, "customer_id", "customer_name", broadcast_bytes=limit)
        got = sorted((r["order_id"], r["customer_name"]) for r in out.collect())
        assert got[:2] == [(1, "a"), (1, "b")] and got[2:] == [(2, None), (3, None)]
        assert out.columns == ["order_id", "customer_id", "customer_name"]
        assert ("BroadcastHashJoin" in plan_of(out)) == (limit > 0)


def test_repetitive_lookup_table_is_measured(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id AS customer_id", "repeat('same name ', 20) AS name")
    rows.coalesce(1).write.parquet(f"{tmp_path}/names")
    orders = spark.createDataFrame([(1, 1)], "order_id int, customer_id int")
    out = enrich_name(orders, spark.read.parquet(f"{tmp_path}/names"), "customer_id", "customer_name", broadcast_bytes=3_000_000)
    assert "BroadcastHashJoin" not in plan_of(out) and out.count() == 1


def test_payload_grows_with_text(spark):
    short = spark.createDataFrame([(1, "a")] * 10, "k int, name string")
    long = spark.createDataFrame([(1, "a" * 1000)] * 10, "k int, name string")
    assert payload_bytes(long) - payload_bytes(short) == 9990
    assert payload_bytes(short.limit(0)) == 0


def test_hot_key_of_a_big_dimension_is_split(spark):
    """A third of the orders share one customer; nothing is broadcast."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        orders = spark.range(0, 200_000, 1, 8).select(
            F.col("id").alias("order_id"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("customer_id"),
        )
        names = spark.range(5000).select(F.col("id").alias("customer_id"), F.concat(F.lit("c"), "id").alias("name"))
        out = enrich_name(orders, names, "customer_id", "customer_name", broadcast_bytes=0)
        totals = out.groupBy().agg(
            F.count("customer_name").alias("n"),
            F.count_if(F.col("customer_name") == F.concat(F.lit("c"), "customer_id")).alias("right"),
        )
        (row,) = totals.collect()
        assert (row["n"], row["right"]) == (200_000, 200_000)
        assert "skew=true" in plan_of(totals)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_ranges(spark, tmp_path):
    # The head of a range file; the repeated id is invented.
    path = tmp_path / "range_time.csv"
    path.write_text("objec_id;t_min;t_max\n321;40;180\n323;30;120\n330;15;60\n321;1;2\n")
    ranges = read_ranges(spark, str(path))
    orders = spark.createDataFrame(
        [(1, 321, 40.0), (2, 321, 180.5), (3, 340, 50.0), (4, None, 50.0), (5, 330, 60.0)],
        "order_id int, area_id int, time_delivery double",
    )
    got = {r["order_id"]: (r["t_min"], r["t_max"], r["in_range"]) for r in delivery_range_check(orders, ranges).collect()}
    assert got == {1: (40, 180, True), 2: (40, 180, False), 3: (None, None, None), 4: (None, None, None), 5: (15, 60, True)}


def test_slices_partition_the_rows(spark):
    df = spark.sql("select explode(sequence(timestamp '2024-01-01', timestamp '2024-01-03', interval 6 hours)) ts")
    bounds = ["2024-01-01", "2024-01-01 13:00:00", "2024-01-02 06:00:00", datetime(2024, 1, 3, tzinfo=UTC)]
    counts = [incremental_slice(df, "ts", a, b).count() for a, b in zip([None] + bounds, bounds + [None])]
    assert counts == [1, 2, 3, 3, 0]
    assert slice_high(df, "ts", "2024-01-02 20:00:00") == datetime(2024, 1, 3, tzinfo=UTC)
    assert slice_high(df, "ts", "2024-01-03") is None


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_slice_bounds_reach_the_scan(spark, tmp_path, kind):
    path = str(tmp_path / "t")
    spark.sql(f"select cast(timestamp '2024-01-02' as {kind}) ts, 1 v").write.parquet(path)
    plan = plan_of(incremental_slice(spark.read.parquet(path), "ts", "2024-01-01", "2024-01-03"))
    assert "GreaterThan(ts,2024-01-01" in plan and "LessThanOrEqual(ts,2024-01-03" in plan


def test_marks_keep_microseconds_in_any_zone(spark, tmp_path):
    path = str(tmp_path / "progress")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
        assert last_mark(spark, path) is None
        assert read_progress(spark, path) == datetime(2024, 1, 1, 5, tzinfo=UTC)
        for micros in (1, 2, 3):
            at = datetime(2024, 6, 1, 1, 2, 3, micros, tzinfo=UTC)
            write_progress(spark, path, at)
            assert read_progress(spark, path) == at
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_crash_while_the_mark_is_replaced_leaves_the_one_before(spark, tmp_path):
    path = tmp_path / "progress"
    for day in (1, 2, 3):
        write_progress(spark, str(path), datetime(2024, 6, day, tzinfo=UTC))
    newest = max(path.iterdir(), key=lambda slot: spark.read.parquet(str(slot)).first()["processed_date"])
    for part in newest.iterdir():
        part.unlink()
    assert read_progress(spark, str(path)) == datetime(2024, 6, 2, tzinfo=UTC)
    write_progress(spark, str(path), datetime(2024, 6, 4, tzinfo=UTC))
    assert read_progress(spark, str(path)) == datetime(2024, 6, 4, tzinfo=UTC)


def test_null_mark_counts_as_none(spark, tmp_path):
    path = str(tmp_path / "progress")
    spark.sql(
        "select cast(null as timestamp) processed_date, cast(null as timestamp) run_at, cast(null as bigint) slice_id"
    ).write.parquet(f"{path}/slot_0")
    assert last_mark(spark, path) is None


def test_only_an_absent_path_counts_as_absent(spark, tmp_path):
    assert read_if_present(spark, str(tmp_path / "no")) is None
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        read_if_present(spark, str(tmp_path / "empty"))


def test_append_counts_rows_while_writing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert append_table(spark.range(5), path) == 5
    assert append_table(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 8


def test_jdbc_options(spark, monkeypatch):
    """The call as Spark gets it; no database is started."""
    calls = []

    class Recorder:
        def __init__(self, df):
            self.seen = {"schema": df.schema}

        def __getattr__(self, name):
            def record(*args, **kwargs):
                if name == "option":
                    self.seen[args[0]] = args[1]
                elif name == "options":
                    self.seen.update(kwargs)
                elif name == "save":
                    calls.append(self.seen)
                else:
                    self.seen[name] = args[0]
                return self

            return record

    silver = working_day(derive_times(parse_orders(lines(spark, order(1))))).withColumns(
        {"neighborhood": F.lit("n"), "comune": F.lit("c")}
    )
    valid, _ = gold_contract(daily_sales(silver, sort=False))
    monkeypatch.setattr(type(valid), "write", property(lambda df: Recorder(df)))
    write_jdbc(valid, "jdbc:x", "daily_sales", {"user": "u", "driver": "d"})
    write_jdbc(valid, "jdbc:x", "daily_sales", mode="append")
    first, second = calls
    assert first["format"] == "jdbc" and first["url"] == "jdbc:x" and first["dbtable"] == "daily_sales"
    assert first["mode"] == "overwrite" and first["truncate"] is True and first["user"] == "u"
    assert first["createTableColumnTypes"] == "neighborhood VARCHAR(255), comune VARCHAR(100), working_day VARCHAR(2)"
    assert not any(f.nullable for f in first["schema"].fields)
    assert second["mode"] == "append" and "truncate" not in second
    assert all(hasattr(DataFrameWriter, n) for n in ("format", "option", "options", "mode", "save"))


def test_daily_sales_order_and_columns(spark):
    silver = spark.createDataFrame(
        [
            (datetime(2024, 1, 2, 3), "b", "y", "M", 1, "o1", 10.0, 1.0, 2.0),
            (datetime(2024, 1, 1, 3), "b", "z", "M", 2, "o2", 20.0, 1.0, 2.0),
            (datetime(2024, 1, 1, 4), "b", "x", "M", 3, None, 30.0, 1.0, 2.0),
            (datetime(2024, 1, 1, 5), "b", "z", "M", 2**31 - 1, "o3", 30.0, 3.0, 2.0),
        ],
        "order_date timestamp, neighborhood string, comune string, working_day string, quantity_products int,"
        " order_id string, time_delivery double, latitude double, longitude double",
    )
    out = daily_sales(silver)
    rows = [tuple(r)[1:] for r in out.collect()]
    assert [r[1] for r in rows] == ["x", "z", "y"]
    # null ids are not counted, sums do not overflow
    assert rows[0] == ("b", "x", "M", 3, 0, 30.0, 1.0, 2.0)
    assert rows[1] == ("b", "z", "M", 2**31 + 1, 2, 25.0, 2.0, 2.0)
