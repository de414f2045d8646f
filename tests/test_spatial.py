import itertools
import math
import random
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException

from orderlake.operators.spatial import AreaIndex, area_lookup, build_cells
from orderlake.sources.boundaries import boundary_edges, read_boundaries
from tests.shapes import box, interior, multipolygon, polygon

BOUNDARY = "ord int, area_id int, neighborhood string, comune string, geometry binary"

HOLED = [box(0, 0, 4, 4), box(1, 1, 2, 3)]
CONCAVE = [[(5, 0), (9, 0), (9, 4), (7, 1), (5, 4), (5, 0)]]
PARTS = [[box(0, 6, 1, 7)], [box(2, 6, 3.5, 7.5), box(2.5, 6.5, 3, 7)]]
OVERLAP = [box(3, 3, 6, 6)]
SLANTED = [[(-3, -3), (-1, -2.5), (-2, -1), (-3, -3)]]
SHAPES = {
    1: ([HOLED[0], HOLED[1]], polygon(HOLED)),
    2: (CONCAVE, polygon(CONCAVE, ">")),
    3: ([r for p in PARTS for r in p], multipolygon(PARTS, ">")),
    4: (OVERLAP, polygon(OVERLAP)),
    5: (SLANTED, multipolygon([SLANTED])),
}


def boundaries(spark, shapes=SHAPES):
    rows = [(o, 100 + o, f"n{o}", f"c{o}", wkb) for o, (_, wkb) in shapes.items()]
    return spark.createDataFrame(rows, BOUNDARY)


def expected(shapes, x, y):
    for o in sorted(shapes):
        if interior(shapes[o][0], x, y):
            return 100 + o
    return None


def looked_up(spark, index, points, **options):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "i int, longitude double, latitude double")
    out = area_lookup(df, index, outputs={"area_id": "area_id", "neighborhood": "neighborhood"}, **options)
    return {r["i"]: r["area_id"] for r in out.collect()}


@pytest.mark.parametrize("size, cell_edges", [(0.3, 256), (1.0, 256), (50.0, 256), (None, 256), (3.0, 3), (7.3, 6)])
def test_all_shapes_on_a_lattice(spark, size, cell_edges):
    index = build_cells(boundaries(spark), size, cell_edges=cell_edges)
    assert (index.levels > 1) == (cell_edges < 256)
    points = [(x / 4, y / 4) for x, y in itertools.product(range(-14, 40), range(-14, 33))]
    got = looked_up(spark, index, points)
    wrong = [(p, got[i], expected(SHAPES, *p)) for i, p in enumerate(points) if got[i] != expected(SHAPES, *p)]
    assert not wrong
    assert len(got) == len(points)


def test_first_area_wins_and_edges_do_not_match(spark):
    index = build_cells(boundaries(spark), 1.0)
    got = looked_up(spark, index, [(3.5, 3.5), (4.0, 3.5), (0.0, 0.0), (1.5, 2.0), (1.0, 2.0), (99.0, 99.0)])
    # (4, 3.5) is on the edge of the first area but inside the overlapping one
    assert got == {0: 101, 1: 104, 2: None, 3: None, 4: None, 5: None}


def test_shuffled_join_gives_the_same(spark):
    index = build_cells(boundaries(spark), 1.0)
    rng = random.Random(3)
    points = [(rng.uniform(-4, 10), rng.uniform(-4, 9)) for _ in range(400)]
    assert looked_up(spark, index, points) == looked_up(spark, index, points, broadcast_bytes=0)


def test_missing_coordinates_give_nulls(spark):
    index = build_cells(boundaries(spark), 1.0)
    got = looked_up(spark, index, [(None, 1.0), (1.0, None), (float("nan"), 0.5), (0.5, float("nan")), (float("inf"), 0.5), (0.5, 0.5)])
    assert got == {0: None, 1: None, 2: None, 3: None, 4: None, 5: 101}


def test_inner_cells_carry_no_edges(spark):
    shapes = {1: ([box(0, 0, 10, 10)], polygon([box(0, 0, 10, 10)]))}
    cells = build_cells(boundaries(spark, shapes), 1.0).cells
    inner = {(r["cx"], r["cy"]) for r in cells.filter("size(areas[0].edges) = 0").select("cx", "cy").collect()}
    assert inner == {(x, y) for x in range(1, 10) for y in range(1, 10)}


def test_candidates_behind_a_whole_cell_are_dropped(spark):
    shapes = {1: ([], polygon([box(0, 0, 10, 10)])), 2: ([], polygon([box(4, 4, 6, 6)]))}
    cells = build_cells(boundaries(spark, shapes), 1.0).cells
    assert cells.filter("cx = 5 and cy = 5").selectExpr("size(areas) n").first()["n"] == 1


def test_index_round_trip(spark, tmp_path):
    index = build_cells(boundaries(spark), 2.8, cell_edges=5)
    index.save(str(tmp_path / "cells"))
    again = AreaIndex.load(spark, str(tmp_path / "cells"))
    assert again.levels == index.levels > 1
    points = [(x / 3, y / 3) for x, y in itertools.product(range(-10, 30), range(-10, 25))]
    assert again.size == 2.8 and again.bytes == index.bytes
    assert looked_up(spark, again, points) == looked_up(spark, index, points)


def test_read_boundaries_keeps_file_order(spark, tmp_path):
    square = polygon([box(0, 0, 1, 1)])
    rows = [(9, "first", "a", square), (2, "second", "b", square)]
    df = spark.createDataFrame(rows, "OBJECTID int, NOMBRE string, IDENTIFICACION string, geometry binary")
    df.coalesce(1).write.parquet(str(tmp_path / "one"))
    df.coalesce(1).write.option("maxRecordsPerFile", 1).parquet(str(tmp_path / "two"))
    assert len(spark.read.parquet(str(tmp_path / "two")).inputFiles()) == 2
    for name, order, first in (("one", None, "first"), ("two", None, "first"), ("two", "OBJECTID", "second")):
        index = build_cells(read_boundaries(spark, str(tmp_path / name), order), 1.0)
        points = spark.createDataFrame([(0.5, 0.5)], "latitude double, longitude double")
        row = area_lookup(points, index).first()
        assert row["neighborhood"] == first


def test_wkb_dimensions_and_errors(spark):
    ring = box(0, 0, 1, 1)
    ewkb = struct.pack("<BII", 1, 0x80000000 | 0x20000000 | 3, 4326) + struct.pack("<II", 1, len(ring))
    ewkb += b"".join(struct.pack("<ddd", x, y, 7.0) for x, y in ring)
    iso = struct.pack(">BIII", 0, 3003, 1, len(ring)) + b"".join(struct.pack(">dddd", x, y, 7.0, 8.0) for x, y in ring)
    for wkb in (ewkb, iso):
        df = spark.createDataFrame([(1, 1, "n", "c", wkb)], BOUNDARY)
        assert boundary_edges(df).count() == 4
    nothing = spark.createDataFrame([(1, 1, "n", "c", None), (2, 2, "n", "c", polygon([]))], BOUNDARY)
    assert boundary_edges(nothing).count() == 0
    point = spark.createDataFrame([(1, 1, "n", "c", struct.pack("<BIdd", 1, 1, 0.0, 0.0))], BOUNDARY)
    with pytest.raises(PythonException):
        boundary_edges(point).count()


def test_no_python_and_no_nested_loop_on_the_point_path(spark, tmp_path):
    build_cells(boundaries(spark), 1.0).save(str(tmp_path / "cells"))
    index = AreaIndex.load(spark, str(tmp_path / "cells"))
    points = spark.createDataFrame([(0.5, 0.5)], "latitude double, longitude double")
    out = area_lookup(points, index)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    for bad in ("EvalPython", "MapInArrow", "NestedLoop", "Cartesian"):
        assert bad not in plan


coordinate = st.integers(-8, 8)


def test_crowd_in_one_cell_is_split(spark):
    """A third of the areas in a corner of one cell, beside areas a thousand times as wide."""
    shapes = {o: ([box(o * 40, 0, o * 40 + 40, 40)], polygon([box(o * 40, 0, o * 40 + 40, 40)])) for o in range(50, 90)}
    for o in range(20):
        ring = box(2100 + o / 8, 1.0, 2100 + (o + 1) / 8, 1.125)
        shapes[o] = ([ring], polygon([ring]))
    plain = build_cells(boundaries(spark, shapes), 40.0, cell_edges=256)
    index = build_cells(boundaries(spark, shapes), 40.0, cell_edges=16)
    assert plain.levels == 1 and index.levels > 2
    worst = lambda i: i.cells.selectExpr("max(aggregate(areas, 0, (n, a) -> n + size(a.edges))) n").first()["n"]
    assert worst(index) <= 16 < worst(plain)
    # no cell lies at two levels
    points = [(2100 + k / 16, 1.0 + j / 16) for k, j in itertools.product(range(-3, 45), range(-1, 4))]
    points += [(2000.0 + 7 * k, 20.0) for k in range(20)]
    got = looked_up(spark, index, points)
    assert got == {i: expected(shapes, *p) for i, p in enumerate(points)}
    assert got == looked_up(spark, plain, points)


def test_budget_goes_to_the_heaviest_cells(spark, monkeypatch):
    """Two crowded cells; the budget pays for one of them, which is split as far as it needs."""
    shapes = {}
    for o in range(60):
        ring = box(1 + o / 128, 1, 1 + (o + 1) / 128, 1.5) if o < 45 else box(41 + o / 128, 1, 41 + (o + 1) / 128, 1.5)
        shapes[o] = ([ring], polygon([ring]))
    points = [(k / 256, 1.25) for k in range(200, 420, 3)] + [(41 + k / 256, 1.25) for k in range(60, 130, 3)]
    want = {i: expected(shapes, *p) for i, p in enumerate(points)}
    for rows, split in ((0, set()), (900, {(0, 0)}), (10**6, {(0, 0), (4, 0)})):
        monkeypatch.setattr("orderlake.operators.spatial.LEVEL_ROWS", rows)
        monkeypatch.setattr("orderlake.operators.spatial.LEVEL_GROWTH", 0)
        index = build_cells(boundaries(spark, shapes), 10.0, cell_edges=40)
        assert {(r["cx"], r["cy"]) for r in index.cells.filter("areas is null and level = 0").collect()} == split
        assert looked_up(spark, index, points) == want


def star(n, r=1.0):
    """A ring of n spikes from a hub, all edges near one point."""
    ring = []
    for i in range(n):
        a, b = 2 * math.pi * i / n, 2 * math.pi * (i + 0.5) / n
        ring += [(r * math.cos(a), r * math.sin(a)), (r / 64 * math.cos(b), r / 64 * math.sin(b))]
    return [*ring, ring[0]]


def test_many_edges_meet_at_one_place(spark):
    ring = star(300)
    index = build_cells(boundaries(spark, {1: ([ring], polygon([ring]))}), 1.0, cell_edges=16)
    assert index.levels > 2
    rng = random.Random(5)
    points = [(rng.uniform(-1, 1) * s, rng.uniform(-1, 1) * s) for s in (1, 0.1, 0.02) for _ in range(150)]
    got = looked_up(spark, index, points)
    assert got == {i: 101 if interior([ring], *p) else None for i, p in enumerate(points)}


def test_far_chains_leave_nothing_in_a_cell(spark):
    """The right side has a thousand vertices; cells at the left side keep their own edges only."""
    right = [(10 + (i % 2) / 8, i / 100) for i in range(1001)]
    ring = [(0, 0), *right, (0, 10), (0, 0)]
    index = build_cells(boundaries(spark, {1: ([ring], polygon([ring]))}), 1.0, cell_edges=10**6)
    for r in index.cells.filter("cx = 0 and cy between 2 and 7").collect():
        assert [len(a.edges) for a in r.areas] == [1] and [a.toggles for a in r.areas] == [[]]
    points = [(x / 4 + 0.125, y / 7) for x, y in itertools.product(range(-2, 44), range(-1, 72, 5))]
    assert looked_up(spark, index, points) == {i: expected({1: ([ring], None)}, *p) for i, p in enumerate(points)}


def test_points_move_once_on_a_split_index(spark, tmp_path):
    build_cells(boundaries(spark), 3.0, cell_edges=4).save(str(tmp_path / "cells"))
    index = AreaIndex.load(spark, str(tmp_path / "cells"))
    assert index.levels > 2 and index.split > 1
    spark.range(1000).selectExpr("id / 100 latitude", "id / 90 longitude").write.parquet(str(tmp_path / "points"))
    out = area_lookup(spark.read.parquet(str(tmp_path / "points")), index, broadcast_bytes=0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == index.levels - 1 and plan.count("SortMergeJoin") == 1
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 2 and all("_cell" in line for line in moved)  # the points, and the cells


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    triangles=st.lists(st.tuples(*[st.tuples(coordinate, coordinate)] * 3), min_size=1, max_size=5),
    size=st.sampled_from([0.5, 2.0, 5.0]),
    cell_edges=st.sampled_from([12, 256]),
)
def test_triangles_match_exact_arithmetic(spark, triangles, size, cell_edges):
    shapes = {}
    for o, (a, b, c) in enumerate(triangles):
        ring = [a, b, c, a]
        shapes[o] = ([ring], polygon([ring]))
    index = build_cells(boundaries(spark, shapes), size, cell_edges=cell_edges)
    points = [(x / 2, y / 2) for x, y in itertools.product(range(-17, 18), range(-17, 18))]
    got = looked_up(spark, index, points)
    assert {i: expected(shapes, *p) for i, p in enumerate(points)} == got
