"""Point-in-polygon as one equi-join on the cells of an adaptive quadtree.

Prepared once per boundary table, each polygon becomes cells of a grid:

* a cell that no edge touches lies wholly inside (kept without edges) or wholly
  outside (dropped);
* a cell at the border keeps the edges that touch it and, for those to its
  right, only their parity by height: whether an odd number of them is above the
  cell's lower end (``parity``), and the heights where that changes
  (``toggles``). Edges to the right meet every ray to the right, so no more of
  them is needed; two edges that meet at a vertex change it twice, that is not
  at all, so a far chain of any number of edges leaves nothing.

All bounds come from the same monotonic ``floor(x / size)``, so a cell's verdict
is the verdict of the full ray cast, not an approximation. The table has one row
per cell; a point meets at most one row, so there is no fan-out and no
aggregation over points.

A cell with many edges is replaced by the cells of a grid eight times as fine,
which follow from its own rows alone, and so on, the heaviest cells first. Edges
are rows until the last step; each level is written once.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.geometry import cell_of, crosses_ray, on_edge
from orderlake.operators.enrich import BROADCAST_BYTES, lookup_join
from orderlake.sinks.scratch import delete_folder, scratch_folder, written
from orderlake.sources.boundaries import boundary_edges

# Mean number of cells per polygon that the automatic cell size aims at.
CELLS_PER_AREA = 64

# A cell with more edges and toggles than this is split into SPLIT by SPLIT
# cells. A power of two keeps the cells of two levels nested exactly, rounding
# included.
CELL_EDGES = 64
SPLIT = 8
LEVELS = 8

# Rows that all levels below the first may have together: so many, or so many
# times those of the first one. Splitting can't help where very many edges meet
# in a point; the index stays proportional to the boundaries there, too. What is
# left goes to the heaviest cells; one that is not split is slower, not wrong.
LEVEL_ROWS = 8_000_000
LEVEL_GROWTH = 16

# Rows that splitting makes of one, as expected when the budget is dealt.
SPLIT_ROWS = 4

# Geometries of at most so many bytes in all (some 60,000 edges) are indexed by one task.
ONE_TASK_BYTES = 1 << 20

# Cells of a grid are numbered within this distance of the origin.
REACH = 1 << 29

# Output column -> field of the area that it takes.
AREA_NAMES = {"neighborhood": "neighborhood", "comune": "comune"}


@dataclass(frozen=True)
class AreaIndex:
    """Cells of a boundary table: one row (level, cx, cy, areas) per cell.

    A cell that was split has a row at its own level, too, without ``areas``.
    These rows are the directory that tells a point's level before the join.
    """

    cells: DataFrame
    size: float
    levels: int
    bytes: int
    split: int = field(default=0)

    def save(self, path: str) -> None:
        """Write the index as a table, to be built once per boundary table."""
        measures = {"size": F.lit(self.size), "bytes": F.lit(self.bytes).cast("bigint")}
        self.cells.withColumns(measures).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> AreaIndex:
        table = spark.read.parquet(path)
        found = table.agg(
            F.max("size").alias("size"),
            F.max("level").alias("level"),
            F.max("bytes").alias("bytes"),
            F.count_if(F.col("areas").isNull()).alias("split"),
        ).first()
        cells = table.drop("size", "bytes")
        return AreaIndex(cells, found["size"] or 1.0, (found["level"] or 0) + 1, found["bytes"] or 0, found["split"])


def choose_cell_size(edges: DataFrame, cells_per_area: int = CELLS_PER_AREA) -> float:
    """Cell side for which the polygons' boxes take ``cells_per_area`` on average.

    A box of w by h takes about (w/s + 1)(h/s + 1) cells; the mean over all
    boxes is set to the target and solved for s. The total number of cells is
    hence proportional to the number of polygons, whatever their sizes.
    """
    boxes = edges.groupBy("area_no").agg(
        (F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2"))).alias("w"),
        (F.max("y2") - F.min("y1")).alias("h"),
    )
    total = boxes.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("w") + F.col("h")).alias("half"),
        F.sum(F.col("w") * F.col("h")).alias("area"),
    ).first()
    if not total["n"] or total["half"] == 0:
        return 1.0
    room = (cells_per_area - 1) * total["n"]
    return (total["half"] + math.sqrt(total["half"] ** 2 + 4 * room * total["area"])) / (2 * room)


def build_cells(
    boundaries: DataFrame,
    size: float | None = None,
    cells_per_area: int = CELLS_PER_AREA,
    cell_edges: int = CELL_EDGES,
) -> AreaIndex:
    """Index of (ord, area_id, neighborhood, comune, geometry) rows.

    ``ord`` must be unique; where areas overlap the lowest one wins. Each level
    is written in a scratch folder and read to weigh its cells: a few rows, cells
    by the power of two of their weight, come back and decide which are split.
    """
    spark = boundaries.sparkSession
    folder = scratch_folder(spark, "areas")
    if isinstance(boundaries.schema["ord"].dataType, T.IntegralType):
        areas = boundaries.withColumn("area_no", F.col("ord").cast("bigint"))
    else:  # written, so that the numbers stay
        areas = written(boundaries.withColumn("area_no", F.monotonically_increasing_id()), f"{folder}/areas")
    weighed = Observation()
    outlines = areas.select("area_no", "geometry").observe(weighed, F.sum(F.octet_length("geometry")).alias("bytes"))
    edges = written(boundary_edges(outlines), f"{folder}/edges")
    # what fits in one task is not worth a shuffle
    few = (weighed.get["bytes"] or 0) <= ONE_TASK_BYTES
    together = (lambda df: df.coalesce(1)) if few else (lambda df: df)
    edges = together(edges)
    size = float(size) if size is not None else choose_cell_size(edges, cells_per_area)
    if not size > 0:
        raise ValueError("the cell size must be positive")
    kept, directories, level, budget = [], [], 0, 0
    rows = written(_first_level(edges, size), f"{folder}/level-0")
    while True:
        weights = together(rows).groupBy("cx", "cy").agg(F.count_if(F.col("kind") != _BASE).alias("weight"), F.count("*").alias("rows"))
        found = _weighed(weights, cell_edges)
        if found["reach"] >= REACH:
            raise ValueError("cell size too small for the coordinates")
        budget = max(LEVEL_ROWS, LEVEL_GROWTH * found["rows"]) if level == 0 else budget
        least, spent = _lightest_to_split(found["crowds"], budget)
        if least is None or level == LEVELS - 1 or (found["reach"] + 1) * SPLIT >= REACH:
            kept.append(rows.withColumn("level", F.lit(level)))
            break
        budget -= spent
        heavy = (F.col("weight") > cell_edges) & (F.col("weight") >= least)
        split = written(weights.filter(heavy).select("cx", "cy"), f"{folder}/split-{level}")
        kept.append(rows.join(split, ["cx", "cy"], "left_anti").withColumn("level", F.lit(level)))
        directories.append(split.withColumn("level", F.lit(level)))
        level += 1
        rows = written(_next_level(rows.join(split, ["cx", "cy"], "left_semi"), size / SPLIT**level), f"{folder}/level-{level}")
    cells = _collected(together(reduce(DataFrame.unionByName, kept)), areas)
    for split in directories:
        cells = cells.unionByName(split.selectExpr("level", *_CELL), allowMissingColumns=True)
    # measured while it is written; a repeated task may count twice, which only makes a broadcast less likely
    observed = Observation()
    measures = F.expr(f"sum({_CELL_BYTES}) AS bytes"), F.expr("count_if(areas IS NULL) AS split")
    cells = written(cells.observe(observed, *measures), f"{folder}/cells")
    for name in ["areas", "edges", *[f"{n}-{i}" for i in range(level + 1) for n in ("level", "split")]]:
        delete_folder(spark, f"{folder}/{name}")
    return AreaIndex(cells, size, level + 1, observed.get["bytes"] or 0, observed.get["split"])


# Kinds of rows of a level: an edge that touches a cell; a height y1 where the
# parity of the edges to its right changes; that this parity is odd at its lower end.
_EDGE, _TOGGLE, _BASE = 0, 1, 2


def _weighed(weights: DataFrame, cell_edges: int) -> dict[str, object]:
    """Rows of a level, its farthest cell, and its crowded cells by the power of two of their weight: one small result."""
    power = F.when(F.col("weight") > cell_edges, F.floor(F.log2("weight"))).otherwise(-1)
    found = weights.groupBy(power.cast("int").alias("power")).agg(
        F.sum("weight").alias("weight"), F.sum("rows").alias("rows"), F.max(F.greatest(F.abs("cx"), F.abs("cy"))).alias("reach")
    )
    rows = found.collect()
    return {
        "rows": sum(r["rows"] for r in rows),
        "reach": max([r["reach"] for r in rows], default=0),
        "crowds": {r["power"]: r["weight"] for r in rows if r["power"] >= 0},
    }


def _lightest_to_split(crowds: Mapping[int, int], budget: int) -> tuple[int | None, int]:
    """Least weight to be split and the rows expected of it: the heaviest powers of two that the budget pays for."""
    least, spent = None, 0
    for power in sorted(crowds, reverse=True):
        cost = crowds[power] * SPLIT_ROWS
        if spent + cost > budget:
            break
        least, spent = 1 << power, spent + cost
    return least, spent


def _bands(edges: DataFrame, size: float, bounds: tuple[str, str] = ("bottom", "top")) -> DataFrame:
    """One row (cy, left, right) for each row of cells that an edge passes, with the columns that it may touch there.

    Columns are those of the edge's part in the row, one more on either side for
    the rounding of its ends, and never more than those of the whole edge.
    ``bounds``: the first and last row of cells that are asked for.
    """
    cell, first, last = f"floor({{}} / {size!r}D)", *bounds
    at = "x1 + ({} - y1) * ((x2 - x1) / (y2 - y1))"
    enters, leaves = at.format(f"greatest(y1, cy * {size!r}D)"), at.format(f"least(y2, (cy + 1) * {size!r}D)")
    ends = [f"{cell.format(e)} AS {name}" for e, name in (("least(x1, x2)", "low"), ("greatest(x1, x2)", "high"), ("y1", "bottom"), ("y2", "top"))]
    rows = edges.selectExpr("*", *ends).selectExpr("*", f"explode(sequence(greatest(bottom, {first}), least(top, {last}))) AS cy")
    left = f"greatest(low, {cell.format(f'least({enters}, {leaves})')} - 1)"
    right = f"least(high, {cell.format(f'greatest({enters}, {leaves})')} + 1)"
    return rows.selectExpr("*", f"IF(bottom = top, low, {left}) AS left", f"IF(bottom = top, high, {right}) AS right")


def _events(bands: DataFrame, *keys: str) -> DataFrame:
    """Rows (kind, y1, column): where an edge changes the parity of the cells left of ``column`` in its row of cells."""
    found = f"""array_compact(array(
        IF(y1 < y2 AND bottom < cy, named_struct('kind', {_BASE}, 'y1', 0D), NULL),
        IF(y1 < y2 AND bottom = cy, named_struct('kind', {_TOGGLE}, 'y1', y1), NULL),
        IF(y1 < y2 AND top = cy, named_struct('kind', {_TOGGLE}, 'y1', y2), NULL)))"""
    return bands.selectExpr("area_no", *keys, "cy", "left AS column", f"inline({found})")


def _right_of_cells(events: DataFrame, *keys: str) -> DataFrame:
    """Rows (cx, cy, area_no, kind, y1) for cells with an odd number of an event to their right."""
    line = ["area_no", *keys, "cy", "kind", "y1"]
    odd = events.groupBy(*line, "column").agg(F.expr("count(*) % 2 = 1 AS odd")).filter("odd")
    order = f"OVER (PARTITION BY {', '.join(line)} ORDER BY column DESC)"
    ranked = odd.selectExpr(*line, "column", f"row_number() {order} AS place", f"lead(column) {order} AS next").filter("place % 2 = 1")
    start, end = "next", "column"
    if keys:  # what is left of a split cell is not there to end an interval
        start, end = f"greatest(next, px * {SPLIT})", f"least(column, (px + 1) * {SPLIT})"
    cells = ranked.selectExpr("*", f"{start} AS start", f"{end} AS end").filter("start < end")
    return cells.selectExpr("explode(sequence(start, end - 1)) AS cx", "cy", "area_no", "kind", "y1")


def _level(touching: DataFrame, beyond: DataFrame) -> DataFrame:
    touching = touching.selectExpr("cx", "cy", "area_no", f"{_EDGE} AS kind", "x1", "y1", "x2", "y2")
    none = "CAST(NULL AS DOUBLE) AS"
    return touching.union(beyond.selectExpr("cx", "cy", "area_no", "kind", f"{none} x1", "y1", f"{none} x2", f"{none} y2"))


def _first_level(edges: DataFrame, size: float) -> DataFrame:
    bands = _bands(edges, size)
    touching = bands.selectExpr("*", "explode(sequence(left, right)) AS cx")
    return _level(touching, _right_of_cells(_events(bands)))


def _next_level(rows: DataFrame, size: float) -> DataFrame:
    """The cells of split cells, from the rows of these alone."""
    parents = rows.withColumnsRenamed({"cx": "px", "cy": "py"})
    bottom, top = f"py * {SPLIT}", f"py * {SPLIT} + {SPLIT - 1}"
    bands = _bands(parents.filter(f"kind = {_EDGE}").drop("kind"), size, (bottom, top))
    met = bands.selectExpr("*", f"greatest(left, px * {SPLIT}) AS first", f"least(right, px * {SPLIT} + {SPLIT - 1}) AS last").filter("first <= last")
    touching = met.selectExpr("*", "explode(sequence(first, last)) AS cx")
    # what lies right of a split cell lies right of its last column
    at = f"floor(y1 / {size!r}D)"
    base = f"named_struct('cy', cy, 'kind', {_BASE}, 'y1', 0D)"
    above = f"transform(IF({{0}} <= {top}, sequence({{0}}, {top}), array()), cy -> {base})"
    own = f"""IF(kind = {_BASE}, {above.format(bottom)},
               concat(array(named_struct('cy', {at}, 'kind', {_TOGGLE}, 'y1', y1)), {above.format(f"{at} + 1")}))"""
    outer = parents.filter(f"kind <> {_EDGE}").selectExpr("area_no", "px", f"(px + 1) * {SPLIT} AS column", f"inline({own})")
    events = _events(bands, "px").unionByName(outer.select("area_no", "px", "cy", "column", "kind", "y1"))
    return _level(touching, _right_of_cells(events, "px"))


def _collected(rows: DataFrame, areas: DataFrame) -> DataFrame:
    """One row (level, cx, cy, areas) per cell, areas in their order."""
    candidates = rows.groupBy("level", "cx", "cy", "area_no").agg(
        F.expr(f"CAST(count_if(kind = {_BASE}) AS INT) AS parity"),
        F.expr(f"sort_array(collect_list(IF(kind = {_TOGGLE}, y1, NULL))) AS toggles"),
        F.expr(f"collect_list(IF(kind = {_EDGE}, struct(x1, y1, x2, y2), NULL)) AS edges"),
    )
    named = candidates.join(areas.drop("geometry"), "area_no")
    fields = ["ord", *[c for c in areas.columns if c not in ("ord", "area_no", "geometry")], "parity", "toggles", "edges"]
    grouped = named.groupBy("level", "cx", "cy").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("areas"))
    # candidates after one that covers the whole cell can never win
    whole = "CAST(array_position(transform(areas, a -> size(a.edges) = 0), true) AS INT)"
    return grouped.selectExpr("level", *_CELL, f"IF({whole} > 0, slice(areas, 1, {whole}), areas) AS areas")


# Memory of a cell: four doubles and a header per edge, a double per toggle, names.
_CELL_BYTES = """48 + aggregate(coalesce(areas, array()), 0L, (n, a) -> n + 56L * size(a.edges) + 8L * size(a.toggles)
    + coalesce(octet_length(a.neighborhood), 0) + coalesce(octet_length(a.comune), 0) + 224)"""
_CELL = ("CAST(cx AS INT) AS cx", "CAST(cy AS INT) AS cy")


def _cell_key(level: int | Column, cx: Column, cy: Column) -> Column:
    """One long for a cell of any level, null outside the numbered cells: the key of the only join that may move points."""
    inside = cx.between(-REACH, REACH - 1) & cy.between(-REACH, REACH - 1)
    level = F.lit(level) if isinstance(level, int) else level
    return F.when(inside, (level.cast("bigint") * (2 * REACH) + cx + REACH) * (2 * REACH) + cy + REACH)


def area_lookup(
    points: DataFrame,
    index: AreaIndex,
    lat: str = "latitude",
    lon: str = "longitude",
    outputs: Mapping[str, str] = AREA_NAMES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add columns of the first area whose interior holds the point, else nulls.

    A point on an edge or a corner is in no area that the edge belongs to.
    ``outputs`` maps new columns to fields of the area (``area_id`` included).
    """
    x, y = F.col(lon), F.col(lat)
    usable = ~(F.isnan(x) | F.isnan(y))
    keys = {}
    for level in range(index.levels):
        size = index.size / SPLIT**level
        keys[f"_cell{level}"] = F.when(usable, _cell_key(level, cell_of(x, size), cell_of(y, size)))
    joined, key = points.withColumns(keys), F.col(f"_cell{index.levels - 1}")
    directory = index.cells.filter(F.col("areas").isNull()) if index.levels > 1 else None
    for level in range(index.levels - 2, -1, -1):
        # only cells with very many edges are split, so their keys are few: measured, and broadcast
        split = directory.filter(F.col("level") == level).select(_cell_key(level, F.col("cx"), F.col("cy")).alias(f"_cell{level}"), F.lit(True).alias(f"_split{level}"))
        joined = lookup_join(joined, split, [f"_cell{level}"], BROADCAST_BYTES, index.split * 32)
        key = F.when(F.col(f"_split{level}"), key).otherwise(F.col(f"_cell{level}"))
    cells = index.cells.filter(F.col("areas").isNotNull()) if index.levels > 1 else index.cells
    cells = cells.select(_cell_key(F.col("level"), F.col("cx"), F.col("cy")).alias("_cell"), F.col("areas").alias("_areas"))
    joined = lookup_join(joined.withColumn("_cell", key), cells, ["_cell"], broadcast_bytes, index.bytes)
    first = F.get("_areas", F.lit(0))
    tested = F.get(F.filter("_areas", lambda a: _interior(a, x, y)), F.lit(0))
    # most cells are wholly inside their first area and need no test at all
    found = joined.withColumn("_hit", F.when(F.size(first["edges"]) == 0, first).otherwise(tested))
    kept = [c for c in points.columns if c not in outputs]
    return found.select(*kept, *[F.col(f"_hit.{f}").alias(out) for out, f in outputs.items()])


def _interior(area: Column, x: Column, y: Column) -> Column:
    edges = area["edges"]
    changed = F.size(F.filter(area["toggles"], lambda t: t <= y))
    crossed = F.size(F.filter(edges, lambda e: crosses_ray(e, x, y)))
    inside = (area["parity"] + changed + crossed) % 2 == 1
    return inside & ~F.exists(edges, lambda e: on_edge(e, x, y))
