"""Area boundaries: polygons as WKB to rows of edges."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.schemas import BOUNDARY_COLUMNS

# Geometry type codes and dimension flags of the WKB format.
_POLYGON = 3
_MULTIPOLYGON = 6
_HAS_Z = 0x80000000
_HAS_M = 0x40000000
_HAS_SRID = 0x20000000


def read_boundaries(spark: SparkSession, path: str, order: str | None = None) -> DataFrame:
    """Boundaries as (ord, area_id, neighborhood, comune, geometry).

    ``ord`` is unique and ranks the areas; where two contain a point the lower
    one wins. Rank is the place in the table, files by name, or the column
    ``order`` and then the place: the same however many files there are.
    """
    table = spark.read.parquet(path)
    area_id, neighborhood, comune, geometry = BOUNDARY_COLUMNS
    rank = F.lit(0).cast("bigint") if order is None else F.col(order)
    return table.select(
        F.struct(
            rank.alias("rank"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        ).alias("ord"),
        F.col(area_id).alias("area_id"),
        F.col(neighborhood).alias("neighborhood"),
        F.col(comune).alias("comune"),
        geometry,
    )


def boundary_edges(boundaries: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One row per edge: the boundary's other columns and x1, y1, x2, y2.

    Edges run upwards. Holes and the parts of a multipolygon are just more
    edges. This is the one step with Python workers; it sees boundaries only.
    """
    fields = [f for f in boundaries.schema.fields if f.name != geometry]
    names = [f.name for f in fields]
    schema = T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in ("x1", "y1", "x2", "y2")])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, wkb in enumerate(batch.column(geometry)):  # one value at a time
                if not wkb.is_valid:
                    continue
                edges = _edges(wkb.as_py())
                if len(edges):
                    same = pa.array(np.full(len(edges), row, dtype=np.int64))
                    columns = [batch.column(n).take(same) for n in names]
                    columns += [pa.array(np.ascontiguousarray(edges[:, i])) for i in range(4)]
                    yield pa.RecordBatch.from_arrays(columns, names=names + ["x1", "y1", "x2", "y2"])

    return boundaries.select(*names, geometry).mapInArrow(decode, schema)


def _edges(wkb: bytes) -> np.ndarray:
    rings, end = _rings(wkb, 0)
    if end != len(wkb):
        raise ValueError(f"{len(wkb) - end} bytes after the geometry")
    parts = [np.empty((0, 4))]
    for ring in rings:
        if len(ring) == 0:
            continue
        if not np.array_equal(ring[0], ring[-1]):
            ring = np.vstack([ring, ring[:1]])
        start, stop = ring[:-1], ring[1:]
        down = (start[:, 1] > stop[:, 1]) | ((start[:, 1] == stop[:, 1]) & (start[:, 0] > stop[:, 0]))
        parts.append(
            np.hstack([np.where(down[:, None], stop, start), np.where(down[:, None], start, stop)])
        )
    return np.vstack(parts)


def _rings(wkb: bytes, at: int) -> tuple[list[np.ndarray], int]:
    order = "<" if wkb[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", wkb, at + 1)
    at += 5
    if code & _HAS_SRID:
        at += 4
    kind, level = (code & 0x0FFFFFFF) % 1000, (code & 0x0FFFFFFF) // 1000
    width = 2 + bool(code & _HAS_Z) + bool(code & _HAS_M) + {0: 0, 1: 1, 2: 1, 3: 2}[level]
    (count,) = struct.unpack_from(order + "I", wkb, at)
    at += 4
    rings: list[np.ndarray] = []
    if kind == _POLYGON:
        for _ in range(count):
            (points,) = struct.unpack_from(order + "I", wkb, at)
            at += 4
            flat = np.frombuffer(wkb, dtype=order + "f8", count=points * width, offset=at)
            rings.append(flat.reshape(points, width)[:, :2].astype(np.float64))
            at += points * width * 8
    elif kind == _MULTIPOLYGON:
        for _ in range(count):
            part, at = _rings(wkb, at)
            rings += part
    else:
        raise ValueError(f"geometry type {code} is neither a polygon nor a multipolygon")
    return rings, at
