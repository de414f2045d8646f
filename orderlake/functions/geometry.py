"""Planar tests on edges, exact in doubles up to the rounding of one product.

An edge is a struct ``x1, y1, x2, y2`` that runs upwards (``y1 <= y2``), so two
areas that share an edge evaluate the same formula for it and a point next to
it lands in exactly one of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cell_of(coordinate: str | Column, size: float) -> Column:
    """Grid index of a coordinate; monotonic, also after rounding."""
    coordinate = F.col(coordinate) if isinstance(coordinate, str) else coordinate
    return F.floor(coordinate / F.lit(float(size)))


def side(edge: Column, x: Column, y: Column) -> Column:
    """Positive left of the edge, negative right of it, zero on its line."""
    return (edge["x2"] - edge["x1"]) * (y - edge["y1"]) - (edge["y2"] - edge["y1"]) * (
        x - edge["x1"]
    )


def crosses_ray(edge: Column, x: Column, y: Column) -> Column:
    """True if the horizontal ray from the point to the right meets the edge.

    The edge is half open (lower end in, upper end out), so a ray through a
    vertex is counted once and horizontal edges never count.
    """
    return (edge["y1"] <= y) & (y < edge["y2"]) & (side(edge, x, y) > 0)


def on_edge(edge: Column, x: Column, y: Column) -> Column:
    """True if the point lies on the closed edge."""
    return (
        y.between(edge["y1"], edge["y2"])
        & x.between(F.least(edge["x1"], edge["x2"]), F.greatest(edge["x1"], edge["x2"]))
        & (side(edge, x, y) == 0)
    )
