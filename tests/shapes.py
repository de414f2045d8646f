"""WKB of invented shapes and a brute-force point-in-polygon with fractions."""

import struct
from fractions import Fraction


def polygon(rings, order="<"):
    body = struct.pack(order + "BII", 1 if order == "<" else 0, 3, len(rings))
    for ring in rings:
        body += struct.pack(order + "I", len(ring))
        for x, y in ring:
            body += struct.pack(order + "dd", x, y)
    return body


def multipolygon(parts, order="<"):
    head = struct.pack(order + "BII", 1 if order == "<" else 0, 6, len(parts))
    return head + b"".join(polygon(rings, order) for rings in parts)


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def interior(rings, x, y):
    """Strict interior, in exact arithmetic."""
    x, y = Fraction(x), Fraction(y)
    inside = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            ax, ay, bx, by = map(Fraction, (ax, ay, bx, by))
            cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
            if cross == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return False
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                inside = not inside
    return inside
