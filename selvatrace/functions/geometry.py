"""Great-circle distance and ring expressions, all built-in column functions.

Coordinates are degrees. The poles and the antimeridian are out of scope: a plot or a
search circle that crosses them has to be rejected first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8  # mean radius of the sphere used for every distance and area


def great_circle_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Haversine distance in metres, rounded to the millimetre.

    The rounding makes ties the same on every platform, whatever its sine.
    """
    half_lat = F.sin(F.radians(lat2 - lat1) / F.lit(2.0))
    half_lon = F.sin(F.radians(lon2 - lon1) / F.lit(2.0))
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.round(F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), h))), 3)


def metres_to_degrees(metres: float) -> float:
    """Degrees of latitude spanned by ``metres``."""
    return math.degrees(metres / EARTH_RADIUS_M)


def lon_reach_deg(lat: Column, metres: float) -> Column:
    """Largest longitude offset of any point within ``metres`` of a point at ``lat``.

    Grows with latitude; 180 where the circle touches a pole.
    """
    angle = metres / EARTH_RADIUS_M
    ratio = F.lit(math.sin(angle)) / F.cos(F.radians(lat))
    over_pole = F.abs(lat) + F.lit(math.degrees(angle)) >= F.lit(90.0)
    return F.when(over_pole, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), ratio))))


def ring_edges(ring: Column) -> Column:
    """Edges of one ring. The first vertex is appended; where the ring was already closed
    that adds an edge of no length, which counts for nothing."""
    shifted = F.concat(F.slice(ring, F.lit(2), F.greatest(F.size(ring), F.lit(1))), F.array(F.get(ring, F.lit(0))))
    return F.zip_with(
        ring,
        shifted,
        lambda a, b: F.struct(a.x.alias("ax"), a.y.alias("ay"), b.x.alias("bx"), b.y.alias("by")),
    )


def plot_edges(rings: Column) -> Column:
    """Edges of all rings in one array; even-odd counting over it honours holes."""
    return F.flatten(F.transform(rings, ring_edges))


def inside(edges: Column, px: Column, py: Column) -> Column:
    """Even-odd ray casting to the right of the point.

    An edge counts when its ends lie on different sides of the half-open rule ``y > py``,
    so a vertex counts once. Points exactly on an edge may fall either way.
    """

    # The point travels in the accumulator. Spark loses sight of columns that are named only
    # inside the lambda and then pushes the test to a side of the join that lacks them.
    def step(seen: Column, e: Column) -> Column:
        reach = (e.bx - e.ax) * (seen.py - e.ay) / F.nullif(e.by - e.ay, F.lit(0.0)) + e.ax
        hit = ((e.ay > seen.py) != (e.by > seen.py)) & (seen.px < reach)
        n = seen.n + F.when(hit, 1).otherwise(0)
        return F.struct(n.alias("n"), seen.px.alias("px"), seen.py.alias("py"))

    start = F.struct(F.lit(0).alias("n"), px.alias("px"), py.alias("py"))
    return F.aggregate(edges, start, step).n % 2 == 1


def bounds(rings: Column) -> list[Column]:
    """xmin, ymin, xmax, ymax over all vertices."""
    xs = F.transform(F.flatten(rings), lambda v: v.x)
    ys = F.transform(F.flatten(rings), lambda v: v.y)
    return [
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    ]


def _ring_area_m2(ring: Column) -> Column:
    """Shoelace area in the cylindrical equal-area projection, taken from the first vertex
    so that large coordinates do not cancel."""
    x0, y0 = F.get(ring, F.lit(0)).x, F.get(ring, F.lit(0)).y
    flat = F.transform(
        ring,
        lambda v: F.struct(
            (F.lit(EARTH_RADIUS_M) * F.radians(v.x - x0)).alias("x"),
            (F.lit(EARTH_RADIUS_M) * (F.sin(F.radians(v.y)) - F.sin(F.radians(y0)))).alias("y"),
        ),
    )
    twice = F.aggregate(ring_edges(flat), F.lit(0.0), lambda s, e: s + (e.ax * e.by - e.bx * e.ay))
    return F.abs(twice) / F.lit(2.0)


def area_ha(rings: Column) -> Column:
    """Outer ring less its holes, in hectares; edges are straight in the projection."""
    total = F.aggregate(
        F.transform(rings, lambda r, i: F.when(i == 0, _ring_area_m2(r)).otherwise(-_ring_area_m2(r))),
        F.lit(0.0),
        lambda s, a: s + a,
    )
    return total / F.lit(10000.0)
