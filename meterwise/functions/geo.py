"""Planar geometry and projections on nested arrays: polygon > ring > point > [x, y]."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: Lambert-93 (EPSG:2154) constants
L93_N = 0.7256077650532670
L93_C = 11754255.4261
L93_XS = 700000.0
L93_YS = 12655612.0499
L93_LON0 = 3.0
L93_E = 0.08181919104281579
EARTH_RADIUS = 6378137.0


def lambert93_to_lonlat(x: Column, y: Column) -> Column:
    """EPSG:2154 metres to [lon, lat] degrees; the latitude by six fixed-point steps."""
    dx, dy = x - L93_XS, F.lit(L93_YS) - y
    radius = F.sqrt(dx * dx + dy * dy)
    lon = L93_LON0 + F.degrees(F.atan(dx / dy) / L93_N)
    base = F.exp(-F.log(radius / L93_C) / L93_N)
    start = 2 * F.atan(base) - math.pi / 2

    def step(phi: Column, _: Column) -> Column:
        s = L93_E * F.sin(phi)
        return 2 * F.atan(F.pow((1 + s) / (1 - s), L93_E / 2) * base) - math.pi / 2

    lat = F.aggregate(F.array_repeat(F.lit(0), 6), start, step, F.degrees)
    return F.array(lon, lat)


def lonlat_to_mercator(lon: Column, lat: Column) -> Column:
    """EPSG:4326 degrees to spherical Mercator [x, y] metres."""
    return F.array(
        F.radians(lon) * EARTH_RADIUS,
        F.log(F.tan(math.pi / 4 + F.radians(lat) / 2)) * EARTH_RADIUS,
    )


def project_rings(rings: Column, project) -> Column:
    """Apply a point projection to every vertex of a polygon."""
    return F.transform(rings, lambda ring: F.transform(ring, lambda p: project(p[0], p[1])))


def _edges(ring: Column) -> Column:
    n = F.size(ring)
    return F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.array(ring[i][0], ring[i][1], ring[(i + 1) % n][0], ring[(i + 1) % n][1]),
    )


def _all_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, _edges))


def on_edges(x: Column, y: Column, edges: Column) -> Column:
    """True when the point lies on one of the edges [ax, ay, bx, by]."""

    def touches(e: Column) -> Column:
        ax, ay, bx, by = e[0], e[1], e[2], e[3]
        cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        inside_x = x.between(F.least(ax, bx), F.greatest(ax, bx))
        inside_y = y.between(F.least(ay, by), F.greatest(ay, by))
        return (F.abs(cross) < 1e-12) & inside_x & inside_y

    return F.exists(edges, touches)


def crossings(x: Column, y: Column, edges: Column) -> Column:
    """Number of edges [ax, ay, bx, by] that a ray to the right meets."""

    def crossing(e: Column) -> Column:
        ax, ay, bx, by = e[0], e[1], e[2], e[3]
        straddles = (ay > y) != (by > y)
        return F.when(straddles & (x < ax + (y - ay) * (bx - ax) / F.nullif(by - ay, F.lit(0.0))), 1).otherwise(0)

    return F.aggregate(edges, F.lit(0), lambda acc, e: acc + crossing(e))


def on_boundary(x: Column, y: Column, rings: Column) -> Column:
    """True when the point lies on an edge of any ring."""
    return on_edges(x, y, _all_edges(rings))


def even_odd_inside(x: Column, y: Column, rings: Column) -> Column:
    """Ray casting over all rings, so holes count as outside."""
    return crossings(x, y, _all_edges(rings)) % 2 == 1


def within(x: Column, y: Column, rings: Column) -> Column:
    return even_odd_inside(x, y, rings) & ~on_boundary(x, y, rings)


def intersects(x: Column, y: Column, rings: Column) -> Column:
    return even_odd_inside(x, y, rings) | on_boundary(x, y, rings)


def bounding_box(rings: Column) -> Column:
    points = F.flatten(rings)
    xs = F.transform(points, lambda p: p[0])
    ys = F.transform(points, lambda p: p[1])
    return F.struct(
        F.array_min(xs).alias("min_x"),
        F.array_min(ys).alias("min_y"),
        F.array_max(xs).alias("max_x"),
        F.array_max(ys).alias("max_y"),
    )
