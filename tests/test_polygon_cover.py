import math

import numpy as np
import pytest
from conftest import rows

from meterwise.operators import spatial
from meterwise.operators.polygon_cover import MAX_DEPTH, cover

SCHEMA = "commune string, rings array<array<array<double>>>, ord long"


def star(x, y, size, points, seed):
    """A closed ring of many uneven spikes."""
    rng = np.random.default_rng(seed)
    turns = [2 * math.pi * k / points for k in range(points)]
    ring = [[x + r * math.cos(t), y + r * math.sin(t)] for t, r in zip(turns, rng.uniform(0.4 * size, size, points).tolist(), strict=True)]
    return [*ring, ring[0]]


def plain_inside(x, y, rings):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                odd = not odd
    return odd


def covering(x, y, cells):
    return [c for c in cells if math.floor(x / 2.0 ** c[0]) == c[1] and math.floor(y / 2.0 ** c[0]) == c[2]]


@pytest.mark.parametrize("points", [3, 40, 900])
def test_cells_decide_like_all_edges(points):
    rings = [star(3.0, -2.0, 10.0, points, points), star(3.0, -2.0, 3.0, 12, 1)]
    cells = list(cover(rings))
    rng = np.random.default_rng(2)
    whole = 0
    for x, y in rng.uniform((-9, -14), (15, 10), (1500, 2)).tolist():
        mine = covering(x, y, cells)
        assert len(mine) <= 1  # cells of one polygon never overlap
        if not mine:
            found = False
        elif mine[0][3]:
            found, whole = True, whole + 1
        else:
            met = sum((ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay) for ax, ay, bx, by in mine[0][5])
            found = (met + mine[0][4]) % 2 == 1
        assert found == plain_inside(x, y, rings), (x, y)
    assert whole > 20


def test_every_corner_lies_in_a_boundary_cell():
    rings = [star(0.0, 0.0, 1.0, 300, 4), [[0, 0], [0.125, 0], [0.125, 0.125], [0, 0.125], [0, 0]]]
    cells = list(cover(rings))
    assert all(len(mine) == 1 and not mine[0][3] for mine in (covering(x, y, cells) for ring in rings for x, y in ring))


def test_work_grows_with_the_boundary():
    """A large square among small ones has as many boundary cells as they, and its edges are not stored per cell."""
    square = lambda s: [[[0.1, 0.1], [0.1 + s, 0.1], [0.1 + s, 0.1 + s], [0.1, 0.1 + s], [0.1, 0.1]]]
    small, large = (sum(not c[3] for c in cover(square(s))) for s in (0.01, 1000.0))
    assert large < 2 * small < 400
    cells = list(cover([star(0.0, 0.0, 1.0, 20_000, 3)]))
    boundary = [c for c in cells if not c[3]]
    assert len(boundary) <= 4 ** (MAX_DEPTH + 1) and np.mean([len(c[5]) for c in boundary]) < 20_000 / 10


def test_no_cells_of_odd_shapes():
    assert list(cover(None)) == list(cover([])) == list(cover([[]])) == list(cover([[[0.0, float("nan")], [1.0, 1.0]]])) == []
    assert len(list(cover([[[2.0, 3.0]]]))) >= 1  # a single point is all boundary


def test_points_meet_polygons_of_very_different_sizes(spark):
    """Thousands of small squares, a country-sized star, overlaps by order, borders, holes, and points far away."""
    wide = [star(50.0, 50.0, 60.0, 500, 7), [[49.0, 49.0], [51.0, 49.0], [51.0, 51.0], [49.0, 51.0], [49.0, 49.0]]]
    shapes = [("wide", wide, 5000), ("none", [], 1), ("null", None, 2)]
    small = {(i, j): [[[i + 0.2, j + 0.2], [i + 0.4, j + 0.2], [i + 0.4, j + 0.4], [i + 0.2, j + 0.4], [i + 0.2, j + 0.2]]] for i in range(40) for j in range(40)}
    shapes += [(f"{i} {j}", ring, 10 + 40 * i + j) for (i, j), ring in small.items()]
    rng = np.random.default_rng(11)
    points = [(k, *p) for k, p in enumerate(rng.uniform(-20, 120, (3000, 2)).tolist())]
    points += [(3000 + k, i + 0.3, j + 0.3) for k, (i, j) in enumerate(list(small)[::7])] + [(9000, 0.2, 0.3), (9001, 1e9, -1e9), (9002, None, 3.0)]

    def plain(x, y):
        if x is None:
            return None
        at = (math.floor(x), math.floor(y))
        if at in small and plain_inside(x, y, small[at]) and (x, y) != (0.2, 0.3):
            return f"{at[0]} {at[1]}"
        return "wide" if plain_inside(x, y, wide) else None

    table = spark.createDataFrame(points, "k long, longitude double, latitude double")
    found = spatial.assign_polygons(table, spark.createDataFrame(shapes, SCHEMA))
    assert dict(rows(found, "k", "commune")) == {k: plain(x, y) for k, x, y in points}
    nothing = spatial.assign_polygons(table, spark.createDataFrame([], SCHEMA))
    assert nothing.filter("commune IS NOT NULL").count() == 0 and nothing.count() == len(points)
