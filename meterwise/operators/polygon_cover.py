"""Adaptive quadtree covers of polygons: cells wholly inside, and boundary cells with the few edges that decide there."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: a polygon's box is halved at most so often; covers of polygons with few edges stop earlier
MAX_DEPTH = 8
SMALLEST = 2.0**-30


def _edges(rings: list) -> np.ndarray:
    """All edges of all rings: ax, ay, bx, by."""
    points = [np.array(ring, dtype=float).reshape(-1, 2) for ring in rings or [] if ring]
    return np.concatenate([np.hstack([p, np.roll(p, -1, axis=0)]) for p in points]) if points else np.zeros((0, 4))


def _touching(low: np.ndarray, width: float, edges: np.ndarray) -> np.ndarray:
    """Which edges may touch the closed square at `low` (row by row): boxes overlap and the corners lie on both sides.

    The slack is on the safe side: a cell that only comes near an edge counts as boundary."""
    a, b = edges[:, :2], edges[:, 2:]
    overlap = ((np.minimum(a, b) <= low + width) & (np.maximum(a, b) >= low)).all(axis=1)
    d = b - a
    base = d[:, 0] * (low[:, 1] - a[:, 1]) - d[:, 1] * (low[:, 0] - a[:, 0])
    turns = np.stack([base, base - d[:, 1] * width, base + d[:, 0] * width, base + (d[:, 0] - d[:, 1]) * width])
    length = np.abs(d).sum(axis=1)
    slack = 1e-12 + 1e-11 * length * (length + width)
    return overlap & (turns.min(axis=0) <= slack) & (turns.max(axis=0) >= -slack)


def _inside(points: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Even-odd test of points against all edges, in blocks."""
    out = np.zeros(len(points), dtype=bool)
    ax, ay, bx, by = edges.T
    slope = (bx - ax) / np.where(by == ay, 1.0, by - ay)
    step = max(1, 1_000_000 // max(1, len(edges)))
    for k in range(0, len(points), step):
        x, y = points[k : k + step, :1], points[k : k + step, 1:]
        out[k : k + step] = (((ay > y) != (by > y)) & (x < ax + (y - ay) * slope)).sum(axis=1) % 2 == 1
    return out


def cover(rings: list) -> Iterator[tuple[int, int, int, bool, bool, list]]:
    """Cells level, cx, cy (a square of width 2^level at cx, cy widths) of one polygon, whether they lie wholly inside and,
    for boundary cells, the parity of edges that lie right of the whole cell and the other edges a ray to the right may meet.

    Polygons without points or with coordinates that are not finite have no cells."""
    edges = _edges(rings)
    if not len(edges) or not np.isfinite(edges).all():
        return
    low, high = edges[:, :2].min(axis=0), edges[:, :2].max(axis=0)
    level = int(np.ceil(np.log2(max(*(high - low), SMALLEST))))
    depth = min(MAX_DEPTH, 2 + int(np.ceil(np.log2(len(edges)) / 2)))
    width = 2.0**level
    first, last = np.floor(low / width).astype(np.int64), np.floor(high / width).astype(np.int64)
    cells = np.array([(x, y) for x in range(first[0], last[0] + 1) for y in range(first[1], last[1] + 1)])
    # pairs of a cell and an edge that may touch it
    cell, edge = np.repeat(np.arange(len(cells)), len(edges)), np.tile(np.arange(len(edges)), len(cells))
    quarters = np.array([(0, 0), (0, 1), (1, 0), (1, 1)])
    for left in range(depth, -1, -1):
        near = _touching(cells[cell] * width, width, edges[edge])
        cell, edge = cell[near], edge[near]
        crossed = np.bincount(cell, minlength=len(cells)) > 0
        free = cells[~crossed]
        for x, y in free[_inside((free + 0.5) * width, edges)].tolist():
            yield level, x, y, True, False, []
        place, cells = np.cumsum(crossed) - 1, cells[crossed]
        if left:
            cells = (cells[:, None] * 2 + quarters).reshape(-1, 2)
            cell, edge = (place[cell][:, None] * 4 + np.arange(4)).ravel(), np.repeat(edge, 4)
            level, width = level - 1, width / 2
    small, large = np.minimum(edges[:, :2], edges[:, 2:]), np.maximum(edges[:, :2], edges[:, 2:])
    for row in np.unique(cells[:, 1]).tolist():
        bottom, top = row * width, (row + 1) * width
        strip = np.flatnonzero((small[:, 1] <= top) & (large[:, 1] >= bottom))
        across = (small[strip, 1] <= bottom) & (large[strip, 1] >= top)
        for x in cells[cells[:, 1] == row, 0].tolist():
            right = across & (small[strip, 0] > (x + 1) * width + 1e-9 * (1 + abs(x + 1) * width))
            here = strip[~right & (large[strip, 0] >= x * width)]
            yield level, x, row, False, bool(right.sum() % 2), edges[here].tolist()


def polygon_cells(polygons: DataFrame) -> DataFrame:
    """The cells of all polygons (rings, label, ord): level, cx, cy, whole, flip, edges, label, ord."""
    kind = polygons.schema["ord"].dataType.simpleString()
    schema = f"level int, cx long, cy long, whole boolean, flip boolean, edges array<array<double>>, label string, ord {kind}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.list_(pa.float64())), pa.string()]
        names = ["level", "cx", "cy", "whole", "flip", "edges", "label", "ord"]
        for batch in batches:
            for k, rings in enumerate(batch.column(0)):
                rows = list(cover(rings.as_py()))
                for at in range(0, len(rows), 1024):
                    part = [*zip(*rows[at : at + 1024], strict=True)]
                    n = len(part[0])
                    columns = [pa.array(c, type=t) for c, t in zip(part, types, strict=False)]
                    own = [batch.column(j).take(pa.array([k] * n, type=pa.int64())) for j in (1, 2)]
                    yield pa.RecordBatch.from_arrays([*columns, own[0].cast(pa.string()), own[1]], names=names)

    return polygons.select("rings", "label", "ord").mapInArrow(run, schema)
