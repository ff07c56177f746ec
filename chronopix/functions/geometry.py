"""Grids, boxes and polygons: pixel centres, cells, point in polygon, hulls."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Point = tuple[float, float]
Ring = Sequence[Point]


@dataclass(frozen=True)
class GridSpec:
    """Cells of tile_size (x, y) with pixels of resolution (x, y), in one coordinate system."""

    crs: str
    tile_size: Point
    resolution: Point

    def cell(self, x: Column, y: Column) -> tuple[Column, Column]:
        return F.floor(x / F.lit(self.tile_size[0])).cast("int"), F.floor(y / F.lit(self.tile_size[1])).cast("int")

    def cells(self, ring: Ring) -> list[tuple[int, int]]:
        """Cells that a ring's box overlaps in more than an edge, by x then y."""
        xs, ys = [p[0] for p in ring], [p[1] for p in ring]
        span = lambda lo, hi, s: range(math.floor(lo / s), max(math.floor(lo / s) + 1, math.ceil(hi / s)))
        return [(i, k) for i in span(min(xs), max(xs), self.tile_size[0]) for k in span(min(ys), max(ys), self.tile_size[1])]


    def touching(self, rings: Sequence[Ring]) -> list[tuple[int, int]]:
        """Cells that have more than an edge in common with the area of the rings, by x then y."""
        out = []
        for cell in sorted({c for r in rings for c in self.cells(r)}):
            (x0, y0), (w, h) = (cell[0] * self.tile_size[0], cell[1] * self.tile_size[1]), self.tile_size
            if any(_cuts(r, x0, y0, x0 + w, y0 + h) for r in rings) or holds(rings, x0 + w / 2, y0 + h / 2):
                out.append(cell)
        return out


def _cuts(ring: Ring, x0: float, y0: float, x1: float, y1: float) -> bool:
    """Whether an edge of the ring goes through the inside of the box: what is left of it after clipping has its middle there."""
    points = list(ring)
    for (ax, ay), (bx, by) in zip(points, points[1:] + points[:1], strict=True):
        lo, hi = 0.0, 1.0
        for a, d, low, high in ((ax, bx - ax, x0, x1), (ay, by - ay, y0, y1)):
            if d == 0:
                if not low < a < high:
                    lo, hi = 1.0, 0.0
            else:
                near, far = sorted(((low - a) / d, (high - a) / d))
                lo, hi = max(lo, near), min(hi, far)
        if lo < hi:
            t = (lo + hi) / 2
            if x0 < ax + t * (bx - ax) < x1 and y0 < ay + t * (by - ay) < y1:
                return True
    return False


def holds(rings: Iterable[Ring], x: float, y: float) -> bool:
    """What ``inside`` says, of one point."""
    odd = False
    for ring in rings:
        points = list(ring)
        for (x0, y0), (x1, y1) in zip(points, points[1:] + points[:1], strict=True):
            if (y < y0) != (y < y1) and x < x0 + (y - y0) * (x1 - x0) / (y1 - y0):
                odd = not odd
    return odd


@dataclass(frozen=True)
class GeoBox:
    """A raster of width by height pixels; a pixel's centre is at (c + a * (x + 1/2), f + e * (y + 1/2))."""

    crs: str
    width: int
    height: int
    a: float
    e: float
    c: float
    f: float

    @classmethod
    def around(cls, crs: str, x: Point, y: Point, resolution: Point) -> GeoBox:
        """The smallest box of whole pixels that holds the ranges; rows go from the largest y down."""
        snap = lambda lo, hi, r: (math.floor(round(lo / r, 9)), math.ceil(round(hi / r, 9)))
        rx, ry = abs(resolution[0]), abs(resolution[1])
        (x0, x1), (y0, y1) = snap(min(x), max(x), rx), snap(min(y), max(y), ry)
        return cls(crs, x1 - x0, y1 - y0, rx, -ry, x0 * rx, y1 * ry)

    def centre(self, x: Column, y: Column) -> tuple[Column, Column]:
        return F.lit(self.c) + F.lit(self.a) * (x + F.lit(0.5)), F.lit(self.f) + F.lit(self.e) * (y + F.lit(0.5))


def inside(x: Column, y: Column, rings: Iterable[Ring]) -> Column:
    """Point in polygon by crossings of a ray to the right: odd numbers are inside, so later rings cut holes."""
    crossings = []
    for ring in rings:
        points = list(ring)
        if points[0] != points[-1]:
            points.append(points[0])
        for (x0, y0), (x1, y1) in zip(points, points[1:], strict=False):
            if y0 == y1:
                continue
            at = F.lit(float(x0)) + (y - F.lit(float(y0))) * F.lit((x1 - x0) / (y1 - y0))
            crossings.append((((y < F.lit(float(y0))) != (y < F.lit(float(y1)))) & (x < at)).cast("int"))
    return (reduce(lambda a, b: a + b, crossings, F.lit(0)) % 2) == 1


def hull(points: Iterable[Point]) -> list[Point]:
    """The convex hull, counter-clockwise from the lowest leftmost point, closed; what a union of polygons has is that of all their points."""
    p = sorted(set(map(tuple, points)))
    if len(p) < 3:
        return [*p, p[0]] if p else []

    def half(ps: list[Point]) -> list[Point]:
        out: list[Point] = []
        for q in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]):
                out.pop()
            out.append(q)
        return out[:-1]

    ring = half(p) + half(p[::-1])
    return [*ring, ring[0]]
