"""Canopy cover classes inside a polygon."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronopix.functions.geometry import Ring, inside
from chronopix.model import ConfigurationError, Measurement
from chronopix.operators.base import Statistic, statistic
from chronopix.sources.regions import read_file


@statistic("mangrove_canopy_cover")
class MangroveCover(Statistic):
    """Of the first band: whether it is over the first threshold, and the number, from 1, of the last listed threshold that it is over (0: none). Outside the rings both are 0. Time stays."""

    reduces = False

    def __init__(self, thresholds: Sequence[float], rings: Sequence[Ring] = (), centre: Callable[[], tuple[Column, Column]] | None = None, bands: Mapping[str, str] | None = None, shape_file: str | None = None, origin: tuple[float, float] = (0.0, 0.0), resolution: float = 25.0):
        if not thresholds:
            raise ConfigurationError("thresholds are needed")
        if shape_file:  # polygons in the units of the grid's coordinates, of which a pixel has so many; y goes down from the origin
            rings = [[((x - origin[0]) / resolution, (origin[1] - y) / resolution) for x, y in r] for s in read_file(shape_file) for r in s["rings"]]
        self.thresholds, self.rings, self.centre = list(thresholds), rings, centre
        self.names = {"extent": "extent", "canopy_cover_class": "canopy_cover_class"} | dict(bands or {})

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        return [Measurement(n, "int16", 0) for n in self.names.values()]

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        v = F.col(f"`{inputs[0].name}`")
        x, y = self.centre() if self.centre else (F.col("x") + 0.5, F.col("y") + 0.5)
        there = inside(x, y, self.rings) if self.rings else F.lit(True)
        level = F.lit(0)
        for i, t in enumerate(self.thresholds, 1):
            level = F.when(v > F.lit(float(t)), F.lit(i)).otherwise(level)
        extent = (there & F.coalesce(v > F.lit(float(self.thresholds[0])), F.lit(False))).cast("short")
        return {self.names["extent"]: extent, self.names["canopy_cover_class"]: F.when(there, level).otherwise(F.lit(0)).cast("short")}
