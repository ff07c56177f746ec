"""Products by name, their scans, and how scenes of one time step become one."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.model import ORDER, PIXEL, SOURCE, TILE, TIME, ConfigurationError, Measurement

KEYS = (*TILE, *PIXEL, TIME, ORDER)


@dataclass(frozen=True)
class Product:
    """A named table of observations: tile_x, tile_y, y, x, time, ord, its bands, and any columns that scenes are searched by.

    scenes, if there is such a table, has dataset_id, tile_x, tile_y and time of each scene, so that planning needs no pixels.
    distinct_times promises that no pixel has two observations of one instant, which spares their fusing.
    """

    name: str
    frame: Callable[[], DataFrame]
    measurements: tuple[Measurement, ...]
    metadata: Mapping[str, Any] = field(default_factory=dict)
    scenes: Callable[[], DataFrame] | None = None
    distinct_times: bool = False

    def times(self) -> DataFrame:
        """tile_x, tile_y, time of the scenes, or of the observations where there is no table of scenes."""
        return (self.scenes or self.frame)().select(*TILE, TIME)

    def measurement(self, name: str) -> Measurement:
        for m in self.measurements:
            if m.name == name:
                return m
        raise ConfigurationError(f"{self.name} has no measurement {name!r}")


class Catalog:
    def __init__(self, products: Sequence[Product] = ()):
        self.products = {p.name: p for p in products}

    def register(self, name: str, frame: DataFrame | Callable[[], DataFrame], measurements: Sequence[Measurement], scenes: DataFrame | Callable[[], DataFrame] | None = None, distinct_times: bool = False, **metadata: Any) -> Product:
        own = lambda f: f if f is None or callable(f) else lambda: f
        self.products[name] = Product(name, own(frame), tuple(measurements), metadata, own(scenes), distinct_times)
        return self.products[name]

    @classmethod
    def of_files(cls, spark: SparkSession, products: Mapping[str, Mapping[str, Any]]) -> Catalog:
        """Products from {name: {path, measurements, and maybe scenes (a path) and distinct_times}}; unreadable files are left out."""
        out = cls()
        for name, p in products.items():
            read = lambda path: lambda: scan(spark, path)
            out.register(name, read(p["path"]), [Measurement(**m) for m in p["measurements"]], read(p["scenes"]) if p.get("scenes") else None, bool(p.get("distinct_times")))
        return out

    def __getitem__(self, name: str) -> Product:
        if name not in self.products:
            raise ConfigurationError(f"unknown product {name!r}; known: {', '.join(sorted(self.products))}")
        return self.products[name]


def scan(spark: SparkSession, path: str, skip_broken: bool = True) -> DataFrame:
    """A Parquet product; unreadable files are left out unless skip_broken is false."""
    return spark.read.option("ignoreCorruptFiles", str(skip_broken).lower()).parquet(path)


def union(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all sources, by column name. Time order is a matter of the aggregates that need it."""
    if not frames:
        raise ConfigurationError("at least one source is needed")
    return reduce(DataFrame.unionByName, frames)


def tag(df: DataFrame, index: int) -> DataFrame:
    return df.withColumn(SOURCE, F.lit(index).cast("byte"))


def solar_day(time: Column, longitude: Column) -> Column:
    """The date of local solar time: 15 degrees of longitude are an hour."""
    return F.timestamp_add("SECOND", F.round(longitude * F.lit(240.0)).cast("int"), time).cast("date")


def first_valid(band: Column, order: Column) -> Column:
    """The first value, in order, that is not missing."""
    return F.min(F.when(band.isNotNull(), F.struct(order.alias("o"), band.alias("v"))))["v"]


def water_fuse(band: Column, order: Column) -> Column:
    """The last value, in order, whose contiguity bit (1) is clear, else the first value."""
    clear = F.max(F.when(band.bitwiseAND(F.lit(2)) == 0, F.struct(order.alias("o"), band.alias("v"))))["v"]
    return F.coalesce(clear, first_valid(band, order))


#: Ways to make one value of the scenes of a time step.
FUSES: dict[str, Callable[[Column, Column], Column]] = {"first_valid": first_valid, "wofs_fuser": water_fuse}


def fuse_of(name: str | None) -> Callable[[Column, Column], Column]:
    """A fuse by its name, or by a dotted name of a function (band, order) -> aggregate column."""
    if name is None:
        return first_valid
    short = name.rsplit(".", 1)[-1]
    if short in FUSES:
        return FUSES[short]
    if "." not in name:
        raise ConfigurationError(f"unknown fuse_func {name!r}")
    module, _, func = name.rpartition(".")
    try:
        return getattr(importlib.import_module(module), func)
    except (ImportError, AttributeError) as e:
        raise ConfigurationError(f"fuse_func {name!r} cannot be found") from e


def fuse_steps(df: DataFrame, hows: Mapping[str, Callable[[Column, Column], Column]], step: Column, keys: Sequence[str] = (*TILE, *PIXEL)) -> DataFrame:
    """keys, _step, time, ord and bands: one row per pixel and step, each band fused by its own rule over the step's scenes in (time, ord) order; time and ord are the first scene's.

    Rows are dealt out by pixel, so that what groups by pixel and more later on, a mask join or the statistics, needs no other shuffle.
    """
    order = F.struct(F.col(TIME).alias("t"), F.col(ORDER).alias("i"))
    rows = df.select(*keys, TIME, ORDER, *[F.col(f"`{b}`") for b in hows], step.alias("_step")).repartition(*keys)
    out = rows.groupBy(*keys, "_step").agg(F.min(order).alias("_at"), *[how(F.col(f"`{b}`"), order).alias(b) for b, how in hows.items()])
    return out.select(*keys, "_step", F.col("_at.t").alias(TIME), F.col("_at.i").alias(ORDER), *[F.col(f"`{b}`") for b in hows])


def fuse(df: DataFrame, bands: Sequence[str], group: Column | None = None, how: Callable[[Column, Column], Column] = first_valid, keys: Sequence[str] = (*TILE, *PIXEL)) -> DataFrame:
    """fuse_steps with one rule, by time or by the group, without the step."""
    return fuse_steps(df, dict.fromkeys(bands, how), F.col(TIME) if group is None else group, keys).drop("_step")
