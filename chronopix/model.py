"""Plain descriptions that a job is made of."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T


class ConfigurationError(ValueError):
    """A job that cannot be planned."""


class ProcessingError(RuntimeError):
    """A job that failed while it ran."""


#: Storage types of bands and the Spark types that hold them.
DTYPES: dict[str, T.DataType] = {
    "int8": T.ByteType(), "uint8": T.ShortType(), "int16": T.ShortType(), "uint16": T.IntegerType(), "int32": T.IntegerType(),
    "int64": T.LongType(), "float32": T.FloatType(), "float64": T.DoubleType(), "bool": T.BooleanType(),
}

#: Columns that place an observation: pixel, time, and an order that makes (pixel, time, ord) unique.
PIXEL, TILE, TIME, ORDER, SOURCE = ("y", "x"), ("tile_x", "tile_y"), "time", "ord", "source"


@dataclass(frozen=True)
class Measurement:
    """A band: how it is stored, and which value stands for missing there. Inside the engine missing is NULL."""

    name: str
    dtype: str = "float32"
    nodata: float | int | None = None
    units: str = "1"
    flags_definition: Mapping[str, Any] | None = None
    attrs: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.dtype not in DTYPES:
            raise ConfigurationError(f"unknown dtype {self.dtype!r} of {self.name}")

    @property
    def spark_type(self) -> T.DataType:
        return DTYPES[self.dtype]

    @property
    def fill(self) -> float | int | None:
        """The stored form of missing: the declared value, else NaN for floats and 0 for integers."""
        if self.nodata is not None:
            return self.nodata
        return float("nan") if self.dtype.startswith("float") else 0

    def with_(self, **changes: Any) -> Measurement:
        return Measurement(**{**self.__dict__, **changes})

    def metadata(self) -> dict[str, Any]:
        fill = self.fill
        out = {"dtype": self.dtype, "units": self.units, "nodata": "NaN" if fill != fill else fill, **self.attrs}
        return out | ({"flags_definition": {k: dict(v) for k, v in self.flags_definition.items()}} if self.flags_definition else {})


@dataclass(frozen=True)
class Epoch:
    """A closed interval of time; generated ones end one microsecond before the next instant."""

    start: dt.datetime
    end: dt.datetime

    def clip(self, window: tuple[dt.datetime, dt.datetime] | None) -> Epoch | None:
        """What both have in common; touching ends count, apart they are None."""
        if window is None:
            return self
        a, b = max(self.start, window[0]), min(self.end, window[1])
        return Epoch(a, b) if a <= b else None


@dataclass(frozen=True)
class OutputProduct:
    name: str
    statistic: Any
    inputs: tuple[Measurement, ...]
    measurements: tuple[Measurement, ...]
    stat_name: str = ""
    template: str | None = None
    params: Mapping[str, Any] = field(default_factory=dict)
    metadata: Mapping[str, Any] = field(default_factory=dict)
