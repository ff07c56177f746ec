"""Statistics from elsewhere, by dotted name."""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from chronopix.model import ORDER, TIME, ConfigurationError, Measurement
from chronopix.operators.base import Kernel, Statistic, statistic


def locate(dotted: str) -> Any:
    """What a dotted name means; the working directory is searched too, for this import only."""
    module, _, name = dotted.rpartition(".")
    if not module:
        raise ConfigurationError(f"{dotted!r} is not a dotted name")
    here = os.getcwd()
    sys.path.insert(0, here)
    try:
        return getattr(importlib.import_module(module), name)
    except (ImportError, AttributeError) as e:
        raise ConfigurationError(f"{dotted!r} cannot be found: {e}") from e
    finally:
        sys.path.remove(here)


class Function(Statistic):
    """A plain function as a statistic: it gets an array (time, band) of each pixel's observations in time order, NaN for missing, and gives one number per output band (by default the inputs)."""

    def __init__(self, func: Callable[[np.ndarray], Sequence[float]], outputs: Sequence[Measurement] | None = None):
        self.func, self.given = func, outputs

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        return list(self.given or inputs)

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        fields = [F.col(f"`{m.name}`").cast("double").alias(f"v{i}") for i, m in enumerate(inputs)]
        return {"obs": F.array_sort(F.collect_list(F.struct(F.col(TIME).alias("t"), F.col(ORDER).alias("o"), *fields)))}

    def kernel(self, inputs: Sequence[Measurement]) -> Kernel:
        bands, func, names = len(inputs), self.func, [m.name for m in self.measurements(inputs)]

        def run(column: pa.Array) -> list[pa.Array]:
            flat, ends = column.flatten(), np.diff(column.offsets.to_numpy()).cumsum()
            x = np.stack([flat.field(f"v{i}").to_numpy(zero_copy_only=False) for i in range(bands)], axis=1).astype(float)
            rows = np.array([func(v) for v in np.split(x, ends[:-1])], float).reshape(len(column), len(names)) if len(column) else np.empty((0, len(names)))
            return [pa.array(rows[:, i], pa.float64(), mask=np.isnan(rows[:, i])) for i in range(len(names))]

        return Kernel("obs", dict.fromkeys(names, "double"), run)


@statistic("external")
class External(Statistic):
    """A Statistic that a user wrote: impl is its class's dotted name, the rest goes to its constructor."""

    def __init__(self, impl: str, *args: Any, **kwargs: Any):
        cls = locate(impl)
        if not (isinstance(cls, type) and issubclass(cls, Statistic)):
            raise ConfigurationError(f"{impl} is no Statistic")
        self.own = cls(*args, **kwargs)
        self.reduces, self.incremental = self.own.reduces, self.own.incremental

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        return self.own.measurements(inputs)

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        return self.own.aggregates(inputs)

    def outputs(self, inputs: Sequence[Measurement], a: Callable[[str], Column]) -> dict[str, Column]:
        return self.own.outputs(inputs, a)

    def kernel(self, inputs: Sequence[Measurement]) -> Kernel | None:
        return self.own.kernel(inputs)
