"""Nearest-index percentiles, which are always observations, with where each came from."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronopix.model import ConfigurationError, Measurement
from chronopix.operators.base import PROVENANCE, Statistic, observation, statistic


def ranked(band: Column, whence: bool = True) -> Column:
    """The valid observations of a band in order of value, then time; or (whence false) the values alone."""
    return F.array_sort(F.collect_list(F.when(band.isNotNull(), observation(v=band)) if whence else band))


def nearest(sorted_array: Column, q: float) -> Column:
    """The element at q / 100 of the last index, rounded half to even; NULL of an empty array."""
    last = F.size(sorted_array) - 1
    return F.when(last >= 0, F.get(sorted_array, F.rint(F.lit(q / 100.0) * last).cast("int")))


def complete(inputs: Sequence[Measurement]) -> Column:
    """How many observations lack no band."""
    every = F.lit(True)
    for m in inputs:
        every = every & F.col(f"`{m.name}`").isNotNull()
    return F.count_if(every)


@statistic("percentile")
class Percentile(Statistic):
    """{band}_PC_{q} of every band and q, each with the per-pixel metadata asked for.

    Where some but fewer than minimum_valid_observations observations lack no band, every output is missing, or
    not_valid_mark if that is given (the metadata stay missing); without any, bands that have values keep them.
    """

    def __init__(self, q: float | Sequence[float], minimum_valid_observations: int = 0, not_valid_mark: float | None = None, per_pixel_metadata: Sequence[str] = ()):
        self.qs = list(q) if isinstance(q, (list, tuple)) else [q]
        if bad := [x for x in self.qs if not 0 <= x <= 100]:
            raise ConfigurationError(f"percentiles must be from 0 to 100: {bad}")
        if bad := [x for x in per_pixel_metadata if x not in ("source", "observed", "observed_date")]:
            raise ConfigurationError(f"unknown per_pixel_metadata {bad}")
        self.least, self.mark, self.extra = minimum_valid_observations, not_valid_mark, list(per_pixel_metadata)

    def label(self, band: str, q: float) -> str:
        return f"{band}_PC_{q:g}"

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        out = []
        for m in inputs:
            wide = m.with_(dtype="int16") if m.dtype == "int8" else m
            for q in self.qs:
                out.append(wide.with_(name=self.label(m.name, q)))
                out += [Measurement(f"{self.label(m.name, q)}_{PROVENANCE[x][0]}", PROVENANCE[x][1], PROVENANCE[x][2]) for x in self.extra]
        return out

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        out: dict[str, Column] = {f"{m.name}_sorted": ranked(F.col(f"`{m.name}`"), bool(self.extra)) for m in inputs}
        return out | ({"complete": complete(inputs)} if self.least else {})

    def outputs(self, inputs: Sequence[Measurement], a: Callable[[str], Column]) -> dict[str, Column]:
        short = (a("complete") > 0) & (a("complete") < self.least) if self.least else F.lit(False)
        mark: Any = F.lit(None) if self.mark is None else F.lit(self.mark)
        out = {}
        for m in inputs:
            for q in self.qs:
                o, name = nearest(a(f"{m.name}_sorted"), q), self.label(m.name, q)
                v = o["v"] if self.extra else o
                out[name] = F.when(short, mark).otherwise(v) if self.least else v
                for x in self.extra:
                    suffix, _, _, column = PROVENANCE[x]
                    out[f"{name}_{suffix}"] = F.when(~short, column(o)) if self.least else column(o)
        return out


@statistic("percentile_no_prov")
class PercentileNoProvenance(Percentile):
    """One percentile of every band under the band's own name."""

    def __init__(self, q: float, minimum_valid_observations: int = 0):
        if isinstance(q, (list, tuple)):
            raise ConfigurationError("one q is expected")
        super().__init__(q, minimum_valid_observations)

    def label(self, band: str, q: float) -> str:
        return band

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        return list(inputs)


class InterpolatedPercentile(Statistic):
    """Linear interpolation between neighbours; a library function, in no configuration."""

    def __init__(self, q: float | Sequence[float]):
        self.qs = list(q) if isinstance(q, (list, tuple)) else [q]

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        return [m.with_(name=f"{m.name}_PC_{q:g}", dtype="float64") for m in inputs for q in self.qs]

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        return {f"{m.name}_PC_{q:g}": F.percentile(F.col(f"`{m.name}`"), q / 100.0) for m in inputs for q in self.qs}
