"""Statistics that are sums, counts and extremes of expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronopix.functions import scalars
from chronopix.model import ORDER, TIME, ConfigurationError, Measurement
from chronopix.operators.base import Statistic, need, statistic


def _ordered(band: Column) -> Column:
    return F.array_sort(F.collect_list(F.struct(F.col(TIME).alias("t"), F.col(ORDER).alias("o"), band.alias("v"))))


def _position(band: Column, sign: int) -> Column:
    """The place on the pixel's time axis, from 0, of the first smallest (largest) value; missing values have places too."""
    places = F.filter(F.transform(_ordered(band), lambda x, i: F.struct((x["v"] * sign).alias("v"), i.alias("i"))), lambda x: x["v"].isNotNull())
    return F.array_min(places)["i"]


#: Reductions over time by the names that arrays give them; missing values are left out.
REDUCTIONS: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "median": F.median,
    "min": F.min,
    "max": F.max,
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0).cast("double")),
    "prod": lambda c: F.coalesce(F.product(c), F.lit(1.0)),
    "std": F.stddev_pop,
    "var": F.var_pop,
    "count": F.count,
    "any": lambda c: F.coalesce(F.bool_or(c != 0), F.lit(False)),
    "all": lambda c: F.coalesce(F.bool_and(c != 0), F.lit(True)),
    "argmin": lambda c: _position(c, 1),
    "argmax": lambda c: _position(c, -1),
}


@statistic("simple")
class Simple(Statistic):
    """One named reduction of every band."""

    incremental = True

    def __init__(self, reduction_function: str = "mean"):
        if reduction_function not in REDUCTIONS:
            raise ConfigurationError(f"unknown reduction {reduction_function!r}; known: {', '.join(REDUCTIONS)}")
        self.reduction = reduction_function
        self.incremental = reduction_function not in ("median", "argmin", "argmax")

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        return {m.name: REDUCTIONS[self.reduction](F.col(f"`{m.name}`")) for m in inputs}


@statistic("none")
class NoReduction(Statistic):
    """Every observation as it is."""

    reduces = False

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        return {m.name: F.col(f"`{m.name}`") for m in inputs}


@statistic("wofs_summary")
class WaterSummary(Statistic):
    """Times wet and clear of the first band's water classes, and wet over clear; missing where nothing is clear."""

    incremental = True
    # Classes of a byte of water flags that are wet and dry, with and without sea.
    WET, DRY = (128, 132), (0, 4)

    def __init__(self, freq_only: bool = False):
        self.freq_only = freq_only

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        if inputs[0].dtype.startswith("float"):
            raise ConfigurationError("water classes must be integers")
        every = [Measurement("count_wet", "int16", -1), Measurement("count_clear", "int16", -1), Measurement("frequency", "float32", -1)]
        return every[2:] if self.freq_only else every

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        water = F.col(f"`{inputs[0].name}`")
        return {"wet": F.count_if(water.isin(*self.WET)), "clear": F.count_if(water.isin(*self.WET, *self.DRY))}

    def outputs(self, inputs: Sequence[Measurement], a: Callable[[str], Column]) -> dict[str, Column]:
        every = {"count_wet": a("wet"), "count_clear": a("clear"), "frequency": F.try_divide(a("wet"), a("clear"))}
        return {m.name: every[m.name] for m in self.measurements(inputs)}


@statistic("simple_normalised_difference")
class NormalisedDifference(Statistic):
    """Reductions of (band1 - band2) / (band1 + band2); clamping makes aggregates outside [-1, 1] missing, after the reduction."""

    def __init__(self, band1: str, band2: str, name: str, stats: Sequence[str] = ("min", "max", "mean"), clamp_outputs: bool = True):
        if unknown := [s for s in stats if s not in REDUCTIONS]:
            raise ConfigurationError(f"unknown reductions {unknown}")
        self.bands, self.label, self.stats, self.clamp = (band1, band2), name, list(stats), clamp_outputs

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        need(inputs, *self.bands)
        return [Measurement(f"{self.label}_{s}", "float32", -1) for s in self.stats]

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        value = scalars.missing_if_nan(scalars.normalised_difference(*need(inputs, *self.bands)))
        return {f"{self.label}_{s}": REDUCTIONS[s](value) for s in self.stats}

    def outputs(self, inputs: Sequence[Measurement], a: Callable[[str], Column]) -> dict[str, Column]:
        clamp = lambda c: F.when((c >= -1) & (c <= 1), c)
        return {f"{self.label}_{s}": clamp(a(f"{self.label}_{s}")) if self.clamp else a(f"{self.label}_{s}") for s in self.stats}


@statistic("tcwbg_summary")
class TasselledCap(Statistic):
    """Of brightness, greenness and wetness: the fraction of valid observations above a threshold, mean and standard deviation."""

    incremental = True
    BANDS = ("blue", "green", "red", "nir", "swir1", "swir2")
    # Published reflectance coefficients of the transform, and default thresholds.
    COEFFICIENTS: Mapping[str, Mapping[str, float]] = {
        "brightness": {"blue": 0.2043, "green": 0.4158, "red": 0.5524, "nir": 0.5741, "swir1": 0.3124, "swir2": 0.2303},
        "greenness": {"blue": -0.1603, "green": -0.2819, "red": -0.4934, "nir": 0.7940, "swir1": -0.0002, "swir2": -0.1446},
        "wetness": {"blue": 0.0315, "green": 0.2021, "red": 0.3102, "nir": 0.1594, "swir1": -0.6806, "swir2": -0.6109},
    }
    THRESHOLDS: Mapping[str, float] = {"brightness": 4000, "greenness": 600, "wetness": -600}

    def __init__(self, thresholds: Mapping[str, float] | None = None, coeffs: Mapping[str, Mapping[str, float]] | None = None):
        self.thresholds, self.coeffs = thresholds or self.THRESHOLDS, coeffs or self.COEFFICIENTS

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        return [Measurement(f"{p}_{i}", "float32", -1) for p in ("pct_exceedance", "mean", "std") for i in self.coeffs]

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        out = {}
        for index, weights in self.coeffs.items():
            v = scalars.combination(need(inputs, *weights), list(weights.values()))
            out |= {f"above_{index}": F.count_if(v > F.lit(float(self.thresholds[index]))), f"n_{index}": F.count(v), f"mean_{index}": F.avg(v), f"std_{index}": F.stddev_pop(v)}
        return out

    def outputs(self, inputs: Sequence[Measurement], a: Callable[[str], Column]) -> dict[str, Column]:
        return {m.name: F.try_divide(a(f"above_{i}"), a(f"n_{i}")) if m.name.startswith("pct") else a(m.name) for m in self.measurements(inputs) for i in [m.name.rsplit("_", 1)[1]]}


class _Picked(Statistic):
    incremental = True
    pick: Callable

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        at = F.struct(F.col(TIME).alias("t"), F.col(ORDER).alias("o"))
        own = lambda c: F.when(c.isNotNull(), F.struct(at.alias("at"), c.alias("v")))
        return {m.name: type(self).pick(own(F.col(f"`{m.name}`")))["v"] for m in inputs}


@statistic("latest")
class Latest(_Picked):
    """Each band's last valid value."""

    pick = staticmethod(F.max)


@statistic("oldest")
class Oldest(_Picked):
    """Each band's first valid value."""

    pick = staticmethod(F.min)


@statistic("or")
class LogicalOr(Statistic):
    """Whether any valid value is not zero."""

    incremental = True

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        return [m.with_(dtype="bool", nodata=None) for m in inputs]

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        return {m.name: REDUCTIONS["any"](F.col(f"`{m.name}`")) for m in inputs}


@statistic("and")
class LogicalAnd(LogicalOr):
    """Whether all valid values are not zero."""

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        return {m.name: REDUCTIONS["all"](F.col(f"`{m.name}`")) for m in inputs}
