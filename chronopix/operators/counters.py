"""Counts of bit flags."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronopix.functions.flags import compile_flags, has_flags
from chronopix.model import ConfigurationError, Measurement
from chronopix.operators.base import Statistic, statistic


@statistic("masked_multi_count")
class MaskedMultiCount(Statistic):
    """For each of vars ({name, flags, simple}): on how many times the first band has the flags.

    With nodata_flags, a pixel on which every time has them counts -1, but for simple vars, which count 0.
    """

    incremental = True

    def __init__(self, vars: Sequence[Mapping[str, Any]], nodata_flags: Mapping[str, Any] | None = None):  # noqa: A002
        if len({v["name"] for v in vars}) != len(vars):
            raise ConfigurationError("vars need distinct names")
        self.vars, self.nodata_flags = [dict(v) for v in vars], nodata_flags

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        return [Measurement(v["name"], "int16", -1) for v in self.vars]

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        band, table = F.col(f"`{inputs[0].name}`"), inputs[0].flags_definition
        if table is None:
            raise ConfigurationError(f"{inputs[0].name} has no flags_definition")
        out = {v["name"]: F.count_if(has_flags(band, *compile_flags(table, **v["flags"]))) for v in self.vars}
        if self.nodata_flags:
            out["_valid"] = F.bool_or(has_flags(band, *compile_flags(table, **self.nodata_flags), inverted=True))
        return out

    def outputs(self, inputs: Sequence[Measurement], a: Callable[[str], Column]) -> dict[str, Column]:
        out = {}
        for v in self.vars:
            n = a(v["name"])
            out[v["name"]] = F.when(a("_valid"), n).otherwise(F.lit(-1)) if self.nodata_flags and not v.get("simple") else n
        return out
