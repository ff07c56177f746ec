"""Medoids: the observation whose distances to the others, over all bands, sum to the least."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from chronopix.model import ORDER, SOURCE, TIME, ConfigurationError, Measurement
from chronopix.operators.base import PROVENANCE, Kernel, Statistic, need, statistic
from chronopix.operators.geomedian import BLOCK, _blocks
from chronopix.operators.percentile import complete

#: Decimals of a sum of distances: sums that differ by less tie, and ties go to the earliest observation.
DECIMALS = 9


def totals(x: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """For x (n, time, bands), whose rows count where valid (n, time), the sum of each row's distances to the others; infinite where it doesn't count. So many rows at once as BLOCK allows."""
    n, depth, bands = x.shape
    out = np.empty((n, depth))
    some = max(1, BLOCK // max(1, n * depth))
    for a in range(0, depth, some):
        square = np.zeros((n, min(some, depth - a), depth))
        for k in range(bands):
            square += (x[:, a : a + some, None, k] - x[:, None, :, k]) ** 2
        out[:, a : a + some] = np.where(valid[:, None, :], np.sqrt(square), 0.0).sum(axis=2)
    return np.where(valid, np.round(out, DECIMALS), np.inf)


def best(column: pa.Array, bands: int) -> np.ndarray:
    """The place, among all observations of the column's lists of structs (v0, ..., t, o), of each list's medoid; -1 for an empty list."""
    flat, starts = column.flatten(), np.diff(column.offsets.to_numpy()).cumsum() - np.diff(column.offsets.to_numpy())
    out = np.full(len(column), -1)
    if not len(flat):
        return out
    order = np.empty(len(flat), np.int64)
    t, o = flat.field("t").cast(pa.int64()).to_numpy(zero_copy_only=False), flat.field("o").to_numpy(zero_copy_only=False)
    order[np.lexsort((o, t))] = np.arange(len(flat))
    for rows, x, valid in _blocks(column, bands):
        d = totals(x, valid)
        places = np.minimum(starts[rows][:, None] + np.arange(x.shape[1])[None, :], len(flat) - 1)
        earliest = np.where(d == d.min(axis=1, keepdims=True), order[places], len(flat)).argmin(axis=1)
        out[rows] = np.where(valid.any(axis=1), starts[rows] + earliest, -1)
    return out


@statistic("medoid")
class Medoid(Statistic):
    """The medoid's bands, with per-pixel metadata.

    Observations that lack an input band cannot be it. With fewer complete ones than minimum_valid_observations everything
    is missing. input_measurements are compared, output_measurements are kept; both default to all bands.
    """

    def __init__(self, minimum_valid_observations: int = 0, input_measurements: Sequence[str] | None = None, output_measurements: Sequence[str] | None = None, metadata_producers: Sequence[str] = ("days_since",)):
        if bad := [x for x in metadata_producers if x not in PROVENANCE]:
            raise ConfigurationError(f"unknown metadata producers {bad}")
        self.least, self.compared, self.kept, self.extra = minimum_valid_observations, input_measurements, output_measurements, list(metadata_producers)

    def _bands(self, inputs: Sequence[Measurement]) -> tuple[list[Measurement], list[Measurement]]:
        by = {m.name: m for m in inputs}
        need(inputs, *(self.compared or ()), *(self.kept or ()))
        return [by[n] for n in self.compared or by], [by[n] for n in self.kept or by]

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        return [*self._bands(inputs)[1], *[Measurement(PROVENANCE[x][0], PROVENANCE[x][1], PROVENANCE[x][2]) for x in self.extra]]

    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        compared, kept = self._bands(inputs)
        whole = F.lit(True)
        for m in compared:
            whole = whole & F.col(f"`{m.name}`").isNotNull()
        fields = {f"v{i}": F.col(f"`{m.name}`").cast("double") for i, m in enumerate(compared)} | {f"k{i}": F.col(f"`{m.name}`").cast(m.spark_type) for i, m in enumerate(kept)}
        fields |= {"t": F.col(TIME), "o": F.col(ORDER).cast("bigint"), "s": F.col(SOURCE).cast("byte")}
        return {"obs": F.collect_list(F.when(whole, F.struct(*[c.alias(n) for n, c in fields.items()])))} | ({"complete": complete(compared)} if self.least else {})

    def outputs(self, inputs: Sequence[Measurement], a: Callable[[str], Column]) -> dict[str, Column]:
        kept = self._bands(inputs)[1]
        chosen = F.struct(*[a(n).alias(n) for n in [*[f"k{i}" for i in range(len(kept))], "t", "o", "s"]])
        chosen = F.when(a("t").isNotNull() & (a("complete") >= self.least if self.least else F.lit(True)), chosen)
        return {m.name: chosen[f"k{i}"] for i, m in enumerate(kept)} | {PROVENANCE[x][0]: PROVENANCE[x][3](chosen) for x in self.extra}

    def kernel(self, inputs: Sequence[Measurement]) -> Kernel:
        compared, kept = self._bands(inputs)
        names, bands = [*[f"k{i}" for i in range(len(kept))], "t", "o", "s"], len(compared)

        def run(column: pa.Array) -> list[pa.Array]:
            at, flat = best(column, bands), column.flatten()
            return [flat.field(n).take(pa.array(at, pa.int64(), mask=at < 0)) for n in names]

        kinds = [m.spark_type.simpleString() for m in kept]
        return Kernel("obs", dict(zip(names, [*kinds, "timestamp_ntz", "bigint", "tinyint"], strict=True)), run)


@statistic("medoid_no_prov")
class MedoidNoProvenance(Medoid):
    def __init__(self, minimum_valid_observations: int = 0, input_measurements: Sequence[str] | None = None):
        super().__init__(minimum_valid_observations, input_measurements, metadata_producers=())


@statistic("medoid_simple")
class MedoidSimple(Medoid):
    """The medoid with days since 1970."""

    def __init__(self, minimum_valid_observations: int = 0):
        super().__init__(minimum_valid_observations, metadata_producers=("days_since",))
