"""What a statistic is: typed outputs, aggregates over a pixel's observations, and columns from those.

All statistics of a job share one grouped aggregation: each gives its aggregates, the frame is grouped once, and
each then gives its outputs from its own aggregates. What is declarative stays a Column, so Catalyst merges equal aggregates
and combines on the map side; a kernel, for what is iterative, gets the aggregated rows in Arrow batches.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import Any, ClassVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronopix.functions.scalars import date_int, days_since, epoch_seconds
from chronopix.model import ORDER, SOURCE, TIME, ConfigurationError, Measurement

#: Name in a configuration -> class.
STATISTICS: dict[str, type[Statistic]] = {}


def statistic(name: str) -> Callable[[type], type]:
    def add(cls: type) -> type:
        STATISTICS[name] = cls
        cls.name = name
        return cls

    return add


class Statistic(ABC):
    name: ClassVar[str] = ""
    #: False: one row out for each row in.
    reduces: ClassVar[bool] = True
    #: True: its aggregates combine in any order and part by part, so they also run on streams.
    incremental: ClassVar[bool] = False

    def measurements(self, inputs: Sequence[Measurement]) -> list[Measurement]:
        """Output bands, known before any data are read; the inputs, unless a statistic says otherwise."""
        return list(inputs)

    @abstractmethod
    def aggregates(self, inputs: Sequence[Measurement]) -> dict[str, Column]:
        """Aggregate columns by name (per-row columns, if it doesn't reduce)."""

    def outputs(self, inputs: Sequence[Measurement], a: Callable[[str], Column]) -> dict[str, Column]:
        """Output columns by band, from the aggregates; by default each is the aggregate of its name."""
        return {m.name: a(m.name) for m in self.measurements(inputs)}

    def kernel(self, inputs: Sequence[Measurement]) -> Kernel | None:
        return None


class Kernel:
    """Arrow columns from one aggregate's column: what Columns cannot say. fields: name -> Spark type of its outputs, which outputs() then finds as aggregates."""

    def __init__(self, source: str, fields: Mapping[str, str], run: Callable[[pa.Array], Sequence[pa.Array]]):
        self.source, self.fields, self.run = source, dict(fields), run


def need(inputs: Sequence[Measurement], *names: str) -> list[Column]:
    known = {m.name for m in inputs}
    if missing := [n for n in names if n not in known]:
        raise ConfigurationError(f"bands {missing} are not among the inputs {sorted(known)}")
    return [F.col(f"`{n}`") for n in names]


def observation(*values: Column, **named: Column) -> Column:
    """A struct that sorts by its values, then by time and order, and carries the source."""
    return F.struct(*values, *[c.alias(n) for n, c in named.items()], F.col(TIME).alias("t"), F.col(ORDER).alias("o"), F.col(SOURCE).alias("s"))


#: Per-pixel metadata about the chosen observation: suffix, dtype, nodata, column.
PROVENANCE: dict[str, tuple[str, str, Any, Callable[[Column], Column]]] = {
    "source": ("source", "int8", -1, lambda o: o["s"].cast("byte")),
    "observed": ("observed", "float64", 0, lambda o: epoch_seconds(o["t"])),
    "observed_date": ("observed_date", "int32", 0, lambda o: date_int(o["t"])),
    "days_since": ("observed", "int16", 0, lambda o: days_since(o["t"])),
}


def reduce_frame(df: DataFrame, keys: Sequence[str], jobs: Iterable[tuple[str, Statistic, Sequence[Measurement]]]) -> DataFrame:
    """keys, and for every (prefix, statistic, inputs) its outputs as prefix + band, from one grouping of df."""
    jobs = list(jobs)
    aggregates, outputs, kernels = [], [], []
    for k, (prefix, stat, inputs) in enumerate(jobs):
        if not stat.reduces:
            raise ConfigurationError(f"{stat.name} does not reduce time; give it a frame of its own")
        named = stat.aggregates(inputs)
        aggregates += [c.alias(f"_{k}_{n}") for n, c in named.items()]
        if kernel := stat.kernel(inputs):
            kernels.append((f"_{k}_", kernel))
        outputs += [c.alias(prefix + n) for n, c in stat.outputs(inputs, lambda n, k=k: F.col(f"`_{k}_{n}`")).items()]
    out = df.groupBy(*keys).agg(*aggregates)
    for prefix, kernel in kernels:
        out = _with_kernel(out, prefix, kernel)
    return out.select(*keys, *outputs)


def per_row(df: DataFrame, keys: Sequence[str], stat: Statistic, inputs: Sequence[Measurement]) -> DataFrame:
    """What a statistic that keeps time gives: a row for each row."""
    named = stat.aggregates(inputs)
    out = stat.outputs(inputs, lambda n: named[n])
    return df.select(*keys, *[c.alias(n) for n, c in out.items()])


def _with_kernel(df: DataFrame, prefix: str, kernel: Kernel) -> DataFrame:
    source = f"{prefix}{kernel.source}"
    kept = [f for f in df.schema if f.name != source]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{prefix}{n}` {t}" for n, t in kernel.fields.items()])
    names, run = [f.name for f in kept], kernel.run

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = run(b.column(b.schema.get_field_index(source)))
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(n)) for n in names] + list(new), names=[*names, *[f"{prefix}{n}" for n in kernel.fields]])

    return df.mapInArrow(mapped, ddl)
