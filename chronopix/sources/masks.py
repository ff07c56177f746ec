"""Missing values and masks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronopix.functions.flags import classes, compile_flags, has_flags
from chronopix.model import ConfigurationError, Measurement


def without_nodata(m: Measurement) -> Column:
    """The band with its sentinel, and NaN, as NULL."""
    c = F.col(f"`{m.name}`")
    if m.dtype.startswith("float"):
        c = F.when(~F.isnan(c), c)
    if m.nodata is not None and m.nodata == m.nodata:
        c = F.nullif(c, F.lit(m.nodata))
    return c.alias(m.name)


def predicate(spec: Mapping[str, Any], m: Measurement) -> Column:
    """Where observations stay. Of flags, less_than, greater_than and nonmasked_values the first that is given counts; a missing mask value masks, whether inverted or not."""
    c = F.col(f"`{m.name}`")
    if "flags" in spec:
        if not m.flags_definition:
            raise ConfigurationError(f"{m.name} has no flags_definition")
        keep = has_flags(c, *compile_flags(m.flags_definition, **spec["flags"]))
    elif "less_than" in spec:
        keep = c < F.lit(spec["less_than"])
    elif "greater_than" in spec:
        keep = c > F.lit(spec["greater_than"])
    elif "nonmasked_values" in spec:
        names = spec["nonmasked_values"]
        keep = c.isin(*(classes(m.flags_definition, names) if m.flags_definition else names))
    else:
        raise ConfigurationError("a mask needs flags, less_than, greater_than or nonmasked_values")
    keep = ~keep if spec.get("invert") else keep
    return F.coalesce(keep & c.isNotNull(), F.lit(False))


def apply(df: DataFrame, bands: Sequence[Measurement], keep: Sequence[Column], in_place: bool = False) -> DataFrame:
    """Bands become missing where any predicate fails; in place they become the band's sentinel, which then counts as a value."""
    if not keep:
        return df
    every = reduce(lambda a, b: a & b, keep)
    masked = lambda m: F.when(every, F.col(f"`{m.name}`")).otherwise(F.lit(m.fill).cast(df.schema[m.name].dataType)) if in_place else F.when(every, F.col(f"`{m.name}`"))
    return df.withColumns({m.name: masked(m) for m in bands})
