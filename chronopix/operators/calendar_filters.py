"""Filters by calendars that come with the data: dry and wet years of a feature, heights of the tide."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronopix.model import ConfigurationError, Epoch

#: Without months, days from the first of July to the end of November count.
DEFAULT_MONTHS = ((7, 1), (11, 30))


def hydrology_years(properties: Mapping[str, Any], kind: str) -> list[int]:
    """Years that the properties whose key contains DY (dry) or WY (wet) give."""
    mark = {"dry": "DY", "wet": "WY"}.get(kind)
    if mark is None:
        raise ValueError(f"type must be dry or wet: {kind!r}")
    return sorted({int(v) for k, v in properties.items() if mark in k and str(v).strip().isdigit()})


def hydrology_windows(years: Sequence[int], months: Sequence[int | str] | None = None) -> list[Epoch]:
    """For each year, from the first month's first day to the last month's 30th (or its last, if earlier), of the following year."""
    out = []
    for y in years:
        if months:
            a, b = int(months[0]), int(months[1])
            last = min(30, calendar.monthrange(y + 1, b)[1])
        else:
            (a, _), (b, last) = DEFAULT_MONTHS
        out.append(Epoch(dt.datetime(y + 1, a, 1), dt.datetime(y + 1, b, last, 23, 59, 59, 999999)))
    return out


def in_windows(df: DataFrame, windows: Sequence[Epoch], time: str = "time") -> DataFrame:
    hit = F.lit(False)
    for w in windows:
        hit = hit | F.col(time).between(F.lit(w.start).cast("timestamp_ntz"), F.lit(w.end).cast("timestamp_ntz"))
    return df.where(hit)


def hydrological_months(df: DataFrame, properties: Mapping[str, Any], kind: str = "dry", months: Sequence[int | str] | None = None) -> DataFrame:
    return in_windows(df, hydrology_windows(hydrology_years(properties, kind), months))


def tide_bands(tide_range: int) -> int:
    if tide_range <= 0 or 100 % tide_range:
        raise ConfigurationError("tide_range must divide 100")
    return 100 // tide_range - 1


def tide_height_band(tides: DataFrame, tide_range: int, tide_percent: int, keys: Sequence[str] = ()) -> DataFrame:
    """Times in one band of height: bands of tide_range % of (highest - lowest), the last twice that, ends rounded to 3 places and both in it; band i (from 0) is asked for by (i + 1) * tide_range."""
    n = tide_bands(tide_range)
    i = tide_percent // tide_range - 1
    if tide_percent % tide_range or not 0 <= i < n:
        raise ConfigurationError(f"tide_percent must be one of {[(k + 1) * tide_range for k in range(n)]}")
    share, wide = tide_range / 100.0, 2 if i == n - 1 else 1
    ends = tides.groupBy(*keys).agg(F.min("height").alias("_lo"), F.max("height").alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    low = F.round(F.col("_lo") + span * F.lit(share * i), 3)
    high = F.round(F.col("_lo") + span * F.lit(share * (i + wide)), 3)
    joined = tides.join(ends, list(keys)) if keys else tides.join(F.broadcast(ends))  # one row of two numbers
    return joined.where(F.col("height").between(low, high)).drop("_lo", "_hi")


def tide_low_high(tides: DataFrame, tide_percent: int, keys: Sequence[str] = ()) -> DataFrame:
    """tides with kind: low (up to lowest + p % of the range) or high (from highest - p %); others go. 50 counts as 25."""
    p = 25 if tide_percent == 50 else tide_percent
    ends = tides.groupBy(*keys).agg(F.min("height").alias("_lo"), F.max("height").alias("_hi"))
    joined = tides.join(ends, list(keys)) if keys else tides.join(F.broadcast(ends))
    part = (F.col("_hi") - F.col("_lo")) * F.lit(p / 100.0)
    kind = F.when(F.col("height") <= F.col("_lo") + part, "low").when(F.col("height") >= F.col("_hi") - part, "high")
    return joined.withColumn("kind", kind).where("kind is not null").drop("_lo", "_hi")


def tide_phase(tides: DataFrame, before: str = "height_before", at: str = "height", after: str = "height_after") -> DataFrame:
    """phase from heights a quarter of an hour before, at and after: ph (peak high), pl (peak low), f (flow, rising) or e (ebb)."""
    b, h, a = F.col(before), F.col(at), F.col(after)
    return tides.withColumn("phase", F.when((b < h) & (h > a), "ph").when((b > h) & (h < a), "pl").when(b < a, "f").otherwise("e"))


def neighbours(tides: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Heights of the row before and after in time, for a regular table of tides."""
    w = Window.partitionBy(*keys).orderBy("time")
    return tides.withColumn("height_before", F.lag("height").over(w)).withColumn("height_after", F.lead("height").over(w)).where("height_before is not null and height_after is not null")


def at_times(df: DataFrame, times: DataFrame, keys: Sequence[str] = ("time",)) -> DataFrame:
    """Rows whose time is listed; sources that have none simply give no rows."""
    return df.join(times.select(*keys), list(keys), "left_semi")


def _compose_tide(df: DataFrame, args: Mapping[str, Any], context: Mapping[str, Any]) -> DataFrame:
    tides = context["tides"]
    low_high = tide_low_high(tides, int(args["tide_percent"]))
    kind = args.get("type", "low")
    if kind not in ("low", "high"):
        raise ValueError(f"type must be low or high: {kind!r}")
    out = low_high.where(F.col("kind") == kind)
    if "epoch" in context:  # heights are of all times, but only those of the first epoch are wanted
        out = in_windows(out, [context["epoch"]])
    if args.get("sub_class"):
        if args["sub_class"] not in ("e", "f", "ph", "pl"):
            raise ValueError(f"unknown sub_class {args['sub_class']!r}")
        out = tide_phase(out).where(F.col("phase") == args["sub_class"])
    return at_times(df, out)


METHODS: dict[str, Callable[[DataFrame, Mapping[str, Any], Mapping[str, Any]], DataFrame]] = {
    "by_hydrological_months": lambda df, a, c: hydrological_months(df, c["properties"], a.get("type", "dry"), a.get("months")),
    "by_tide_height": lambda df, a, c: at_times(df, tide_height_band(c["tides"], int(a["tide_range"]), int(a["tide_percent"])))
    if "tide_range" in a
    else _compose_tide(df, a, c),
}


def filter_product(df: DataFrame, spec: Mapping[str, Any] | None, context: Mapping[str, Any]) -> DataFrame:
    """filter_product of a configuration; context has the feature's properties, its table of tides (time, height, and for a sub_class the heights before and after) and maybe the first epoch."""
    if not spec:
        return df
    if spec["method"] not in METHODS:
        raise ValueError(f"unknown method {spec['method']!r}; known: {', '.join(METHODS)}")
    needs = "properties" if spec["method"] == "by_hydrological_months" else "tides"
    if needs not in context:
        raise ConfigurationError(f"{spec['method']} needs {'a feature' if needs == 'properties' else 'a table of tides'}")
    return METHODS[spec["method"]](df, spec.get("args") or {}, context)


def part_name(feature: Mapping[str, Any], spec: Mapping[str, Any] | None) -> tuple[str, str]:
    """What stands for x and y in the file names of a feature's outputs: by a tide's phase, by its dry or wet years, by its percentage; without a filter its id and place."""
    props, args = feature["properties"], (spec or {}).get("args") or {}
    lon, lat = str(props.get("lon")), str(props.get("lat"))
    if args.get("sub_class"):
        return f"{args['sub_class'].upper()}_{lon}", lat
    if (spec or {}).get("method") == "by_hydrological_months":
        mark = "DY" if args.get("type", "dry") == "dry" else "WY"
        return str(feature["feature_id"]), "_".join(str(v) for k, v in props.items() if mark in k.upper())
    if "tide_percent" in args:
        return f"{feature['feature_id']}_{lon}", f"{lat}_PER_{args['tide_percent']}"
    return str(feature["feature_id"]), ""
