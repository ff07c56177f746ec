"""Scalar columns: dates, vectors, safe ratios, names."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_int(time: Column) -> Column:
    """YYYYMMDD."""
    return (F.year(time) * 10000 + F.month(time) * 100 + F.dayofmonth(time)).cast("int")


def days_since(time: Column, since: dt.date = dt.date(1970, 1, 1)) -> Column:
    return F.date_diff(time.cast("date"), F.lit(since)).cast("short")


def epoch_seconds(time: Column) -> Column:
    """Seconds since 1970 of a time without zone, as a double."""
    return F.timestamp_diff("MICROSECOND", F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz"), time) / F.lit(1e6)


def missing_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def ratio(n: Column, d: Column) -> Column:
    """n / d with IEEE results for a zero denominator: infinite, or NaN for 0 / 0."""
    inf = F.when(n > 0, F.lit(math.inf)).when(n < 0, F.lit(-math.inf)).when(n == 0, F.lit(math.nan))
    return F.when(d == 0, inf).otherwise(F.try_divide(n, d))


def normalised_difference(a: Column, b: Column) -> Column:
    return ratio(a - b, a + b)


def combination(bands: Sequence[Column], weights: Sequence[float]) -> Column:
    """Sum of weight * band, from the left; NULL where a band is."""
    return reduce(lambda x, y: x + y, [b * F.lit(float(w)) for b, w in zip(bands, weights, strict=True)])


def product(values: Sequence[int]) -> int:
    return math.prod(values)


def format_bytes(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if abs(n) < 1024 or unit == "TB":
            return f"{n:.1f} {unit}" if unit != "B" else f"{int(n)} B"
        n /= 1024
    raise AssertionError


def format_seconds(s: float) -> str:
    m, s = divmod(s, 60)
    h, m = divmod(int(m), 60)
    return f"{h}:{m:02d}:{s:04.1f}"
