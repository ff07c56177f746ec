"""Calendar epochs, and the join of observations to them."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Iterable, Iterator

from dateutil.relativedelta import relativedelta
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.model import TIME, ConfigurationError, Epoch

MICRO = dt.timedelta(microseconds=1)
#: Epochs, counted once per month that they touch, that may be broadcast; more are joined by shuffling.
BROADCAST_ROWS = 200_000


def parse_duration(text: str, units: str = "ymdM") -> relativedelta:
    """'<n><unit>': y(ears), m(onths), d(ays) or M(icroseconds)."""
    n, unit = text[:-1], text[-1:]
    if not n.isdigit() or unit not in units or not unit:
        raise ValueError(f"{text!r}: a number and one of {units} is expected")
    return relativedelta(**{{"y": "years", "m": "months", "d": "days", "M": "microseconds"}[unit]: int(n)})


def _starts(start: dt.datetime, step: str, end: dt.datetime) -> Iterator[dt.datetime]:
    """start and every step after it; months or years that lack its day of the month are left out, not moved."""
    parse_duration(step, "ymd")
    n, unit = int(step[:-1]), step[-1]
    if n <= 0:
        raise ValueError("a step must be over 0")
    k = 0
    while True:
        if unit == "d":
            at = start + dt.timedelta(days=k * n)
        else:
            month = start.month - 1 + k * n * (12 if unit == "y" else 1)
            year, month = start.year + month // 12, month % 12 + 1
            if year > 9999 or dt.datetime(year, month, 1) > end:
                return
            if start.day > calendar.monthrange(year, month)[1]:
                k += 1
                continue
            at = start.replace(year=year, month=month)
        if at > end:
            return
        yield at
        k += 1


def date_sequence(start: dt.datetime, end: dt.datetime, duration: str, step: str) -> list[Epoch]:
    """Epochs from start by step, each as long as duration less a microsecond, whose end is not after end."""
    length = parse_duration(duration)
    out = []
    for a in _starts(start, step, end):
        b = a + length - MICRO
        if b <= end:
            out.append(Epoch(a, b))
    return out


def intersect(window: tuple[str | dt.datetime, str | dt.datetime] | None, epoch: Epoch) -> Epoch | None:
    """The epoch clipped to a source's window."""
    return epoch.clip(tuple(map(as_time, window)) if window else None)


def as_time(x: str | dt.date | dt.datetime) -> dt.datetime:
    if isinstance(x, dt.datetime):
        return x
    if isinstance(x, dt.date):
        return dt.datetime(x.year, x.month, x.day)
    return dt.datetime.fromisoformat(str(x))


def days_with_data(products: Iterable[DataFrame], start: dt.datetime, end: dt.datetime, most: int = 100_000) -> list[Epoch]:
    """One epoch per day on which any product has a scene, in order. Days are distinct dates, so they are few."""
    days = None
    for p in products:
        own = p.where(F.col(TIME).between(F.lit(start), F.lit(end))).select(F.col(TIME).cast("date").alias("day")).groupBy("day").count().where("count > 0").select("day")
        days = own if days is None else days.union(own)
    if days is None:
        return []
    rows = days.distinct().orderBy("day").limit(most + 1).collect()
    if len(rows) > most:
        raise ConfigurationError(f"more than {most} days")
    return [Epoch(a := as_time(r["day"]), a + dt.timedelta(days=1) - MICRO) for r in rows]


def epochs_of(config: dict, products: Iterable[DataFrame] = ()) -> list[Epoch]:
    """date_ranges: by type first (find_daily_data), then a single range where neither duration nor step is given, whose end is itself in it, else a sequence."""
    start, end = as_time(config["start_date"]), as_time(config["end_date"])
    if start > end:
        raise ConfigurationError("start_date is after end_date")
    kind, duration, step = config.get("type"), config.get("stats_duration"), config.get("step_size")
    if kind == "find_daily_data":
        return days_with_data(products, start, end)
    if kind not in (None, "simple"):
        raise ConfigurationError(f"unknown type of date_ranges: {kind!r}")
    if duration is None and step is None:
        return [Epoch(start, end)]
    if duration is None or step is None:
        raise ConfigurationError("stats_duration and step_size go together")
    return date_sequence(start, end, duration, step)


def for_year(config: dict, year: int) -> dict:
    return {**config, "start_date": dt.datetime(year, 1, 1), "end_date": dt.datetime(year + 1, 1, 1)}


def _month(t: Column) -> Column:
    return F.year(t) * 12 + F.month(t)


def epoch_frame(spark: SparkSession, epochs: list[Epoch]) -> DataFrame:
    return spark.createDataFrame([(i, e.start, e.end) for i, e in enumerate(epochs)], "epoch_id int, epoch_start timestamp_ntz, epoch_end timestamp_ntz")


def assign(obs: DataFrame, epochs: list[Epoch], time: str = TIME) -> DataFrame:
    """Observations with epoch_id, epoch_start, epoch_end, once for each epoch that holds them.

    The interval join is an equality on the month plus a comparison, so many short epochs cost no nested loop. A single
    epoch is a plain filter that reaches the scan.
    """
    if not epochs:
        return obs.where(F.lit(False)).select("*", F.lit(0).alias("epoch_id"), F.lit(None).cast("timestamp_ntz").alias("epoch_start"), F.lit(None).cast("timestamp_ntz").alias("epoch_end"))
    first, last = min(e.start for e in epochs), max(e.end for e in epochs)
    obs = obs.where(F.col(time).between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))
    if len(epochs) == 1:
        return obs.select("*", F.lit(0).alias("epoch_id"), F.lit(first).cast("timestamp_ntz").alias("epoch_start"), F.lit(last).cast("timestamp_ntz").alias("epoch_end"))
    months = [(i, e.start, e.end, m) for i, e in enumerate(epochs) for m in range(e.start.year * 12 + e.start.month, e.end.year * 12 + e.end.month + 1)]
    e = obs.sparkSession.createDataFrame(months, "epoch_id int, epoch_start timestamp_ntz, epoch_end timestamp_ntz, _month int")
    e = F.broadcast(e) if len(months) <= BROADCAST_ROWS else e
    return obs.withColumn("_month", _month(F.col(time))).join(e, "_month").where(F.col(time).between(F.col("epoch_start"), F.col("epoch_end"))).drop("_month")
