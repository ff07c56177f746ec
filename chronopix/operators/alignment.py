"""Scenes that products have in common, and those they do not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.model import ConfigurationError

SCENE = ("tile_x", "tile_y", "time")


def common(df: DataFrame, others: Sequence[DataFrame], keys: Sequence[str] = SCENE) -> DataFrame:
    """Rows whose key every other product has too: a chain of semi-joins, so no row is repeated."""
    for o in others:
        df = df.join(o.select(*keys), list(keys), "left_semi")
    return df


def unmatched(df: DataFrame, others: Sequence[DataFrame], keys: Sequence[str] = SCENE) -> DataFrame:
    """Rows whose key some other product lacks."""
    parts = [df.join(o.select(*keys), list(keys), "left_anti") for o in others]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct() if len(parts) > 1 else out


def ancestors(df: DataFrame, scenes: DataFrame, keys: Sequence[str], **ranges: tuple[float, float]) -> DataFrame:
    """Rows whose ancestor scene has all fields in their ranges, ends included."""
    hit = F.lit(True)
    for name, (lo, hi) in ranges.items():
        hit = hit & F.col(name).between(lo, hi)
    return df.join(scenes.where(hit).select(*keys), list(keys), "left_semi")


def coverage(products: dict[str, DataFrame], cell: Sequence[str], time: str = "time") -> DataFrame:
    """Per product, cell and day: matched (every product has the exact time), unmatched, or sibling: unmatched, but every product has some scene of that cell and day."""
    if len(products) < 2:
        raise ConfigurationError("two products are needed")
    n = len(products)
    scenes = None
    for name, df in products.items():
        own = df.select(*cell, F.col(time).alias("time")).distinct().withColumn("product", F.lit(name))
        scenes = own if scenes is None else scenes.unionByName(own)
    scenes = scenes.withColumn("day", F.col("time").cast("date"))
    times = scenes.groupBy(*cell, "day", "time").agg(F.collect_set("product").alias("have"))
    days = times.groupBy(*cell, "day").agg(F.size(F.array_distinct(F.flatten(F.collect_list("have")))).alias("together"), F.collect_list("have").alias("times"))
    each = days.select(*cell, "day", "together", F.explode("times").alias("have")).select(*cell, "day", "together", F.size("have").alias("n"), F.explode("have").alias("product"))
    status = F.when(F.col("n") == n, "matched").when(F.col("together") == n, "sibling").otherwise("unmatched")
    return each.select("product", *cell, "day", status.alias("status")).groupBy("product", *cell, "day", "status").agg(F.count("*").alias("scenes"))


def resumable(tasks: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tasks whose output does not exist yet."""
    return tasks.join(done.select(*keys), list(keys), "left_anti")


def task_slice(tasks: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
    """a:b:c of the tasks in order, as Python slices lists; negative numbers are not allowed."""
    from pyspark.sql.window import Window

    parts = [int(p) if p else None for p in text.split(":")]
    if len(parts) > 3 or any(p is not None and p < 0 for p in parts):
        raise ValueError(f"{text!r} is no slice")
    start, stop, step = (parts + [None, None])[:3] if len(parts) > 1 else (parts[0], None if parts[0] is None else parts[0] + 1, None)
    step, start = step or 1, start or 0
    i = F.row_number().over(Window.orderBy(*order)) - 1
    out = tasks.withColumn("_i", i).where((F.col("_i") >= start) & ((F.col("_i") - start) % step == 0))
    return (out.where(F.col("_i") < stop) if stop is not None else out).drop("_i")
