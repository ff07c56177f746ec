"""Incremental statistics as a streaming aggregation.

Statistics whose aggregates combine part by part keep a small state per pixel and window. Late observations are taken up to the
watermark; a window's result is final once the watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronopix.model import TIME, ConfigurationError, Measurement
from chronopix.operators.base import Statistic


def stream_reduce(obs: DataFrame, keys: Sequence[str], stats: Sequence[tuple[str, Statistic, Sequence[Measurement]]], window: str, slide: str | None = None, late: str = "0 seconds") -> DataFrame:
    """keys, epoch_start, epoch_end (exclusive), and the statistics' outputs; obs may be a stream or a table, with the same result once all is in. The time must have a zone, as watermarks need."""
    if bad := [s.name for _, s, _ in stats if not (s.reduces and s.incremental)]:
        raise ConfigurationError(f"not incremental: {bad}")
    aggregates, outputs = [], []
    for k, (prefix, stat, inputs) in enumerate(stats):
        aggregates += [c.alias(f"_{k}_{n}") for n, c in stat.aggregates(inputs).items()]
        outputs += [c.alias(prefix + n) for n, c in stat.outputs(inputs, lambda n, k=k: F.col(f"`_{k}_{n}`")).items()]
    at = F.window(TIME, window, slide or window).alias("_w")
    out = obs.withWatermark(TIME, late).groupBy(*keys, at).agg(*aggregates)
    return out.select(*keys, F.col("_w.start").alias("epoch_start"), F.col("_w.end").alias("epoch_end"), *outputs)


def run_to_table(df: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> StreamingQuery:
    """Runs what is available of a stream into an in-memory table."""
    return df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
