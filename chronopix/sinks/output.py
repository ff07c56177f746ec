"""Writers of output products.

Inside the engine missing is NULL; here it becomes the declared sentinel, and values their declared type. Writers are Spark's:
tasks commit or abort as a whole, and what exists already is never overwritten unless that is asked for.
"""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.model import ConfigurationError, Measurement, OutputProduct
from chronopix.operators.alignment import resumable

INT_RANGE = {"int8": (-(2**7), 2**7 - 1), "uint8": (0, 2**8 - 1), "int16": (-(2**15), 2**15 - 1), "uint16": (0, 2**16 - 1), "int32": (-(2**31), 2**31 - 1), "int64": (-(2**63), 2**63 - 1)}


def stored(m: Measurement, c: Column | None = None) -> Column:
    """The band in its declared type: integers truncate toward zero; missing, NaN and what the type cannot hold become the sentinel."""
    c = F.col(f"`{m.name}`") if c is None else c
    if m.dtype == "bool":
        return F.coalesce(c.cast("boolean"), F.lit(False)).alias(m.name, metadata=m.metadata())
    fill = F.lit(m.fill).cast(m.spark_type)
    if m.dtype in INT_RANGE:
        lo, hi = INT_RANGE[m.dtype]
        d = c.cast("double")
        whole = F.when(d < 0, F.ceil(d)).otherwise(F.floor(d)) if m.dtype != "int64" else c
        c = F.when(~F.isnan(d) & whole.between(lo, hi), whole)
    return F.coalesce(c.cast(m.spark_type), fill).alias(m.name, metadata=m.metadata())


def cast_back(df: DataFrame, keys: Sequence[str], measurements: Sequence[Measurement]) -> DataFrame:
    if lacking := [m.name for m in measurements if m.name not in df.columns]:
        raise ConfigurationError(f"bands {lacking} were not computed")
    kept = {m.name: df.schema[m.name].metadata | m.metadata() for m in measurements}
    return df.select(*keys, *[stored(m).alias(m.name, metadata=kept[m.name]) for m in measurements])


def attributes(default: Mapping[str, Any], plugin: Mapping[str, Any], config: Mapping[str, Any]) -> dict[str, Any]:
    """Later ones win."""
    return {**default, **plugin, **config}


#: strftime's directives in Spark's patterns.
_DIRECTIVES = {"Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss", "j": "DDD", "b": "MMM", "B": "MMMM", "f": "SSSSSS"}


def _dated(time: Column, spec: str) -> Column:
    """The time by a strftime format; without one, as Python writes it."""
    if not spec:
        whole = F.date_format(time, "yyyy-MM-dd HH:mm:ss")
        return F.when(F.date_format(time, "SSSSSS") == "000000", whole).otherwise(F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    parts, plain = [], ""
    it = iter(spec)
    for ch in it:
        if ch == "%":
            d = next(it, "%")
            if d != "%" and d not in _DIRECTIVES:
                raise ConfigurationError(f"a date format has %{d}, which is not known here")
            if d != "%":
                parts += [F.lit(plain), F.date_format(time, _DIRECTIVES[d])]
            plain = "%" if d == "%" else ""
        else:
            plain += ch
    return F.concat(*parts, F.lit(plain))


def file_column(product: OutputProduct, columns: Sequence[str], places: Mapping[Any, tuple[str, str]] | None = None) -> Column:
    """The path that the product's template gives a row: x and y are the tile (of a feature's rows the names in places), epoch_start and epoch_end take
    strftime formats, var_name is the band where rows are by band, and the product's own metadata may be named."""
    by_feature = "feature_id" in columns

    def place(i: int) -> Column:
        if not by_feature:
            return F.col(("tile_x", "tile_y")[i]).cast("string")
        out = F.col("feature_id").cast("string") if i == 0 else F.lit("")
        for feature, names in (places or {}).items():
            out = F.when(F.col("feature_id") == feature, F.lit(names[i])).otherwise(out)
        return out

    parts = []
    for text, name, spec, _ in string.Formatter().parse(product.template or ""):
        parts.append(F.lit(text))
        if name is None:
            continue
        if name in ("x", "y"):
            parts.append(place("xy".index(name)))
        elif name in ("epoch_start", "epoch_end"):
            parts.append(_dated(F.col(name), spec or ""))
        elif name in ("name", "stat_name"):
            parts.append(F.lit(product.name if name == "name" else product.stat_name))
        elif name == "var_name" and "measurement" in columns:
            parts.append(F.col("measurement"))
        elif name == "feature_id" and by_feature:
            parts.append(F.col("feature_id").cast("string"))
        elif name in product.metadata:
            parts.append(F.lit(format(product.metadata[name], spec or "")))
        else:
            raise ConfigurationError(f"the template's {name!r} is not known here")
    return F.concat(*parts)


def tiff_type(dtype: str, nodata: Any) -> tuple[str, Any]:
    """What a raster file holds a type as: int8 has no form there and becomes uint8, its sentinel 255."""
    return ("uint8", 255) if dtype == "int8" else (dtype, nodata)


class Writer:
    """Writes one output product under a location, in one folder per task's file name where it has a template, else per epoch.

    What exists is an error, unless it is to be overwritten, or skipped: then the tasks (tile or feature, and epoch) that are there are left out, and the others join them.
    """

    name = "parquet"
    format = "parquet"

    def __init__(self, location: str, overwrite: bool = False, skip: bool = False, places: Mapping[Any, tuple[str, str]] | None = None, chunking: Mapping[str, int] | None = None, **params: Any):
        self.location, self.mode, self.skip, self.places, self.params = location.rstrip("/"), "overwrite" if overwrite else "errorifexists", skip, places, params
        self.chunking = dict(chunking or {})
        if unknown := set(self.chunking) - {"x", "y", "time"}:
            raise ConfigurationError(f"chunking has unknown dimensions {sorted(unknown)}")

    def path(self, product: OutputProduct) -> str:
        return f"{self.location}/{product.name}"

    def shape(self, df: DataFrame, product: OutputProduct, keys: Sequence[str]) -> DataFrame:
        return cast_back(df, keys, product.measurements)

    def done(self, df: DataFrame, product: OutputProduct) -> DataFrame | None:
        """The tasks that the product's folder has rows of; None where there is no such folder."""
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(self.path(product))
        if not path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).exists(path):
            return None
        keys = [k for k in ("tile_x", "tile_y", "feature_id", "epoch_start", "epoch_end") if k in df.columns]
        return df.sparkSession.read.format(self.format).schema(df.select(*keys).schema if self.format == "parquet" else df.schema).load(self.path(product)).select(*keys).distinct()

    def write(self, df: DataFrame, product: OutputProduct, keys: Sequence[str], partition: Sequence[str] = ("epoch_id",)) -> Any:
        out, mode = self.shape(df, product, keys), self.mode
        if self.skip and (done := self.done(out, product)) is not None:
            out, mode = self.missing(out, done, done.columns), "append"
        if product.template:
            out, partition = out.withColumn("file", file_column(product, out.columns, self.places)), ("file",)
        blocks = [F.floor(F.col(c) / n) for c, n in self.chunking.items() if c in out.columns]
        if blocks:  # rows of one block of pixels lie together
            out = out.sortWithinPartitions(*partition, *blocks)
        w = out.write.mode(mode).options(**{k: v for k, v in self.params.items() if isinstance(v, (str, int, bool))})
        (w.partitionBy(*partition) if partition else w).format(self.format).save(self.path(product))
        return self.path(product)

    def missing(self, tasks: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
        """What is still to be written."""
        return resumable(tasks, existing, keys)

    def describe(self, spark: SparkSession, product: OutputProduct, definition: Mapping[str, Any]) -> None:
        """The product's definition, where its bands are, and what else is given, as YAML beside it."""
        import yaml

        bands = {m.name: {"layer": i, "path": product.name} for i, m in enumerate(product.measurements, 1)}
        text = yaml.safe_dump(plain({**definition, "bands": bands}), sort_keys=False)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.location}/_definitions/{product.name}")


class CsvWriter(Writer):
    name, format = "csv", "csv"


class BandWriter(Writer):
    """One directory per band: rows are unpivoted, all bands must share a type and a sentinel, int8 is widened."""

    name = "bands"

    def shape(self, df: DataFrame, product: OutputProduct, keys: Sequence[str]) -> DataFrame:
        return unpivot(cast_back(df, keys, product.measurements), keys, product.measurements)

    def write(self, df: DataFrame, product: OutputProduct, keys: Sequence[str], partition: Sequence[str] = ("measurement",)) -> Any:
        return super().write(df, product, keys, ("measurement",))


class FrameWriter(Writer):
    """Returns the frame."""

    name = "frame"

    def __init__(self, location: str = "", **params: Any):
        super().__init__(location, **params)

    def write(self, df: DataFrame, product: OutputProduct, keys: Sequence[str], partition: Sequence[str] = ()) -> Any:
        return self.shape(df, product, keys)


class NoopWriter(Writer):
    """Computes everything, keeps nothing."""

    name = "noop"

    def write(self, df: DataFrame, product: OutputProduct, keys: Sequence[str], partition: Sequence[str] = ()) -> Any:
        self.shape(df, product, keys).write.format("noop").mode("overwrite").save()


WRITERS = {w.name: w for w in (Writer, CsvWriter, BandWriter, FrameWriter, NoopWriter)}


def writer(name: str) -> type[Writer]:
    """A writer by name, whatever its case and spaces."""
    import chronopix.sinks.rasters  # noqa: F401  registers its own

    key = name.replace(" ", "").lower()
    if key not in WRITERS:
        raise ConfigurationError(f"unknown driver {name!r}; known: {', '.join(WRITERS)}")
    return WRITERS[key]


def unpivot(df: DataFrame, keys: Sequence[str], measurements: Sequence[Measurement]) -> DataFrame:
    """keys, measurement, value: one row per band."""
    kinds = {tiff_type(m.dtype, m.fill) for m in measurements if m.fill == m.fill} | {(m.dtype, None) for m in measurements if m.fill != m.fill}
    if len(kinds) > 1:
        raise ConfigurationError(f"bands of one file must share type and nodata: {sorted(map(str, kinds))}")
    return df.unpivot(list(keys), [m.name for m in measurements], "measurement", "value")


def plain(x: Any) -> Any:
    """x with dates and numbers that YAML has no form for as text."""
    if isinstance(x, Mapping):
        return {str(k): plain(v) for k, v in x.items()}
    if isinstance(x, (list, tuple)):
        return [plain(v) for v in x]
    return x if isinstance(x, (str, int, float, bool, type(None))) else str(x)


def product_definition(product: OutputProduct, config: Mapping[str, Any], driver: str) -> dict[str, Any]:
    """What a catalog needs to know of a product: its bands, period, step, format, custom metadata, global attributes, and the configuration it came from."""
    dates = config["date_ranges"]
    stats = {"period": dates.get("stats_duration") or "*", "step": dates.get("step_size") or "*"}
    kept = attributes({"product_type": "!!NOTSET!!", "statistics": stats, "format": driver}, product.metadata, {})
    return {
        "name": product.name,
        "metadata": kept,
        "measurements": [{"name": m.name, **m.metadata()} for m in product.measurements],
        "attributes": attributes({"title": product.name}, {}, config.get("global_attributes") or {}),
        "lineage": {"algorithm": {"name": "chronopix", "parameters": {"configuration": {k: v for k, v in config.items() if k != "global_attributes"}}}},
    }
