"""A job: a configuration bound to a catalog, compiled to lazy frames.

The plan is: per source, scan - mask join - masks - time window - tag; union; region; epochs; one grouping that all
reducing statistics share. Nothing runs before the caller asks for rows or writes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.functions.geometry import GridSpec
from chronopix.model import ORDER, PIXEL, SOURCE, TILE, TIME, ConfigurationError, Epoch, Measurement, OutputProduct
from chronopix.operators import alignment
from chronopix.operators.base import STATISTICS, per_row, reduce_frame
from chronopix.operators.calendar_filters import filter_product
from chronopix.plans import config as C
from chronopix.plans.epochs import as_time, assign, epochs_of, intersect
from chronopix.sources import catalog as S
from chronopix.sources import masks, regions

GROUP = (*TILE, *PIXEL, "epoch_id", "epoch_start", "epoch_end")
#: How scenes are grouped where a source does not say.
DEFAULT_GROUP = "time"


class Job:
    def __init__(self, config: Mapping[str, Any], catalog: S.Catalog, context: Mapping[str, Any] | None = None):
        C.validate(config)
        self.config, self.catalog, self.context = C.normalise(config), catalog, dict(context or {})
        self.sources = list(config["sources"])
        first = catalog[self.sources[0]["product"]]
        self.inputs = tuple(first.measurement(n) for n in self.sources[0]["measurements"])
        for s in self.sources[1:]:
            other = catalog[s["product"]]
            if [other.measurement(n).dtype for n in s["measurements"]] != [m.dtype for m in self.inputs]:
                raise ConfigurationError("all sources must have the same measurements, of the same types")
        self.outputs = {o["name"]: self._output(o) for o in config["output_products"]}
        size = self.config["storage"].get("tile_size")
        self.grid = GridSpec(str(self.config["storage"].get("crs", "")), (float(size[0]), float(size[1])) if isinstance(size, (list, tuple)) else (float(size["x"]), float(size["y"])), (1.0, 1.0)) if size else None
        self.features = regions.features_of(self.config.get("input_region"))
        #: The columns that outputs have one row for.
        self.keys = (*GROUP, "feature_id") if self.features else GROUP
        self._shared: DataFrame | None = None
        self.epochs: list[Epoch] = epochs_of(config["date_ranges"], [catalog[s["product"]].times() for s in self.sources] if config["date_ranges"].get("type") == "find_daily_data" else ())

    @classmethod
    def from_config(cls, config: Mapping[str, Any], catalog: S.Catalog, **context: Any) -> Job:
        return cls(config, catalog, context)

    def _output(self, o: Mapping[str, Any]) -> OutputProduct:
        stat = STATISTICS[o["statistic"]](**(o.get("statistic_args") or {}))
        return OutputProduct(o["name"], stat, self.inputs, tuple(stat.measurements(self.inputs)), o["statistic"], o.get("file_path_template"), o.get("output_params") or {}, o.get("metadata") or {})

    def window(self) -> Epoch | None:
        return Epoch(min(e.start for e in self.epochs), max(e.end for e in self.epochs)) if self.epochs else None

    def source(self, index: int) -> DataFrame | None:
        """One source, its scenes grouped, masked and tagged; None where its window and the epochs have nothing in common, so it is never scanned.

        Scenes of one time step become one observation: of one instant, unless group_by says solar_day, or null, which leaves every scene as it is.
        Each mask's scenes are grouped the same way, by its own fuse_func, and masks meet the data at the step. A mask in the source's own product is read with it.
        """
        spec = self.sources[index]
        span = self.window()
        span = intersect(spec.get("time"), span) if span else None
        if span is None:
            return None
        by = spec.get("group_by", DEFAULT_GROUP)
        if by not in (None, "time", "solar_day"):
            raise ConfigurationError(f"unknown group_by {by!r}")
        step = S.solar_day(F.col(TIME), F.col("lon")) if by == "solar_day" else F.col(TIME) if by else None
        bands, whole = [self.catalog[spec["product"]].measurement(n) for n in spec["measurements"]], spec.get("mask_nodata", True)
        specs = spec.get("masks") or []
        columns = [self.catalog[m["product"]].measurement(m["measurement"]).with_(name=f"_mask{k}") for k, m in enumerate(specs)]
        own = {c.name: (m["measurement"], m.get("fuse_func")) for m, c in zip(specs, columns, strict=True) if m["product"] == spec["product"]}

        product, df = self.catalog[spec["product"]], self._within(spec["product"], span)
        quality = dict(spec.get("source_filter") or {})
        ancestor = quality.pop("product", None)
        if ancestor:
            scenes = self.catalog[ancestor].frame()
            keys = [k for k in ("dataset_id", *TILE, TIME) if k in scenes.columns and k in df.columns]
            df = alignment.ancestors(df, scenes, keys, **{k: tuple(v) for k, v in quality.items()})
        # A rule of the user's sees values as they are stored; the usual one takes the first that is not missing.
        raw = spec.get("fuse_func") or not whole and by is None
        values = [F.col(f"`{m.name}`") if raw else masks.without_nodata(m) for m in bands]
        df = self._steps(product, df, step, [*values, *[F.col(f"`{m}`").alias(n) for n, (m, _) in own.items()]], dict.fromkeys((m.name for m in bands), spec.get("fuse_func")) | {n: f for n, (_, f) in own.items()})
        for m, c in zip(specs, columns, strict=True):
            if c.name not in own:
                there = self.catalog[m["product"]]
                mask = self._steps(there, self._within(m["product"], span), step, [F.col(f"`{m['measurement']}`").alias(c.name)], {c.name: m.get("fuse_func")})
                keys = [*TILE, *PIXEL, "_step"] if by else list(S.KEYS)
                # Repeated keys of a mask would repeat observations.
                mask = mask.select(*keys, c.name) if by else mask.groupBy(*keys).agg(F.min(c.name).alias(c.name))
                df = df.join(mask, keys, "inner")
        if whole and raw:
            df = df.withColumns({m.name: masks.without_nodata(m) for m in bands})
        elif not whole and not raw:
            df = df.withColumns({m.name: F.coalesce(F.col(f"`{m.name}`"), F.lit(m.nodata).cast(df.schema[m.name].dataType)) for m in bands if m.nodata is not None})
        df = masks.apply(df, bands, [masks.predicate(m, c) for m, c in zip(specs, columns, strict=True)], spec.get("mask_inplace", False) or not whole)
        return S.tag(df.select(*S.KEYS, *[f"`{m.name}`" for m in bands]), index)

    def _within(self, product: str, span: Epoch) -> DataFrame:
        """A product's observations in the span and the region: predicates that reach the scan."""
        df = self.catalog[product].frame()
        return regions.limit(df.where(F.col(TIME).between(F.lit(span.start).cast("timestamp_ntz"), F.lit(span.end).cast("timestamp_ntz"))), self.config.get("input_region"), self.grid)

    @staticmethod
    def _steps(product: S.Product, df: DataFrame, step: Column | None, values: Sequence[Column], fuses: Mapping[str, str | None]) -> DataFrame:
        """The keys and values of each scene (no step), or of each step with the step as _step."""
        if step is None:
            if any(fuses.values()):
                raise ConfigurationError("a fuse_func needs a group_by")
            return df.select(*S.KEYS, *values)
        lon = ["lon"] if "lon" in df.columns else []
        df = df.select(*S.KEYS, *lon, *values)
        if product.distinct_times and not any(fuses.values()) and "lon" not in str(step):
            return df.withColumn("_step", step)
        return S.fuse_steps(df, {n: S.fuse_of(f) for n, f in fuses.items()}, step)

    def observations(self) -> DataFrame:
        """All sources, filtered and joined to the epochs; where features are wanted, once for each feature, by feature_id."""
        frames = [f for f in map(self.source, range(len(self.sources))) if f is not None]
        if not frames:
            empty = self.catalog[self.sources[0]["product"]].frame().where(F.lit(False))
            frames = [S.tag(empty.select(*S.KEYS, *[f"`{m.name}`" for m in self.inputs]), 0)]
        obs, spec = S.union(frames), self.config.get("filter_product")
        context = ({"epoch": self.epochs[0]} if self.epochs else {}) | self.context
        if not self.features:
            return assign(filter_product(obs, spec, context), self.epochs)
        if spec:  # a feature's own properties say what is left of it
            obs = reduce(DataFrame.unionByName, [filter_product(regions.in_features(obs, [f]), spec, {"properties": f["properties"], **context}) for f in self.features])
        else:
            obs = regions.in_features(obs, self.features)
        return assign(obs, self.epochs)

    def run(self, spark: SparkSession | None = None) -> dict[str, DataFrame]:
        """A lazy frame for each output product: pixel and epoch keys, and its bands.

        Reducing statistics come from one scan and one grouping: with several, its rows are kept when the first of them is asked for, on the
        executors' disks where they don't fit the memory, and the others are cut from them. ``release`` lets go of them. Lost rows are computed again.
        """
        obs = self.observations()
        reducing = [(f"{i}~", o.statistic, self.inputs) for i, o in enumerate(self.outputs.values()) if o.statistic.reduces]
        together = reduce_frame(obs, self.keys, reducing) if reducing else None
        if len(reducing) > 1:
            self._shared = together = together.persist()
        tags = {"source_products": [s["product"] for s in self.sources], **({"start_date": str(w.start), "end_date": str(w.end)} if (w := self.window()) else {})}
        attrs = self.config["var_attributes"]
        out = {}
        for i, (name, o) in enumerate(self.outputs.items()):
            if o.statistic.reduces:
                bands = [F.col(f"`{i}~{m.name}`").alias(m.name, metadata=m.metadata() | tags | dict(attrs.get(m.name) or {})) for m in o.measurements]
                out[name] = together.select(*self.keys, *bands)
            else:
                out[name] = per_row(obs, (*self.keys, TIME, ORDER, SOURCE), o.statistic, self.inputs)
        return out

    def release(self) -> None:
        """Lets go of the rows that several outputs share."""
        if self._shared is not None:
            self._shared.unpersist()

    def tasks(self, spark: SparkSession) -> DataFrame:
        """task_id, tile, epoch, as rows: what there is to compute, for slicing, saving and resuming. Tables of scenes, where products have them, spare a scan of the pixels."""
        span, obs = self.window(), []
        for s in self.sources:
            if span and (own := intersect(s.get("time"), span)):
                p = self.catalog[s["product"]]
                df = p.times() if p.scenes and self._by_tiles() else regions.limit(p.frame(), self.config.get("input_region"), self.grid).select(*TILE, TIME)
                df = regions.limit(df, self.config.get("input_region"), self.grid) if p.scenes and self._by_tiles() else df
                obs.append(df.where(F.col(TIME).between(F.lit(own.start).cast("timestamp_ntz"), F.lit(own.end).cast("timestamp_ntz"))))
        if not obs:
            obs = [self.catalog[self.sources[0]["product"]].times().where(F.lit(False))]
        cells = assign(reduce(DataFrame.unionByName, obs).distinct(), self.epochs).select(*TILE, "epoch_id", "epoch_start", "epoch_end").distinct()
        return cells.withColumn("task_id", F.concat_ws("_", "tile_x", "tile_y", "epoch_id"))

    def _by_tiles(self) -> bool:
        """Whether the region is whole tiles, so that scenes can tell it."""
        region = self.config.get("input_region") or {}
        return not region or not self.features and bool({"tile", "tiles", "geometry", "from_file"} & set(region))

    def provenance(self, scenes: DataFrame) -> DataFrame:
        """Per tile and epoch, the distinct scenes that went in, their number and when the first and last were, from a table of dataset_id, product, tile_x, tile_y, time.

        Of a source with masks only scenes count whose tile and instant (or solar day's date) its masks have too, and the masks' own that go with them.
        """
        parts = []
        for s in self.sources:
            span = self.window()
            span = intersect(s.get("time"), span) if span else None
            if span is None:
                continue
            at = F.col(TIME).cast("date") if s.get("group_by") == "solar_day" else F.col(TIME)
            every = scenes.where(F.col(TIME).between(F.lit(span.start).cast("timestamp_ntz"), F.lit(span.end).cast("timestamp_ntz"))).withColumn("_at", at)
            used = list(dict.fromkeys([s["product"], *[m["product"] for m in s.get("masks") or []]]))
            each = [every.where(F.col("product") == p) for p in used]
            for k, own in enumerate(each):
                parts.append(alignment.common(own, each[:k] + each[k + 1 :], (*TILE, "_at")).drop("_at"))
        if not parts:
            parts = [scenes.where(F.lit(False))]
        kept = reduce(DataFrame.unionByName, parts)
        kept = assign(regions.limit(kept, self.config.get("input_region"), self.grid) if self._by_tiles() else kept, self.epochs)
        return kept.groupBy(*TILE, "epoch_id").agg(F.array_sort(F.collect_set("dataset_id")).alias("datasets"), F.count_distinct("dataset_id").alias("n"), F.min(TIME).alias("first_time"), F.max(TIME).alias("last_time"))


def valid_region(df: DataFrame, bands: Sequence[Measurement], keys: Sequence[str] = (*TILE, "epoch_id")) -> DataFrame:
    """Per tile and epoch, the box of pixels of an output that have a value in any band, and how many there are."""
    has = reduce(lambda a, b: a | b, [F.col(f"`{m.name}`").isNotNull() for m in bands])
    ends = [f(c).alias(f"{c}_{n}") for c in PIXEL for n, f in (("min", F.min), ("max", F.max))]
    return df.where(has).groupBy(*keys).agg(*ends, F.count_distinct(*PIXEL).alias("pixels"))


def single(obs: DataFrame, statistic: Any, inputs: Sequence[Measurement], epochs: Sequence[Epoch], keys: Sequence[str] = GROUP) -> DataFrame:
    """One statistic over observations that are ready, without a configuration."""
    return reduce_frame(assign(obs, list(epochs)), keys, [("", statistic, inputs)])


def period(start: str, end: str) -> list[Epoch]:
    return [Epoch(as_time(start), as_time(end))]
