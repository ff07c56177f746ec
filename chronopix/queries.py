"""One query per operator over the driver's tables, and the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix import fixtures as X
from chronopix.functions import scalars
from chronopix.functions.geometry import inside
from chronopix.model import Epoch, Measurement
from chronopix.operators import alignment, calendar_filters, percentile
from chronopix.operators.algebraic import Latest, LogicalAnd, LogicalOr, Oldest, Simple
from chronopix.operators.base import reduce_frame
from chronopix.operators.geomedian import GeometricMedian, SpectralMAD
from chronopix.plans.epochs import assign, epochs_of
from chronopix.plans.job import GROUP, Job
from chronopix.sinks.output import cast_back, unpivot
from chronopix.sources import catalog as S

Q = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Q] = {}
_SQL: dict[str, str] = {}

YEARLY = {"start_date": "1995-01-01", "end_date": "2002-01-01", "stats_duration": "1y", "step_size": "1y"}
WHOLE = {"start_date": "1995-01-01", "end_date": "2002-01-01"}

_OBS = """obs AS (SELECT CAST(l_partkey // 50 AS INTEGER) AS y, CAST(l_partkey % 50 AS INTEGER) AS x, l_shipdate AS t, l_orderkey * 8 + l_linenumber AS o,
  CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS TINYINT) AS src, l_quantity AS blue, l_extendedprice AS green, nullif(l_discount, 0) AS red, nullif(l_tax, 0) AS nir,
  l_discount AS raw_red, 1 + l_discount AS gain,
  CASE l_returnflag WHEN 'A' THEN CASE l_linestatus WHEN 'F' THEN 128 ELSE 132 END WHEN 'N' THEN CASE l_linestatus WHEN 'F' THEN 0 ELSE 4 END ELSE CASE l_linestatus WHEN 'F' THEN 64 ELSE 2 END END AS water,
  CASE WHEN l_discount > 0 THEN 1 ELSE 0 END + CASE WHEN l_tax > 0.06 THEN 2 ELSE 0 END + CASE WHEN l_quantity > 25 THEN 4 ELSE 0 END AS pq, l_orderkey, l_partkey FROM lineitem)"""


def _ts(t: dt.datetime) -> str:
    return f"TIMESTAMP '{t.isoformat(sep=' ')}'"


def _epochs_sql(dates: dict | Sequence[Epoch]) -> str:
    epochs = epochs_of(dates) if isinstance(dates, dict) else list(dates)
    return "ep(epoch_id, s, e) AS (VALUES " + ", ".join(f"({i}, {_ts(e.start)}, {_ts(e.end)})" for i, e in enumerate(epochs)) + ")"


def _with(dates: dict | Sequence[Epoch] = YEARLY, more: str = "", obs: str = _OBS) -> str:
    return f"WITH {obs}, {_epochs_sql(dates)}, oe AS (SELECT obs.*, epoch_id, s FROM obs JOIN ep ON t BETWEEN s AND e)" + (f", {more}" if more else "")


def _grouped(select: str, dates: dict | Sequence[Epoch] = YEARLY, where: str = "", more: str = "") -> str:
    return f"{_with(dates, more)} SELECT y, x, epoch_id, {select} FROM oe {where} GROUP BY y, x, epoch_id"


def _config(statistic: str, bands: Sequence[str], args: dict | None = None, dates: dict = YEARLY, product: str = "obs", region: dict | None = None, **source) -> dict:
    # An order line is a scene of its own here, so scenes of one instant are not fused unless a query says so.
    out = {"sources": [{"product": product, "measurements": list(bands), "group_by": None, **source}], "date_ranges": dates, "output_products": [{"name": "out", "statistic": statistic, "statistic_args": args or {}}]}
    return out | ({"input_region": region} if region else {})


def _job(statistic: str, bands: Sequence[str], args: dict | None = None, digits: int | dict[str, int] = 6, kinds: dict[str, str] | None = None, **config) -> Q:
    """A job of one output; doubles are rounded, so that the order of additions does not show."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        job = Job.from_config(_config(statistic, bands, args, **config), X.catalog(spark, sf_dir))
        return _rounded(job.run(spark)["out"].drop("tile_x", "tile_y", "epoch_start", "epoch_end"), digits, kinds)

    return run


def _rounded(df: DataFrame, digits: int | dict[str, int] = 6, kinds: dict[str, str] | None = None) -> DataFrame:
    def one(c: str, t: str) -> Column:
        n = digits if isinstance(digits, int) else digits.get(c, 6)
        out = F.round(F.col(f"`{c}`"), n) + F.lit(0.0) if t in ("double", "float") else F.col(f"`{c}`")
        return (out.cast(kinds[c]) if kinds and c in kinds else out).alias(c)

    return df.select(*[one(c, t) for c, t in df.dtypes])


def add(name: str, query: Q, sql: str | None = None) -> None:
    _QUERIES[name] = query
    if sql:
        _SQL[name] = sql


def _day() -> Column:
    return F.date_trunc("day", F.col("time")).cast("timestamp_ntz")


# Reductions
def _simple(name: str, reductions: Sequence[str], bands: Sequence[str], sql: Sequence[str], dates: dict = YEARLY, digits: int = 6, where: str = "") -> None:
    """Several reductions of the same bands from one grouping."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = _config("simple", bands, dates=dates) | {"output_products": [{"name": r, "statistic": "simple", "statistic_args": {"reduction_function": r}} for r in reductions]}
        job = Job.from_config(cfg, X.catalog(spark, sf_dir))
        inputs = job.inputs
        df = reduce_frame(job.observations(), ("y", "x", "epoch_id"), [(f"{r}_", job.outputs[r].statistic, inputs) for r in reductions])
        return _rounded(df, digits)

    add(name, run, _grouped(", ".join(f"{s} AS {r}_{b}" for b in bands for r, s in zip(reductions, [q.replace("$", b) for q in sql], strict=True)), dates))


add("simple_mean_yearly", _job("simple", ["blue", "green"], {"reduction_function": "mean"}), _grouped("round(avg(blue), 6) AS blue, round(avg(green), 6) AS green"))
_simple("simple_median", ["median"], ["blue", "red"], ["round(median($), 6)"])
_simple("simple_minmax", ["min", "max"], ["green", "red"], ["round(min($), 6)", "round(max($), 6)"])
_simple("simple_sum_prod", ["sum", "prod"], ["gain"], ["round(coalesce(sum($), 0), 6)", "round(coalesce(product($), 1), 6)"])
_simple("simple_std_var", ["std", "var"], ["blue", "nir"], ["round(stddev_pop($), 6)", "round(var_pop($), 6)"])
_simple("simple_count", ["count"], ["red", "nir"], ["count($)"])
_simple("simple_any_all", ["any", "all"], ["red", "raw_red"], ["coalesce(bool_or($ <> 0), false)", "coalesce(bool_and($ <> 0), true)"])


def _argminmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = assign(S.tag(X.cube(spark, sf_dir).withColumn("red", F.nullif("red", F.lit(0.0))), 0), epochs_of(YEARLY))
    red = [Measurement("red", "float64")]
    return reduce_frame(obs, ("y", "x", "epoch_id"), [("argmin_", Simple("argmin"), red), ("argmax_", Simple("argmax"), red)])


_FIRST = "(min(struct_pack(v := {s}red, i := i)) FILTER (red IS NOT NULL))['i']"
add(
    "simple_argminmax",
    _argminmax,
    _with(YEARLY, "p AS (SELECT *, CAST(row_number() OVER (PARTITION BY y, x, epoch_id ORDER BY t, o) - 1 AS INTEGER) AS i FROM oe)")
    + f" SELECT y, x, epoch_id, {_FIRST.format(s='')} AS argmin_red, {_FIRST.format(s='-')} AS argmax_red FROM p GROUP BY y, x, epoch_id",
)
add("none_passthrough", lambda s, d: _job("none", ["blue", "red"])(s, d).drop("source"), f"{_with()} SELECT y, x, epoch_id, t AS time, o AS ord, blue, red FROM oe")

# Indices
add("wofs_summary", _job("wofs_summary", ["water"]), _grouped("count(*) FILTER (water IN (128, 132)) AS count_wet, count(*) FILTER (water IN (128, 132, 0, 4)) AS count_clear, round(count(*) FILTER (water IN (128, 132)) / nullif(count(*) FILTER (water IN (128, 132, 0, 4)), 0), 6) AS frequency"))
add("wofs_frequency_only", _job("wofs_summary", ["water"], {"freq_only": True}, dates=WHOLE), _grouped("round(count(*) FILTER (water IN (128, 132)) / nullif(count(*) FILTER (water IN (128, 132, 0, 4)), 0), 6) AS frequency", WHOLE))
_ND = "CASE WHEN red + nir <> 0 THEN (red - nir) / (red + nir) WHEN red - nir > 0 THEN 'inf'::DOUBLE WHEN red - nir < 0 THEN '-inf'::DOUBLE END"
_nd = lambda stats: {"band1": "red", "band2": "nir", "name": "nd", "stats": list(stats)}
add("nd_minmaxmean", _job("simple_normalised_difference", ["red", "nir"], _nd(["min", "max", "mean"])), _grouped(", ".join(f"CASE WHEN {f}({_ND}) BETWEEN -1 AND 1 THEN round({f}({_ND}), 6) + 0.0 END AS nd_{n}" for n, f in (("min", "min"), ("max", "max"), ("mean", "avg")))))
add("nd_median_std", _job("simple_normalised_difference", ["red", "nir"], _nd(["median", "std"]), dates=WHOLE), _grouped(f"round(median({_ND}), 6) AS nd_median, round(stddev_pop({_ND}), 6) AS nd_std", WHOLE))
add("nd_unclamped", _job("simple_normalised_difference", ["blue", "raw_red"], {"band1": "raw_red", "band2": "blue", "name": "nd", "stats": ["min", "mean"], "clamp_outputs": False}), _grouped("round(min((raw_red - blue) / (raw_red + blue)), 6) AS nd_min, round(avg((raw_red - blue) / (raw_red + blue)), 6) AS nd_mean"))
_COEFFS = {"brightness": {"blue": 0.2, "red": 0.4}, "greenness": {"blue": -0.1, "nir": 0.7}, "wetness": {"red": 0.3, "swir1": -0.6}}
_TC = {"brightness": "(blue * 0.2::DOUBLE + red * 0.4::DOUBLE)", "greenness": "(blue * (-0.1::DOUBLE) + nir * 0.7::DOUBLE)", "wetness": "(red * 0.3::DOUBLE + swir1 * (-0.6::DOUBLE))"}
_LEVELS = {"brightness": 5.0, "greenness": -2.0, "wetness": -15.0}
add(
    "tasselled_cap_summary",
    _job("tcwbg_summary", ["blue", "red", "nir", "swir1"], {"coeffs": _COEFFS, "thresholds": _LEVELS}, product="six"),
    _with(YEARLY, "q AS (SELECT oe.*, CAST(p_size AS DOUBLE) AS swir1 FROM oe JOIN part ON l_partkey = p_partkey)")
    + " SELECT y, x, epoch_id, "
    + ", ".join(f"round(count(*) FILTER ({v} > {_LEVELS[n]}) / nullif(count({v}), 0), 6) AS pct_exceedance_{n}, round(avg({v}), 6) AS mean_{n}, round(stddev_pop({v}), 6) AS std_{n}" for n, v in _TC.items())
    + " FROM q GROUP BY y, x, epoch_id",
)

# Percentiles
_PICK = "list_sort(list({b}) FILTER ({b} IS NOT NULL))[1 + CAST(round_even({q} * (count({b}) - 1), 0) AS INT)]"
_pc = lambda b, q: "CASE WHEN count({b}) > 0 THEN {p} END".format(b=b, p=_PICK.format(b=b, q=q / 100))
add("percentile_10_50_90", _job("percentile", ["green", "red"], {"q": [10, 50, 90]}, dates=WHOLE), _grouped(", ".join(f"{_pc(b, q)} AS {b}_PC_{q}" for b in ("green", "red") for q in (10, 50, 90)), WHOLE))
add("percentile_no_prov", _job("percentile_no_prov", ["green", "nir"], {"q": 25}), _grouped(f"{_pc('green', 25)} AS green, {_pc('nir', 25)} AS nir"))
_FULL = "count(*) FILTER (green IS NOT NULL AND red IS NOT NULL)"
add("percentile_min_valid", _job("percentile", ["green", "red"], {"q": 50, "minimum_valid_observations": 4}), _grouped(", ".join(f"CASE WHEN NOT ({_FULL} > 0 AND {_FULL} < 4) THEN {_pc(b, 50)} END AS {b}_PC_50" for b in ("green", "red"))))
add("percentile_not_valid_mark", _job("percentile", ["green", "red"], {"q": 50, "minimum_valid_observations": 4, "not_valid_mark": -7.0}), _grouped(", ".join(f"CASE WHEN NOT ({_FULL} > 0 AND {_FULL} < 4) THEN {_pc(b, 50)} ELSE -7 END AS {b}_PC_50" for b in ("green", "red"))))
_three = [{"product": f"obs_{f}", "measurements": ["red"], "group_by": None} for f in "ANR"]


def _provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _config("percentile", ["red"], {"q": [10, 90], "per_pixel_metadata": ["source", "observed", "observed_date"]}) | {"sources": _three}
    return _rounded(Job.from_config(cfg, X.catalog(spark, sf_dir)).run(spark)["out"].drop("tile_x", "tile_y", "epoch_start", "epoch_end"))


_RANK = "r AS (SELECT *, row_number() OVER (PARTITION BY y, x, epoch_id ORDER BY red NULLS LAST, t, o) - 1 AS i, count(red) OVER (PARTITION BY y, x, epoch_id) AS n FROM oe)"
add("percentile_provenance", _provenance, _with(YEARLY, _RANK) + " SELECT y, x, epoch_id, " + ", ".join(f"max({e}) FILTER (i = CAST(round_even({q} * (n - 1), 0) AS INT) AND n > 0) AS red_PC_{int(q * 100)}{s}" for q in (0.1, 0.9) for e, s in (("red", ""), ("src", "_source"), ("epoch_us(t) / 1e6", "_observed"), ("CAST(strftime(t, '%Y%m%d') AS INTEGER)", "_observed_date"))) + " FROM r GROUP BY y, x, epoch_id")
add("percentile_interpolated", lambda s, d: _rounded(reduce_frame(assign(X.cube(s, d), epochs_of(WHOLE)), ("y", "x"), [("", percentile.InterpolatedPercentile([45, 70]), [Measurement("blue", "float64")])])), _with(WHOLE) + " SELECT y, x, round(quantile_cont(blue, 0.45), 6) AS blue_PC_45, round(quantile_cont(blue, 0.7), 6) AS blue_PC_70 FROM oe GROUP BY y, x")

# Medoids
_DIST = """pair AS (SELECT a.y, a.x, a.epoch_id, a.t, a.o, round(coalesce(sum(sqrt({d})), 0), 9) AS dist FROM whole a JOIN whole b ON a.y = b.y AND a.x = b.x AND a.epoch_id = b.epoch_id GROUP BY ALL),
best AS (SELECT y, x, epoch_id, min(struct_pack(d := dist, t := t, o := o)) AS m, count(*) AS n FROM pair GROUP BY y, x, epoch_id),
keys AS (SELECT DISTINCT y, x, epoch_id FROM oe)"""


def _medoid_sql(compare: Sequence[str], kept: Sequence[str], extra: str = "", least: int = 0) -> str:
    d = " + ".join(f"(a.{b} - b.{b}) * (a.{b} - b.{b})" for b in compare)
    whole = "whole AS (SELECT * FROM oe WHERE " + " AND ".join(f"{b} IS NOT NULL" for b in compare) + ")"
    pick = (lambda e: f"CASE WHEN n >= {least} THEN {e} END") if least else (lambda e: e)
    cols = ", ".join(f"{pick('w.' + b)} AS {b}" for b in kept) + (f", {pick(extra)} AS observed" if extra else "")
    return _with(YEARLY, f"{whole}, {_DIST.format(d=d)}") + f" SELECT k.y, k.x, k.epoch_id, {cols} FROM keys k LEFT JOIN best USING (y, x, epoch_id) LEFT JOIN whole w ON w.y = k.y AND w.x = k.x AND w.epoch_id = k.epoch_id AND w.t = m['t'] AND w.o = m['o']"


_DAYS = "CAST(date_diff('day', DATE '1970-01-01', CAST(w.t AS DATE)) AS SMALLINT)"
add("medoid", _job("medoid", ["blue", "red", "nir"]), _medoid_sql(["blue", "red", "nir"], ["blue", "red", "nir"], _DAYS))
add("medoid_subset_bands", _job("medoid", ["blue", "red", "nir"], {"input_measurements": ["blue", "red"], "output_measurements": ["nir", "blue"]}), _medoid_sql(["blue", "red"], ["nir", "blue"], _DAYS))
add("medoid_min_valid", _job("medoid", ["blue", "red"], {"minimum_valid_observations": 3}), _medoid_sql(["blue", "red"], ["blue", "red"], _DAYS, 3))
add("medoid_no_prov", _job("medoid_no_prov", ["blue", "nir"]), _medoid_sql(["blue", "nir"], ["blue", "nir"]))
add("medoid_simple", _job("medoid_simple", ["blue", "green"]), _medoid_sql(["blue", "green"], ["blue", "green"], _DAYS))


# Geometric medians
def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[Measurement]]:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    bands = [Measurement(f"b{i}", "float64") for i in range(64)]
    return e.select("label", *[F.col("embedding")[i].cast("double").alias(f"b{i}") for i in range(64)]), bands


def _on_vectors(stat) -> Q:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df, bands = _vectors(spark, sf_dir)
        return reduce_frame(df, ("label",), [("", stat(1e-9), bands)])

    return run


add("geomedian_embeddings", _on_vectors(GeometricMedian))
add("spectral_mad_embeddings", _on_vectors(SpectralMAD))
add("geomedian_yearly", _job("geomedian", ["blue", "red", "nir"], {"eps": 1e-9}))

def _optimum(df: DataFrame, keys: Sequence[str], bands: Sequence[str], medians: DataFrame) -> DataFrame:
    """keys, n and whether the median meets the condition of the optimum: the unit vectors to the other observations sum to no more than the number of observations at it.

    Written with column functions alone, nothing of the kernel's.
    """
    whole = df.where(" AND ".join(f"{b} IS NOT NULL" for b in bands)).select(*keys, *bands)
    m = medians.select(*keys, *[F.col(b).alias(f"m_{b}") for b in bands])
    gap = [F.col(b) - F.col(f"m_{b}") for b in bands]
    far = F.sqrt(sum((g * g for g in gap[1:]), gap[0] * gap[0]))
    pull = [F.sum(F.when(F.col("_far") > 1e-9, g / F.col("_far"))).alias(f"_p{i}") for i, g in enumerate(gap)]
    out = whole.join(m, list(keys)).withColumn("_far", far).groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col("_far") <= 1e-9).alias("_here"), *pull)
    length = F.sqrt(sum((F.coalesce(F.col(f"_p{i}"), F.lit(0.0)) ** 2 for i in range(len(bands))), F.lit(0.0)))
    return out.select(*keys, "n", (length <= F.col("_here") + F.col("n") * 1e-5 + 1e-6).alias("optimal"))


def _yearly_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = ["blue", "red", "nir"]
    job = Job.from_config(_config("geomedian", bands, {"eps": 1e-9}), X.catalog(spark, sf_dir))
    return _optimum(job.observations(), ["y", "x", "epoch_id"], bands, job.run(spark)["out"])


def _embedding_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, bands = _vectors(spark, sf_dir)
    return _optimum(df, ["label"], [m.name for m in bands], _QUERIES["geomedian_embeddings"](spark, sf_dir))


add("geomedian_yearly_optimum", _yearly_optimum, _grouped("count(*) AS n, true AS optimal", where="WHERE blue IS NOT NULL AND red IS NOT NULL AND nir IS NOT NULL"))
add("geomedian_embeddings_optimum", _embedding_optimum, "SELECT label, count(*) AS n, true AS optimal FROM embeddings WHERE embedding IS NOT NULL GROUP BY label")

# Counters
_COUNT_VARS = [{"name": "cloudy", "flags": {"cloud": "cloud"}}, {"name": "clear_bright", "flags": {"cloud": "no_cloud", "bright": True, "contiguous": True}, "simple": True}]
_COUNTS = "count(*) FILTER ((pq & 2) = 2) AS cloudy, count(*) FILTER ((pq & 7) = 5) AS clear_bright"
add("flag_multi_count_simple", _job("masked_multi_count", ["pq"], {"vars": [{**v, "simple": True} for v in _COUNT_VARS], "nodata_flags": {"contiguous": False}}), _grouped(_COUNTS))
add("flag_multi_count", _job("masked_multi_count", ["pq"], {"vars": _COUNT_VARS, "nodata_flags": {"contiguous": False}}), _grouped("CASE WHEN bool_or((pq & 1) <> 0) THEN count(*) FILTER ((pq & 2) = 2) ELSE -1 END AS cloudy, count(*) FILTER ((pq & 7) = 5) AS clear_bright"))


def _direct(stat, bands: Sequence[str], dates: dict = YEARLY) -> Q:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        job = Job.from_config(_config("simple", bands, dates=dates), X.catalog(spark, sf_dir))
        return _rounded(reduce_frame(job.observations(), ("y", "x", "epoch_id"), [("", stat, job.inputs)]))

    return run


add("latest_valid", _direct(Latest(), ["red", "green"]), _grouped("arg_max(red, struct_pack(t := t, o := o)) FILTER (red IS NOT NULL) AS red, arg_max(green, struct_pack(t := t, o := o)) AS green"))
add("oldest_valid", _direct(Oldest(), ["red", "green"]), _grouped("arg_min(red, struct_pack(t := t, o := o)) FILTER (red IS NOT NULL) AS red, arg_min(green, struct_pack(t := t, o := o)) AS green"))
add("incremental_or", _direct(LogicalOr(), ["raw_red", "nir"]), _grouped("coalesce(bool_or(raw_red <> 0), false) AS raw_red, coalesce(bool_or(nir <> 0), false) AS nir"))
add("incremental_and", _direct(LogicalAnd(), ["raw_red", "nir"]), _grouped("coalesce(bool_and(raw_red <> 0), true) AS raw_red, coalesce(bool_and(nir <> 0), true) AS nir"))

# Canopy classes, regions
_TRIANGLE = [(5.2, 3.1), (44.7, 12.4), (20.3, 38.6)]


def _inside_sql(ring: Sequence[tuple[float, float]], x: str = "(x + 0.5)", y: str = "(y + 0.5)") -> str:
    closed = [*ring, ring[0]]
    parts = [f"CASE WHEN (({y} < {y0}) <> ({y} < {y1})) AND {x} < {x0}::DOUBLE + ({y} - {y0}::DOUBLE) * ({(x1 - x0) / (y1 - y0)!r}::DOUBLE) THEN 1 ELSE 0 END" for (x0, y0), (x1, y1) in zip(closed, closed[1:], strict=False)]
    return f"(({' + '.join(parts)}) % 2 = 1)"


add(
    "mangrove_cover_classes",
    lambda s, d: _job("mangrove_canopy_cover", ["blue"], {"thresholds": [10.0, 25.0, 40.0], "rings": [_TRIANGLE]})(s, d).drop("source"),
    f"{_with()} SELECT y, x, epoch_id, t AS time, o AS ord, CAST({_inside_sql(_TRIANGLE)} AND blue > 10 AS SMALLINT) AS extent, CAST(CASE WHEN NOT {_inside_sql(_TRIANGLE)} THEN 0 WHEN blue > 40 THEN 3 WHEN blue > 25 THEN 2 WHEN blue > 10 THEN 1 ELSE 0 END AS SMALLINT) AS canopy_cover_class FROM oe",
)
_MEAN = "round(avg(blue), 6) AS blue"
add("polygon_mask", lambda s, d: _job("simple", ["blue"], region={"gridded": False, "geometry": {"type": "Polygon", "coordinates": [[*map(list, _TRIANGLE), list(_TRIANGLE[0])]]}})(s, d).drop("feature_id"), _grouped(_MEAN, where=f"WHERE {_inside_sql(_TRIANGLE)}"))
add("bbox_region", _job("simple", ["blue"], region={"x": [10, 20], "y": [0, 2]}), _grouped(_MEAN, where="WHERE x + 0.5 BETWEEN 10 AND 20 AND y + 0.5 BETWEEN 0 AND 2"))
add("tile_list", _job("simple", ["blue"], region={"tiles": [[0, 0], [3, 0]]}), _grouped(_MEAN, where="WHERE (x // 10, y // 10) IN ((0, 0), (3, 0))"))
add("grid_cells", lambda s, d: assign(X.cube(s, d), epochs_of(WHOLE)).groupBy("tile_x", "tile_y").agg(F.count("*").alias("n"), F.count_distinct("y", "x").alias("pixels")), f"{_with(WHOLE)} SELECT CAST(x // 10 AS INTEGER) AS tile_x, CAST(y // 10 AS INTEGER) AS tile_y, count(*) AS n, count(DISTINCT (y, x)) AS pixels FROM oe GROUP BY 1, 2")


_SQUARE = [(30.4, 0.3), (49.6, 0.31), (49.61, 20.2), (30.41, 20.21)]


def _feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = F.array(*[F.struct(F.lit(i).alias("feature_id"), inside(F.col("x") + 0.5, F.col("y") + 0.5, [r]).alias("hit")) for i, r in enumerate((_TRIANGLE, _SQUARE))])
    hits = X.cube(spark, sf_dir).select("y", "x", F.explode(F.filter(each, lambda f: f["hit"])).alias("f"))
    return hits.groupBy("f.feature_id").agg(F.count("*").alias("n"), F.count_distinct("y", "x").alias("pixels"))


add("feature_stats", _feature_stats, f"WITH {_OBS} SELECT feature_id, count(*) AS n, count(DISTINCT (y, x)) AS pixels FROM (SELECT 0 AS feature_id, y, x FROM obs WHERE {_inside_sql(_TRIANGLE)} UNION ALL SELECT 1, y, x FROM obs WHERE {_inside_sql(_SQUARE)}) GROUP BY 1")

#: Two features that overlap: an L (1) and a triangle (2).
FEATURES = Path(__file__).parent / "features.json"
_ELL, _WEDGE = [(2.2, 0.3), (28.1, 0.31), (28.2, 2.4), (8.3, 2.41), (8.31, 38.2), (2.21, 38.3)], [(5.3, 0.2), (40.2, 1.3), (6.4, 30.1)]
add(
    "feature_id_polygon",
    _job("simple", ["blue"], region={"from_file": str(FEATURES), "feature_id": [1, 2]}),
    f"{_with()} SELECT y, x, epoch_id, feature_id, {_MEAN} FROM (SELECT *, CAST(1 AS BIGINT) AS feature_id FROM oe WHERE {_inside_sql(_ELL)} UNION ALL SELECT *, 2 FROM oe WHERE {_inside_sql(_WEDGE)}) GROUP BY y, x, epoch_id, feature_id",
)


def _tiles(region: dict) -> Q:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        job = Job.from_config(_config("simple", ["blue"], region=region) | {"storage": {"tile_size": [10, 10]}}, X.catalog(spark, sf_dir))
        return _rounded(job.run(spark)["out"].drop("tile_x", "tile_y", "epoch_start", "epoch_end"))

    return run


_ELL_SHAPE = {"type": "Polygon", "coordinates": [[*map(list, _ELL), list(_ELL[0])]]}
add("geometry_tiles", _tiles({"geometry": _ELL_SHAPE}), _grouped(_MEAN, where="WHERE (y < 10 AND x < 30) OR (x < 10 AND y < 40)"))
add("geometry_among_tiles", _tiles({"geometry": _ELL_SHAPE, "tiles": [[1, 0], [4, 0], [2, 0]]}), _grouped(_MEAN, where="WHERE y < 10 AND x >= 10 AND x < 30"))
add("file_hull_tiles", _tiles({"from_file": str(FEATURES)}), _grouped(_MEAN, where="WHERE x < 50 AND y < 40 AND (y // 10, x // 10) IN ((0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (2, 1), (2, 2), (3, 0), (3, 1))"))

# Masks
_ORDER = "JOIN orders ON l_orderkey = o_orderkey"


def _mask(name: str, mask: dict | list, keep: str, bands: Sequence[str] = ("blue", "red"), join: str = "", **source) -> None:
    each = ", ".join(f"round(avg(CASE WHEN {keep} THEN {b} END), 6) AS {b}" for b in bands)
    add(name, _job("simple", bands, masks=mask if isinstance(mask, list) else [mask], **source), f"{_with()} SELECT y, x, epoch_id, {each} FROM oe {join} GROUP BY y, x, epoch_id")


_cloudless = {"product": "obs", "measurement": "pq", "flags": {"cloud": "no_cloud", "contiguous": True}}
_mask("mask_flags", _cloudless, "(pq & 3) = 1")
_mask("mask_less_than", {"product": "order_mask", "measurement": "level", "less_than": 150000.0}, "o_totalprice < 150000", join=_ORDER)
_mask("mask_greater_than", {"product": "order_mask", "measurement": "level", "greater_than": 150000.0}, "o_totalprice > 150000", join=_ORDER)
_mask("mask_categories", {"product": "order_mask", "measurement": "status", "nonmasked_values": ["open", "pending"]}, "o_orderstatus <> 'F'", join=_ORDER)
_mask("mask_invert", {**_cloudless, "invert": True}, "(pq & 3) <> 1")
_mask("mask_multi", [_cloudless, {"product": "order_mask", "measurement": "level", "greater_than": 100000.0}], "(pq & 3) = 1 AND o_totalprice > 100000", join=_ORDER)
add("mask_inplace", _job("simple", ["red"], {"reduction_function": "count"}, masks=[_cloudless], mask_nodata=False), _grouped("count(CASE WHEN (pq & 3) = 1 THEN raw_red ELSE 0 END) AS red"))
add("mask_inplace_min", _job("simple", ["red"], {"reduction_function": "min"}, masks=[_cloudless], mask_nodata=False), _grouped("round(min(CASE WHEN (pq & 3) = 1 THEN raw_red ELSE 0 END), 6) AS red"))


# Sources
def _sources(sources: list[dict], statistic: str, args: dict, dates: dict = YEARLY) -> Q:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = _config(statistic, sources[0]["measurements"], args, dates=dates) | {"sources": sources}
        return _rounded(Job.from_config(cfg, X.catalog(spark, sf_dir)).run(spark)["out"].drop("tile_x", "tile_y", "epoch_start", "epoch_end"))

    return run


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _config("none", ["red"]) | {"sources": _three}
    obs = Job.from_config(cfg, X.catalog(spark, sf_dir)).observations()
    return obs.groupBy("source", "epoch_id").agg(F.count("*").alias("n"), F.count("red").alias("valid"), F.count_distinct("y", "x").alias("pixels"))


add("source_union_tagged", _tagged, f"{_with()} SELECT src AS source, epoch_id, count(*) AS n, count(red) AS valid, count(DISTINCT (y, x)) AS pixels FROM oe GROUP BY 1, 2")
_windows = [{"product": "obs_A", "measurements": ["blue"], "group_by": None, "time": ["1996-03-01", "1999-06-30"]}, {"product": "obs_N", "measurements": ["blue"], "group_by": None}, {"product": "obs_R", "measurements": ["blue"], "group_by": None, "time": ["1980-01-01", "1990-01-01"]}]
add("source_time_window", _sources(_windows, "simple", {"reduction_function": "mean"}), _grouped(_MEAN, where="WHERE src = 1 OR (src = 0 AND t BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1999-06-30')"))
add("source_filter_semijoin", _job("simple", ["blue"], source_filter={"product": "scenes", "quality": [0.0, 5000.0]}), _grouped(_MEAN, where="WHERE l_orderkey IN (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal BETWEEN 0 AND 5000)"))


def _fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _job("none", ["red", "raw_nir"], dates=WHOLE, group_by="solar_day")(spark, sf_dir).select("y", "x", "time", "ord", "red", F.col("raw_nir").alias("nir"))


add("solar_day_group_fuse_first", _fused, f"WITH {_OBS}, g AS (SELECT *, CAST(t + to_seconds(CAST(x * 3 * 240 AS BIGINT)) AS DATE) AS day FROM obs) SELECT y, x, min(struct_pack(t := t, o := o))['t'] AS time, min(struct_pack(t := t, o := o))['o'] AS ord, arg_min(red, struct_pack(t := t, o := o)) FILTER (red IS NOT NULL) AS red, arg_min(coalesce(nir, 0), struct_pack(t := t, o := o)) AS nir FROM g GROUP BY y, x, day")
add(
    "wofs_fuse",
    lambda s, d: _job("none", ["water"], dates=WHOLE, product="obs_utc", group_by="solar_day", fuse_func="wofs_fuser")(s, d).select("y", "x", _day().alias("day"), "water"),
    f"WITH {_OBS} SELECT y, x, date_trunc('day', t)::TIMESTAMP AS day, coalesce(arg_max(water, struct_pack(t := t, o := o)) FILTER ((water & 2) = 0), arg_min(water, struct_pack(t := t, o := o))) AS water FROM obs GROUP BY ALL",
)


def _steps_sql(step: str, bands: dict[str, str], select: str, more: str = "") -> str:
    """Steps of each pixel, their time that of the first scene, joined to the yearly epochs."""
    at = "struct_pack(t := t, o := o)"
    each = ", ".join(f"{e.format(at=at)} AS {b}" for b, e in bands.items())
    return f"WITH {_OBS}, {_epochs_sql(YEARLY)}, g AS (SELECT y, x, {step} AS step, min(t) AS t, {each} FROM obs {more} GROUP BY y, x, step), ge AS (SELECT g.*, epoch_id FROM g JOIN ep ON t BETWEEN s AND e) SELECT y, x, epoch_id, {select} FROM ge GROUP BY y, x, epoch_id"


_FIRST_RED, _FIRST_GREEN, _FIRST_PQ = "arg_min(red, {at}) FILTER (red IS NOT NULL)", "arg_min(green, {at})", "arg_min(pq, {at})"
_SOLAR = "CAST(t + to_seconds(CAST(x * 3 * 240 AS BIGINT)) AS DATE)"
add(
    "group_by_time_default",
    lambda s, d: _outputs({"mean": ("simple", {}), "count": ("simple", {"reduction_function": "count"})}, [{"product": "obs", "measurements": ["red", "green"]}])(s, d),
    _steps_sql("t", {"red": _FIRST_RED, "green": _FIRST_GREEN}, "round(avg(red), 6) AS mean_red, round(avg(green), 6) AS mean_green, count(red) AS count_red, count(green) AS count_green"),
)
add(
    "solar_day_masked",
    _job("simple", ["red", "green"], group_by="solar_day", masks=[{"product": "obs", "measurement": "pq", "flags": {"cloud": "no_cloud"}}, {"product": "order_mask", "measurement": "level", "greater_than": 100000.0}]),
    _steps_sql(_SOLAR, {"red": _FIRST_RED, "green": _FIRST_GREEN, "pq": _FIRST_PQ, "level": "arg_min(o_totalprice, {at})"}, "round(avg(CASE WHEN (pq & 2) = 0 AND level > 100000 THEN red END), 6) AS red, round(avg(CASE WHEN (pq & 2) = 0 AND level > 100000 THEN green END), 6) AS green", "JOIN orders ON l_orderkey = o_orderkey"),
)
add(
    "mask_fused",
    _job("simple", ["green"], group_by="solar_day", masks=[{"product": "obs", "measurement": "pq", "flags": {"contiguous": True}, "fuse_func": "wofs_fuser"}]),
    _steps_sql(_SOLAR, {"green": _FIRST_GREEN, "pq": "coalesce(arg_max(pq, {at}) FILTER ((pq & 2) = 0), arg_min(pq, {at}))"}, "round(avg(CASE WHEN (pq & 1) = 1 THEN green END), 6) AS green"),
)

# Alignment
_SCENES = "sc AS (SELECT DISTINCT src, CAST(x // 10 AS INTEGER) AS tile_x, CAST(y // 10 AS INTEGER) AS tile_y, t FROM obs)"


def _products(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    cat = X.catalog(spark, sf_dir)
    return {f: cat[f"obs_{f}"].frame().select("tile_x", "tile_y", "time").distinct() for f in "ANR"}


def _common(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _products(spark, sf_dir)
    return alignment.common(p["A"], [p["N"], p["R"]])


add("common_observations", _common, f"WITH {_OBS}, {_SCENES} SELECT tile_x, tile_y, t AS time FROM sc GROUP BY ALL HAVING count(DISTINCT src) = 3")
add("unmatched_observations", lambda s, d: alignment.unmatched((p := _products(s, d))["A"], [p["N"], p["R"]]), f"WITH {_OBS}, {_SCENES} SELECT tile_x, tile_y, t AS time FROM sc GROUP BY ALL HAVING count(DISTINCT src) < 3 AND bool_or(src = 0)")
add(
    "coverage_report",
    lambda s, d: alignment.coverage(_products(s, d), ["tile_x", "tile_y"]).withColumn("day", F.col("day").cast("timestamp_ntz")),
    f"""WITH {_OBS}, {_SCENES}, n AS (SELECT *, date_trunc('day', t)::TIMESTAMP AS day, count(*) OVER (PARTITION BY tile_x, tile_y, t) AS k FROM sc), m AS (SELECT tile_x, tile_y, day, count(DISTINCT src) AS together FROM n GROUP BY ALL)
SELECT CASE src WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS product, tile_x, tile_y, day, CASE WHEN k = 3 THEN 'matched' WHEN together = 3 THEN 'sibling' ELSE 'unmatched' END AS status, count(*) AS scenes FROM n JOIN m USING (tile_x, tile_y, day) GROUP BY ALL""",
)


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, n, r = (p.select(_day().alias("day"), "tile_x") for p in _products(spark, sf_dir).values())
    return a.select("day").intersect(n.select("day")).subtract(r.where("tile_x = 0").select("day"))


add("intersect_days", _days, f"WITH {_OBS}, {_SCENES} SELECT date_trunc('day', t)::TIMESTAMP AS day FROM sc WHERE src = 0 INTERSECT SELECT date_trunc('day', t)::TIMESTAMP FROM sc WHERE src = 1 EXCEPT SELECT date_trunc('day', t)::TIMESTAMP FROM sc WHERE src = 2 AND tile_x = 0")

# Epochs
_SEASONAL = {"start_date": "1995-06-01", "end_date": "2001-09-01", "stats_duration": "3m", "step_size": "1y"}
_SLIDING = {"start_date": "1995-09-01", "end_date": "2002-01-01", "stats_duration": "16m", "step_size": "12m"}
_MONTHEND = {"start_date": "1995-01-31", "end_date": "1997-12-31", "stats_duration": "10d", "step_size": "1m"}
for _name, _dates in (("epochs_seasonal", _SEASONAL), ("epochs_sliding", _SLIDING), ("epochs_single", {"start_date": "1996-01-01", "end_date": "1996-12-31"}), ("epochs_month_end", _MONTHEND)):
    add(_name, _job("simple", ["blue"], dates=_dates), _grouped(_MEAN, _dates))


def _daily(dates: dict, **config) -> Q:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        job = Job.from_config(_config("simple", ["blue"], dates=dates | {"type": "find_daily_data"}, **config), X.catalog(spark, sf_dir))
        return _rounded(job.run(spark)["out"].select("y", "x", "epoch_start", "blue"))

    return run


add("epochs_daily_discovery", _daily(WHOLE), f"WITH {_OBS} SELECT y, x, date_trunc('day', t)::TIMESTAMP AS epoch_start, {_MEAN} FROM obs GROUP BY ALL")
add("year_override", lambda s, d: _job("simple", ["blue"], dates={"start_date": dt.datetime(1997, 1, 1), "end_date": dt.datetime(1998, 1, 1), "stats_duration": "1y", "step_size": "1y"})(s, d), _grouped(_MEAN, [Epoch(dt.datetime(1997, 1, 1), dt.datetime(1997, 12, 31, 23, 59, 59, 999999))]))

# Calendars
_PROPS = {"DY1": "1995", "DY2": "1998", "WY1": "1996"}
add("hydrological_months", lambda s, d: calendar_filters.hydrological_months(X.cube(s, d), _PROPS, "dry", ["07", "11"]).groupBy("y", "x").agg(F.count("*").alias("n")), f"WITH {_OBS} SELECT y, x, count(*) AS n FROM obs WHERE CAST(t AS DATE) BETWEEN DATE '1996-07-01' AND DATE '1996-11-30' OR CAST(t AS DATE) BETWEEN DATE '1999-07-01' AND DATE '1999-11-30' GROUP BY y, x")


def _tides(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", "user_id", F.col("ts").alias("time"), F.col("value").alias("height"))


_T = "WITH z AS (SELECT min(value) AS lo, max(value) AS hi FROM events)"
add("tide_height_band", lambda s, d: calendar_filters.tide_height_band(_tides(s, d), 10, 20), f"{_T} SELECT event_id, user_id, ts AS time, value AS height FROM events, z WHERE value BETWEEN round(lo + (hi - lo) * 0.1::DOUBLE, 3) AND round(lo + (hi - lo) * 0.2::DOUBLE, 3)")
add("tide_height_top_band", lambda s, d: calendar_filters.tide_height_band(_tides(s, d), 10, 90), f"{_T} SELECT event_id, user_id, ts AS time, value AS height FROM events, z WHERE value BETWEEN round(lo + (hi - lo) * 0.8::DOUBLE, 3) AND round(lo + (hi - lo) * 1.0::DOUBLE, 3)")
add("tide_low_high", lambda s, d: calendar_filters.tide_low_high(_tides(s, d), 50), f"{_T} SELECT event_id, user_id, ts AS time, value AS height, CASE WHEN value <= lo + (hi - lo) * 0.25 THEN 'low' ELSE 'high' END AS kind FROM events, z WHERE value <= lo + (hi - lo) * 0.25 OR value >= hi - (hi - lo) * 0.25")


def _phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = _tides(spark, sf_dir).groupBy("user_id", "time").agg(F.max("height").alias("height"))
    return calendar_filters.tide_phase(calendar_filters.neighbours(per, ["user_id"])).select("user_id", "time", "phase")


add("tide_ebb_flow", _phases, "WITH p AS (SELECT user_id, ts, max(value) AS h FROM events GROUP BY ALL), n AS (SELECT *, lag(h) OVER w AS b, lead(h) OVER w AS a FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts)) SELECT user_id, ts AS time, CASE WHEN b < h AND h > a THEN 'ph' WHEN b > h AND h < a THEN 'pl' WHEN b < a THEN 'f' ELSE 'e' END AS phase FROM n WHERE b IS NOT NULL AND a IS NOT NULL")


def _composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    tides = X.lineitem(spark, sf_dir).groupBy(F.col("l_shipdate").alias("time")).agg(F.max("l_extendedprice").alias("height"))
    out = calendar_filters.filter_product(X.cube(spark, sf_dir), {"method": "by_tide_height", "args": {"tide_percent": 20, "type": "high"}}, {"tides": tides})
    return out.groupBy("y", "x").agg(F.count("*").alias("n"))


add("filter_product_tide", _composite, f"WITH {_OBS}, h AS (SELECT t, max(green) AS v FROM obs GROUP BY t), z AS (SELECT min(v) AS lo, max(v) AS hi FROM h) SELECT y, x, count(*) AS n FROM obs WHERE t IN (SELECT t FROM h, z WHERE v >= hi - (hi - lo) * 0.2 AND NOT v <= lo + (hi - lo) * 0.2) GROUP BY y, x")

# Sinks
add("provenance_sources", lambda s, d: Job.from_config(_config("simple", ["blue"]), X.catalog(s, d)).provenance(X.cube(s, d).select(F.col("l_orderkey").alias("dataset_id"), F.lit("obs").alias("product"), "tile_x", "tile_y", "time")).select("tile_x", "tile_y", "epoch_id", "n", F.element_at("datasets", 1).alias("first"), F.element_at("datasets", -1).alias("last")), f"{_with()} SELECT CAST(x // 10 AS INTEGER) AS tile_x, CAST(y // 10 AS INTEGER) AS tile_y, epoch_id, count(DISTINCT l_orderkey) AS n, min(l_orderkey) AS first, max(l_orderkey) AS last FROM oe GROUP BY ALL")


def _cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _direct(Simple("mean"), ["red", "blue"])(spark, sf_dir)
    df = df.select("y", "x", "epoch_id", ((F.col("blue") - 25) * 1.5).alias("level"), (F.col("blue") * 4000).alias("large"), F.col("red").alias("share"))
    return cast_back(df, ["y", "x", "epoch_id"], [Measurement("level", "int16", -999), Measurement("large", "int16", -1), Measurement("share", "float64", -1.0)])


add("castback_int16", _cast, f"{_with()}, g AS (SELECT y, x, epoch_id, round(avg(blue), 6) AS b, round(avg(red), 6) AS r FROM oe GROUP BY y, x, epoch_id) SELECT y, x, epoch_id, CAST(trunc((b - 25) * 1.5) AS SMALLINT) AS level, CAST(CASE WHEN trunc(b * 4000) BETWEEN -32768 AND 32767 THEN trunc(b * 4000) ELSE -1 END AS SMALLINT) AS large, coalesce(r, -1.0) AS share FROM g")
add("unpivot_single_band", lambda s, d: unpivot(_simple_two(s, d), ["y", "x", "epoch_id"], [Measurement("blue", "float64", -1.0), Measurement("green", "float64", -1.0)]), f"{_with()}, g AS (SELECT y, x, epoch_id, round(avg(blue), 6) AS blue, round(avg(green), 6) AS green FROM oe GROUP BY y, x, epoch_id) SELECT y, x, epoch_id, 'blue' AS measurement, blue AS value FROM g UNION ALL SELECT y, x, epoch_id, 'green', green FROM g")


def _simple_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _QUERIES["simple_mean_yearly"](spark, sf_dir)


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Job.from_config(_config("simple", ["blue"]), X.catalog(spark, sf_dir)).tasks(spark).select("tile_x", "tile_y", "epoch_id")


_TASKS = "tk AS (SELECT DISTINCT CAST(x // 10 AS INTEGER) AS tile_x, CAST(y // 10 AS INTEGER) AS tile_y, epoch_id FROM oe)"
add("task_slice", lambda s, d: alignment.task_slice(_tasks(s, d), "3:40:4", ["tile_x", "tile_y", "epoch_id"]), f"{_with(YEARLY, _TASKS)}, n AS (SELECT *, row_number() OVER (ORDER BY tile_x, tile_y, epoch_id) - 1 AS i FROM tk) SELECT tile_x, tile_y, epoch_id FROM n WHERE i >= 3 AND i < 40 AND (i - 3) % 4 = 0")
add("resume_tasks", lambda s, d: alignment.resumable((t := _tasks(s, d)), t.where("epoch_id < 3"), ["tile_x", "tile_y", "epoch_id"]), f"{_with(YEARLY, _TASKS)} SELECT * FROM tk WHERE epoch_id >= 3")
add("date_columns", lambda s, d: X.cube(s, d).select("y", "x", "ord", scalars.date_int(F.col("time")).alias("date_int"), scalars.days_since(F.col("time")).alias("days"), scalars.epoch_seconds(F.col("time")).alias("seconds")), f"WITH {_OBS} SELECT y, x, o AS ord, CAST(strftime(t, '%Y%m%d') AS INTEGER) AS date_int, CAST(date_diff('day', DATE '1970-01-01', CAST(t AS DATE)) AS SMALLINT) AS days, epoch_us(t) / 1e6 AS seconds FROM obs")

# Extension points, several outputs
add("external_count_wet", _job("external", ["water"], {"impl": "chronopix.contrib.CountWet"}), _grouped("count(*) FILTER (water = 128) AS wet"))


def _outputs(products: dict[str, tuple[str, dict]], sources: list[dict], dates: dict = YEARLY) -> Q:
    """A job of several outputs, side by side."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = {"sources": sources, "date_ranges": dates, "output_products": [{"name": n, "statistic": k, "statistic_args": a} for n, (k, a) in products.items()]}
        keys, out = ["y", "x", "epoch_id"], None
        for name, df in Job.from_config(cfg, X.catalog(spark, sf_dir)).run(spark).items():
            df = df.select(*keys, *[F.col(f"`{c}`").alias(f"{name}_{c}") for c in df.columns if c not in GROUP])
            out = df if out is None else out.join(df, keys)
        return _rounded(out)

    return run


def _multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outputs({"mean": ("simple", {}), "p": ("percentile", {"q": 50}), "last": ("latest", {})}, [{"product": "obs", "measurements": ["blue", "red"], "group_by": None}])(spark, sf_dir)


add("multi_output_job", _multi, _grouped("round(avg(blue), 6) AS mean_blue, round(avg(red), 6) AS mean_red, " + f"{_pc('blue', 50)} AS p_blue_PC_50, {_pc('red', 50)} AS p_red_PC_50, arg_max(blue, struct_pack(t := t, o := o)) AS last_blue, arg_max(red, struct_pack(t := t, o := o)) FILTER (red IS NOT NULL) AS last_red"))


def _windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.streaming.incremental import stream_reduce

    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("time"), "value", F.col("event_id").alias("ord"))
    m = [Measurement("value", "float64")]
    out = stream_reduce(e, ["user_id"], [("n_", Simple("count"), m), ("max_", Simple("max"), m), ("last_", Latest(), m)], "7 days")
    return out.select("user_id", F.col("epoch_start").cast("timestamp_ntz").alias("epoch_start"), "n_value", "max_value", "last_value")


add("windowed_incremental", _windowed, "SELECT user_id, time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS epoch_start, count(value) AS n_value, max(value) AS max_value, arg_max(value, struct_pack(t := ts, o := event_id)) AS last_value FROM events GROUP BY ALL")


def queries() -> dict[str, Q]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
