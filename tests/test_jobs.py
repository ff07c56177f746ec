"""Jobs through their configuration, on small tables whose results are known."""

from __future__ import annotations

import datetime as dt
import json
import re

import numpy as np
import pytest

from chronopix.__main__ import main
from chronopix.functions.geometry import GridSpec, holds
from chronopix.model import ConfigurationError, Measurement
from chronopix.operators import Function, GeometricMedian, Medoid, reduce_frame
from chronopix.operators.geomedian import weiszfeld
from chronopix.operators.medoid import totals
from chronopix.plans.job import Job, valid_region
from chronopix.sources.catalog import Catalog

D = dt.datetime
SCHEMA = "tile_x int, tile_y int, y int, x int, time timestamp_ntz, ord bigint, lon double, red double, pq int"
RED, PQ = Measurement("red", "float64", -1.0), Measurement("pq", "int32", flags_definition={"cloud": {"bits": 0, "values": {0: "no", 1: "yes"}}})
YEAR = {"start_date": "2000-01-01", "end_date": "2000-12-31"}


def row(x, time, ord, red, pq=0, y=0, lon=0.0):
    return (x // 10, y // 10, y, x, time, ord, lon, red, pq)


def catalog(spark, rows, masks=None, **more):
    c = Catalog()
    c.register("p", spark.createDataFrame(rows, SCHEMA), [RED, PQ], **more)
    c.register("m", spark.createDataFrame(masks if masks is not None else rows, SCHEMA), [RED, PQ])
    return c


def config(statistic="simple", args=None, region=None, outputs=None, storage=None, **source):
    out = {"sources": [{"product": "p", "measurements": ["red"], **source}], "date_ranges": YEAR, "output_products": outputs or [{"name": "out", "statistic": statistic, "statistic_args": args or {}}]}
    return out | ({"input_region": region} if region else {}) | ({"storage": storage} if storage else {})


def result(cfg, cat, **context):
    return {(r["y"], r["x"]): r["red"] for r in Job.from_config(cfg, cat, **context).run()["out"].collect()}


COUNT = {"reduction_function": "count"}
DAY = D(2000, 3, 1, 10)


def test_scenes_of_one_instant_are_one_observation_unless_told(spark):
    cat = catalog(spark, [row(0, DAY, 2, 5.0), row(0, DAY, 1, -1.0), row(0, DAY, 3, 7.0), row(0, D(2000, 4, 1), 1, 9.0)])
    assert result(config(args=COUNT), cat) == {(0, 0): 2} and result(config(args=COUNT, group_by="time"), cat) == {(0, 0): 2}
    assert result(config(args={"reduction_function": "min"}), cat) == {(0, 0): 5.0}  # the first that is not missing
    assert result(config(args=COUNT, group_by=None), cat) == {(0, 0): 3}
    with pytest.raises(ConfigurationError):
        result(config(group_by="week"), cat)
    with pytest.raises(ConfigurationError):
        result(config(group_by=None, fuse_func="wofs_fuser"), cat)


def test_fuse_func_counts_without_group_by(spark):
    from chronopix.sources import catalog as S

    S.FUSES["largest"] = lambda band, order: __import__("pyspark.sql.functions", fromlist=["max"]).max(band)
    try:
        assert result(config(args={"reduction_function": "min"}, fuse_func="largest"), catalog(spark, [row(0, DAY, 1, 5.0), row(0, DAY, 2, 7.0)])) == {(0, 0): 7.0}
    finally:
        del S.FUSES["largest"]


def test_sentinels_stay_where_they_are_wanted(spark):
    cat = catalog(spark, [row(0, DAY, 1, -1.0), row(0, DAY, 2, 4.0), row(1, DAY, 1, -1.0)])
    for by in ("time", "solar_day"):
        assert result(config(args={"reduction_function": "min"}, group_by=by, mask_nodata=False), cat) == {(0, 0): 4.0, (0, 1): -1.0}
    assert result(config(args={"reduction_function": "min"}, group_by=None, mask_nodata=False), cat) == {(0, 0): -1.0, (0, 1): -1.0}


@pytest.mark.parametrize("product", ["p", "m"])
def test_masks_are_fused_with_their_solar_day(spark, product):
    """A pixel that only the day's second scene has, seen and unmasked there."""
    rows = [row(0, DAY, 1, 3.0, 1), row(1, D(2000, 3, 1, 12), 1, 5.0, 0), row(2, D(2000, 3, 1, 11), 1, 6.0, 0), row(2, D(2000, 3, 1, 12), 2, 8.0, 1)]
    mask = {"product": product, "measurement": "pq", "flags": {"cloud": "no"}}
    cat = catalog(spark, rows, masks=[(*r[:4], r[4] + dt.timedelta(seconds=5), *r[5:]) for r in rows] if product == "m" else None)
    assert result(config(group_by="solar_day", masks=[mask]), cat) == {(0, 0): None, (0, 1): 5.0, (0, 2): 6.0}
    later = {**mask, "fuse_func": "wofs_fuser"}  # the last whose bit 1 is clear
    assert result(config(group_by="solar_day", masks=[later]), cat)[0, 2] is None


def test_mask_rows_that_repeat_do_not_repeat_observations_and_missing_masks_drop_them(spark):
    rows = [row(0, DAY, 1, 3.0), row(1, DAY, 1, 4.0)]
    mask = {"product": "m", "measurement": "pq", "flags": {"cloud": "no"}}
    for by in (None, "time"):
        assert result(config(args=COUNT, group_by=by, masks=[mask]), catalog(spark, rows, masks=[rows[0]] * 3)) == {(0, 0): 1}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_masks_of_the_same_product_and_the_statistics_need_one_scan_and_one_shuffle(spark, tmp_path):
    spark.createDataFrame([row(i, DAY, 1, 1.0) for i in range(20)], SCHEMA).write.parquet(str(tmp_path / "p"))
    c = Catalog()
    c.register("p", lambda: spark.read.parquet(str(tmp_path / "p")), [RED, PQ])
    mask = {"product": "p", "measurement": "pq", "flags": {"cloud": "no"}}
    for by, most in ((None, 1), ("time", 1), ("solar_day", 1)):
        plan = plan_of(Job.from_config(config(masks=[mask], group_by=by), c).run()["out"])
        assert plan.count("FileScan") == 1 and len(re.findall(r"Exchange hashpartitioning", plan)) <= most, plan


def test_outputs_share_one_pass(spark):
    outputs = [{"name": n, "statistic": "simple", "statistic_args": {"reduction_function": n}} for n in ("min", "max", "mean")]
    job = Job.from_config(config(outputs=outputs), catalog(spark, [row(0, DAY, 1, 5.0), row(0, D(2000, 5, 1), 1, 7.0)]))
    frames = job.run()
    assert [frames[n].first()["red"] for n in ("min", "max", "mean")] == [5.0, 7.0, 6.0]
    assert all("InMemoryTableScan" in plan_of(f) for f in frames.values())
    assert frames["min"].schema["red"].metadata["source_products"] == ["p"] and frames["min"].schema["red"].metadata["start_date"].startswith("2000-01-01")
    job.release()


def test_regions_by_tile_and_by_feature(spark, tmp_path):
    ell = [[1.2, 1.2], [8.8, 1.2], [8.8, 2.8], [2.8, 2.8], [2.8, 8.8], [1.2, 8.8], [1.2, 1.2]]
    square = [[2.1, 1.1], [4.9, 1.1], [4.9, 4.9], [2.1, 4.9], [2.1, 1.1]]
    shapes = {"type": "FeatureCollection", "features": [{"properties": {"ID": i, "DY": "1999"}, "geometry": {"type": "Polygon", "coordinates": [r]}} for i, r in ((1, ell), (2, square))]}
    (tmp_path / "f.json").write_text(json.dumps(shapes))
    cat = catalog(spark, [row(x, DAY, 1, 1.0, y=y) for x in range(25) for y in range(25)])
    file, tiled = str(tmp_path / "f.json"), {"tile_size": [10, 10]}
    out = Job.from_config(config(region={"from_file": file, "feature_id": [1, 2]}), cat).run()["out"].collect()
    for i, ring in ((1, ell), (2, square)):
        assert {(r["y"], r["x"]) for r in out if r["feature_id"] == i} == {(y, x) for x in range(25) for y in range(25) if holds([ring], x + 0.5, y + 0.5)}
    assert len(result(config(region={"from_file": file}, storage=tiled), cat)) == 100
    shape = {"type": "Polygon", "coordinates": [[[5, 5], [15, 5], [15, 6], [5, 5]]]}
    assert {(x // 10, y // 10) for y, x in result(config(region={"geometry": shape}, storage=tiled), cat)} == {(0, 0), (1, 0)}
    assert {(x // 10, y // 10) for y, x in result(config(region={"geometry": shape, "tiles": [[1, 0], [2, 2]]}, storage=tiled), cat)} == {(1, 0)}
    with pytest.raises(ConfigurationError):
        result(config(region={"geometry": shape}), cat)
    dry = config(region={"from_file": file, "feature_id": [2]}) | {"filter_product": {"method": "by_hydrological_months", "args": {"type": "dry", "months": ["03", "05"]}}}
    assert len(result(dry, cat)) > 0
    dry["filter_product"]["args"]["months"] = ["07", "08"]
    assert not result(dry, cat)
    with pytest.raises(ConfigurationError):
        result(config() | {"filter_product": {"method": "by_hydrological_months", "args": {}}}, cat)


def shapefile(path, shapes):
    """A polygon shapefile: [(attributes, rings)], attributes ID (a number) and NAME."""
    import struct

    records, dbf = b"", b""
    for i, (props, rings) in enumerate(shapes, 1):
        points = [p for r in rings for p in r]
        starts = [sum(len(r) for r in rings[:k]) for k in range(len(rings))]
        xs, ys = zip(*points, strict=True)
        body = struct.pack("<i4d2i", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        records += struct.pack(">2i", i, len(body) // 2) + body
        dbf += b" " + f"{props['ID']:>8}".encode() + f"{props['NAME']:<12}".encode()
    path.with_suffix(".shp").write_bytes(struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(records)) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8) + records)
    fields = b"".join(n.ljust(11, b"\0") + k + b"\0" * 4 + bytes([length]) + b"\0" * 15 for n, k, length in ((b"ID", b"N", 8), (b"NAME", b"C", 12)))
    path.with_suffix(".dbf").write_bytes(struct.pack("<4BIHH20x", 3, 0, 1, 1, len(shapes), 32 + len(fields) + 1, 21) + fields + b"\r" + dbf)


def test_features_of_a_shapefile(spark, tmp_path):
    outer, hole = [(0, 0), (0, 6), (6, 6), (6, 0), (0, 0)], [(2, 2), (4, 2), (4, 4), (2, 4), (2, 2)]
    shapefile(tmp_path / "s", [({"ID": 7, "NAME": "ring"}, [outer, hole]), ({"ID": 9, "NAME": "box"}, [[(8, 8), (8, 9), (9, 9), (9, 8), (8, 8)]])])
    path = str(tmp_path / "s.shp")
    cat = catalog(spark, [row(x, DAY, 1, 5.0, y=y) for x in range(12) for y in range(12)])
    out = Job.from_config(config(region={"from_file": path, "gridded": False}), cat).run()["out"].collect()
    assert sorted({r["feature_id"] for r in out}) == [7, 9] and sum(r["feature_id"] == 7 for r in out) == 32 and sum(r["feature_id"] == 9 for r in out) == 1
    from chronopix.operators import MangroveCover
    from chronopix.sources.regions import read_file

    assert read_file(path, [9])[0]["properties"] == {"ID": 9, "NAME": "box"}
    cover = MangroveCover([1.0], shape_file=path, origin=(0.0, 12.0), resolution=1.0)
    df = spark.createDataFrame([(x, y, 5.0) for x in range(12) for y in range(12)], "x int, y int, v double")
    got = df.select("x", "y", *[c.alias(n) for n, c in cover.aggregates([Measurement("v", "float64")]).items()]).where("extent = 1").collect()
    assert {(r["x"], 11 - r["y"]) for r in got} == {(r["x"], r["y"]) for r in out}  # y goes down from the origin


def test_cells_that_a_shape_touches():
    grid, rng = GridSpec("", (3.0, 2.0), (1.0, 1.0)), np.random.default_rng(1)
    for _ in range(60):
        ring = [tuple(p) for p in rng.uniform(-8, 8, (3, 2))]
        fine = {(int(np.floor(x / 3)), int(np.floor(y / 2))) for x in np.arange(-9, 9, 0.05) for y in np.arange(-9, 9, 0.05) if holds([ring], x, y)}
        got = set(grid.touching([ring]))
        assert fine <= got and all(any(abs(c[0] - f[0]) <= 1 and abs(c[1] - f[1]) <= 1 for f in fine) for c in got if fine)


def test_tasks_come_from_scenes(spark):
    scenes = spark.createDataFrame([(1, 0, 0, DAY), (2, 3, 0, DAY), (3, 3, 0, D(1990, 1, 1))], "dataset_id bigint, tile_x int, tile_y int, time timestamp_ntz")

    def never():
        raise AssertionError("pixels were read")

    c = Catalog()
    c.register("p", never, [RED], scenes=scenes)
    job = Job.from_config(config(region={"tiles": [[3, 0], [9, 9]]}), c)
    assert [(r["tile_x"], r["task_id"]) for r in job.tasks(spark).collect()] == [(3, "3_0_0")]


def test_provenance_takes_scenes_that_data_and_masks_have(spark):
    rows = [(1, "p", 0, 0, DAY), (2, "p", 0, 0, D(2000, 4, 1)), (3, "m", 0, 0, DAY), (4, "m", 1, 0, DAY), (5, "other", 0, 0, DAY)]
    scenes = spark.createDataFrame(rows, "dataset_id bigint, product string, tile_x int, tile_y int, time timestamp_ntz")
    cat = catalog(spark, [row(0, DAY, 1, 1.0)])
    mask = {"product": "m", "measurement": "pq", "flags": {"cloud": "no"}}
    assert Job.from_config(config(), cat).provenance(scenes).first()["datasets"] == [1, 2]
    assert [(r["datasets"], r["last_time"]) for r in Job.from_config(config(masks=[mask]), cat).provenance(scenes).collect()] == [([1, 3], DAY)]
    df = spark.createDataFrame([(0, 0, 0, y, x, v) for y, x, v in ((1, 2, 1.0), (5, 3, None), (4, 9, 2.0))], "tile_x int, tile_y int, epoch_id int, y int, x int, red double")
    assert tuple(valid_region(df, [RED]).first())[3:] == (1, 4, 2, 9, 2)


def test_plain_functions_are_statistics(spark):
    df = spark.createDataFrame([row(x, D(2000, 1, 1 + i), i, None if (x, i) == (1, 1) else float(x + i)) for x in range(3) for i in range(3)], SCHEMA)
    got = reduce_frame(df, ("y", "x"), [("", Function(lambda v: [np.nanmax(v) - v[0, 0]], [Measurement("gain", "float64")]), [RED])])
    assert {r["x"]: r["gain"] for r in got.collect()} == {0: 2.0, 1: 2.0, 2: 2.0}


def test_medoid_distances_in_blocks(monkeypatch):
    import chronopix.operators.medoid as M

    rng = np.random.default_rng(0)
    x, valid = rng.normal(size=(5, 9, 3)), rng.random((5, 9)) < 0.7
    whole = totals(x, valid)
    monkeypatch.setattr(M, "BLOCK", 60)
    assert np.array_equal(whole, totals(x, valid))
    for i in range(5):
        for k in range(9):
            assert whole[i, k] == (pytest.approx(sum(np.linalg.norm(x[i, k] - x[i, j]) for j in range(9) if valid[i, j]), abs=1e-8) if valid[i, k] else np.inf)


def test_geometric_medians_of_series_that_all_but_lie_on_a_line():
    """Where the sum of distances is nearly flat: the condition of the optimum must hold all the same."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.uniform(0, 50, (400, 6, 1)).round(), rng.uniform(0, 0.1, (400, 6, 2)).round(2)], axis=2)
    n = rng.integers(2, 7, 400)
    valid = np.arange(6)[None, :] < n[:, None]
    m = weiszfeld(x, valid, 1e-9)
    for xs, v, c in zip(x, valid, m, strict=True):
        gap = xs[v] - c
        far = np.linalg.norm(gap, axis=1)
        pull = np.linalg.norm((gap[far > 1e-9] / far[far > 1e-9, None]).sum(axis=0))
        assert pull <= (far <= 1e-9).sum() + 1e-5 * len(far)
    assert GeometricMedian().eps == 1e-3 and Medoid().least == 0


def test_geometric_medians_that_come_within_rounding_of_an_observation():
    """Iteration stops at an observation that is not the median, or beside one that is; sums of distances were up to 7 too large."""
    for x in (
        [[6, 0.01, 0.01], [36, 0.04, 0.01], [11, 0.08, 0.05], [2, 0.04, 0.02], [43, 0.02, 0.02], [18, 0.04, 0.03], [10, 0.05, 0.07]],
        [[31, 0.06, 0.03], [28, 0.06, 0.07], [37, 0.06, 0.02], [34, 0.08, 0.04], [48, 0.04, 0.01], [8, 0.06, 0.01]],
        [[3, 0.01, 0.03], [10, 0.09, 0.07], [8, 0.08, 0.02], [9, 0.05, 0.07], [40, 0.02, 0.06], [14, 0.05, 0.05]],
        [[14, 0.08, 0.04], [19, 0.02, 0.07], [15, 0.04, 0.08], [22, 0.06, 0.05], [40, 0.1, 0.01]],
        [[20, 0.01, 0.07], [49, 0.07, 0.03], [37, 0.03, 0.03], [37, 0.03, 0.05], [42, 0.01, 0.07]],
        [[19, 0.09, 0.01], [13, 0.06, 0.07], [17, 0.08, 0.03], [17, 0.02, 0.02]],
    ):
        x = np.array(x)
        c = weiszfeld(x[None], np.ones((1, len(x)), bool), 1e-9)[0]
        far = np.linalg.norm(x - c, axis=1)
        pull = np.linalg.norm(((x - c)[far > 1e-9] / far[far > 1e-9, None]).sum(axis=0))
        assert pull <= (far <= 1e-9).sum() + 1e-5 * len(x) + 1e-6


@pytest.fixture
def files(spark, tmp_path):
    rows = [row(x, D(y, 3, 1, 10), 1, float(x + y)) for x in range(20) for y in (2000, 2001)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "p"))
    (tmp_path / "products.json").write_text(json.dumps({"p": {"path": str(tmp_path / "p"), "measurements": [{"name": "red", "dtype": "float64", "nodata": -1.0}]}}))
    text = """
sources: [{product: p, measurements: [red]}]
date_ranges: {start_date: 2000-01-01, end_date: 2002-01-01, stats_duration: 1y, step_size: 1y}
location: LOCATION
storage: {driver: Parquet, chunking: {x: 5, y: 5}}
global_attributes: {institution: someone}
var_attributes: {red: {long_name: Red}}
output_products:
  - {name: mean, statistic: simple, statistic_args: {reduction_function: mean}, file_path_template: "{x}_{y}_{epoch_start:%Y}_{name}", product_type: !!str summary}
  - {name: top, statistic: simple, statistic_args: {reduction_function: max}}
""".replace("LOCATION", str(tmp_path / "out"))
    (tmp_path / "job.yaml").write_text(text)
    return tmp_path


def run(files, *more):
    return main([str(files / "job.yaml"), "--products", str(files / "products.json"), *more])


def test_command_line(spark, files, capsys):
    assert run(files, "--task-slice", "0:1") == 0
    mean = lambda: spark.read.parquet(str(files / "out/mean"))
    assert mean().count() == 10 and {r["file"] for r in mean().collect()} == {"0_0_2000_mean"}
    assert run(files) == 0  # what is there is skipped, the rest is added
    assert mean().count() == 40 and spark.read.parquet(str(files / "out/top")).count() == 40 and mean().select("file").distinct().count() == 4
    assert run(files) == 0 and mean().count() == 40 and run(files, "--overwrite") == 0 and mean().count() == 40
    import yaml

    told = yaml.safe_load("\n".join(r["value"] for r in spark.read.text(str(files / "out/_definitions/mean")).collect()))
    assert told["attributes"] == {"title": "mean", "institution": "someone"} and told["bands"]["red"]["layer"] == 1 and told["metadata"]["statistics"] == {"period": "1y", "step": "1y"}
    assert mean().schema["red"].metadata["long_name"] == "Red"
    assert run(files, "--save-tasks", str(files / "tasks")) == 0 and spark.read.parquet(str(files / "tasks")).count() == 4
    assert run(files, "--load-tasks", str(files / "tasks"), "--output-location", str(files / "again"), "--year", "2001") == 0
    capsys.readouterr()
    assert run(files, "--batch", "3") == 0
    lines = capsys.readouterr().out.splitlines()
    assert len(lines) == 3 and lines[1].endswith("--task-slice 1::3") and "--batch" not in lines[0]
    assert main(["--list-statistics"]) == 0 and "geomedian" in capsys.readouterr().out


def test_command_line_filters_and_errors(spark, files, capsys):
    text = (files / "job.yaml").read_text() + "filter_product: {method: by_tide_height, args: {tide_percent: 50, type: high}}\n"
    (files / "job.yaml").write_text(text)
    assert run(files) == 2 and "table of tides" in capsys.readouterr().err
    spark.createDataFrame([(D(2000, 3, 1, 10), 2.0), (D(2001, 3, 1, 10), 0.0)], "time timestamp_ntz, height double").write.parquet(str(files / "tides"))
    assert run(files, "--tides", str(files / "tides")) == 0
    assert {r["epoch_id"] for r in spark.read.parquet(str(files / "out/top")).collect()} == {0}
    (files / "job.yaml").write_text(text.replace("chunking: {x: 5, y: 5}", "chunking: {z: 5}"))
    assert run(files) == 2
