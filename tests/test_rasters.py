"""Raster files, read back by readers of the formats that share nothing with the writers."""

from __future__ import annotations

import datetime as dt
import json
import struct

import numpy as np
import pytest

from chronopix.__main__ import main
from chronopix.model import ConfigurationError, Measurement, OutputProduct
from chronopix.operators import Simple
from chronopix.sinks.output import writer
from chronopix.sinks.rasters import unpack

KEYS = ["tile_x", "tile_y", "y", "x", "epoch_start", "epoch_end"]
A = dt.datetime(2000, 1, 1)


def tiff(data):
    """Tags, and the planes as arrays."""
    assert data[:4] == b"II*\0"
    (at,) = struct.unpack_from("<I", data, 4)
    (n,) = struct.unpack_from("<H", data, at)
    tags = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from("<HHI", data, at + 2 + 12 * k)
        code, size = {2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 12: ("d", 8)}[kind]
        where = at + 2 + 12 * k + 8
        if size * count > 4:
            (where,) = struct.unpack_from("<I", data, where)
        tags[tag] = struct.unpack_from(f"<{count}{code}", data, where) if kind != 2 else data[where : where + count - 1].decode()
    assert list(tags) == sorted(tags)
    kind = {1: "u", 2: "i", 3: "f"}[tags[339][0]] + str(tags[258][0] // 8)
    planes = [np.frombuffer(data[o : o + s], "<" + kind).reshape(tags[257][0], tags[256][0]) for o, s in zip(tags[273], tags[279], strict=True)]
    return tags, planes


def netcdf(data):
    """Dimensions, attributes, and variables as (attributes, array)."""
    at = 8

    def u4():
        nonlocal at
        at += 4
        return struct.unpack_from(">I", data, at - 4)[0]

    def name():
        nonlocal at
        n = u4()
        s = data[at : at + n].decode()
        at += n + -n % 4
        return s

    def attrs():
        nonlocal at
        out = {}
        u4()
        for _ in range(u4()):
            key, kind, n = name(), u4(), u4()
            size = {1: 1, 2: 1, 3: 2, 4: 4, 5: 4, 6: 8}[kind]
            raw = data[at : at + size * n]
            out[key] = raw.decode() if kind == 2 else np.frombuffer(raw, {1: "i1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}[kind])[0]
            at += size * n + -(size * n) % 4
        return out

    assert data[:4] == b"CDF\2"
    u4()
    dims = [(name(), u4()) for _ in range(u4())]
    top, variables = attrs(), {}
    u4()
    for _ in range(u4()):
        n = name()
        ids = [u4() for _ in range(u4())]
        given, kind, _ = attrs(), u4(), u4()
        (start,) = struct.unpack_from(">Q", data, at)
        at += 8
        shape = [dims[i][1] for i in ids]
        variables[n] = (given, np.frombuffer(data, {1: "i1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}[kind], int(np.prod(shape)), start).reshape(shape))
    return dims, top, variables


def product(template, *bands, **metadata):
    return OutputProduct("out", Simple(), bands, bands, "simple", template, {}, metadata)


def table(spark, dtype):
    rows = [(tx, 0, y, tx * 4 + x, A, A, float(10 * tx + y), None if (x, y) == (1, 1) else 7.0) for tx in (0, 1) for y in range(3) for x in range(4) if (x, y) != (3, 2)]
    return spark.createDataFrame(rows, "tile_x int, tile_y int, y int, x int, epoch_start timestamp_ntz, epoch_end timestamp_ntz, a double, b double")


@pytest.mark.parametrize("dtype,nodata", [("int8", -5), ("uint8", 254), ("int16", -999), ("float32", float("nan")), ("float64", float("nan"))])
def test_geotiff(spark, tmp_path, dtype, nodata):
    a, b = Measurement("a", dtype, nodata), Measurement("b", dtype, nodata)
    w = writer("GeoTIFF")(str(tmp_path / "t"), tile_size=[4, 3], resolution=[25, -25], crs="EPSG:3577")
    got = {r["file"]: r["content"] for r in spark.read.parquet(w.write(table(spark, dtype), product("{x}_{y}.tif", a, b), KEYS)).collect()}
    assert sorted(got) == ["0_0.tif", "1_0.tif"]
    tags, (pa, pb) = tiff(got["1_0.tif"])
    fill, kind = (255, "u1") if dtype == "int8" else (nodata, np.dtype(dtype).str[1:])
    assert pa.dtype.str[1:] == kind and pa.shape == (3, 4) and tags[270] == "a,b" and tags[33922] == (0, 0, 0, 100, 0, 0) and tags[33550] == (25, 25, 0) and 3577 in tags[34735]
    same = lambda x, y: x == y or x != x and y != y
    assert [pa[y, 0] for y in range(3)] == [10, 11, 12] and pb[0, 0] == 7 and same(pb[2, 3], fill) and same(float(tags[42113]), fill)
    assert same(pb[1, 1], fill)
    single = {r["file"] for r in spark.read.parquet(writer("geotiff")(str(tmp_path / "s")).write(table(spark, dtype), product("{var_name}_{x}.tif", a, b), KEYS)).collect()}
    assert single == {"a_0.tif", "b_0.tif", "a_1.tif", "b_1.tif"}
    with pytest.raises(ConfigurationError):
        w.write(table(spark, dtype), product("{x}.tif", a, Measurement("b", "int32", 0)), KEYS)


def test_netcdf_and_envi(spark, tmp_path):
    a, b = Measurement("a", "int16", -1), Measurement("b", "float32")
    w = writer("NetCDF CF")(str(tmp_path / "n"), tile_size={"x": 4, "y": 3}, attributes={"title": "T"}, var_attributes={"b": {"long_name": "B"}})
    files = spark.read.parquet(w.write(table(spark, ""), product(None, a, b), KEYS))
    assert unpack(files, str(tmp_path / "f")) == 2
    dims, top, variables = netcdf((tmp_path / "f" / "out_1_0_20000101.nc").read_bytes())
    assert dims == [("time", 1), ("y", 3), ("x", 4)] and top == {"Conventions": "CF-1.6", "title": "T"}
    assert variables["a"][0]["_FillValue"] == -1 and variables["b"][0]["long_name"] == "B" and variables["x"][1].tolist() == [4.5, 5.5, 6.5, 7.5]
    assert variables["a"][1][0].tolist() == [[10] * 4, [11] * 4, [12, 12, 12, -1]] and np.isnan(variables["b"][1][0][1, 1]) and variables["time"][1][0] == 946684800
    e = {r["file"]: r["content"] for r in spark.read.parquet(writer("ENVI BIL")(str(tmp_path / "e"), tile_size=[4, 3]).write(table(spark, ""), product("{x}.bil", a, Measurement("b", "int16", -1)), KEYS)).collect()}
    assert sorted(e) == ["0.bil", "0.bil.hdr", "1.bil", "1.bil.hdr"] and b"interleave = bil" in e["1.bil.hdr"] and b"samples = 4" in e["1.bil.hdr"]
    assert np.frombuffer(e["1.bil"], "<i2").reshape(3, 2, 4)[1].tolist() == [[11] * 4, [7, -1, 7, 7]]


def test_rasters_by_the_command_line_skip_what_is_there(spark, tmp_path):
    schema = "tile_x int, tile_y int, y int, x int, time timestamp_ntz, ord bigint, red double"
    spark.createDataFrame([(x // 5, 0, y, x, dt.datetime(2000, 3, 1), 1, float(x)) for x in range(10) for y in range(5)], schema).write.parquet(str(tmp_path / "p"))
    (tmp_path / "products.json").write_text(json.dumps({"p": {"path": str(tmp_path / "p"), "measurements": [{"name": "red", "dtype": "int16", "nodata": -1}]}}))
    text = "sources: [{product: p, measurements: [red]}]\ndate_ranges: {start_date: 2000-01-01, end_date: 2000-12-31}\nstorage: {driver: GeoTIFF, tile_size: [5, 5], crs: 'EPSG:4326'}\noutput_products: [{name: m, statistic: simple, file_path_template: '{x}_{y}_{epoch_start:%Y}.tif'}]\n"
    (tmp_path / "job.yaml").write_text(text)
    for more in (["--task-slice", "0:1"], [], []):
        assert main([str(tmp_path / "job.yaml"), "--products", str(tmp_path / "products.json"), "--output-location", str(tmp_path / "o"), *more]) == 0
    got = {r["file"]: r["content"] for r in spark.read.parquet(str(tmp_path / "o/m")).collect()}
    assert sorted(got) == ["0_0_2000.tif", "1_0_2000.tif"] and tiff(got["1_0_2000.tif"])[1][0][0].tolist() == [5, 6, 7, 8, 9]
