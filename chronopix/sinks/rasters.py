"""Outputs as raster files: GeoTIFF, NetCDF (classic, CF attributes) and ENVI BIL, one per task.

A task's pixels become the bytes of its file in one Arrow group, so a task of the cluster holds one tile. Files are rows (file, content) of a Parquet
table, written and committed like any other, whatever store that is; ``unpack`` copies them out.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.model import ConfigurationError, Measurement, OutputProduct
from chronopix.sinks.output import WRITERS, Writer, cast_back, file_column, tiff_type

#: Numbers of a NetCDF type, and what holds the types that the classic format lacks.
_CDF = {"i1": 1, "i2": 3, "i4": 4, "f4": 5, "f8": 6}
_CLASSIC = {"int8": "i1", "uint8": "i2", "int16": "i2", "uint16": "i4", "int32": "i4", "int64": "f8", "float32": "f4", "float64": "f8", "bool": "i1"}


def numpy_type(dtype: str) -> str:
    return "u1" if dtype == "bool" else np.dtype(dtype).str[1:]


def geotiff(bands: Mapping[str, np.ndarray], nodata: Any, origin: tuple[float, float], resolution: tuple[float, float], epsg: int | None) -> bytes:
    """A GeoTIFF, one plane per band; all bands (rows, columns) of one type. origin: of the upper left corner."""
    arrays = list(bands.values())
    rows, columns = arrays[0].shape
    n, kind = len(arrays), {"u": 1, "i": 2, "f": 3}[arrays[0].dtype.kind]
    planes = [np.ascontiguousarray(a).astype(a.dtype.newbyteorder("<"), copy=False).tobytes() for a in arrays]
    keys = [1, 1, 0, 3, 1024, 0, 1, 2 if epsg == 4326 else 1, 1025, 0, 1, 1, 2048 if epsg == 4326 else 3072, 0, 1, epsg] if epsg else []
    text = lambda s: s.encode() + b"\0"
    # (tag, type, values): 2 text, 3 short, 4 long, 12 double
    tags: list[tuple[int, int, Any]] = [
        (256, 4, [columns]), (257, 4, [rows]), (258, 3, [8 * arrays[0].itemsize] * n), (259, 3, [1]), (262, 3, [1]), (270, 2, text(",".join(bands))), (273, 4, None), (277, 3, [n]), (278, 4, [rows]),
        (279, 4, [len(p) for p in planes]), (284, 3, [2]), (339, 3, [kind] * n), (33550, 12, [abs(resolution[0]), abs(resolution[1]), 0.0]), (33922, 12, [0.0, 0.0, 0.0, origin[0], origin[1], 0.0]),
        *([(34735, 3, keys)] if keys else []), (42113, 2, text("nan" if nodata != nodata else f"{nodata:g}")),
    ]
    after = 8 + 2 + 12 * len(tags) + 4
    sizes = {2: 1, 3: 2, 4: 4, 12: 8}
    count = lambda t, v: n if v is None else len(v)
    extra = sum((s + 1) // 2 * 2 for t, k, v in tags if (s := sizes[k] * count(t, v)) > 4)
    starts, at = [], after + extra
    for p in planes:
        starts.append(at)
        at += len(p)
    entries, values = b"", b""
    for tag, k, v in tags:
        v = starts if v is None else v
        raw = v if k == 2 else struct.pack(f"<{len(v)}{ {3: 'H', 4: 'I', 12: 'd'}[k]}", *v)
        if len(raw) > 4:
            entries += struct.pack("<HHII", tag, k, len(v), after + len(values))
            values += raw + b"\0" * (len(raw) % 2)
        else:
            entries += struct.pack("<HHI", tag, k, len(v)) + raw.ljust(4, b"\0")
    return b"II" + struct.pack("<HI", 42, 8) + struct.pack("<H", len(tags)) + entries + struct.pack("<I", 0) + values + b"".join(planes)


def netcdf(bands: Mapping[str, np.ndarray], attributes: Mapping[str, Mapping[str, Any]], title: Mapping[str, Any], x: np.ndarray, y: np.ndarray, time: float) -> bytes:
    """A NetCDF file (64-bit offsets) of the bands (time 1, y, x), each with its attributes, and the coordinates."""

    def name(s: str) -> bytes:
        b = s.encode()
        return struct.pack(">I", len(b)) + b + b"\0" * (-len(b) % 4)

    def attrs(given: Mapping[str, Any]) -> bytes:
        out = b""
        for k, v in given.items():
            if isinstance(v, np.generic):
                raw, kind, n = v.astype(v.dtype.newbyteorder(">")).tobytes(), _CDF[v.dtype.str[1:]], 1
            else:
                raw, kind = str(v).encode(), 2
                n = len(raw)
            out += name(k) + struct.pack(">II", kind, n) + raw + b"\0" * (-len(raw) % 4)
        return struct.pack(">II", 12 if given else 0, len(given)) + out

    rows, columns = len(y), len(x)
    units = {"units": "seconds since 1970-01-01 00:00:00", "standard_name": "time"}
    variables = [("time", [0], np.array([time]), units), ("y", [1], y, {"axis": "Y"}), ("x", [2], x, {"axis": "X"})]
    variables += [(n, [0, 1, 2], a, attributes.get(n, {})) for n, a in bands.items()]
    raws = [np.ascontiguousarray(a).astype(a.dtype.newbyteorder(">"), copy=False).tobytes() for _, _, a, _ in variables]
    raws = [r + b"\0" * (-len(r) % 4) for r in raws]
    dims = struct.pack(">II", 10, 3) + b"".join(name(n) + struct.pack(">I", k) for n, k in (("time", 1), ("y", rows), ("x", columns)))
    head = b"CDF\2" + struct.pack(">I", 0) + dims + attrs({"Conventions": "CF-1.6", **title}) + struct.pack(">II", 11, len(variables))
    told = [name(n) + struct.pack(f">I{len(d)}I", len(d), *d) + attrs(given) + struct.pack(">II", _CDF[a.dtype.str[1:]], min(len(raw), 2**32 - 4)) for (n, d, a, given), raw in zip(variables, raws, strict=True)]
    at, out = len(head) + sum(len(t) + 8 for t in told), head
    for t, raw in zip(told, raws, strict=True):
        out += t + struct.pack(">Q", at)
        at += len(raw)
    return out + b"".join(raws)


def envi(bands: Mapping[str, np.ndarray], nodata: Any, origin: tuple[float, float], resolution: tuple[float, float]) -> tuple[bytes, bytes]:
    """An ENVI file, interleaved by line, and its header."""
    stack = np.stack(list(bands.values()), axis=1)  # row, band, column
    kind = {"u1": 1, "i2": 2, "i4": 3, "f4": 4, "f8": 5, "u2": 12, "i8": 14}[stack.dtype.str[1:]]
    rows, n, columns = stack.shape
    head = ["ENVI", f"samples = {columns}", f"lines = {rows}", f"bands = {n}", "header offset = 0", "file type = ENVI Standard", f"data type = {kind}", "interleave = bil", "byte order = 0"]
    head += [f"map info = {{Arbitrary, 1, 1, {origin[0]}, {origin[1]}, {abs(resolution[0])}, {abs(resolution[1])}}}", f"data ignore value = {nodata}", "band names = {" + ", ".join(bands) + "}"]
    return stack.astype(stack.dtype.newbyteorder("<"), copy=False).tobytes(), ("\n".join(head) + "\n").encode()


class RasterWriter(Writer):
    """One GeoTIFF per task, or per task and band where the template has var_name; bands of one file share type and nodata, int8 is widened."""

    name, suffix = "geotiff", ".tif"

    def __init__(self, location: str, tile_size: Any = None, resolution: Any = None, crs: Any = None, attributes: Mapping[str, Any] | None = None, var_attributes: Mapping[str, Any] | None = None, **params: Any):
        super().__init__(location, **params)
        pair = lambda v, one: one if v is None else (float(v["x"]), float(v["y"])) if isinstance(v, Mapping) else (float(v[0]), float(v[1]))
        self.tile, self.resolution = pair(tile_size, None), pair(resolution, (1.0, 1.0))
        self.epsg = int(str(crs).split(":")[-1]) if crs and str(crs).split(":")[-1].isdigit() else None
        self.attributes, self.var_attributes = dict(attributes or {}), dict(var_attributes or {})

    def held(self, m: Measurement) -> Measurement:
        """The band as the file holds it."""
        dtype, fill = tiff_type(m.dtype, m.fill)
        return m.with_(dtype=dtype, nodata=fill)

    def kinds(self, measurements: Sequence[Measurement]) -> dict[str, tuple[str, Any]]:
        """Each band's numpy type and nodata in the file."""
        return {m.name: (numpy_type(h.dtype), h.fill) for m in measurements for h in [self.held(m)]}

    def groups(self, product: OutputProduct) -> list[list[Measurement]]:
        """The bands of each of a task's files."""
        if "{var_name" in (product.template or ""):
            return [[m] for m in product.measurements]
        if len({str(k) for k in self.kinds(product.measurements).values()}) > 1:
            raise ConfigurationError("bands of one file must share type and nodata; name files by var_name, or give the bands one type")
        return [list(product.measurements)]

    def encode(self, arrays: Mapping[str, np.ndarray], fills: Mapping[str, Any], x: np.ndarray, y: np.ndarray, time: float, origin: tuple[float, float]) -> Iterator[tuple[str, bytes]]:
        yield "", geotiff(arrays, next(iter(fills.values())), origin, self.resolution, self.epsg)

    def write(self, df: DataFrame, product: OutputProduct, keys: Sequence[str], partition: Sequence[str] = ()) -> Any:
        template = product.template or "{name}_{x}_{y}_{epoch_start:%Y%m%d}" + self.suffix
        parts = []
        for bands in self.groups(product):
            named = OutputProduct(product.name, product.statistic, product.inputs, tuple(bands), product.stat_name, template, product.params, product.metadata)
            rows = cast_back(df, keys, [self.held(m) for m in bands])
            if "{var_name" in template:
                rows = rows.withColumn("measurement", F.lit(bands[0].name))
            rows = rows.withColumn("file", file_column(named, rows.columns, self.places))
            kinds = self.kinds(bands)
            by = [c for c in ("tile_x", "tile_y") if c in rows.columns and "feature_id" not in rows.columns]
            parts.append(rows.select("file", "epoch_start", *by, "y", "x", *[F.col(f"`{m.name}`") for m in bands]).groupBy("file").applyInArrow(self._task(kinds, bool(by)), "file string, content binary"))
        out, mode = parts[0], self.mode
        for p in parts[1:]:
            out = out.unionByName(p)
        if self.skip and (done := self.done(out, product)) is not None:
            out, mode = self.missing(out, done, ["file"]), "append"
        out.write.mode(mode).parquet(self.path(product))
        return self.path(product)

    def done(self, df: DataFrame, product: OutputProduct) -> DataFrame | None:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(self.path(product))
        if not path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).exists(path):
            return None
        return df.sparkSession.read.schema("file string").parquet(self.path(product))

    def _task(self, kinds: Mapping[str, tuple[str, Any]], tiled: bool) -> Any:
        tile, resolution, encode = self.tile, self.resolution, self.encode

        def run(table: pa.Table) -> pa.Table:
            xs, ys = (table[c].to_numpy().astype(np.int64) for c in ("x", "y"))
            if tile and tiled:  # the whole tile, seen or not
                x0, y0 = (round(table[c][0].as_py() * s) for c, s in zip(("tile_x", "tile_y"), tile, strict=True))
                width, height = round(tile[0]), round(tile[1])
            else:
                x0, y0 = int(xs.min()), int(ys.min())
                width, height = int(xs.max()) - x0 + 1, int(ys.max()) - y0 + 1
            arrays = {}
            for n, (kind, fill) in kinds.items():
                a = np.full((height, width), np.nan if fill != fill else fill, dtype=kind)
                a[ys - y0, xs - x0] = table[n].to_numpy().astype(kind)
                arrays[n] = a
            rx, ry = abs(resolution[0]), abs(resolution[1])
            centres = (np.arange(x0, x0 + width) + 0.5) * rx, -(np.arange(y0, y0 + height) + 0.5) * ry
            start = table["epoch_start"][0].as_py()
            seconds = (start - type(start)(1970, 1, 1)).total_seconds()
            file = table["file"][0].as_py()
            made = list(encode(arrays, {n: f for n, (_, f) in kinds.items()}, *centres, seconds, (x0 * rx, -y0 * ry)))
            return pa.table({"file": pa.array([file + s for s, _ in made]), "content": pa.array([c for _, c in made], pa.binary())})

        return run


class NetcdfWriter(RasterWriter):
    """One NetCDF file per task; bands keep types of their own, those that the classic format lacks in the next wider."""

    name, suffix = "netcdfcf", ".nc"

    def held(self, m: Measurement) -> Measurement:
        return m

    def kinds(self, measurements: Sequence[Measurement]) -> dict[str, tuple[str, Any]]:
        return {m.name: (_CLASSIC[m.dtype], m.fill) for m in measurements}

    def groups(self, product: OutputProduct) -> list[list[Measurement]]:
        return [[m] for m in product.measurements] if "{var_name" in (product.template or "") else [list(product.measurements)]

    def encode(self, arrays: Mapping[str, np.ndarray], fills: Mapping[str, Any], x: np.ndarray, y: np.ndarray, time: float, origin: tuple[float, float]) -> Iterator[tuple[str, bytes]]:
        given = {n: {"_FillValue": a.dtype.type(fills[n]), **(self.var_attributes.get(n) or {})} for n, a in arrays.items()}
        yield "", netcdf(arrays, given, self.attributes, x, y, time)


class EnviWriter(RasterWriter):
    """One ENVI file per task, interleaved by line, with its header beside it."""

    name, suffix = "envibil", ".bil"

    def encode(self, arrays: Mapping[str, np.ndarray], fills: Mapping[str, Any], x: np.ndarray, y: np.ndarray, time: float, origin: tuple[float, float]) -> Iterator[tuple[str, bytes]]:
        data, head = envi(arrays, next(iter(fills.values())), origin, self.resolution)
        yield "", data
        yield ".hdr", head


def unpack(files: DataFrame, folder: str) -> int:
    """Copies the files of a table out to a folder, one at a time; how many there are. A folder that only Spark can write needs other means."""
    import os

    n = 0
    for r in files.toLocalIterator():
        path = os.path.join(folder, r["file"])
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        with open(path, "xb") as f:
            f.write(r["content"])
        n += 1
    return n


WRITERS.update({w.name: w for w in (RasterWriter, NetcdfWriter, EnviWriter)})
