"""Regions: tiles, boxes, polygons, features."""

from __future__ import annotations

import json
import struct
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.functions.geometry import GridSpec, hull, inside
from chronopix.model import ConfigurationError

#: Tiles that a list may have and still be sent to the executors.
BROADCAST_TILES = 1_000_000


def read_features(text: str, feature_ids: Sequence[Any] | None = None) -> list[dict]:
    """GeoJSON features as {feature_id, properties, rings}; the id is property ID, then id, then the feature's own, then its place."""
    data = json.loads(text)
    out = []
    for i, f in enumerate(data["features"] if data.get("type") == "FeatureCollection" else [data]):
        props = f.get("properties") or {}
        own = props.get("ID", props.get("id", f.get("id", i)))
        shape = f["geometry"] if "geometry" in f else f
        polygons = [shape["coordinates"]] if shape["type"] == "Polygon" else shape["coordinates"]
        rings = [[(float(p[0]), float(p[1])) for p in ring] for polygon in polygons for ring in polygon]
        if feature_ids is None or own in feature_ids:
            out.append({"feature_id": own, "properties": props, "rings": rings})
    return out


def read_shapefile(path: str, feature_ids: Sequence[Any] | None = None) -> list[dict]:
    """Polygon features of a shapefile (.shp with its .dbf), as ``read_features`` gives them; the id is the attribute ID, then id, then the record's place."""
    with open(path, "rb") as f:
        shp = f.read()
    with open(path[: -len(".shp")] + ".dbf", "rb") as f:
        dbf = f.read()
    n, start, size = struct.unpack_from("<IHH", dbf, 4)
    fields, at = [], 32
    while dbf[at] != 0x0D:
        name, kind, length = dbf[at : at + 11].split(b"\0")[0].decode(), chr(dbf[at + 11]), dbf[at + 16]
        fields.append((name, kind, length))
        at += 32
    out, at = [], 100
    for i in range(n):
        (words,) = struct.unpack_from(">i", shp, at + 4)
        body, at = at + 8, at + 8 + 2 * words
        record = start + i * size
        if dbf[record : record + 1] == b"*":  # deleted
            continue
        props, place = {}, record + 1
        for name, kind, length in fields:
            text, place = dbf[place : place + length].decode("utf-8", "replace").strip(), place + length
            props[name] = (float(text) if "." in text or "e" in text.lower() else int(text)) if kind in "NF" and text.strip("*") else text or None
        (shape,) = struct.unpack_from("<i", shp, body)
        if shape == 0:
            continue
        if shape not in (5, 15, 25):
            raise ConfigurationError(f"{path} has shapes that are no polygons")
        parts, points = struct.unpack_from("<ii", shp, body + 36)
        ends = [*struct.unpack_from(f"<{parts}i", shp, body + 44), points]
        xy = struct.unpack_from(f"<{2 * points}d", shp, body + 44 + 4 * parts)
        rings = [[(xy[2 * k], xy[2 * k + 1]) for k in range(a, b)] for a, b in zip(ends, ends[1:], strict=False)]
        own = props.get("ID", props.get("id"))
        own = i if own is None else own
        if feature_ids is None or own in feature_ids:
            out.append({"feature_id": own, "properties": props, "rings": rings})
    return out


def read_file(path: str, feature_ids: Sequence[Any] | None = None) -> list[dict]:
    """The features of a shapefile or a GeoJSON file."""
    if path.lower().endswith(".shp"):
        return read_shapefile(path, feature_ids)
    with open(path, encoding="utf-8") as f:
        return read_features(f.read(), feature_ids)


def boundary(features: Sequence[Mapping[str, Any]]) -> list[tuple[float, float]]:
    """The convex hull of all features."""
    return hull(p for f in features for ring in f["rings"] for p in ring)


def read_tiles(pair: Sequence[int] | None = None, path: str | None = None) -> list[tuple[int, int]] | None:
    """Tiles from a pair or from a file of 'X Y' lines, not both; an empty file gives none."""
    if pair and path:
        raise ConfigurationError("give one tile or a file of tiles, not both")
    if pair:
        return [(int(pair[0]), int(pair[1]))]
    if path:
        with open(path, encoding="utf-8") as f:
            return [tuple(map(int, line.split()[:2])) for line in f if line.strip()] or None
    return None


def in_tiles(df: DataFrame, tiles: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of the tiles: a predicate for a few, which reaches the scan; a semi-join for more, broadcast while the list is short."""
    tiles = sorted(set(map(tuple, tiles)))
    if len(tiles) <= 100:
        hit = F.lit(False)
        for x, y in tiles:
            hit = hit | ((F.col("tile_x") == x) & (F.col("tile_y") == y))
        return df.where(hit)
    t = df.sparkSession.createDataFrame(tiles, "tile_x int, tile_y int")
    return df.join(F.broadcast(t) if len(tiles) <= BROADCAST_TILES else t, ["tile_x", "tile_y"], "left_semi")


def _file(region: Mapping[str, Any]) -> list[dict]:
    features = read_file(region["from_file"], region.get("feature_id"))
    if not features:
        raise ConfigurationError("no such features")
    return features


def features_of(region: Mapping[str, Any] | None) -> list[dict]:
    """The features whose pixels are wanted, each with results of its own; none where whole tiles or a box are.

    They come from a file if feature_id is given or gridded is false, or from a geometry if gridded is false.
    """
    region = region or {}
    if "geometry" in region:
        return read_features(json.dumps(region["geometry"])) if region.get("gridded") is False else []
    if "tile" in region or "tiles" in region or "from_file" not in region:
        return []
    return _file(region) if "feature_id" in region or region.get("gridded") is False else []


def in_features(df: DataFrame, features: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Rows with the feature_id of each feature that holds their pixel's centre, once for each."""
    ids = [f["feature_id"] for f in features]
    kind = "bigint" if all(isinstance(i, int) for i in ids) else "string"
    every = [F.when(inside(F.col("x") + 0.5, F.col("y") + 0.5, f["rings"]), F.lit(i).cast(kind)) for i, f in zip(ids, features, strict=True)]
    return df.withColumn("feature_id", F.explode(F.array_compact(F.array(*every))))


def limit(df: DataFrame, region: Mapping[str, Any] | None, grid: GridSpec | None = None) -> DataFrame:
    """input_region: tile; tiles; geometry, which is the whole tiles it touches, of the listed ones if tiles are given too; from_file, which is
    the whole tiles that its features' convex hull touches, or the features' pixels; ranges of x and y (or longitude and latitude). None is everywhere.

    Coordinates are those of pixel centres (x + 1/2, y + 1/2). Whole tiles need the grid, which a configuration's storage.tile_size gives.
    """
    if not region:
        return df
    tiles = [tuple(t) for t in region.get("tiles") or ([region["tile"]] if "tile" in region and "geometry" not in region else [])]
    if features := features_of(region):
        boxed = [p for f in features for r in f["rings"] for p in r]
        low, high = [min(p[i] for p in boxed) for i in (0, 1)], [max(p[i] for p in boxed) for i in (0, 1)]
        df = df.where(F.col("x").between(int(low[0]) - 1, int(high[0]) + 1) & F.col("y").between(int(low[1]) - 1, int(high[1]) + 1))
        hit = F.lit(False)
        for f in features:
            hit = hit | inside(F.col("x") + 0.5, F.col("y") + 0.5, f["rings"])
        return df.where(hit)
    if "geometry" in region or "from_file" in region and not tiles:
        rings = read_features(json.dumps(region["geometry"]))[0]["rings"] if "geometry" in region else [boundary(_file(region))]
        if grid is None:
            raise ConfigurationError("a region of whole tiles needs storage.tile_size")
        cells = grid.touching(rings)
        return in_tiles(df, [c for c in cells if c in tiles] if tiles else cells)
    if tiles:
        return in_tiles(df, tiles)
    x, y = region.get("x", region.get("longitude")), region.get("y", region.get("latitude"))
    if x is None or y is None:
        raise ConfigurationError(f"unknown input_region {sorted(region)}")
    return df.where((F.col("x") + 0.5).between(min(x), max(x)) & (F.col("y") + 0.5).between(min(y), max(y)))
