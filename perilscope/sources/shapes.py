"""Adapters for landed polygons, roads and sensor lists.

Geometry comes as WKB (binary) or GeoJSON (text) and is turned into the arrays that the joins use:
a polygon is parts of rings of ``struct<lon, lat>``, a road is a list of ``struct<lon, lat>``.
GeoJSON is parsed by Spark; WKB, which Spark has no function for, in one Arrow batch function.
"""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType

from ..session import spread
from .geodesic import plain_polygons, plain_roads

PARTS = "array<array<array<struct<lon:double,lat:double>>>>"
LINES = "array<array<struct<lon:double,lat:double>>>"

# fixed values: geometry codes of well-known binary
_LINE, _POLYGON, _MANY_LINES, _MANY_POLYGONS = 2, 3, 5, 6


def _wkb(data: bytes, at: int = 0):
    """(code, points of a line | rings of a polygon | list of members, position behind it)."""
    order = "<" if data[at] == 1 else ">"
    code, = struct.unpack_from(order + "I", data, at + 1)
    at += 5
    if code & 0x20000000:                                   # a reference system follows
        at += 4
    width = 2 + bool(code & 0x80000000) + bool(code & 0x40000000) + (1, 1, 2, 0)[(code & 0xFFFF) // 1000 - 1] * ((code & 0xFFFF) >= 1000)
    code = (code & 0xFFFF) % 1000

    def count():
        nonlocal at
        n, = struct.unpack_from(order + "I", data, at)
        at += 4
        return n

    def points():
        nonlocal at
        n = count()
        xs = struct.unpack_from(f"{order}{n * width}d", data, at)
        at += 8 * n * width
        return [{"lon": xs[i], "lat": xs[i + 1]} for i in range(0, n * width, width)]

    if code == _LINE:
        return code, points(), at
    if code == _POLYGON:
        return code, [points() for _ in range(count())], at
    if code in (_MANY_LINES, _MANY_POLYGONS):
        members = []
        for _ in range(count()):
            _, one, at = _wkb(data, at)
            members.append(one)
        return code, members, at
    raise ValueError(f"geometry code {code} is neither a line nor a polygon")


def _decode(values: pd.Series, single: int, many: int) -> pd.Series:
    out = []
    for v in values:
        if v is None:
            out.append(None)
            continue
        code, shape, _ = _wkb(bytes(v))
        out.append([shape] if code == single else shape if code == many else None)
    return pd.Series(out, dtype=object)


def _from_wkb(c: Column, ddl: str, single: int, many: int) -> Column:
    @F.pandas_udf(ddl)
    def shapes(values: pd.Series) -> pd.Series:
        return _decode(values, single, many)
    return shapes(c)


def _geojson(c: Column, single: str, many: str, depth: int) -> Column:
    """Coordinates of a ``single`` or ``many`` shape as lists, ``depth`` levels above the points."""
    def parse(levels: int) -> Column:
        t = "array<" * levels + "double" + ">" * levels
        return F.from_json(c, f"type string, coordinates {t}")

    def points(x: Column, levels: int) -> Column:
        if levels == 1:
            return F.transform(x, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))
        return F.transform(x, lambda y: points(y, levels - 1))

    kind = F.get_json_object(c, "$.type")
    one, all_ = parse(depth + 1)["coordinates"], parse(depth + 2)["coordinates"]
    return F.when(kind == single, F.array(points(one, depth))).when(kind == many, points(all_, depth + 1))


def polygon_parts(df: DataFrame, geometry: str = "geometry") -> Column:
    """Parts of a (multi)polygon column; another shape gives NULL."""
    if isinstance(df.schema[geometry].dataType, BinaryType):
        return _from_wkb(F.col(geometry), PARTS, _POLYGON, _MANY_POLYGONS)
    return _geojson(F.col(geometry), "Polygon", "MultiPolygon", 2)


def line_list(df: DataFrame, geometry: str = "geometry") -> Column:
    """Lines of a (multi)line column; another shape gives NULL."""
    if isinstance(df.schema[geometry].dataType, BinaryType):
        return _from_wkb(F.col(geometry), LINES, _LINE, _MANY_LINES)
    return _geojson(F.col(geometry), "LineString", "MultiLineString", 1)


def division_areas(areas: DataFrame, *, subtype: str = "country", geodesic_step: float | None = None) -> DataFrame:
    """Landed division areas -> ``country_id, iso_code, country_name, is_land, version, geom``.

    Input: ``id, names.primary, country, subtype, is_land, version, geometry``.  Only areas of the
    subtype with a geometry; flags and versions that do not cast are NULL.  ``geodesic_step``: edges are
    great circles, given vertices at least every so many degrees, and areas across +-180 or around a
    pole are cut there (``geodesic``); without it edges are straight in longitude and latitude.
    """
    kept = areas.where((F.col("subtype") == subtype) & F.col("geometry").isNotNull())
    out = kept.select(
        F.col("id").alias("country_id"), F.col("country").alias("iso_code"), F.col("names.primary").alias("country_name"),
        F.col("is_land").cast("string").try_cast("boolean").alias("is_land"),
        F.col("version").cast("string").try_cast("bigint").alias("version"),
        polygon_parts(kept).alias("geom")).where(F.col("geom").isNotNull())
    return out if geodesic_step is None else out.withColumn("geom", plain_polygons("geom", geodesic_step))


def road_segments(segments: DataFrame, *, subtype: str | None = None, geodesic_step: float | None = None) -> DataFrame:
    """Landed segments with a geometry (of ``subtype``, if given) -> ``road_id, geom``.

    ``geom`` is the list of a segment's lines; one row per segment.  ``geodesic_step`` as above.
    """
    kept = segments.where(F.col("geometry").isNotNull())
    if subtype is not None:
        kept = kept.where(F.col("subtype") == subtype)
    kept = spread(kept.select("id", "geometry"))       # a file that is read as one split is not parsed by one task
    out = kept.select(F.col("id").alias("road_id"), line_list(kept).alias("geom")).where(F.col("geom").isNotNull())
    return out if geodesic_step is None else out.withColumn("geom", plain_roads("geom", geodesic_step))


def sensor_items(items: DataFrame) -> DataFrame:
    """Sensor locations as the service lists them -> the columns of ``sensors_near_incident``.

    Input (text, from ``read_json_pages``): ``id, name, coordinates, country[, city]``, where
    ``coordinates`` is an object and the labels may be objects too.  A location without an id or a
    place is kept with NULLs; the box join leaves it out.
    """
    place = F.from_json("coordinates", "latitude double, longitude double")
    city = F.col("city") if "city" in items.columns else F.lit(None).cast("string")
    return items.select(
        F.col("id").try_cast("bigint").alias("location_id"), place["latitude"].alias("lat"), place["longitude"].alias("lon"),
        F.col("name").alias("location_name"), F.col("country").alias("country_raw"), city.alias("city_raw"))
