"""Geometry kernels as native column expressions.

Points are two double columns (``lat``, ``lon``).  A polygon is
``array<array<array<struct<lon:double,lat:double>>>>``: parts (multipolygon) ->
rings (outer ring first, then holes) -> closed vertex lists.  Lines are
``array<struct<lon:double,lat:double>>``.  Containment is planar in lon/lat with
the even-odd rule; points on an edge are *not* within (boundary excluded).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# fixed values: mean Earth radius (km) used for every distance; the reference
# names none, so this is our choice and the oracles use the same.
EARTH_RADIUS_KM = 6371.0088
KM_PER_DEG_LAT_BBOX = 111.0      # bbox_from_point: km per degree of latitude
KM_PER_DEG_LON_BBOX = 111.320    # bbox_from_point: km per degree of longitude at the equator

POLYGON_TYPE = "array<array<array<struct<lon:double,lat:double>>>>"
LINE_TYPE = "array<struct<lon:double,lat:double>>"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km."""
    return arc_km(on_sphere(lat1, lon1), on_sphere(lat2, lon2), radius_km)


def on_sphere(lat, lon) -> tuple[Column, Column, Column]:
    """What ``arc_km`` needs of a point: latitude and its cosine, longitude, in radians."""
    phi = F.radians(_c(lat))
    return phi, F.cos(phi), F.radians(_c(lon))


def arc_km(a, b, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """``haversine_km`` of two points ``on_sphere``: these can be made once per point, before points meet."""
    (p1, c1, l1), (p2, c2, l2) = (map(_c, x) for x in (a, b))
    h = F.pow(F.sin((p2 - p1) / 2), 2) + c1 * c2 * F.pow(F.sin((l2 - l1) / 2), 2)
    return F.lit(2.0 * radius_km) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def within_distance(lat1, lon1, lat2, lon2, radius_km: float) -> Column:
    """ST_DWITHIN on the sphere, inclusive."""
    return haversine_km(lat1, lon1, lat2, lon2) <= F.lit(float(radius_km))


def bbox_from_point(lat, lon, radius_km: float = 100.0) -> Column:
    """Box around a centre: struct(min_lon, min_lat, max_lon, max_lat).

    dlat = r/111, dlon = r/(111.32*max(cos(lat), 1e-6)); latitude clamped to
    [-90, 90]; a longitude beyond +-180 is wrapped once by 360 (so a box over the
    antimeridian has min_lon > max_lon).
    """
    lat, lon = _c(lat), _c(lon)
    r = F.lit(float(radius_km))
    dlat = r / F.lit(KM_PER_DEG_LAT_BBOX)
    dlon = r / (F.lit(KM_PER_DEG_LON_BBOX) * F.greatest(F.cos(F.radians(lat)), F.lit(1e-6)))
    min_lon, max_lon = lon - dlon, lon + dlon
    return F.struct(
        F.when(min_lon < -180, min_lon + 360).otherwise(min_lon).alias("min_lon"),
        F.greatest(lat - dlat, F.lit(-90.0)).alias("min_lat"),
        F.when(max_lon > 180, max_lon - 360).otherwise(max_lon).alias("max_lon"),
        F.least(lat + dlat, F.lit(90.0)).alias("max_lat"),
    )


def lat_reach_deg(radius_km: float) -> float:
    """Largest latitude difference of two points within ``radius_km``."""
    return math.degrees(radius_km / EARTH_RADIUS_KM)


def lon_reach_deg(lat, radius_km: float) -> Column:
    """Largest longitude difference to any point within ``radius_km`` of a point at ``lat``.

    Exact bound from the haversine formula using the highest latitude the circle
    reaches; NULL when the circle reaches a pole (every longitude is in reach).
    """
    dlat = lat_reach_deg(radius_km)
    top = F.least(F.abs(_c(lat)) + F.lit(dlat), F.lit(90.0))
    s = F.lit(math.sin(radius_km / EARTH_RADIUS_KM / 2.0)) / F.cos(F.radians(top))
    return F.when(s < 1.0, F.degrees(F.lit(2.0) * F.asin(s)))


def box_polygon(min_lon, min_lat, max_lon, max_lat) -> Column:
    """Axis-aligned box as a one-part, one-ring closed polygon."""
    def pt(lo, la):
        return F.struct(_c(lo).cast("double").alias("lon"), _c(la).cast("double").alias("lat"))
    ring = F.array(pt(min_lon, min_lat), pt(max_lon, min_lat), pt(max_lon, max_lat),
                   pt(min_lon, max_lat), pt(min_lon, min_lat))
    return F.array(F.array(ring))


def polygon_bbox(geom) -> Column:
    """struct(min_lon, min_lat, max_lon, max_lat) over every vertex of a polygon."""
    pts = F.flatten(F.flatten(_c(geom)))
    return F.struct(
        F.array_min(F.transform(pts, lambda p: p["lon"])).alias("min_lon"),
        F.array_min(F.transform(pts, lambda p: p["lat"])).alias("min_lat"),
        F.array_max(F.transform(pts, lambda p: p["lon"])).alias("max_lon"),
        F.array_max(F.transform(pts, lambda p: p["lat"])).alias("max_lat"),
    )


def line_bbox(line) -> Column:
    pts = _c(line)
    return F.struct(
        F.array_min(F.transform(pts, lambda p: p["lon"])).alias("min_lon"),
        F.array_min(F.transform(pts, lambda p: p["lat"])).alias("min_lat"),
        F.array_max(F.transform(pts, lambda p: p["lon"])).alias("max_lon"),
        F.array_max(F.transform(pts, lambda p: p["lat"])).alias("max_lat"),
    )


def _edges(ring: Column) -> Column:
    """Consecutive vertex pairs of a closed ring as struct(a, b)."""
    n = F.size(ring)
    return F.zip_with(F.slice(ring, 1, n - 1), F.slice(ring, 2, n - 1),
                      lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def point_in_polygon(lon, lat, geom) -> Column:
    """ST_WITHIN(point, polygon): even-odd ray cast per part; an edge point is outside.

    Evaluated with higher-order functions, so it runs in the JVM next to the join.
    NULL point or polygon -> NULL (a left join then keeps the row unmatched).
    """
    x, y = _c(lon), _c(lat)

    def crosses(e):
        a, b = e["a"], e["b"]
        straddles = (a["lat"] > y) != (b["lat"] > y)
        x_at = a["lon"] + (b["lon"] - a["lon"]) * F.try_divide(y - a["lat"], b["lat"] - a["lat"])
        return straddles & (x < x_at)

    def on_edge(e):
        a, b = e["a"], e["b"]
        cross = (b["lon"] - a["lon"]) * (y - a["lat"]) - (b["lat"] - a["lat"]) * (x - a["lon"])
        return ((cross == 0)
                & x.between(F.least(a["lon"], b["lon"]), F.greatest(a["lon"], b["lon"]))
                & y.between(F.least(a["lat"], b["lat"]), F.greatest(a["lat"], b["lat"])))

    def part_inside(part):
        n_cross = F.aggregate(part, F.lit(0),
                              lambda acc, ring: acc + F.size(F.filter(_edges(ring), crosses)))
        return (n_cross % 2) == 1

    def part_touch(part):
        return F.exists(part, lambda ring: F.exists(_edges(ring), on_edge))

    g = _c(geom)
    return F.when(x.isNotNull() & y.isNotNull() & g.isNotNull(),
                  F.exists(g, part_inside) & ~F.exists(g, part_touch))
