"""Landed shapes on the sphere -> shapes in plain longitude and latitude, once, at load (J6, J7, G-4).

Between two vertices a landed edge is the shorter great circle; the joins take edges as straight in
longitude and latitude and know no way round the back.  So long edges get vertices on their great circle,
shapes that cross +-180 are cut there, and a ring around a pole is closed over the pole.  A place
exactly on the cut is on an outline.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

#: an edge has a vertex at least every so many degrees: its bow stays below about 100 m at 60 degrees
STEP_DEG = 0.5


def _xyz(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    a, b = np.radians(lon), np.radians(lat)
    return np.stack([np.cos(b) * np.cos(a), np.cos(b) * np.sin(a), np.sin(b)], -1)


def on_great_circles(lon: np.ndarray, lat: np.ndarray, step: float = STEP_DEG) -> tuple[np.ndarray, np.ndarray]:
    """The vertices and those between them, longitudes without jumps (they may leave -180..180)."""
    if len(lon) < 2:
        return lon, lat
    p = _xyz(lon, lat)
    chord = np.linalg.norm(p[1:] - p[:-1], axis=1)
    angle = 2 * np.arcsin(np.minimum(chord / 2, 1.0))
    n = np.maximum(np.ceil(np.degrees(angle) / step), 1).astype("i8")
    edge = np.repeat(np.arange(len(n)), n)
    t = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) / n[edge]
    w = angle[edge]
    sine = np.where(w > 0, np.sin(w), 1.0)
    q = (np.where(w > 0, np.sin((1 - t) * w) / sine, 1 - t)[:, None] * p[edge] + np.where(w > 0, np.sin(t * w) / sine, t)[:, None] * p[edge + 1])
    x, y = np.degrees(np.arctan2(q[:, 1], q[:, 0])), np.degrees(np.arctan2(q[:, 2], np.hypot(q[:, 0], q[:, 1])))
    own = t == 0                                           # a vertex keeps its own numbers
    x[own], y[own] = lon[edge[own]], lat[edge[own]]
    return np.unwrap(np.append(x, lon[-1]), period=360.0), np.append(y, lat[-1])


def _half(x: np.ndarray, y: np.ndarray, at: float, sign: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of a closed ring on one side of a meridian (sign 1: east of it)."""
    if not len(x):
        return x, y
    inside = (x - at) * sign >= 0
    x1, y1, in1 = np.roll(x, -1), np.roll(y, -1), np.roll(inside, -1)
    cross = inside != in1
    with np.errstate(divide="ignore", invalid="ignore"):
        yc = y + (y1 - y) * ((at - x) / (x1 - x))
    keep = np.stack([inside, cross], 1).reshape(-1)
    return np.stack([x, np.full(len(x), at)], 1).reshape(-1)[keep], np.stack([y, yc], 1).reshape(-1)[keep]


def plain_ring(lon, lat, step: float = STEP_DEG) -> list[tuple[np.ndarray, np.ndarray]]:
    """A closed ring -> closed rings within -180..180 whose insides, taken together, are its inside."""
    x, y = on_great_circles(np.asarray(lon, "f8"), np.asarray(lat, "f8"), step)
    if abs(x[-1] - x[0]) > 180:                            # once around: over the nearer pole and back
        pole = 90.0 if y.mean() >= 0 else -90.0
        x, y = np.concatenate([x, [x[-1], x[0]]]), np.concatenate([y, [pole, pole]])
    else:
        x, y = x[:-1], y[:-1]
    out = []
    for k in range(int(np.floor((x.min() + 180) / 360)), int(np.ceil((x.max() + 180) / 360))):
        px, py = _half(*_half(x, y, -180.0 + 360 * k, 1), 180.0 + 360 * k, -1)
        if len(px) > 2:
            out.append((np.append(px, px[0]) - 360 * k, np.append(py, py[0])))
    return out


def plain_lines(lon, lat, step: float = STEP_DEG) -> list[tuple[np.ndarray, np.ndarray]]:
    """A line -> lines within -180..180, cut where it crosses."""
    x, y = on_great_circles(np.asarray(lon, "f8"), np.asarray(lat, "f8"), step)
    if len(x) < 2:
        return [(x, y)]
    out, px, py = [], [x[0]], [y[0]]
    for i in range(len(x) - 1):
        a, b = np.floor((x[i] + 180) / 360), np.floor((x[i + 1] + 180) / 360)
        if a != b and x[i] != x[i + 1]:
            at = 360 * max(a, b) - 180
            yc = y[i] + (y[i + 1] - y[i]) * (at - x[i]) / (x[i + 1] - x[i])
            if px[-1] != at or py[-1] != yc:
                px.append(at)
                py.append(yc)
            out.append((np.array(px), np.array(py)))
            px, py = [at], [yc]
        if px[-1] != x[i + 1] or py[-1] != y[i + 1]:
            px.append(x[i + 1])
            py.append(y[i + 1])
    out.append((np.array(px), np.array(py)))
    kept = []
    for u, v in out:
        if len(u) > 1:
            turn = np.floor((u.mean() + 180) / 360)
            kept.append((u - 360 * turn, v))
    return kept


def _points(shape) -> tuple[np.ndarray, np.ndarray]:
    return np.array([p["lon"] for p in shape], "f8"), np.array([p["lat"] for p in shape], "f8")


def _rows(x, y) -> list[dict]:
    return [{"lon": a, "lat": b} for a, b in zip(x.tolist(), y.tolist())]


def plain_polygons(geom: str | Column, step: float = STEP_DEG) -> Column:
    """Parts of rings on the sphere -> parts of rings for the joins.  Rings of a part stay together."""
    @F.pandas_udf("array<array<array<struct<lon:double,lat:double>>>>")
    def plain(shapes: pd.Series) -> pd.Series:
        return pd.Series([None if s is None else [
            [_rows(*r) for ring in part if len(ring) > 3 for r in plain_ring(*_points(ring), step)] for part in s] for s in shapes], dtype=object)
    return plain(geom)


def plain_roads(geom: str | Column, step: float = STEP_DEG) -> Column:
    """Lists of lines on the sphere -> lists of lines for the joins."""
    @F.pandas_udf("array<array<struct<lon:double,lat:double>>>")
    def plain(shapes: pd.Series) -> pd.Series:
        return pd.Series([None if s is None else [
            _rows(*r) for line in s if len(line) > 1 for r in plain_lines(*_points(line), step)] for s in shapes], dtype=object)
    return plain(geom)
