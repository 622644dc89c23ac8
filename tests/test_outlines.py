"""Roads of several lines, dense tiles cut to quarters, and points on awkward places, against plain kernels."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from perilscope.operators import spatial
from perilscope.operators.outlines import EDGE_LIMIT, fine_tiles
from perilscope.operators.roads import clip_length_km, length_by, line_length_in
from perilscope.sources import shapes
from tests.test_geometry import POLY, plain_contains, ring, slanted

LINE = "array<struct<lon:double,lat:double>>"
KM = math.pi / 180 * 6371.0088


def line(*pts):
    return [{"lon": float(x), "lat": float(y)} for x, y in pts]


def edges_of(polygon):
    return np.array([(n, a["lon"], a["lat"], b["lon"], b["lat"]) for n, part in enumerate(polygon) for rg in part
                     for a, b in zip(rg[:-1], rg[1:])], float).T


def km_of(lines, polygon):
    """(length, whether they meet) of a road of several lines by the plain kernel."""
    each = [clip_length_km([p["lon"] for p in g], [p["lat"] for p in g], *edges_of(polygon)) for g in lines]
    return sum(k for k, _ in each), any(h for _, h in each)


def test_two_lines_of_one_road_add_up(spark):
    """A degree and four degrees of meridian inside a box, listed as rows or as one multi-line: one row each."""
    G = spark.createDataFrame([(1, [[ring((0, 0), (10, 0), (10, 10), (0, 10))]])], f"country_id long, geom {POLY}")
    a, b = line((2.5, 1), (2.5, 2)), line((7.5, 3), (7.5, 7))
    rows = spark.createDataFrame([(1, a), (1, b), (1, b), (2, line((3.2, 3.2), (3.2, 3.3))), (2, line((3.2, 4.2), (3.2, 4.3)))],
                                 f"road_id long, geom {LINE}")
    lists = spark.createDataFrame([(1, [a, b]), (2, [line((3.2, 3.2), (3.2, 3.3)), line((3.2, 4.2), (3.2, 4.3))])],
                                  f"road_id long, geom array<{LINE}>")
    for L in (rows, lists):
        pairs = line_length_in(L, G)
        got = {(r.road_id, r.country_id): r.length_km for r in pairs.collect()}
        assert pairs.count() == 2 and abs(got[1, 1] - 5 * KM) < 1e-6 and abs(got[2, 1] - 0.2 * KM) < 1e-6
    total, = length_by(pairs, G.withColumn("iso_code", F.lit("X"))).collect()
    assert abs(total.road_km - 5.2 * KM) < 1e-6


def test_multi_lines_against_the_kernel(spark):
    rng = np.random.default_rng(16)
    polys = slanted(rng, 6)
    roads = []
    for i in range(60):
        lines = []
        for _ in range(int(rng.integers(1, 5))):
            p = rng.uniform(-22, 22, 2)
            walk = np.vstack([p, p + np.cumsum(rng.uniform(-0.3, 0.3, (int(rng.integers(1, 6)), 2)) * (12 if i % 4 == 0 else 1), 0)])
            lines.append(line(*np.round(walk) if i % 5 == 0 else walk))
        roads.append((i, lines))
    L = spark.createDataFrame(roads, f"road_id long, geom array<{LINE}>")
    pairs = line_length_in(L, spark.createDataFrame(polys, f"country_id long, geom {POLY}")).collect()
    got = {(r.road_id, r.country_id): r.length_km for r in pairs}
    assert len(got) == len(pairs)
    for i, lines in roads:
        for k, polygon in polys:
            want, hit = km_of(lines, polygon)
            assert abs(got.get((i, k), 0.0) - want) < 1e-6 * max(1.0, want) and (hit or (i, k) not in got), (i, k)


def test_roads_without_a_key_and_odd_shapes(spark):
    G = spark.createDataFrame([(1, [[ring((0, 0), (10, 0), (10, 10), (0, 10))]])], f"country_id long, geom {POLY}")
    L = spark.createDataFrame([(None, [line((1, 1), (1, 2))]), (None, [line((2, 1), (2, 3))]), (5, None), (6, []), (7, [line((1, 1))]),
                               (8, [line((1, 1)), line((4, 1), (4, 2))])], f"road_id long, geom array<{LINE}>")
    got = sorted((r.road_id is None, round(r.length_km / KM, 6)) for r in line_length_in(L, G).collect())
    assert got == [(False, 1.0), (True, 1.0), (True, 2.0)]


def test_landed_segments_keep_their_lines_together(spark):
    rows = [(1, "road", '{"type":"MultiLineString","coordinates":[[[1,1],[2,2]],[[3,3],[4,4],[5,5]]]}'),
            (2, "road", '{"type":"LineString","coordinates":[[1,1],[2,2]]}'), (3, "road", '{"type":"Point","coordinates":[1,1]}')]
    d = spark.createDataFrame(rows, "id long, subtype string, geometry string")
    assert {r.road_id: [len(x) for x in r.geom] for r in shapes.road_segments(d, subtype="road").collect()} == {1: [2, 3], 2: [2]}


def islands(n, corners=8, seed=4):
    """Small star shapes in one degree, some of them sharing a corner with a neighbour's box."""
    rng = np.random.default_rng(seed)
    parts = []
    for i in range(n):
        cx, cy = rng.uniform(0.05, 0.95, 2)
        a = np.sort(rng.uniform(0, 2 * np.pi, corners))
        r = rng.uniform(0.002, 0.012, corners)
        parts.append([ring(*zip(cx + r * np.cos(a), cy + r * np.sin(a)))])
    return parts


def test_a_thousand_islands_in_one_tile(spark):
    polygon = islands(1000)
    G = spark.createDataFrame([(1, polygon)], f"country_id long, geom {POLY}")
    rng = np.random.default_rng(9)
    centres = np.array([np.mean([(p["lon"], p["lat"]) for p in part[0][:-1]], 0) for part in polygon[:500]])
    xy = np.vstack([rng.uniform(0, 1, (400, 2)), centres, rng.uniform(-2, 3, (100, 2))])
    P = spark.createDataFrame([(i, float(y), float(x)) for i, (x, y) in enumerate(xy)], "event_id long, lat double, lon double")
    tiles = fine_tiles(G)
    assert tiles.by_tile().keys() == {(0, 0)}
    assert tiles.cells.selectExpr("max(size(edges))").first()[0] <= EDGE_LIMIT
    t = time.time()
    got = {r.event_id for r in spatial.locate(P, G, how="inner").collect()}
    took = time.time() - t
    want = {i for i, (x, y) in enumerate(xy) if plain_contains(polygon, x, y)}
    assert got == want and len(want) > 300
    left = spatial.locate(P, G).collect()
    assert len(left) == 1000 and sum(r.country_id is not None for r in left) == len(want)
    assert took < 30                                     # 68 s for 400 islands when each point visited parts x edges


@pytest.mark.parametrize("limit", [4, 40])
def test_split_cells_against_plain_kernels(spark, limit):
    """Overlapping polygons with holes, several parts and vertices on tile corners, split far down."""
    from perilscope.operators import outlines, roads
    rng = np.random.default_rng(limit)
    polys = slanted(rng, 8) + [(50, islands(40)), (51, [[ring((0, 0), (0.5, 0), (0.5, 0.5), (0, 0.5))], [ring((0.5, 0.5), (1, 0.5), (1, 1), (0.5, 1))]])]
    G = spark.createDataFrame(polys, f"country_id long, geom {POLY}")
    pts = [(j, float(y), float(x)) for j, (x, y) in enumerate(np.vstack([
        rng.uniform(-25, 25, (400, 2)), rng.uniform(-0.2, 1.2, (300, 2)), rng.integers(-160, 160, (200, 2)) / 8 + 1 / 16]))]
    P = spark.createDataFrame(pts, "event_id long, lat double, lon double")
    lines = [(i, [line(*(rng.uniform(-0.3, 1.3, 2) + np.cumsum(rng.uniform(-0.4, 0.4, (4, 2)), 0)))]) for i in range(40)]
    lines += [(100 + i, [line(*rng.uniform(-20, 20, (2, 2)))]) for i in range(20)]
    L = spark.createDataFrame(lines, f"road_id long, geom array<{LINE}>")
    kept = outlines.fine_tiles.__kwdefaults__["limit"]
    outlines.fine_tiles.__kwdefaults__["limit"] = limit
    try:
        assert fine_tiles(G).by_tile()
        got = {(r.event_id, r.country_id) for r in spatial.locate(P, G, how="inner").collect()}
        km = {(r.road_id, r.country_id): r.length_km for r in roads.line_length_in(L, G).collect()}
    finally:
        outlines.fine_tiles.__kwdefaults__["limit"] = kept
    assert got == {(j, i) for j, y, x in pts for i, g in polys if plain_contains(g, x, y)}
    for i, g in lines:
        for k, polygon in polys:
            want, hit = km_of(g, polygon)
            assert abs(km.get((i, k), 0.0) - want) < 1e-6 * max(1.0, want) and (hit or (i, k) not in km), (i, k)


def test_an_edge_through_the_corner_of_a_way(spark):
    """Edges that pass exactly through the point above or below, at the height of the tile's centre."""
    diamond = [[ring((0.5, -0.5), (1.5, 0.5), (0.5, 1.5), (-0.5, 0.5))]]
    G = spark.createDataFrame([(1, diamond)], f"country_id long, geom {POLY}")
    pts = [(x / 8, y / 8) for x in range(-8, 20) for y in range(-8, 20)]
    P = spark.createDataFrame([(i, y, x) for i, (x, y) in enumerate(pts)], "event_id long, lat double, lon double")
    got = {r.event_id for r in spatial.locate(P, G, how="inner").collect()}
    assert got == {i for i, (x, y) in enumerate(pts) if abs(x - 0.5) + abs(y - 0.5) < 1}
