"""Geometry kernels and spatial joins against brute force (micro-fixtures + hypothesis)."""

import math

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from perilscope.functions.geo import bbox_from_point, box_polygon, haversine_km, point_in_polygon
from perilscope.operators import spatial
from perilscope.operators.roads import clip_length_km, line_length_in

POLY = "array<array<array<struct<lon:double,lat:double>>>>"


def ring(*pts):
    pts = list(pts) + [pts[0]]
    return [{"lon": float(x), "lat": float(y)} for x, y in pts]


def contains(spark, geom, pts):
    df = spark.createDataFrame([(float(x), float(y), geom) for x, y in pts], f"lon double, lat double, g {POLY}")
    out = df.select(point_in_polygon("lon", "lat", "g").alias("w")).collect()
    return [r.w for r in out]


def test_point_in_polygon_edges_holes_multipart(spark):
    square = [ring((0, 0), (10, 0), (10, 10), (0, 10))]
    hole = [ring((0, 0), (10, 0), (10, 10), (0, 10)), ring((4, 4), (6, 4), (6, 6), (4, 6))]
    multi = [[ring((0, 0), (1, 0), (1, 1), (0, 1))], [ring((5, 5), (6, 5), (6, 6), (5, 6))]]
    assert contains(spark, [square], [(5, 5), (10, 5), (0, 0), (5, 0), (11, 5)]) == \
        [True, False, False, False, False]
    assert contains(spark, [hole], [(5, 5), (2, 2), (4, 5)]) == [False, True, False]
    assert contains(spark, multi, [(0.5, 0.5), (5.5, 5.5), (3, 3)]) == [True, True, False]
    # non-convex ring (a U shape)
    u = [[ring((0, 0), (3, 0), (3, 3), (2, 3), (2, 1), (1, 1), (1, 3), (0, 3))]]
    assert contains(spark, u, [(0.5, 2), (1.5, 2), (2.5, 2), (1.5, 0.5)]) == [True, False, True, True]


def test_haversine_and_bbox(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (89.9, 0.0, 89.9, 180.0)], "a double, b double, c double, d double")
    d = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert abs(d[0] - 6371.0088 * math.pi / 180) < 1e-9
    assert abs(d[1] - 2 * 0.1 * 6371.0088 * math.pi / 180) < 1e-6
    df = spark.createDataFrame([(10.0, 179.5), (89.9999, 0.0)], "lat double, lon double")
    b = df.select(bbox_from_point("lat", "lon", 100.0).alias("b")).collect()
    assert b[0].b.min_lon < 180 and b[0].b.max_lon < b[0].b.min_lon  # wrapped over the antimeridian
    assert b[1].b.max_lat == 90.0


def brute_pairs(inc, news, radius):
    out = set()
    R = 6371.0088
    for e, la, lo, t0, t1 in inc:
        for n, nla, nlo, t in news:
            p1, p2 = math.radians(la), math.radians(nla)
            a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(nlo - lo) / 2) ** 2
            dist = 2 * R * math.asin(math.sqrt(min(1.0, a)))
            if dist <= radius and t0 - 24 <= t <= t1 + 24:
                out.add((e, n))
    return out


@settings(max_examples=8, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.floats(-89.5, 89.5), st.floats(-180, 180), st.integers(0, 200), st.integers(0, 1200)),
                min_size=1, max_size=12),
       st.lists(st.tuples(st.floats(-90, 90), st.floats(-180, 180), st.integers(0, 80)), min_size=1, max_size=25))
def test_band_join_equals_brute_force(spark, incs, news):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    inc_rows = [(i, la, lo, base + dt.timedelta(hours=h), base + dt.timedelta(hours=h + dur))
                for i, (la, lo, h, dur) in enumerate(incs)]
    # news on day boundaries near each incident, plus the random ones
    news_rows = [(j, la, lo, base + dt.timedelta(days=day)) for j, (la, lo, day) in enumerate(news)]
    news_rows += [(1000 + i, la + 0.5, lo, base + dt.timedelta(hours=h)) for i, (_, la, lo, h, _) in
                  enumerate([(0, *x[1:3], x[3].hour + (x[3] - base).days * 24, 0) for x in inc_rows])
                  if -90 <= la + 0.5 <= 90]
    L = spark.createDataFrame(inc_rows, "event_id long, lat double, lon double, start_time timestamp_ntz, end_time timestamp_ntz")
    Rn = spark.createDataFrame(news_rows, "news_id long, lat double, lon double, event_time timestamp_ntz")
    got = {(r.event_id, r.news_id) for r in spatial.near_in_time(L, Rn, radius_km=300.0).collect()}
    hours = lambda t: (t - base).total_seconds() / 3600.0
    want = brute_pairs([(e, la, lo, hours(a), hours(b)) for e, la, lo, a, b in inc_rows],
                       [(n, la, lo, hours(t)) for n, la, lo, t in news_rows], 300.0)
    assert got == want


def test_band_join_poles_antimeridian_and_long_windows(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 10)
    inc = spark.createDataFrame([
        (1, 89.8, 0.0, t, t),                       # circle over the pole
        (2, 10.0, 179.9, t, t),                     # across +-180
        (3, 40.0, 10.0, t, t + dt.timedelta(days=90)),  # window longer than a month
        (4, None, None, t, t),                      # no point: never matches
    ], "event_id long, lat double, lon double, start_time timestamp_ntz, end_time timestamp_ntz")
    news = spark.createDataFrame([
        (10, 89.8, 180.0, t), (20, 10.0, -179.9, t), (30, 40.0, 10.5, t + dt.timedelta(days=60)),
        (31, 40.0, 10.5, t + dt.timedelta(days=95)), (40, 10.0, 170.0, t),
    ], "news_id long, lat double, lon double, event_time timestamp_ntz")
    got = {(r.event_id, r.news_id) for r in spatial.near_in_time(inc, news).collect()}
    assert got == {(1, 10), (2, 20), (3, 30)}
    # every window cut by month gives the same pairs
    by_month = {(r.event_id, r.news_id) for r in spatial.near_in_time(inc, news, max_window_days=0).collect()}
    assert by_month == got
    # the reference's fixed bins miss the pole and antimeridian pairs
    got_bins = {(r.event_id, r.news_id) for r in spatial.near_in_time(inc, news, mode="bins").collect()}
    assert got_bins == {(3, 30)}


@settings(max_examples=10, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.floats(-60, 60), st.floats(-60, 60), st.floats(0.5, 30), st.floats(0.5, 30)),
                min_size=1, max_size=6),
       st.lists(st.tuples(st.floats(-70, 70), st.floats(-70, 70)), min_size=1, max_size=30))
def test_locate_equals_brute_force(spark, boxes, pts):
    polys = spark.createDataFrame([(i, x, y, x + w, y + h) for i, (x, y, w, h) in enumerate(boxes)],
                                  "country_id long, a double, b double, c double, d double") \
        .select("country_id", box_polygon("a", "b", "c", "d").alias("geom"))
    P = spark.createDataFrame([(j, la, lo) for j, (lo, la) in enumerate(pts)], "event_id long, lat double, lon double")
    got = {(r.event_id, r.country_id) for r in spatial.locate(P, polys, tile_deg=2.0).collect()}
    fine = {(r.event_id, r.country_id) for r in spatial.locate(P, polys, tile_deg=0.7).collect()}
    assert got == fine
    want = set()
    for j, (lo, la) in enumerate(pts):
        hit = [i for i, (x, y, w, h) in enumerate(boxes) if x < lo < x + w and y < la < y + h]
        want |= {(j, i) for i in hit} if hit else {(j, None)}
    assert got == want


def test_clip_length_partition_sums_to_line():
    # a diagonal line across two adjacent boxes: the pieces add up to the whole line
    lx, ly = [1.0, 9.0], [1.0, 5.0]
    left = [(0, 0, 0, 5, 0), (0, 5, 0, 5, 10), (0, 5, 10, 0, 10), (0, 0, 10, 0, 0)]
    right = [(0, 5, 0, 10, 0), (0, 10, 0, 10, 10), (0, 10, 10, 5, 10), (0, 5, 10, 5, 0)]
    def k(edges):
        e = np.array(edges, float)
        return clip_length_km(lx, ly, e[:, 0], e[:, 1], e[:, 2], e[:, 3], e[:, 4])
    (a, ha), (b, hb) = k(left), k(right)
    whole = clip_length_km(lx, ly, *np.array([(0, 0, 0, 10, 0), (0, 10, 0, 10, 10), (0, 10, 10, 0, 10),
                                                   (0, 0, 10, 0, 0)], float).T)[0]
    assert ha and hb and a > 0 and b > 0
    # pieces are split at planar lon/lat points and measured as great-circle arcs,
    # so the sum exceeds the single arc by the planar/geodesic gap (~1e-6 here)
    assert abs((a + b) - whole) < 1e-5 * whole
    outside = clip_length_km([20.0, 30.0], [20.0, 30.0], *np.array(left, float).T)
    assert outside == (0.0, False)


def test_road_join_meridian_closed_form(spark):
    from perilscope import fixtures as fx
    d = "/root/testdata/sf0.001"
    c = fx.countries_fx(spark, d)
    pairs = line_length_in(fx.roads_fx(spark, d), c).collect()
    R = 6371.0088
    boxes = {r.country_id: r for r in c.collect()}
    roads = {r.road_id: r for r in fx.roads_fx(spark, d).collect()}
    want = {}
    for rid, r in roads.items():
        for cid, b in boxes.items():
            if b.min_lon < r.lon < b.max_lon and r.lat_b > b.min_lat and r.lat_a < b.max_lat:
                want[(rid, cid)] = (min(r.lat_b, b.max_lat) - max(r.lat_a, b.min_lat)) * R * math.pi / 180
    got = {(p.road_id, p.country_id): p.length_km for p in pairs}
    assert set(got) == set(want) and len(got) == 287
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)


def plain_contains(polygon, x, y):
    """Even-odd per part; a point on the outline is outside."""
    def odd(part):
        return sum((a["lat"] > y) != (b["lat"] > y) and x < a["lon"] + (b["lon"] - a["lon"]) * (y - a["lat"]) / (b["lat"] - a["lat"])
                   for rg in part for a, b in zip(rg[:-1], rg[1:])) % 2 == 1
    return any(odd(part) for part in polygon)


def slanted(rng, n=14):
    """Star-shaped outlines with a hole, a second part, and vertices on tile corners."""
    out = []
    for i in range(n):
        cx, cy = rng.uniform(-20, 20, 2)
        ang = np.sort(rng.uniform(0, 2 * np.pi, int(rng.integers(3, 12))))
        rad = rng.uniform(0.3, 6, len(ang))
        outer = [(float(cx + r * np.cos(a)), float(cy + r * np.sin(a))) for a, r in zip(ang, rad)]
        if i % 4 == 0:
            outer = [(round(x), round(y)) for x, y in outer]
        hole = [(cx + (x - cx) / 3, cy + (y - cy) / 3) for x, y in outer]
        parts = [[ring(*outer), ring(*hole)]]
        if i % 3 == 0:
            parts.append([ring((cx + 7, cy), (cx + 8.3, cy + 0.4), (cx + 7.2, cy + 2.1))])
        out.append((i, parts))
    return out


def test_points_in_slanted_holed_polygons(spark):
    rng = np.random.default_rng(5)
    polys = slanted(rng)
    pts = [(j, float(y), float(x)) for j, (x, y) in enumerate(rng.uniform(-30, 30, (1500, 2)))]
    pts += [(2000 + j, float(y), float(x)) for j, (x, y) in enumerate(rng.integers(-20, 20, (200, 2)) + 0.5)]   # tile centres
    P = spark.createDataFrame(pts, "event_id long, lat double, lon double")
    G = spark.createDataFrame(polys, f"country_id long, geom {POLY}")
    want = {(j, i) for j, y, x in pts for i, g in polys if plain_contains(g, x, y)}
    for size in (1.0, 0.3):
        got = {(r.event_id, r.country_id) for r in spatial.locate(P, G, tile_deg=size, how="inner").collect()}
        assert got == want and len(want) > 50


def test_lines_in_slanted_holed_polygons(spark):
    rng = np.random.default_rng(6)
    polys = slanted(rng, 6)
    lines = []
    for i in range(120):
        p = rng.uniform(-22, 22, 2)
        steps = rng.uniform(-0.3, 0.3, (int(rng.integers(1, 9)), 2)) * (12 if i % 4 == 0 else 1)
        walk = np.vstack([p, p + np.cumsum(steps, 0)])
        if i % 5 == 0:
            walk = np.round(walk)                                     # along tile borders, through corners
        lines.append((i, [{"lon": float(x), "lat": float(y)} for x, y in walk]))
    L = spark.createDataFrame(lines, "road_id long, geom array<struct<lon:double,lat:double>>")
    G = spark.createDataFrame(polys, f"country_id long, geom {POLY}")
    got = {(r.road_id, r.country_id): r.length_km for r in line_length_in(L, G).collect()}
    for i, g in lines:
        for k, poly in polys:
            e = np.array([(n, a["lon"], a["lat"], b["lon"], b["lat"]) for n, part in enumerate(poly) for rg in part
                          for a, b in zip(rg[:-1], rg[1:])], float)
            want, hit = clip_length_km([p["lon"] for p in g], [p["lat"] for p in g], *e.T)
            assert abs(got.get((i, k), 0.0) - want) < 1e-6 * max(1.0, want), (i, k)
            assert hit or (i, k) not in got


def test_an_outline_of_100000_vertices(spark):
    """No row of the index holds more than a sliver of it, and answers equal the closed form."""
    from perilscope.operators.outlines import outline_tiles
    a = np.linspace(0, 2 * np.pi, 100_001)[:-1]
    circle = [[ring(*[(float(x), float(y)) for x, y in zip(30 + 9.5 * np.cos(a), 10 + 9.5 * np.sin(a))])]]
    G = spark.createDataFrame([(1, circle)], f"country_id long, geom {POLY}")
    t = outline_tiles(G).selectExpr("cls", "size(edges) as n").collect()
    assert max(r.n for r in t) < 3_000 and sum(r.n for r in t) < 105_000 and sum(r.cls == 0 for r in t) > 150
    rng = np.random.default_rng(2)
    xy = rng.uniform(0, 1, (2000, 2)) * 22 + np.array([19, -1])
    P = spark.createDataFrame([(i, float(y), float(x)) for i, (x, y) in enumerate(xy)], "event_id long, lat double, lon double")
    got = {r.event_id for r in spatial.locate(P, G, how="inner").collect()}
    r = np.hypot(xy[:, 0] - 30, xy[:, 1] - 10)
    assert got == set(np.flatnonzero(r < 9.5 * np.cos(np.pi / 100_000)).tolist()) and 0 < len(got) < 2000
    L = spark.createDataFrame([(1, [{"lon": 30.0, "lat": -5.0}, {"lon": 30.0, "lat": 25.0}])],
                              "road_id long, geom array<struct<lon:double,lat:double>>")
    km, = [r.length_km for r in line_length_in(L, G).collect()]
    assert abs(km - 19 * math.pi / 180 * 6371.0088) < 1e-3


@settings(max_examples=8, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.floats(-89.99, 89.99), st.floats(-180, 180)), min_size=1, max_size=10),
       st.lists(st.tuples(st.floats(-90, 90), st.floats(-180, 180)), min_size=1, max_size=30),
       st.sampled_from([50.0, 100.0, 400.0]))
def test_box_join_equals_brute_force(spark, pts, sites, radius):
    """J11 against the box rule itself: wrap at +-180, all longitudes when dlon >= 180."""
    P = spark.createDataFrame([(i, la, lo) for i, (la, lo) in enumerate(pts)], "event_id long, lat double, lon double")
    sites = sites + [(la + 0.3, lo) for la, lo in pts if la + 0.3 <= 90]
    S = spark.createDataFrame([(j, la, lo) for j, (la, lo) in enumerate(sites)], "location_id long, lat double, lon double")
    got = {(r.event_id, r.location_id) for r in spatial.in_box(P, S, radius_km=radius).collect()}
    want = set()
    for i, (la, lo) in enumerate(pts):
        dlat = radius / 111.0
        dlon = radius / (111.320 * max(math.cos(math.radians(la)), 1e-6))
        lo0, hi0 = lo - dlon, lo + dlon
        lo0 = lo0 + 360 if lo0 < -180 else lo0
        hi0 = hi0 - 360 if hi0 > 180 else hi0
        a0, a1 = max(la - dlat, -90.0), min(la + dlat, 90.0)
        for j, (sla, slo) in enumerate(sites):
            if not (a0 <= sla <= a1):
                continue
            if dlon >= 180 or (lo0 <= hi0 and lo0 <= slo <= hi0) or (lo0 > hi0 and (slo >= lo0 or slo <= hi0)):
                want.add((i, j))
    assert got == want


def test_tile_classes_and_shortcuts_match_kernel(spark):
    """Short lines inside one tile take the interior/exterior shortcuts; the answers
    equal the exact clip for every line (a U-shaped polygon with a notch)."""
    from perilscope.operators.outlines import outline_tiles
    u = [[ring((0, 0), (6, 0), (6, 6), (4, 6), (4, 2), (2, 2), (2, 6), (0, 6))]]
    polys = spark.createDataFrame([(1, u)], f"country_id long, geom {POLY}")
    cls = {(r.ty, r.tx): r.cls for r in outline_tiles(polys).collect()}
    assert cls[(0, 0)] == 2 and cls[(0, 1)] == 2 and cls.get((4, 2)) in (None, 2) and (7, 3) not in cls
    rng = np.random.default_rng(3)
    lines = []
    for i in range(150):
        x, y = rng.uniform(-1, 7, 2)
        dx, dy = rng.uniform(-0.4, 0.4, 2) if i % 3 else rng.uniform(-3, 3, 2)
        lines.append((i, [{"lon": float(x), "lat": float(y)}, {"lon": float(x + dx), "lat": float(y + dy)}]))
    L = spark.createDataFrame(lines, "road_id long, geom array<struct<lon:double,lat:double>>")
    got = {r.road_id: r.length_km for r in line_length_in(L, polys).collect()}
    edges = []
    for part_i, part in enumerate(u):
        for rg in part:
            for a, b in zip(rg[:-1], rg[1:]):
                edges.append((part_i, a["lon"], a["lat"], b["lon"], b["lat"]))
    e = np.array(edges, float)
    want = {}
    for rid, g in lines:
        length, hit = clip_length_km([p["lon"] for p in g], [p["lat"] for p in g], *e.T)
        if hit:
            want[rid] = length
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 * max(1.0, want[k]) for k in want)


def test_day_blocks_cover_each_day_once(spark):
    """Days of any span, long ones in few blocks; also before 1970."""
    import datetime as dt
    rng = np.random.default_rng(4)
    spans = [(int(a), int(a + n)) for a in rng.integers(-3000, 20000, 60) for n in (0, 1, 30, 31, int(rng.integers(0, 9000)))]
    day = lambda n: dt.date(1970, 1, 1) + dt.timedelta(days=n)
    d = spark.createDataFrame([(i, day(a), day(b)) for i, (a, b) in enumerate(spans)], "i int, a date, b date")
    for r in d.select("i", spatial.day_blocks(F.col("a"), F.col("b"), 31).alias("x")).collect():
        a, b = spans[r.i]
        days = sorted(k for x in r.x for k in range((x >> 3) * 8 ** (x & 7), ((x >> 3) + 1) * 8 ** (x & 7)))
        assert days == list(range(a, b + 1)) and (len(r.x) <= 31 or len(r.x) < 80)


def test_band_join_shuffles_the_points_once(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 10)
    inc = spark.createDataFrame([(i, 10.0, 10.0 + i, t, t + dt.timedelta(days=200 * i)) for i in range(3)],
                                "event_id long, lat double, lon double, start_time timestamp_ntz, end_time timestamp_ntz")
    pts = spark.createDataFrame([(j, 10.1, 10.0 + j % 3, t + dt.timedelta(days=j)) for j in range(500)],
                                "news_id long, lat double, lon double, event_time timestamp_ntz")
    for window in (None, ("2024-01-01 00:00:00", "2024-02-20 23:59:59")):
        near = [(j, la, lo, at) for j, la, lo, at in ((r.news_id, r.lat, r.lon, r.event_time) for r in pts.collect())
                if window is None or at <= dt.datetime(2024, 2, 20)]
        here = pts if window is None else pts.where("event_time <= timestamp_ntz'2024-02-20 00:00:00'")
        out = spatial.near_in_time(inc, here, right_window=window)
        text = out._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning(_tile_lat") == 2      # one of each side
        want = brute_pairs([(i, 10.0, 10.0 + i, 0.0, 200.0 * i * 24) for i in range(3)],
                           [(j, la, lo, (at - t).total_seconds() / 3600) for j, la, lo, at in near], 100.0)
        assert {(r.event_id, r.news_id) for r in out.collect()} == want
