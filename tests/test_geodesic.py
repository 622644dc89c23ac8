"""Shapes on the sphere: across +-180, around poles and with long edges, against the gnomonic projection,
in which great circles are straight."""

import json

import numpy as np

from perilscope.operators import spatial
from perilscope.operators.roads import line_length_in
from perilscope.sources import shapes
from perilscope.sources.geodesic import _xyz

SHAPES = {
    1: [[(176.0, -21.0), (-178.0, -20.5), (-178.5, -15.0), (176.5, -15.5)]],                                # islands across +-180
    2: [[(lon, 70.0 + 6 * (i % 2)) for i, lon in enumerate(range(-170, 180, 40))]],                         # around the north pole
    3: [[(lon, -62.0) for lon in range(180, -180, -30)], [(lon, -75.0) for lon in range(-180, 180, 30)]],   # a ring around the south pole
    4: [[(-60.0, 40.0), (10.0, 45.0), (-25.0, 62.0)]],                                                      # long edges
    5: [[(150.0, 10.0), (-150.0, 12.0), (-155.0, 40.0), (155.0, 42.0)], [(170.0, 20.0), (-170.0, 20.0), (-172.0, 30.0), (172.0, 30.0)]],
}


def landed(rings):
    return json.dumps({"type": "Polygon", "coordinates": [[list(p) for p in [*r, r[0]]] for r in rings]})


def frame_of(rings):
    c = sum(_xyz(*np.array(r).T).sum(0) for r in rings[:1])
    c = c / np.linalg.norm(c)
    u = np.cross(c, [0.3, 0.5, 0.81])
    u /= np.linalg.norm(u)
    return c, u, np.cross(c, u)


def on_sphere(rings, lon, lat):
    """Whether each point is inside, and how near an outline it is; far from the centre none is."""
    c, u, v = frame_of(rings)
    p = _xyz(lon, lat)
    front = p @ c > 0.02
    h = np.where(front, p @ c, 1.0)
    x, y = (p @ u) / h, (p @ v) / h
    odd, near = np.zeros(len(x), "i8"), np.full(len(x), np.inf)
    for r in rings:
        q = _xyz(*np.array([*r, r[0]]).T)
        ax, ay = (q @ u) / (q @ c), (q @ v) / (q @ c)
        for x0, y0, x1, y1 in zip(ax[:-1], ay[:-1], ax[1:], ay[1:]):
            with np.errstate(divide="ignore", invalid="ignore"):
                odd += ((y0 > y) != (y1 > y)) & (x < x0 + (x1 - x0) * (y - y0) / (y1 - y0))
            t = np.clip(((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / ((x1 - x0) ** 2 + (y1 - y0) ** 2), 0, 1)
            near = np.minimum(near, np.hypot(x - x0 - t * (x1 - x0), y - y0 - t * (y1 - y0)))
    return front & (odd % 2 == 1), near


def areas(spark, step):
    rows = [(i, "C%d" % i, "country", "true", "1", landed(r)) for i, r in SHAPES.items()]
    d = spark.createDataFrame(rows, "id long, country string, subtype string, is_land string, version string, geometry string")
    return shapes.division_areas(d.selectExpr("*", "named_struct('primary', country) as names"), geodesic_step=step)


def test_points_on_the_sphere(spark):
    rng = np.random.default_rng(7)
    lat = np.degrees(np.arcsin(rng.uniform(-1, 1, 6000)))
    lon = rng.uniform(-180, 180, 6000)
    lat = np.concatenate([lat, rng.uniform(-25, -10, 500), rng.uniform(80, 90, 300), rng.uniform(-90, -60, 500)])
    lon = np.concatenate([lon, (rng.uniform(172, 186, 500) + 180) % 360 - 180, rng.uniform(-180, 180, 800)])
    P = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))], "event_id long, lat double, lon double")
    polys = areas(spark, 0.1).select("country_id", "geom")
    got = {(r.event_id, r.country_id) for r in spatial.locate(P, polys, how="inner").collect()}
    for k, rings in SHAPES.items():
        inside, near = on_sphere(rings, lon, lat)
        sure = near > 2e-4                                # the bow of a tenth of a degree
        mine = np.array([(i, k) in got for i in range(len(lat))])
        assert (mine == inside)[sure].all() and inside.sum() > 30 and sure.mean() > 0.95, k


def test_lines_across_the_cut(spark):
    """A road over +-180 has its great-circle length, as one row, inside an area that is cut there too."""
    line = [(177.5, -18.0), (-179.5, -17.0), (179.0, -16.5)]
    d = spark.createDataFrame([(1, "road", json.dumps({"type": "LineString", "coordinates": [list(p) for p in line]}))],
                              "id long, subtype string, geometry string")
    roads = shapes.road_segments(d, geodesic_step=0.1)
    assert max(abs(p.lon) for g in roads.first().geom for p in g) <= 180 and len(roads.first().geom) == 3
    got = line_length_in(roads, areas(spark, 0.1).where("country_id = 1").select("country_id", "geom")).collect()
    p = _xyz(*np.array(line).T)
    want = sum(2 * np.arcsin(np.linalg.norm(b - a) / 2) for a, b in zip(p[:-1], p[1:])) * 6371.0088
    assert len(got) == 1 and abs(got[0].length_km - want) < 1e-3


def test_plain_shapes_stay_as_they_are(spark):
    """Short edges within -180..180 keep their vertices; empty and missing shapes are kept."""
    rows = [(1, json.dumps({"type": "LineString", "coordinates": [[1, 1], [1.1, 1.2]]})), (2, None)]
    d = spark.createDataFrame(rows, "id long, geometry string").selectExpr("*", "'road' as subtype")
    r, = shapes.road_segments(d, geodesic_step=0.5).collect()
    assert [[(p.lon, p.lat) for p in g] for g in r.geom] == [[(1.0, 1.0), (1.1, 1.2)]]
