"""Pairs are made from lists that meet, not joined one by one; numbers are rounded without decimals."""

import random
import re

from perilscope.functions.clean import rounded
from perilscope.functions.geo import haversine_km
from perilscope.operators import air, news, spatial
from pyspark.sql import functions as F

SITE = "location_id long, lat double, lon double, location_name string, country_raw string"


def first_plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_sites_of_a_cell_meet_boxes_as_packs(spark):
    r = random.Random(3)
    pts = [(i, r.uniform(-89.9, 89.9), r.choice([r.uniform(-180, 180), 179.8, -179.9])) for i in range(60)] + [(90, 89.995, 3.0), (91, 10.0, 10.0), (None, 10.1, 10.2)]
    sites = [(j, r.uniform(-90, 90), r.uniform(-180, 180)) for j in range(400)] + [
        (1000 + j, la + r.uniform(-1, 1), lo + r.uniform(-1.5, 1.5)) for j, (_, la, lo) in enumerate(pts * 3) if abs(la) < 88 and abs(lo) < 178]
    sites += [(5000 + j, 10.0 + 1e-4 * (j % 7), 10.0) for j in range(3000)] + [(5000, 10.0, 10.0), (None, 10.0, 10.0), (9000, None, 1.0), (9001, -180.0, 180.0)]
    P = spark.createDataFrame(pts, "event_id long, lat double, lon double")
    S = spark.createDataFrame(sites, "location_id long, lat double, lon double")
    plain, many = (spatial.in_box(P, S, many=m) for m in (False, True))
    assert plain.columns == many.columns and sorted(map(str, plain.collect())) == sorted(map(str, many.collect()))
    by_bin = S.withColumnsRenamed({"lat": "site_lat", "lon": "site_lon"}).withColumns(
        {"_ty": F.floor("site_lat"), "_tx": F.floor("site_lon")})
    packs = spatial._packs(by_bin, ["location_id", "site_lat", "site_lon"], 1.0)
    here = packs.where("_ty = 10 and _tx = 10 and _lat0 < 10.001 and _lon0 < 10.001").select(F.sum(F.size("_pack")), F.count(F.lit(1))).first()
    assert here[0] >= 3002 and here[1] <= 4 * spatial.PACK_PARTS


def test_sensor_pairs_are_written_from_packs(spark):
    sites = spark.createDataFrame([(j, 10.0 + j % 50 / 40, 10.0 + j % 30 / 20, f"n{j}", "x") for j in range(600)] + [(5, 10.5, 10.5, "z", None)], SITE)
    inc = spark.createDataFrame([(i, "storm", 10.0 + i % 9 / 8, 10.0 + i % 7 / 6) for i in range(40)] + [(3, "storm", 10.2, 10.9)],
                                "event_id long, hazard_type string, lat double, lon double")
    one = air.sensors_near_incident(inc, sites, distances=True)
    assert "inline(_pack" in first_plan(one)
    rows = one.withColumn("want", haversine_km("incident_lat", "incident_lon", "latitude", "longitude")).collect()
    assert len(rows) == one.select("event_id", "location_id").distinct().count() > 1000 and all(r["dist_km"] == r["want"] for r in rows)


def test_rounded_equals_round(spark):
    r = random.Random(1)
    x = [r.uniform(-1, 1) * 10 ** r.randrange(-9, 14) for _ in range(4000)] + [k / 1e6 + 5e-7 for k in range(-1000, 1000)] + [
        round(r.uniform(0, 3e4), r.randrange(9)) for _ in range(3000)] + [0.0, -0.0, -1e-9, 4.9999995e-1, 2.5e-6, 1e300, float("nan"), float("inf"), -float("inf"), None]
    d = spark.createDataFrame([(v,) for v in x], "v double")
    for digits in (6, 2):
        for a, b in d.select(rounded("v", digits), F.round("v", digits)).collect():
            assert str(a) == str(b)


def test_news_pairs_are_not_shuffled(spark):
    """All incidents and news near each other, each at its own place: what is shuffled are rows of both sides."""
    import datetime as dt
    inc = spark.createDataFrame([(i % 50 or None, 10.0 + i / 1000, 10.0, dt.datetime(2024, 1, 5), None) for i in range(60)],
                                "event_id long, lat double, lon double, start_time timestamp_ntz, end_time timestamp_ntz")
    staged = spark.createDataFrame([(k if k % 9 else None, dt.datetime(2024, 1, 5), 10.0, 10.0 + k / 1000, k / 7) for k in range(80)],
                                   "news_id long, event_time timestamp_ntz, lat double, lon double, tone double")
    got = news.news_pairs(inc, staged, digits=6)
    # pairs come from the lists behind the only join, with no exchange above it
    assert first_plan(got).count("SortMergeJoin") == 1 and not re.search(r"Exchange[^\n]*\n(?:.*\n)*?.*Join", first_plan(got).split("Subqueries")[0])
    rows = got.collect()
    assert len(rows) == 60 * 80 and {len({r[c] for r in rows}) for c in ("lat", "r_lon")} == {60, 80}
    want = got.withColumn("far", F.round(haversine_km("lat", "lon", "r_lat", "r_lon"), 6)).where("far <=> dist_km")
    assert want.count() == 60 * 80 and sorted({r["tone"] for r in rows}) == sorted({round(k / 7, 6) for k in range(80)})
