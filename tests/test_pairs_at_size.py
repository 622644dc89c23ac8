"""Joins whose pairs grow faster than their tables: what is shuffled, summed and kept."""

import datetime as dt
from collections import defaultdict

import pytest

from perilscope.operators import air

INC = "event_id string, hazard_type string, lat double, lon double, start_time timestamp_ntz, end_time timestamp_ntz"
SITE = "location_id bigint, lat double, lon double, location_name string, country_raw string"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


@pytest.fixture(scope="module")
def incidents(spark):
    rows = [(f"e{i}", "storm", 10.0 + i % 7 / 10, 5.0 + i % 5 / 10, at(1 + i % 20, i % 24), at(2 + i % 20, i % 24) if i % 3 else None)
            for i in range(40)]
    rows += [("e3", "storm", 10.2, 5.1, at(4, 5), None), ("e3", "storm", 12.0, 5.1, at(4, 7), None), ("e3", "storm", 10.2, 5.1, at(4, 5), None),
             (None, "x", 10.2, 5.1, at(4, 5), None), (None, "y", 10.3, 5.1, at(9, 5), None), ("e50", "x", None, 5.0, at(3), None), ("e51", None, 10.1, 5.2, None, None)]
    return spark.createDataFrame(rows, INC)


@pytest.fixture(scope="module")
def sites(spark):
    rows = [(i, 10.0 + i % 4 / 10, 5.0 + i % 3 / 10, f"n{i}", "plain" if i % 2 else '{"code":"C1"}') for i in range(24)]
    rows += [(3, 10.3, 5.0, "again", None), (5, 11.9, 5.1, "moved", None), (None, 10.1, 5.1, "none", None), (30, None, 5.0, "nowhere", None)]
    return spark.createDataFrame(rows, SITE)


def box(i, s):
    import math
    d, w = 100 / 111.0, 100 / (111.320 * math.cos(math.radians(i["lat"])))
    return abs(s["lat"] - i["lat"]) <= d and abs(s["lon"] - i["lon"]) <= w


def test_sensors_come_once_with_repeated_and_null_ids(spark, incidents, sites):
    got = air.sensors_near_incident(incidents, sites).collect()
    want = defaultdict(list)
    for i in incidents.where("lat is not null").collect():
        for s in sites.where("lat is not null").collect():
            if box(i, s):
                want[i["event_id"], s["location_id"]].append((s["lat"], s["lon"], s["location_name"]))
    assert {(r["event_id"], r["location_id"]): (r["latitude"], r["longitude"], r["location_name"]) for r in got} == {k: min(v) for k, v in want.items()}
    assert len(got) == len(want)
    rounded = air.sensors_near_incident(incidents, sites, digits=0).select("event_id", "location_id", "latitude", "location_name").collect()
    assert sorted((str(r[0]), str(r[1]), r[2], r[3]) for r in rounded) == sorted(
        (str(k[0]), str(k[1]), float(int(min(v)[0] + 0.5)), min(v)[2]) for k, v in want.items())


def test_pairs_of_single_ids_are_not_shuffled(spark, incidents, sites):
    """Pairs are written as they are found: no shuffle lies above the join of single ids."""
    single = incidents.where("event_id > 'e31' and event_id < 'e5'").localCheckpoint()
    df = air.sensors_near_incident(single, sites.where("location_id > 5 and location_id < 24").localCheckpoint())
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    first = p.split("+- == Initial Plan ==")[0]
    assert "HashAggregate" not in first.split("Join")[0]


def test_air_quality_of_stations_equals_every_measurement(spark, incidents, sites):
    meas = spark.createDataFrame([(k % 26, "pm25" if k % 3 else "pm10", at(1 + k % 25, k * 7 % 24), float(k % 11) if k % 13 else None)
                                  for k in range(900)] + [(None, "pm25", at(4, 4), 1e6), (4, "o3", at(4, 4), 1e6), (4, "pm25", None, 1e6)],
                                 "location_id bigint, pollutant string, ts timestamp_ntz, value double")
    day, hits = dt.timedelta(hours=24), defaultdict(set)
    listed, readings = sites.where("lat is not null").collect(), [(n, *r) for n, r in enumerate(meas.collect())]
    for i in incidents.where("lat is not null and start_time is not null").collect():
        ids, s, e = {x["location_id"] for x in listed if box(i, x)}, i["start_time"], i["end_time"] or i["start_time"]
        for n, loc, pol, ts, value in readings:
            if loc is not None and loc in ids and pol in air.POLLUTANTS and ts is not None:
                for side, near in (("before", s - day <= ts < s), ("after", e < ts <= e + day)):
                    if near:
                        hits[i["event_id"]].add((pol, side, n, value))
    def mean(v, pol, side):
        known = [x[3] for x in v if x[:2] == (pol, side) and x[3] is not None]
        return round(sum(known) / len(known), 6) if known else None
    columns = [(pol, side) for pol in air.POLLUTANTS for side in ("before", "after")]
    want = {k: tuple(mean(v, *c) for c in columns) for k, v in hits.items()}
    df = air.air_quality_before_after(incidents, sites, meas)
    got = {r[0]: tuple(None if r[f"{p}_{s}"] is None else round(r[f"{p}_{s}"], 6) for p, s in columns) for r in df.collect()}
    assert got == want


def test_locations_of_one_place_are_one_station(spark, sites):
    """Twelve places of 24 measuring locations; the listing at a second place keeps a location apart."""
    from pyspark.sql import functions as F
    stations, of = air._stations(sites, sites.select(F.col("location_id")).where("location_id is not null").distinct())
    names = {r["location_id"]: r["station"] for r in of.collect()}
    assert len(names) == 24 and names[17] != names[5] == 5 and names[12] == names[0] == 0
    assert stations.count() == 12 + 2      # twelve places, the moved location has two of its own


@pytest.fixture(scope="module")
def feed(spark):
    rows = [(k, 20240100 + 1 + k % 12, 10.0 + k % 5 * 0.4, 5.0 + k % 3 * 0.3, None if k % 17 == 0 else k % 23 - 9.5, 1) for k in range(400)]
    rows += [(None, 20240104, 10.4, 5.0, 3.0, 1), (7, 20240105, None, 5.0, 3.0, 1), (8, 20240105, 10.0, 5.0, None, 1), (8, 20240105, 10.0, 5.0, 2.0, 1)]
    return spark.createDataFrame(rows, "news_id bigint, sqldate int, lat double, lon double, tone double, num_articles int")


def plain(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("mode", ["exact", "bins"])
def test_news_pairs_by_places_equal_the_plain_join(spark, incidents, feed, mode):
    from perilscope.operators import news, spatial
    staged = news.stage_news(feed, "2024-01-11", days=8)
    inc = incidents.select("event_id", "lat", "lon", "start_time", "end_time")
    one_by_one = spatial.near_in_time(inc, staged.select("news_id", "event_time", "lat", "lon", "tone"), mode=mode)
    got = news.news_pairs(incidents, staged, mode=mode, as_of="2024-01-11", days=8)
    assert plain(got.select(one_by_one.columns)) == plain(one_by_one) != []
    assert plain(news.news_pairs(incidents, staged, mode=mode, hours=6).select("event_id", "news_id")) == plain(
        spatial.near_in_time(inc, staged.select("news_id", "event_time", "lat", "lon"), mode=mode, before_hours=6, after_hours=6).select("event_id", "news_id"))


def test_news_metrics_make_no_pairs(spark, incidents, feed):
    """Ten times the news of the same places and days meet as many rows as before."""
    from pyspark.sql import functions as F
    from perilscope.operators import news
    many = feed.crossJoin(spark.range(10)).drop("id")
    staged = news.stage_news(many, "2024-01-11", days=8)
    got = news.metrics_near(incidents, staged, as_of="2024-01-11", days=8)
    assert plain(got) == plain(news.news_metrics(news.news_pairs(incidents, staged, as_of="2024-01-11", days=8)))
    met = [news.near_sums(incidents, news.stage_news(f, "2024-01-11", days=8)) for f in (feed, many)]
    assert met[0].count() == met[1].count()
    assert met[1].agg(F.sum("n")).first()[0] == 10 * met[0].agg(F.sum("n")).first()[0]


def test_features_are_worked_out_once_for_pairs(spark, monkeypatch):
    from perilscope.plans import q_text
    calls = []
    real = q_text.features
    monkeypatch.setattr(q_text, "features", lambda *a: calls.append(a) or real(*a))
    q_text.pair_feats(spark, "/root/testdata/sf0.001")
    assert len(calls) == 1


def test_topk_of_a_block_holds_few_distances_at_once():
    import tracemalloc
    import numpy as np
    import pandas as pd
    from perilscope.operators.vectors import _topk_block
    rng = np.random.default_rng(1)
    n = 2000
    base = pd.DataFrame({"id": range(n), "vec": list(rng.normal(size=(n, 16)))})
    query = pd.DataFrame({"qid": range(n), "qvec": list(base["vec"])})
    tracemalloc.start()
    got = _topk_block(3, True)((), base, query)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 3 * n and peak < 20e6             # 2000 x 2000 distances are 32 MB, and were held several times
    B = np.stack(base["vec"])
    d = 1 - (B @ B.T) / np.outer(*[np.linalg.norm(B, axis=1)] * 2)
    np.fill_diagonal(d, np.inf)
    assert got["neighbor_event"].tolist() == np.argsort(d, axis=1, kind="stable")[:, :3].ravel().tolist()


def test_windows_of_single_incidents_are_not_merged(spark, incidents, sites):
    """Incidents of one row and locations of one place: their windows are not shuffled by incident and station."""
    meas = spark.createDataFrame([(k % 24, "pm25", at(1 + k % 25, k * 7 % 24), float(k % 11)) for k in range(300)],
                                 "location_id bigint, pollutant string, ts timestamp_ntz, value double")
    single = incidents.where("event_id > 'e31' and event_id < 'e5'").localCheckpoint()
    one_place = sites.where("location_id > 5 and location_id < 24").localCheckpoint()

    def merges(inc, places):
        df = air.air_quality_before_after(inc, places, meas)
        assert df.collect()
        return "windowspecdefinition(event_id" in df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert not merges(single, one_place)
    assert merges(single.union(single), one_place) and merges(single, one_place.union(one_place.selectExpr("location_id", "lat + 0.1", "lon", "location_name", "country_raw")))


def test_days_of_news_are_added_up_before_incidents_meet_them(spark, incidents, feed):
    from perilscope.operators import news
    staged = news.stage_news(feed, "2024-01-11", days=8)
    inc = incidents.select("event_id", "lat", "lon", "start_time", "end_time").where("event_id < 'e3'")
    once = news._sums_by([], inc, staged, 100.0, 24, None)
    assert 0 < once.count() <= inc.count() < news.near_sums(inc, staged).count()


def test_landed_roads_are_dealt_out_before_they_are_parsed(spark):
    """Roads that come as one split: every task parses some of them."""
    from pyspark.sql import functions as F
    from perilscope.sources import shapes
    landed = spark.range(0, 400, 1, 1).select("id", F.lit("road").alias("subtype"), F.lit(
        '{"type":"MultiLineString","coordinates":[[[1.0,2.0],[1.0,3.0]],[[2.0,2.0],[2.0,4.0]]]}').alias("geometry"))
    parsed = shapes.road_segments(landed, subtype="road").withColumn("part", F.spark_partition_id())
    assert parsed.count() == 400 and parsed.select("part").distinct().count() > 1
    assert all(len(r["geom"]) == 2 for r in parsed.collect())
