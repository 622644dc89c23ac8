"""Readers, joins and model steps on the cases that used to go wrong."""

import datetime as dt
import json
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from perilscope import fixtures as fx
from perilscope.functions.clean import fmt_whole
from perilscope.operators import air, enrich, generate, news, normalize, spatial, vectors
from perilscope.plans import pipeline
from perilscope.sources import files, shapes, sinks

T = dt.datetime


def _ring(points, order="<"):
    return struct.pack(order + "I", len(points)) + b"".join(struct.pack(order + "2d", *p) for p in points)


def test_wkb_and_geojson_give_the_same_shapes(spark):
    outer, hole = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)]
    poly = b"\x01" + struct.pack("<II", 3, 2) + _ring(outer) + _ring(hole)
    big = b"\x00" + struct.pack(">II", 3, 1) + _ring(outer, ">")
    multi = b"\x01" + struct.pack("<II", 6, 2) + poly + big
    z = b"\x01" + struct.pack("<II", 1002, 2) + struct.pack("<6d", 1, 2, 9, 3, 4, 9)
    srid = b"\x01" + struct.pack("<III", 2 | 0x20000000, 4326, 2) + struct.pack("<4d", 1, 2, 3, 4)
    d = spark.createDataFrame([(bytearray(poly),), (bytearray(multi),), (None,)], "geometry binary")
    got = [r[0] and [[[(p.lon, p.lat) for p in ring] for ring in part] for part in r[0]] for r in d.select(shapes.polygon_parts(d)).collect()]
    assert got == [[[outer, hole]], [[outer, hole], [outer]], None]
    j = spark.createDataFrame([(json.dumps({"type": "Polygon", "coordinates": [outer, hole]}),),
                               (json.dumps({"type": "MultiPolygon", "coordinates": [[outer, hole], [outer]]}),),
                               (json.dumps({"type": "Point", "coordinates": [1, 2]}),)], "geometry string")
    assert [r[0] and [[[(p.lon, p.lat) for p in ring] for ring in part] for part in r[0]]
            for r in j.select(shapes.polygon_parts(j)).collect()] == got
    lines = spark.createDataFrame([(bytearray(z),), (bytearray(srid),)], "geometry binary")
    assert [[[(p.lon, p.lat) for p in line] for line in r[0]] for r in lines.select(shapes.line_list(lines)).collect()] == \
        [[[(1, 2), (3, 4)]]] * 2


def test_truncated_page_stops_the_read(spark, tmp_path):
    for n, body in ((1, '{"results": [{"id": 1}]}'), (2, '{"results": [{"id": 2'), (3, '{"results": [{"id": 3}]}')):
        os.makedirs(tmp_path / f"page={n}")
        (tmp_path / f"page={n}" / "p.json").write_text(body)
    with pytest.raises(Exception, match="page=2"):
        files.read_json_pages(spark, str(tmp_path), ["id"], list_keys=("results",), stop_at_empty=True).collect()


def test_csv_with_another_header_order_stops_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("SID,LAT\nA,1\n")
    (tmp_path / "b.csv").write_text("LAT,SID\n2,B\n")
    with pytest.raises(Exception):
        files.read_csv_landed(spark, str(tmp_path), ["sid", "lat"]).collect()
    (tmp_path / "b.csv").write_text("SID,LAT\nB,2\n")
    assert sorted(map(tuple, files.read_csv_landed(spark, str(tmp_path), ["sid", "lat"]).collect())) == [("A", "1"), ("B", "2")]


def test_points_of_a_track_pair_their_own_sensors_and_windows(spark):
    inc = spark.createDataFrame([("T1", "hurricane", 0.0, 0.0, T(2024, 1, 2, 6), None),
                                 ("T1", "hurricane", 0.0, 30.0, T(2024, 1, 20, 6), None)],
                                "event_id string, hazard_type string, lat double, lon double, start_time timestamp_ntz, end_time timestamp_ntz")
    sites = spark.createDataFrame([(1, 0.1, 0.1, "a", None), (1, 0.1, 0.1, "a", None), (2, 0.1, 30.1, "b", None)],
                                  "location_id bigint, lat double, lon double, location_name string, country_raw string")
    meas = spark.createDataFrame([(1, "pm25", T(2024, 1, 2, 0), 10.0), (2, "pm25", T(2024, 1, 2, 0), 90.0),
                                  (2, "pm25", T(2024, 1, 20, 7), 30.0), (1, "pm25", T(2024, 1, 20, 7), 70.0)],
                                 "location_id bigint, pollutant string, ts timestamp_ntz, value double")
    r, = air.air_quality_before_after(inc, sites, meas).collect()
    assert (r["pm25_before"], r["pm25_after"]) == (10.0, 30.0)
    near = air.sensors_near_incident(inc, sites).collect()
    assert sorted(x["location_id"] for x in near) == [1, 2]            # listed twice, kept once


def test_long_windows_are_joined_without_a_count(spark):
    inc = spark.createDataFrame([(1, 0.0, 0.0, T(2023, 1, 1), T(2023, 12, 1)), (2, 0.0, 0.0, T(2023, 5, 1), None)],
                                "event_id long, lat double, lon double, start_time timestamp_ntz, end_time timestamp_ntz")
    pts = spark.createDataFrame([(i, 0.1, 0.1, T(2023, 1 + i, 1)) for i in range(12)],
                                "news_id long, lat double, lon double, event_time timestamp_ntz")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    j = spatial.near_in_time(inc, pts)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before      # planning runs no job
    assert sorted((r["event_id"], r["news_id"]) for r in j.collect()) == [(1, i) for i in range(12)] + [(2, 4)]


def test_hazard_words_are_whole_words_of_the_hazard(spark):
    f = spark.createDataFrame([(1, "storm", "Iceland", 1.0), (2, "landslide", "Thailand", 1.0), (3, "ice storm", "x", 1.0),
                               (4, "Wildfires", None, 2.0), (5, "hail", None, None)],
                              "event_id long, hazard_type string, country_name string, severity double")
    got = {r["event_id"]: r["hazard_bucket"] for r in generate.hazard_buckets(f).collect()}
    assert got == {1: "wind", 2: "other", 3: "winter", 4: "wildfire", 5: None}


def test_answers_are_not_shared_between_providers_or_settings(spark, tmp_path):
    d = spark.createDataFrame([("p",), (None,)], "prompt string")
    path = str(tmp_path / "cache")

    def ask(name, params=None, task=""):
        p = generate.BatchProvider(lambda xs, **k: [f"{name}:{k.get('temperature')}" for _ in xs], path, name=name,
                                   params=params, pass_params=True)
        return sorted(str(r["out"]) for r in p.run(d, "prompt", "out", task).collect())
    assert ask("a") == ["None", "a:None"] and ask("b") == ["None", "b:None"]
    assert ask("a", {"temperature": 1}) == ["None", "a:1"] and ask("a", task="brief") == ["None", "a:0.2"]
    assert spark.read.parquet(path).count() == 4 and ask("a") == ["None", "a:None"]


def test_numbers_are_printed_whole(spark):
    d = spark.createDataFrame([(6.125,), (100.0,), (0.0,), (-0.5,), (None,)], "x double")
    assert [r[0] for r in d.select(fmt_whole("x")).collect()] == ["6.125", "100", "0", "-0.5", None]


def test_lists_are_as_many_as_asked_for_and_probed_until_k(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 16))
    v = [(i, (centres[i % 20] + 0.05 * rng.normal(size=16)).tolist()) for i in range(600)]
    d = spark.createDataFrame(v, "event_id long, emb array<double>")
    assert len(vectors.build_lists(d, n_lists=20)) == 20
    with pytest.raises(ValueError):
        vectors.build_lists(d, n_lists=601)
    q = d.where("event_id < 100")
    exact = {(r[0], r[1]) for r in vectors.similar(d, q).select("query_event", "neighbor_event").collect()}
    found = {(r[0], r[1]) for r in vectors.similar_ivf(d, q, n_lists=20, share=0.1).select("query_event", "neighbor_event").collect()}
    assert len(exact & found) / len(exact) >= 0.9
    short = vectors.similar_ivf(d, q, n_lists=300, share=1 / 300).groupBy("query_event").count().collect()
    assert len(short) == 100 and all(r["count"] == 5 for r in short)   # lists of about two vectors: further ones are probed


def test_embedding_does_not_shuffle(spark):
    d = spark.createDataFrame([(1, "a b a"), (2, "")], "id long, t string")
    for e in (vectors.hashed_terms(d, "id", "t"), vectors.embed(d, "id", "t")):
        assert "Exchange" not in e._jdf.queryExecution().executedPlan().toString()
    r = {x["id"]: x["emb"] for x in vectors.embed(d, "id", "t").collect()}
    assert sum(x * x for x in r[1]) == pytest.approx(1) and not any(r[2])


def test_staged_days_are_files_of_narrow_ranges(spark, tmp_path):
    n = spark.range(0, 3000).selectExpr("id as news_id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(id % 15 as int)) as event_time",
                                        "id % 40 as lat_bin", "id % 50 as lon_bin")
    path = str(tmp_path / "staged")
    sinks.stage_partitioned(n, path, "event_time", cluster_by=["lat_bin", "lon_bin"])
    count = sum(f.endswith(".parquet") for _, _, fs in os.walk(path) for f in fs)
    assert count <= 15 + 8                                             # a day ends and begins in a file, or spans a cut
    sinks.stage_partitioned(n.where("event_time >= '2024-01-10'"), path, "event_time", cluster_by=["lat_bin"])
    assert spark.read.parquet(path).agg(F.min("event_date")).first()[0] == dt.date(2024, 1, 10)


def test_pipeline_runs_twice_into_one_folder(spark, tmp_path):
    src = fx.pipeline_sources(spark, "/root/testdata/sf0.001")
    only = ["incidents_raw", "gdelt_recent_sig", "news_metrics_recent"]
    out = str(tmp_path / "p")
    counts = []
    for as_of in ("2024-01-10", "2024-01-31", "2024-01-31"):
        paths = pipeline.run(spark, src, out, pipeline.Options(as_of=as_of, news_days=5), only)
        t = spark.read.parquet(paths["gdelt_recent_sig"]).agg(F.min("event_date"), F.max("event_date"), F.count("*")).first()
        assert t[0] >= dt.date.fromisoformat(as_of) - dt.timedelta(days=5) and t[1] <= dt.date.fromisoformat(as_of)
        counts.append((t[2], spark.read.parquet(paths["news_metrics_recent"]).count()))
    assert counts[1] == counts[2]
    none = pipeline.Sources(**{**src.__dict__, "storms": src.storms.limit(0), "tracks": src.tracks.limit(0), "quakes": src.quakes.limit(0)})
    with pytest.raises(RuntimeError):
        pipeline.run(spark, none, out, pipeline.Options(as_of="2024-01-31"), only)
    assert pipeline.run(spark, none, out, pipeline.Options(as_of="2024-01-31", empty_input="skip"), only) == {}


def test_quakes_repeated_by_overlapping_pages_count_once(spark):
    q = fx.quakes_fx(spark, "/root/testdata/sf0.001")
    assert normalize.normalize_quakes(q.union(q)).count() == normalize.normalize_quakes(q).count()


def test_needed_countries_shuffle_distinct_keys(spark):
    c = spark.createDataFrame([("A",), ("B",)], "iso_code string")
    i = spark.createDataFrame([("A",)] * 50 + [(None,)], "iso_code string")
    j = enrich.countries_needed(c, i)
    assert [r[0] for r in j.collect()] == ["A"] and "HashAggregate" in j._jdf.queryExecution().executedPlan().toString()


def test_lookback_drops_days_on_both_sides(spark):
    d = spark.createDataFrame([(i, 20240100 + i, 1.0, 1.0, 0.5, 1) for i in range(1, 31)],
                              "news_id long, sqldate int, lat double, lon double, tone double, num_articles long")
    got = sorted(r["news_id"] for r in news.stage_news(d, "2024-01-20", days=7).collect())
    assert got == list(range(13, 21))
