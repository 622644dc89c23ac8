"""Providers, JSON action lists and landed-file readers."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from perilscope.operators import generate
from perilscope.sources import files


def test_actions_from_json_edges(spark):
    rows = [(1, '[{"priority":1,"action":"a","owner":"Ops","eta_hours":3},{"priority":"high","action":"b"}]'),
            (2, "not json"), (3, "[]"), (4, None), (5, '[{"priority":2,"action":"c"'),  # truncated
            (6, '[{"priority":1.5,"eta_hours":"7"}]')]
    df = spark.createDataFrame(rows, "query_event long, json_actions string")
    got = sorted(((r.query_event, r.priority, r.action, r.owner, r.eta_hours)
                  for r in generate.actions_from_json(df).collect()), key=repr)
    assert got == sorted([(1, None, "b", None, None), (1, 1, "a", "Ops", 3), (6, None, None, None, 7)], key=repr)
    bad = generate.actions_from_json(df, keep_bad=True).where("parse_error").select("query_event").collect()
    assert sorted(r[0] for r in bad) == [2, 4, 5]


def test_offline_actions_keep_contract(spark):
    pairs = spark.createDataFrame([(7, 9, 0.91), (7, 8, 0.95), (5, 7, 0.5)],
                                  "query_event long, neighbor_event long, cosine_similarity double")
    nl = {r.query_event: r.neighbor_list for r in generate.neighbor_list(pairs).collect()}
    assert nl[7] == "8 (sim=0.95), 9 (sim=0.91)"
    rep = generate.action_contract_report(generate.action_replies(pairs)).collect()
    assert len(rep) == 2 and all(r.contract_ok and r.n_items == 5 for r in rep)


def test_batch_provider_dedupes_prompts(spark):
    calls = []

    def fn(prompts):
        calls.append(len(prompts))
        return [p.upper() for p in prompts]

    df = spark.createDataFrame([(i, "same prompt" if i % 2 else f"p{i % 4}") for i in range(40)] + [(99, None)],
                               "event_id long, prompt string")
    out = generate.BatchProvider(fn).run(df, "prompt", "answer").collect()
    assert len(out) == 41
    assert {r.answer for r in out if r.prompt == "same prompt"} == {"SAME PROMPT"}
    assert [r.answer for r in out if r.prompt is None] == [None]


def test_csv_quoted_newlines_and_pages(spark, tmp_path):
    p = tmp_path / "tracks.csv"
    p.write_text('SID,ISO_TIME,LAT,LON,WMO_WIND,EXTRA\n"A","2020-01-01 06:00:00","1.5","2","",x\n'
                 '"B","2020-01-02 06:00:00","line\nbreak","3"," ",y\n')
    df = files.read_csv_landed(spark, str(p), ["sid", "iso_time", "lat", "lon", "wmo_wind"])
    rows = sorted(df.collect())
    assert [r.sid for r in rows] == ["A", "B"] and rows[1].lat == "line\nbreak" and rows[1].wmo_wind == " "
    root = tmp_path / "pages"
    bodies = {"query=a/page=1": {"results": [{"location_id": 1, "lat": "1.0"}]},
              "query=a/page=2": {"results": []},
              "query=a/page=3": {"results": [{"location_id": 99}]},
              "query=b/page=1": [{"location_id": 2}],
              "query=b/page=2": {"items": [{"location_id": 3}]}}
    for k, v in bodies.items():
        os.makedirs(root / k)
        (root / k / "part-0.json").write_text(json.dumps(v))
    got = files.read_json_pages(spark, str(root), ["location_id", "lat"], list_keys=("results", "items"),
                                stop_at_empty=True)
    assert sorted(int(r.location_id) for r in got.collect()) == [1, 2, 3]


def test_with_index_is_contiguous_and_ordered(spark):
    from perilscope.sources.sinks import with_index
    df = spark.range(0, 5000).selectExpr("id * 7 % 5000 as k", "id as v").repartition(7)
    out = with_index(df, ["k"]).collect()
    assert sorted(r["index"] for r in out) == list(range(5000))
    assert all(r["index"] == r["k"] for r in out)
