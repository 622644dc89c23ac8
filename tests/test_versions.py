"""Tables replaced by versions, scratch removed, the database made, and model vectors asked for once."""

import os

import pytest
from pyspark.sql import functions as F

from perilscope import fixtures as fx
from perilscope.operators import vectors
from perilscope.plans import pipeline
from perilscope.session import materialize, scratch_path, scratch_scope, shared_dir
from perilscope.sources import sinks

SF = "/root/testdata/sf0.001"


def ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(sinks.current(spark, path)).collect())


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sinks.current(spark, path)
    sinks.replace_table(spark.range(3), path)
    with pytest.raises(Exception):
        sinks.replace_table(spark.range(9).select(F.raise_error(F.lit("no")).cast("long").alias("id")), path)
    assert ids(spark, path) == [0, 1, 2] and len(sinks.versions(spark, path)) == 2
    # a table may be replaced by what is read from it, and remains of the failed write go
    sinks.replace_table(spark.read.parquet(sinks.current(spark, path)).select((F.col("id") + 10).alias("id")), path)
    assert ids(spark, path) == [10, 11, 12] and len(sinks.versions(spark, path)) == 1
    sinks.replace_table(spark.range(1), path, keep=2)
    assert len(sinks.versions(spark, path)) == 2 and ids(spark, path) == [0]
    sinks.replace_table(spark.range(0), path)
    assert ids(spark, path) == [] and len(sinks.versions(spark, path)) == 1


def test_scratch_scope_removes_its_stages_only(spark):
    outer = materialize(spark.range(2), "kept")
    with pytest.raises(ZeroDivisionError):
        with scratch_scope(spark) as mine:
            materialize(spark.range(5), "gone")
            assert len(mine) == 1 and os.path.exists(mine[0])
            1 / 0
    assert not os.path.exists(mine[0]) and outer.count() == 2


def test_pipeline_leaves_no_scratch_and_registers_its_tables(spark, tmp_path):
    base = os.path.join(shared_dir(spark), "perilscope")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    only = ["incidents_raw", "gdelt_recent_sig", "news_metrics_recent", "incidents_enriched"]
    src, out = fx.pipeline_sources(spark, SF), str(tmp_path / "out")
    opt = pipeline.Options(as_of="2024-01-31")
    paths = pipeline.run(spark, src, out, opt, only, database="perilscope_test")
    again = pipeline.run(spark, src, out, opt, only[:1])
    assert set(os.listdir(base)) == before
    assert sorted(again) == sorted(only) and again["incidents_raw"] != paths["incidents_raw"]
    assert again["incidents_enriched"] == paths["incidents_enriched"] == sinks.current(spark, os.path.join(out, "incidents_enriched"))
    assert spark.table("perilscope_test.incidents_enriched").count() == spark.read.parquet(paths["incidents_enriched"]).count() > 0
    spark.sql("DROP DATABASE perilscope_test CASCADE")


def test_model_vectors_are_asked_for_once(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def model(texts, width=2):
        with open(calls, "a") as f:
            f.writelines(t + "\n" for t in texts)
        return [[float(len(t))] * width for t in texts]

    def asked():
        with open(calls) as f:
            return sorted(f.read().split("\n")[:-1])
    d = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "a"), (4, None), (5, "")], "id long, text string").repartition(3)
    store = str(tmp_path / "store")
    e = vectors.embed(d, "id", "text", provider=model, store=store)
    assert {r.id: r.emb for r in e.collect()} == {1: [1.0, 1.0], 2: [2.0, 2.0], 3: [1.0, 1.0], 4: [0.0, 0.0], 5: [0.0, 0.0]}
    assert e.count() == 5 and asked() == ["", "a", "bb"]
    more = d.unionByName(spark.createDataFrame([(6, "ccc"), (7, "bb")], "id long, text string"))
    assert vectors.embed(more, "id", "text", provider=model, store=store).count() == 7 and asked() == ["", "a", "bb", "ccc"]
    wide = vectors.embed(d, "id", "text", provider=model, params={"width": 3}, store=store)        # other parameters, other vectors
    assert {len(r.emb) for r in wide.collect()} == {3} and len(asked()) == 7
    vectors.embed(d, "id", "text", provider=model, name="other", store=store).collect()
    assert len(asked()) == 10
    unstored = vectors.embed(d, "id", "text", provider=model)
    assert unstored.count() == 5 and len(unstored.collect()) == 5 and len(asked()) == 13
