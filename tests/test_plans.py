"""Plan shape: no Cartesian products in the spatial joins, top-k as WindowGroupLimit,
partition pruning on the staged layout; and the driver entry point."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spatial_joins_are_equi_joins(spark):
    q = E.queries()
    for name in ("news_near_incident", "country_of_incident", "road_country_pairs", "sensors_near_incident",
                 "similar_top5", "air_quality_before_after"):
        p = plan(q[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_band_join_never_broadcasts_the_exploded_side(spark):
    p = plan(E.queries()["news_near_incident"](spark, SF))
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p


def test_topk_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in plan(E.queries()["similar_top5"](spark, SF))


def test_staged_layout_prunes_partitions(spark):
    df = E.queries()["staged_news_layout"](spark, SF)
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in txt


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "event_id" and df.count() > 0
