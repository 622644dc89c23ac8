"""News metrics kept up day by day against whole runs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from perilscope import fixtures as fx
from perilscope.operators import news, news_daily
from perilscope.plans import pipeline

SF = "/root/testdata/sf0.001"
DAYS = 10


def day(d):
    return f"2024-01-{d:02d}"


def ints(*days):
    return F.col("sqldate").isin([20240100 + d for d in days])


@pytest.fixture(scope="module")
def feed(spark):
    f = fx.news_fx(spark, SF)
    return f.unionByName(f.where("news_id % 3 = 0"))         # repeated rows count each


@pytest.fixture(scope="module")
def incidents(spark):
    """Incidents near the news of January, some on several rows, some equal, some without a time or an id."""
    i = (fx.news_fx(spark, SF).where("news_id % 7 = 0").limit(150).select(
        F.concat(F.lit("e"), (F.col("news_id") % 60).cast("string")).alias("event_id"), (F.col("lat") + 0.3).alias("lat"), "lon",
        F.to_timestamp_ntz(F.col("sqldate").cast("string"), F.lit("yyyyMMdd")).alias("start_time"))
        .withColumn("end_time", F.when(F.col("lat") > 40, F.col("start_time") + F.expr("interval 5 day"))))
    odd = spark.createDataFrame([("n1", None, 1.0), ("n2", 30.0, 1.0), (None, 30.1, 0.5)], "event_id string, lat double, lon double").select(
        "*", F.when(F.col("lat") > 30.05, F.lit("2024-01-20").cast("timestamp_ntz")).alias("start_time"),
        F.lit(None).cast("timestamp_ntz").alias("end_time"))
    both = i.unionByName(i.where("lat < 30")).unionByName(odd)
    return spark.createDataFrame(both.collect(), both.schema)


def rows(df):
    return {r[0]: (r[1], round(r[2], 9)) for r in df.select("event_id", "news_articles_48h", "news_tone_48h").collect()}


def whole(feed, inc, as_of):
    return rows(news.news_metrics(news.news_pairs(inc, news.stage_news(feed, as_of, days=DAYS), as_of=as_of, days=DAYS)))


def test_days_in_a_row_equal_whole_runs(spark, tmp_path, feed, incidents):
    store = news_daily.DailyNews(spark, str(tmp_path / "s"))
    assert len(store.update(feed, incidents, day(20), days=DAYS)) == DAYS + 1
    assert rows(store.metrics()) == whole(feed, incidents, day(20)) != {}
    # the next day: only its news are read (the rest of the feed may be gone), and one day leaves
    assert store.update(feed.where(ints(21)), incidents, day(21), days=DAYS) == [dt.date(2024, 1, 21)]
    assert rows(store.metrics()) == whole(feed, incidents, day(21))
    # new incidents, and some that move, meet the days that are kept, without the feed
    moved = incidents.withColumn("lon", F.when(F.col("event_id") == "e7", F.col("lon") + 1).otherwise(F.col("lon"))).unionByName(
        incidents.where("event_id = 'e14'").withColumn("event_id", F.lit("late")))
    assert store.update(feed.where("false"), moved, day(21), days=DAYS) == []
    assert rows(store.metrics()) == whole(feed, moved, day(21))
    # one that was gone for a day and is back is counted once
    store.update(feed.where(ints(22)), incidents.where("event_id <> 'e21'"), day(22), days=DAYS)
    assert "e21" not in rows(store.metrics())
    store.update(feed.where(ints(23)), incidents, day(23), days=DAYS)
    assert rows(store.metrics()) == whole(feed, incidents, day(23))
    assert store.staged().count() == news.stage_news(feed, day(23), days=DAYS).count()


def test_late_news_replace_their_day_only(spark, tmp_path, feed, incidents):
    store = news_daily.DailyNews(spark, str(tmp_path / "s"))
    part = feed.where(~(ints(15) & (F.col("news_id") % 2 == 0)))
    store.update(part, incidents, day(20), days=DAYS)
    assert store.update(feed.where(ints(15)), incidents, day(20), days=DAYS, changed=[day(15)]) == [dt.date(2024, 1, 15)]
    assert rows(store.metrics()) == whole(feed, incidents, day(20))
    # a day whose news were all withdrawn
    store.update(feed.where("false"), incidents, day(20), days=DAYS, changed=[day(16)])
    assert rows(store.metrics()) == whole(feed.where(~ints(16)), incidents, day(20))


def test_a_failed_run_changes_nothing_and_can_be_repeated(spark, tmp_path, feed, incidents, monkeypatch):
    store = news_daily.DailyNews(spark, str(tmp_path / "s"))
    store.update(feed, incidents, day(20), days=DAYS)
    before = rows(store.metrics())
    with monkeypatch.context() as m:
        m.setattr(news_daily.sinks, "replace_table", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.update(feed, incidents, day(22), days=DAYS)
    assert rows(store.metrics()) == before
    assert len(store.update(feed, incidents, day(22), days=DAYS)) == 2
    assert rows(store.metrics()) == whole(feed, incidents, day(22))


def test_batches_are_merged_and_old_days_removed(spark, tmp_path, feed, incidents, monkeypatch):
    monkeypatch.setattr(news_daily, "MAX_BATCHES", 2)
    store = news_daily.DailyNews(spark, str(tmp_path / "s"))
    for d in range(16, 21):
        store.update(feed, incidents.where("event_id <> 'e28'") if d == 17 else incidents, day(d), days=3)
    want = news.news_metrics(news.news_pairs(incidents, news.stage_news(feed, day(20), days=3), as_of=day(20), days=3))
    assert rows(store.metrics()) == rows(want)
    assert len(os.listdir(tmp_path / "s" / "counts")) <= 2 and len(os.listdir(tmp_path / "s" / "places")) == 1
    held = {d for b in os.listdir(tmp_path / "s" / "staged") for d in os.listdir(tmp_path / "s" / "staged" / b) if d[0] == "e"}
    assert held <= {f"event_date={day(d)}" for d in range(17, 21)}


def test_empty_tables_and_other_settings(spark, tmp_path, feed, incidents):
    store = news_daily.DailyNews(spark, str(tmp_path / "s"))
    with pytest.raises(FileNotFoundError):
        store.metrics()
    store.update(feed.where("false"), incidents.where("false"), day(20), days=DAYS)
    assert store.metrics().count() == 0 and store.staged().count() == 0
    store.update(feed.where(ints(21)), incidents, day(21), days=DAYS)
    assert rows(store.metrics()) == whole(feed.where(ints(21)), incidents, day(21))
    with pytest.raises(ValueError):
        news_daily.DailyNews(spark, str(tmp_path / "s"), radius_km=50).update(feed, incidents, day(21))


def test_pipeline_steps_by_day(spark, tmp_path):
    src, only = fx.pipeline_sources(spark, SF), ["incidents_raw", "gdelt_recent_sig", "news_metrics_recent"]
    plain = pipeline.run(spark, src, str(tmp_path / "plain"), pipeline.Options(as_of=day(29)), only=only)
    for d in (28, 29):
        opt = pipeline.Options(as_of=day(d), daily_path=str(tmp_path / "daily"))
        kept = pipeline.run(spark, src, str(tmp_path / "by-day"), opt, only=only)
    name = "news_metrics_recent"
    assert rows(spark.read.parquet(kept[name])) == rows(spark.read.parquet(plain[name])) != {}
    assert "gdelt_recent_sig" not in kept
