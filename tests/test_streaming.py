"""Incremental staging: two landings, two available-now runs, every row staged once."""

from pyspark.sql import functions as F

from perilscope import fixtures as fx
from perilscope.operators import news
from perilscope.session import scratch_path
from perilscope.streaming.news_stage import read_staged, stage_news_stream

SF = "/root/testdata/sf0.001"


def test_available_now_staging_is_incremental(spark):
    src = fx.news_fx(spark, SF)
    landing, out, seen = (scratch_path(spark, n) for n in ("landing", "staged", "seen"))
    src.where(F.col("sqldate") <= 20240115).write.parquet(f"{landing}/batch=1")
    stage_news_stream(spark, f"{landing}/*", out, checkpoint=seen)
    first = spark.read.parquet(out).count()
    src.where(F.col("sqldate") > 20240115).write.parquet(f"{landing}/batch=2")
    stage_news_stream(spark, f"{landing}/*", out, checkpoint=seen)
    staged = read_staged(spark, out, "2024-01-31", 90)
    want = news.stage_news(src, "2024-01-31")
    assert 0 < first < staged.count()
    got = sorted(r.news_id for r in staged.select("news_id").collect())
    assert got == sorted(r.news_id for r in want.select("news_id").collect())
