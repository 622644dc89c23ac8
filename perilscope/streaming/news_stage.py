"""Incremental staging of landed news files (the "one-time (or daily)" step 1D).

The reference rewrites its 90-day news table on each run.  Here new landed
files are picked up incrementally with Structured Streaming: ``readStream`` over
the landing folder, the same cleaning as the batch ``stage_news`` minus the
look-back (a stream has no fixed "today"), written ``partitionBy(event_date)``
with ``trigger(availableNow=True)`` -- every file not yet seen is processed once,
then the query stops.  The checkpoint lives in the shared folder, so a restart
(or a lost executor) resumes exactly where it left off.  Readers apply the
look-back at read time (``lookback_days``), which prunes partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.clean import grid_bin, parse_yyyymmdd, valid_coords
from ..operators.news import NEWS_BIN_DEG

NEWS_SCHEMA = "news_id long, sqldate int, lat double, lon double, tone double, num_articles long"


def clean_news(events: DataFrame, bin_deg: float = NEWS_BIN_DEG) -> DataFrame:
    """Located, toned rows with event time, day and grid bins (no look-back)."""
    keep = (valid_coords("lat", "lon") & F.col("tone").isNotNull() & F.col("num_articles").isNotNull()
            & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    t = parse_yyyymmdd("sqldate")
    return events.where(keep & t.isNotNull()).select(
        "news_id", t.alias("event_time"), "lat", "lon", "tone", "num_articles",
        grid_bin("lat", bin_deg).alias("lat_bin"), grid_bin("lon", bin_deg).alias("lon_bin"),
        F.to_date(t).alias("event_date"))


def stage_news_stream(spark: SparkSession, landing: str, out_path: str, *,
                      checkpoint: str, schema: str | StructType = NEWS_SCHEMA, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> None:
    """Process every landed file not yet staged, then stop (available-now trigger).

    ``checkpoint``: a lasting shared folder that belongs to ``out_path``; it remembers the files
    already staged, so it must be the same one in every run.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    staged = clean_news(reader.load(landing))
    q = (staged.writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .partitionBy("event_date").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_staged(spark: SparkSession, path: str, as_of: str, days: int) -> DataFrame:
    """The staged news of the look-back window [as_of - days, as_of] (partition-pruned)."""
    lo = F.date_sub(F.lit(as_of).cast("date"), days)
    hi = F.lit(as_of).cast("date")
    return spark.read.parquet(path).where(F.col("event_date").between(lo, hi))
