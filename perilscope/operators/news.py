"""News signals near incidents (steps 1D, 1D'): staging, band join, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.clean import grid_bin, parse_yyyymmdd, rounded, valid_coords, yyyymmdd
from .spatial import count_and_mean, near_in_time

NEWS_LOOKBACK_DAYS = 90
NEWS_BIN_DEG = 0.5
NEWS_RADIUS_KM = 100.0
NEWS_WINDOW_HOURS = 24


def lookback_days(c, as_of: str, days: int, *, integer_day: bool = False):
    """Rolling look-back, inclusive at both ends: as_of - days <= c <= as_of.

    On an integer ``YYYYMMDD`` column the bounds are integers too, so the filter
    reaches the parquet scan (and a partition column prunes files).
    """
    lo = F.date_sub(F.lit(as_of).cast("date"), days)
    hi = F.lit(as_of).cast("date")
    col = F.col(c) if isinstance(c, str) else c
    if integer_day:
        return col.between(yyyymmdd(lo), yyyymmdd(hi))
    return (col >= lo.cast("timestamp_ntz")) & (col < F.date_add(hi, 1).cast("timestamp_ntz"))


def stage_news(events: DataFrame, as_of: str, *, days: int = NEWS_LOOKBACK_DAYS,
               bin_deg: float = NEWS_BIN_DEG) -> DataFrame:
    """gdelt_recent_sig: recent, located, toned news events with grid bins.

    Input columns: ``news_id, sqldate (int YYYYMMDD), lat, lon, tone, num_articles``.
    """
    keep = (lookback_days("sqldate", as_of, days, integer_day=True)
            & valid_coords("lat", "lon")
            & F.col("tone").isNotNull() & F.col("num_articles").isNotNull()
            & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return events.where(keep).select(
        "news_id",
        parse_yyyymmdd("sqldate").alias("event_time"),
        "lat", "lon", "tone", "num_articles",
        grid_bin("lat", bin_deg).alias("lat_bin"),
        grid_bin("lon", bin_deg).alias("lon_bin"),
    )


def news_window(as_of: str, days: int = NEWS_LOOKBACK_DAYS) -> tuple[str, str]:
    """Time span covered by ``stage_news(.., as_of, days)`` (as timestamps)."""
    import datetime as dt
    end = dt.date.fromisoformat(as_of)
    return (str(end - dt.timedelta(days=days)) + " 00:00:00", str(end) + " 23:59:59.999999")


#: an incident's place and the first and last day of news that its window holds
ASK = ["lat", "lon", "_first", "_last"]


def _asking(incidents: DataFrame, hours: int) -> DataFrame:
    """Located incident rows with ``_first, _last``: the first and last midnight of their window.

    News are dated by the day (``stage_news``: midnight), so these bound the same news as the window.
    """
    reach = F.make_dt_interval(F.lit(0), F.lit(hours))
    t0, t1 = F.col("start_time") - reach, F.coalesce("end_time", "start_time") + reach
    day = F.date_trunc("day", t0).cast("timestamp_ntz")
    return incidents.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("start_time").isNotNull()).withColumn(
        "_first", F.when(day < t0, F.date_add(F.to_date(t0), 1).cast("timestamp_ntz")).otherwise(day)).withColumn(
        "_last", F.to_date(t1).cast("timestamp_ntz")).where(F.col("_first") <= F.col("_last"))


def _near(asking: DataFrame, news: DataFrame, *, radius_km: float, window: tuple[str, str] | None, **how) -> DataFrame:
    """``ASK`` x rows of ``news`` (one per place and day) within the radius and the days, with ``dist_km``."""
    asks = asking.select("lat", "lon", F.col("_first").alias("start_time"), F.col("_last").alias("end_time")).distinct()
    met = near_in_time(asks, news, radius_km=radius_km, before_hours=0, after_hours=0, right_window=window, **how)
    return met.withColumnsRenamed({"start_time": "_first", "end_time": "_last"})


def near_sums(incidents: DataFrame, staged: DataFrame, *, radius_km: float = NEWS_RADIUS_KM,
              hours: int = NEWS_WINDOW_HOURS, window: tuple[str, str] | None = None) -> DataFrame:
    """Incident rows x days with news near: ``event_time, n, n_tone, tone_sum``.

    News of one place and day are summed before any incident meets them (the feed places news by a
    gazetteer, so there are far fewer places than news), and incidents of one place and span of days ask
    once: what meets are places, not news.
    """
    return _sums_by(["event_time"], incidents, staged, radius_km, hours, window)


def _sums_by(more: list[str], incidents: DataFrame, staged: DataFrame, radius_km: float, hours: int,
             window: tuple[str, str] | None) -> DataFrame:
    """Incident rows x groups (by the columns ``more`` of the news; none: one group) of news near."""
    left = _asking(incidents, hours)
    sums = staged.groupBy("lat", "lon", "event_time").agg(
        F.count(F.lit(1)).alias("n"), F.count("tone").alias("n_tone"), F.sum("tone").alias("tone_sum"))
    met = _near(left, sums, radius_km=radius_km, window=window).groupBy(*ASK, *more).agg(
        *[F.sum(c).alias(c) for c in ("n", "n_tone", "tone_sum")])
    return left.join(met, ASK).drop("_first", "_last")


#: rows of a list that meets others, and degrees of its tiles: lists go to few tiles
LISTED, LIST_TILE_DEG = 1000, 2.0


def _listed(df: DataFrame, keys: list[str], cols: list[str], name: str) -> DataFrame:
    """``keys, name``: the rows of equal ``keys`` as lists of their ``cols``, ``LISTED`` in a row at most."""
    whole = df.groupBy(*keys).agg(F.collect_list(F.struct(*cols)).alias("_all"))
    starts = F.explode(F.sequence(F.lit(1), F.size("_all"), F.lit(LISTED)))
    return whole.withColumn("_at", starts).select(*keys, F.slice("_all", F.col("_at"), F.lit(LISTED)).alias(name))


def news_pairs(incidents: DataFrame, staged: DataFrame, *, mode: str = "exact",
               radius_km: float = NEWS_RADIUS_KM, hours: int = NEWS_WINDOW_HOURS,
               bin_deg: float = NEWS_BIN_DEG, as_of: str | None = None,
               days: int = NEWS_LOOKBACK_DAYS, digits: int | None = None, brief: bool = False) -> DataFrame:
    """(incident, news) pairs within the radius and the +-hours window.

    With ``as_of`` (the staging date), incidents that cannot reach the staged
    look-back are skipped up front.  Lists meet (``_listed``: incidents that ask alike, news of one place and day), so
    distances are worked out once per two lists, and what is shuffled are the rows of both sides, never pairs of
    either kind: pairs are written from the two lists of a row.  ``tone`` and ``dist_km`` rounded to ``digits``
    (None: as they are) are so before there are pairs.  ``brief``: without ``start_time`` and ``end_time``, which
    are not shuffled then.
    """
    def shown(c):
        return F.col(c) if digits is None else rounded(c, digits).alias(c)
    win = news_window(as_of, days) if as_of else None
    own = ["event_id"] if brief else ["event_id", "start_time", "end_time"]
    asks = _listed(_asking(incidents.select("event_id", "lat", "lon", "start_time", "end_time"), hours), ASK, own,
                   "asking").withColumnsRenamed({"_first": "start_time", "_last": "end_time"})
    places = _listed(staged.select("news_id", "event_time", "lat", "lon", shown("tone")).where(
        F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("event_time").isNotNull()),
        ["lat", "lon", "event_time"], ["news_id", "tone"], "told")
    met = near_in_time(asks, places, radius_km=radius_km, before_hours=0, after_hours=0, right_window=win, bin_deg=bin_deg,
                       tile_deg=LIST_TILE_DEG, mode=mode).drop("start_time", "end_time").withColumn("dist_km", shown("dist_km"))
    pairs = met.select("*", F.inline("asking")).drop("asking").select("*", F.inline("told")).drop("told")
    return pairs.select(
        own[0], "lat", "lon", *own[1:], "news_id", "event_time", "r_lat", "r_lon", "tone", "dist_km")


def news_metrics(pairs: DataFrame) -> DataFrame:
    """news_metrics_recent (A1): rows counted and mean tone per incident.

    Named "articles in 48 h" after the reference, it counts news *events*.
    """
    return count_and_mean(pairs, "event_id", "tone", count_name="news_articles_48h",
                          mean_name="news_tone_48h")


def metrics_near(incidents: DataFrame, staged: DataFrame, *, radius_km: float = NEWS_RADIUS_KM,
                 hours: int = NEWS_WINDOW_HOURS, as_of: str | None = None, days: int = NEWS_LOOKBACK_DAYS) -> DataFrame:
    """``news_metrics(news_pairs(...))`` from sums per place and day: pairs are not made, and the days of a
    window are added up before they meet the incident rows, so each row meets one sum."""
    near = _sums_by([], incidents.select("event_id", "lat", "lon", "start_time", "end_time"), staged, radius_km, hours,
                    news_window(as_of, days) if as_of else None)
    return near.groupBy("event_id").agg(F.sum("n").alias("news_articles_48h"), F.try_divide(
        F.sum("tone_sum"), F.sum("n_tone")).alias("news_tone_48h"))
