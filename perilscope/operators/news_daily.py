"""News metrics kept up day by day: a run reads the days it does not hold yet and merges their counts.

The store is a folder of batches, one per run, and a list of days (a versioned table) that says which of
them hold:

    staged/b-<n>/event_date=<day>/   located, toned news of the days that run n read
    counts/b-<n>/event_date=<day>/   place, n, tone_sum: pairs of an incident's place and window with a day's news
    places/b-<n>/                    the incident rows (event, position, window) that run n counted
    days/                            event_date, staged (its batch), counts (its first batch), last (n)

A count is a sum over days, so the metrics of a look-back are the merged counts of its days.  Nothing holds
before the list of days is replaced, the last step of a run; a run that fails is repeated as it was.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import file_system, materialize
from ..sources import sinks
from . import news

PLACE = ["event_id", "lat", "lon", "start_time", "end_time"]
#: batches of counts that are read side by side before a run merges them into one
MAX_BATCHES = 16
COUNTS = "place string, n bigint, tone_sum double, event_date date, batch bigint"


def places(incidents: DataFrame) -> DataFrame:
    """Distinct incident rows with their number of ``copies`` and a digest, ``place``, of all that decides
    which news they meet; a row that moves or whose window grows is another place."""
    key = F.sha2(F.to_json(F.struct(*[F.col(c).cast("string") for c in PLACE]), {"ignoreNullFields": "false"}), 256)
    return incidents.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("copies")).withColumn("place", key)


class DailyNews:
    """Staged news and their counts per incident and day in the folder ``path``.  One writer at a time.

    The radius and the window of a store are those of its first run; another value is an error.
    """

    def __init__(self, spark: SparkSession, path: str, *, radius_km: float = news.NEWS_RADIUS_KM,
                 hours: int = news.NEWS_WINDOW_HOURS):
        self.spark, self.path = spark, path.rstrip("/")
        self.radius_km, self.hours = float(radius_km), int(hours)

    # ---------------------------------------------------------------- state
    def _days(self) -> dict[dt.date, dict]:
        """The list of days: at most one row per day of a look-back."""
        if not any(whole for _, _, whole in sinks.versions(self.spark, f"{self.path}/days")):
            return {}
        rows = self.spark.read.parquet(sinks.current(self.spark, f"{self.path}/days")).collect()
        if any((r["radius_km"], r["hours"]) != (self.radius_km, self.hours) for r in rows):
            raise ValueError(f"{self.path} holds counts of another radius or window")
        return {r["event_date"]: r.asDict() for r in rows}

    def _folders(self, kind: str) -> dict[tuple[int, dt.date], str]:
        """(batch, day) -> folder, of all that is there, of failed runs too."""
        fs, root = file_system(self.spark, f"{self.path}/{kind}")
        found = {}
        for batch in fs.listStatus(root) if fs.exists(root) else []:
            n = batch.getPath().getName()
            for day in fs.listStatus(batch.getPath()):
                name = day.getPath().getName()
                if name.startswith("event_date=") and not name.endswith("__"):
                    found[int(n[2:]), dt.date.fromisoformat(name[11:])] = f"{self.path}/{kind}/{n}/{name}"
        return found

    def _read(self, folders: list[str], kind: str, schema: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        by_batch: dict[str, list[str]] = {}
        for f in folders:
            by_batch.setdefault(f.rsplit("/", 2)[1], []).append(f)
        out = None
        for name, days in sorted(by_batch.items()):
            base = f"{self.path}/{kind}/{name}"
            part = self.spark.read.option("basePath", base).parquet(*sorted(days))
            part = part.withColumn("batch", F.lit(int(name[2:])).cast("bigint"))
            out = part if out is None else out.unionByName(part)
        return out

    def _staged(self, days: dict, wanted: Iterable[dt.date]) -> DataFrame:
        there = self._folders("staged")
        keys = [(days[d]["staged"], d) for d in wanted]
        return self._read([there[k] for k in keys if k in there], "staged",
                          "news_id bigint, event_time timestamp_ntz, lat double, lon double, tone double, "
                          "num_articles bigint, lat_bin bigint, lon_bin bigint, event_date date").drop("batch")

    def _counts(self, days: dict, wanted: Iterable[dt.date]) -> DataFrame:
        """place, event_date, n, tone_sum: the latest count of a place and day."""
        wanted = set(wanted)
        held = [f for (n, d), f in self._folders("counts").items()
                if d in wanted and days[d]["counts"] <= n <= days[d]["last"]]
        rows = self._read(held, "counts", COUNTS)
        last = F.max(F.struct("batch", "n", "tone_sum"))
        return rows.groupBy("place", "event_date").agg(last.alias("c")).select("place", "event_date", "c.n", "c.tone_sum")

    # ---------------------------------------------------------------- a run
    def _count(self, inc: DataFrame, staged: DataFrame, days: list[dt.date]) -> DataFrame:
        span = (f"{min(days)} 00:00:00", f"{max(days)} 23:59:59.999999")
        near = news.near_sums(inc.select("place", "lat", "lon", "start_time", "end_time"), staged, radius_km=self.radius_km,
                              hours=self.hours, window=span)
        return near.groupBy("place", F.to_date("event_time").alias("event_date")).agg(
            F.sum("n").alias("n"), F.sum("tone_sum").alias("tone_sum"))

    def update(self, events: DataFrame, incidents: DataFrame, as_of: str, *, days: int = news.NEWS_LOOKBACK_DAYS,
               changed: Iterable[str] = ()) -> list[dt.date]:
        """Brings the store to ``as_of`` and its look-back; returns the days that were read from ``events``.

        Read are the days of the look-back that the store does not hold, and those named in ``changed``
        (late news).  Their news are counted for all incidents; the news of the other days are only opened
        for incidents that are new or have moved, and only the days near these.  Days that leave the
        look-back are dropped.  ``incidents`` is the present table, whole; news without a valid day are not
        staged.
        """
        end = dt.date.fromisoformat(as_of)
        window = [end - dt.timedelta(days=k) for k in range(days, -1, -1)]
        redo = {dt.date.fromisoformat(c) for c in changed}
        held = self._days()
        todo = [d for d in window if d not in held or d in redo]
        keep = [d for d in window if d in held and d not in redo]
        number = max((r["last"] for r in held.values()), default=0) + 1
        batch = f"b-{number:08d}"

        now = materialize(places(incidents), "places")
        now.write.mode("overwrite").parquet(f"{self.path}/places/{batch}")
        parts = []
        if todo:
            ints = [int(d.strftime("%Y%m%d")) for d in todo]
            fresh = events.where(F.col("sqldate").between(min(ints), max(ints)) & F.col("sqldate").isin(ints))
            sinks.stage_partitioned(news.stage_news(fresh, as_of, days=days), f"{self.path}/staged/{batch}", "event_time",
                                    cluster_by=["lat_bin", "lon_bin"])
            here = {d: {"staged": number} for d in todo}
            parts.append(self._count(now, self._staged(here, todo), todo))
        if keep:
            before = self.spark.read.parquet(f"{self.path}/places/b-{next(iter(held.values()))['last']:08d}")
            new = now.join(before.select("place"), "place", "left_anti")
            reach = dt.timedelta(hours=self.hours)
            lo, hi = new.agg(F.min("start_time"), F.max(F.coalesce("end_time", "start_time"))).first()
            near = [d for d in keep if lo and (lo - reach).date() <= d <= (hi + reach).date()]
            if near:
                parts.append(self._count(new, self._staged(held, near), near))
        merge = len({n for n, _ in self._folders("counts")}) >= MAX_BATCHES
        if merge:
            parts.append(self._counts(held, keep).join(now.select("place"), "place", "left_semi"))
        counts = parts[0] if parts else self.spark.createDataFrame([], "place string, event_date date, n bigint, tone_sum double")
        for p in parts[1:]:
            counts = counts.unionByName(p)
        if merge:                                         # a place counted anew and its old count are the same
            counts = counts.groupBy("place", "event_date").agg(F.max(F.struct("n", "tone_sum")).alias("c")).select(
                "place", "event_date", "c.n", "c.tone_sum")
        sinks.write_table(counts, f"{self.path}/counts/{batch}", partition_by=["event_date"], cluster_by=["place"])

        listed = [(d, held[d]["staged"] if d in keep else number,
                   held[d]["counts"] if d in keep and not merge else number, number, self.radius_km, self.hours) for d in window]
        sinks.replace_table(self.spark.createDataFrame(
            listed, "event_date date, staged bigint, counts bigint, last bigint, radius_km double, hours int"), f"{self.path}/days")
        self._clean()
        return todo

    def _clean(self) -> None:
        """Removes what no listed day refers to."""
        days = self._days()
        last = max(r["last"] for r in days.values())
        dead = [f for (n, d), f in self._folders("staged").items() if d not in days or days[d]["staged"] != n]
        dead += [f for (n, d), f in self._folders("counts").items() if d not in days or n < days[d]["counts"]]
        oldest = {"staged": min(r["staged"] for r in days.values()), "counts": min(r["counts"] for r in days.values()),
                  "places": last}
        for kind, first in oldest.items():
            fs, root = file_system(self.spark, f"{self.path}/{kind}")
            for f in fs.listStatus(root) if fs.exists(root) else []:
                if int(f.getPath().getName()[2:]) < first:
                    dead.append(f"{self.path}/{kind}/{f.getPath().getName()}")
        for f in dead:
            fs, p = file_system(self.spark, f)
            fs.delete(p, True)

    # ---------------------------------------------------------------- results
    def staged(self) -> DataFrame:
        """The staged news of the look-back (``news.stage_news`` with ``event_date``)."""
        days = self._days()
        return self._staged(days, days)

    def metrics(self) -> DataFrame:
        """``news.news_metrics`` of the last run's incidents and look-back, from the counts alone."""
        days = self._days()
        last = max((r["last"] for r in days.values()), default=None)
        if last is None:
            raise FileNotFoundError(f"no run in {self.path}")
        inc = self.spark.read.parquet(f"{self.path}/places/b-{last:08d}").select("event_id", "place", "copies")
        per = self._counts(days, days).groupBy("place").agg(F.sum("n").alias("n"), F.sum("tone_sum").alias("s"))
        n = F.sum(F.col("n") * F.col("copies"))
        return per.join(inc, "place").groupBy("event_id").agg(
            n.alias("news_articles_48h"), (F.sum(F.col("s") * F.col("copies")) / n).alias("news_tone_48h"))
