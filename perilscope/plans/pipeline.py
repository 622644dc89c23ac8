"""End-to-end pipeline (E1): feeds -> incidents -> enrichment -> vectors -> briefs -> actions.

A plain ordered list of steps ``(name, function, inputs)``.  Each step is a pure
``DataFrame -> DataFrame`` function; its result is written as a parquet table
under ``out_dir/<name>`` and the next steps read that table back, so every
step starts from stored data (lineage is cut, a lost executor only re-runs the
current step, and a re-run with the same ``as_of`` replaces the tables by equal ones).
A table is replaced by a new version beside the old one, so a step that fails leaves the old
table readable, and what a step stores for itself is removed when its table is written.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import incident_description
from ..operators import air, enrich, generate, news, news_daily, normalize, scoring, vector_index, vectors
from ..sources import sinks


@dataclass
class Sources:
    """Landed inputs, already read (see ``perilscope.sources.files``)."""
    storms: DataFrame
    tracks: DataFrame
    quakes: DataFrame
    news_events: DataFrame          # news_id, sqldate, lat, lon, tone, num_articles
    countries: DataFrame            # country_id, iso_code, country_name, is_land, version, geom
    population: DataFrame           # country_code, year, midyear_population
    roads: DataFrame                # road_id, geom (line)
    sites: DataFrame                # location_id, lat, lon, location_name, country_raw
    measurements: DataFrame | None = None   # location_id, pollutant, ts, value


@dataclass
class Options:
    as_of: str                      # news staging date and search date (YYYY-MM-DD)
    news_days: int = news.NEWS_LOOKBACK_DAYS
    sensor_days: int = air.SENSOR_LOOKBACK_DAYS
    search: str = "exact"           # or "ivf": a share of the lists, which can miss neighbours
    ivf_lists: int = vectors.IVF_LISTS
    ivf_share: float = vectors.IVF_SHARE
    index_path: str | None = None   # with "ivf": a stored index, opened, extended by new vectors and searched
    text_provider: object = None    # None -> offline provider
    embed_provider: Callable | None = None
    embed_name: str = "provider"    # of the provider's vectors in the store
    embed_store: str | None = None  # folder of vectors that the provider gave before
    empty_input: str = "error"      # or "skip"
    daily_path: str | None = None   # a store of daily news counts: only days it does not hold are read
    changed_days: tuple[str, ...] = ()   # with it: days of late news, read again


Step = tuple[str, Callable[..., DataFrame], list[str]]


def steps(src: Sources, opt: Options) -> list[Step]:
    as_of = opt.as_of

    def incidents_raw():
        return normalize.union_incidents(src.storms, src.tracks, src.quakes)

    def gdelt_recent_sig():
        return news.stage_news(src.news_events, as_of, days=opt.news_days)

    def news_metrics_recent(inc, staged):
        # the look-back holds on read too, whatever the stored table carries
        recent = staged.where(news.lookback_days("event_time", as_of, opt.news_days))
        return news.metrics_near(inc, recent, as_of=as_of, days=opt.news_days)

    def news_metrics_daily(inc):
        store = news_daily.DailyNews(inc.sparkSession, opt.daily_path)
        store.update(src.news_events, inc, as_of, days=opt.news_days, changed=opt.changed_days)
        return store.metrics()

    def openaq_locations_near_incidents(inc):
        lo = F.date_sub(F.lit(as_of).cast("date"), opt.sensor_days).cast("timestamp_ntz")
        return air.sensors_near_incident(inc.where(F.col("start_time") >= lo), src.sites)

    def air_quality_metrics(inc):
        if src.measurements is None:
            spark = inc.sparkSession
            return spark.createDataFrame([], "event_id string, pm25_before double, pm25_after double, "
                                             "pm10_before double, pm10_after double")
        return air.air_quality_before_after(inc, src.sites, src.measurements)

    def incidents_roads_10d(inc):
        return enrich.incident_roads(inc, src.countries, src.roads, as_of)

    def incidents_enriched(inc):
        return enrich.enrich_incidents(inc, src.countries, src.population, src.roads)

    def incident_corpus(enr, aq, nm):
        e = enr.join(aq, "event_id", "left").join(nm, "event_id", "left")
        return e.select("event_id", incident_description(set(e.columns)).alias("description"))

    def incident_embeddings_arr(corpus):
        return vectors.embed(corpus, "event_id", "description", provider=opt.embed_provider, name=opt.embed_name,
                             store=opt.embed_store)

    def incident_embeddings_wide(enr, emb):
        return enr.select("event_id", "hazard_type", F.to_date("start_time").alias("event_date"),
                          "country_name").join(emb, "event_id", "inner")

    def similar_incidents_top5(wide):
        base = vectors.recent(wide, "event_date", as_of, vectors.BASE_SPAN_MONTHS)
        qry = vectors.recent(wide, "event_date", as_of, vectors.QUERY_SPAN_MONTHS)
        if opt.search == "ivf" and opt.index_path:
            index = vector_index.refresh(base, opt.index_path, n_lists=opt.ivf_lists)
            return index.search(qry, share=opt.ivf_share, base=vector_index.with_hash(base), same=("vec_hash",))
        if opt.search == "ivf":
            return vectors.similar_ivf(base, qry, n_lists=opt.ivf_lists, share=opt.ivf_share)
        return vectors.similar(base, qry)

    def incident_features_recent(enr, nm):
        # inputs are stored tables; the join of the two is cheap to run twice
        return scoring.impact_score(scoring.impact_features(enr, nm), materialize_input=False)

    def incident_tags(feat):
        return generate.hazard_buckets(feat, opt.text_provider)

    def incident_briefs(sim, feat, tags):
        return generate.pair_briefs(generate.pair_features(sim, feat, tags), opt.text_provider)

    def incident_actions(sim):
        return generate.actions_from_json(generate.action_replies(sim, opt.text_provider))

    # with a daily store the staged news stay in it, by day
    signals = [("news_metrics_recent", news_metrics_daily, ["incidents_raw"])] if opt.daily_path else [
        ("gdelt_recent_sig", gdelt_recent_sig, []),
        ("news_metrics_recent", news_metrics_recent, ["incidents_raw", "gdelt_recent_sig"])]
    return [
        ("incidents_raw", incidents_raw, []),
        *signals,
        ("openaq_locations_near_incidents", openaq_locations_near_incidents, ["incidents_raw"]),
        ("air_quality_metrics", air_quality_metrics, ["incidents_raw"]),
        ("incidents_roads_10d", incidents_roads_10d, ["incidents_raw"]),
        ("incidents_enriched", incidents_enriched, ["incidents_raw"]),
        ("incident_corpus", incident_corpus, ["incidents_enriched", "air_quality_metrics", "news_metrics_recent"]),
        ("incident_embeddings_arr", incident_embeddings_arr, ["incident_corpus"]),
        ("incident_embeddings_wide", incident_embeddings_wide, ["incidents_enriched", "incident_embeddings_arr"]),
        ("similar_incidents_top5", similar_incidents_top5, ["incident_embeddings_wide"]),
        ("incident_features_recent", incident_features_recent, ["incidents_enriched", "news_metrics_recent"]),
        ("incident_tags", incident_tags, ["incident_features_recent"]),
        ("incident_briefs", incident_briefs, ["similar_incidents_top5", "incident_features_recent", "incident_tags"]),
        ("incident_actions", incident_actions, ["similar_incidents_top5"]),
    ]


# physical layout of the stored tables (K2, K3)
LAYOUT = {
    "gdelt_recent_sig": dict(partition_by=["event_date"], cluster_by=["lat_bin", "lon_bin"]),
    "incidents_enriched": dict(cluster_by=["hazard_type", "iso_code"]),
    "incident_actions": dict(cluster_by=["query_event", "priority"]),
}


def run(spark: SparkSession, src: Sources, out_dir: str, opt: Options,
        only: list[str] | None = None, database: str | None = None) -> dict[str, str]:
    """Run the steps in order; returns ``{table: path}``, the folder of each table's present version.

    ``only``: the steps to run; the others' tables are taken as they are.  ``database``: created if it is
    not there, with a view of every table.  ``opt.empty_input``: what to do when no source has an
    incident (K8): ``error`` stops the run before any table is written, ``skip`` leaves the stored
    tables as they are.
    """
    from ..session import scratch_scope, ship_package
    ship_package(spark)
    if not sinks.require_rows(normalize.union_incidents(src.storms, src.tracks, src.quakes), "incidents",
                              policy=opt.empty_input):
        return {}
    paths: dict[str, str] = {}
    for name, fn, inputs in steps(src, opt):
        path = os.path.join(out_dir, name)
        if only is not None and name not in only:
            if any(whole for _, _, whole in sinks.versions(spark, path)):
                paths[name] = sinks.current(spark, path)
            continue
        with scratch_scope(spark):
            df = fn(*[spark.read.parquet(paths[i]) for i in inputs])
            lay = LAYOUT.get(name, {})
            if "partition_by" in lay:
                paths[name] = sinks.replace_table(df, path, date_col="event_time", cluster_by=lay["cluster_by"])
            else:
                paths[name] = sinks.replace_table(df, path, cluster_by=lay.get("cluster_by", ()))
    if database:
        sinks.ensure_database(spark, database)
        for name, path in paths.items():
            spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT * FROM parquet.`{path}`")
    return paths


def sample_actions(spark: SparkSession, paths: dict[str, str], n: int = 10) -> DataFrame:
    """Step 13: the first ``n`` actions in a stated total order (K7)."""
    a = spark.read.parquet(paths["incident_actions"])
    return a.orderBy("query_event", *[F.col(c).asc_nulls_first() for c in ("priority", "action", "owner",
                                                                             "eta_hours")]).limit(n)
