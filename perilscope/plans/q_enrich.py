"""Registered queries: news band join, country, population, roads, impact (phase 1/3).

Every query derives its inputs from the driver tables (``perilscope.fixtures``)
and runs over them whole.  Doubles are rounded to 6 places (road km to 3) and
integers cast to bigint in the final projection, on both engines.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.clean import rounded
from ..functions.geo import bbox_from_point
from ..operators import enrich, news, news_daily, scoring, spatial
from ..operators.roads import line_length_in
from ..sources import shapes
from ..session import materialize, scratch_path
from .oracle_fixtures import with_ctes
from .registry import query

AS_OF = fx.AS_OF_NEWS


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ----------------------------------------------------------------- spark chain
def staged_news(spark, d):
    return news.stage_news(fx.news_fx(spark, d), AS_OF)


def pairs(spark, d, **how):
    return news.news_pairs(fx.incidents_fx(spark, d), staged_news(spark, d), as_of=AS_OF, **how)


def metrics(spark, d):
    return news.metrics_near(fx.incidents_fx(spark, d), staged_news(spark, d), as_of=AS_OF)


def enriched(spark, d):
    return enrich.enrich_incidents(fx.incidents_fx(spark, d), fx.countries_fx(spark, d),
                                   fx.population_fx(spark, d), fx.roads_fx(spark, d))


def features(spark, d):
    return scoring.impact_score(scoring.impact_features(enriched(spark, d), metrics(spark, d)))


# ----------------------------------------------------------------- oracle chain
HAV = ("2 * 6371.0088 * asin(sqrt(least(1, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + "
       "cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))")

O_STAGE = ("news_stage", """
select news_id, cast(strptime(cast(sqldate as varchar), '%Y%m%d') as timestamp) as event_time,
       lat, lon, tone, num_articles,
       cast(floor(lat * 2) as bigint) as lat_bin, cast(floor(lon * 2) as bigint) as lon_bin
from news_fx
where sqldate between cast(strftime(date '2024-01-31' - interval 90 day, '%Y%m%d') as int)
                  and cast(strftime(date '2024-01-31', '%Y%m%d') as int)
  and lat between -90 and 90 and lon between -180 and 180
  and tone is not null and num_articles is not null""")

O_PAIRS = ("pairs", f"""
select i.event_id, n.news_id, n.tone, {HAV.format(a='i', b='n')} as dist_km
from incidents_fx i join news_stage n
  on n.event_time between i.start_time - interval 24 hour
                      and coalesce(i.end_time, i.start_time) + interval 24 hour
 and abs(n.lat - i.lat) <= 0.9
where i.lat is not null and i.lon is not null
  and {HAV.format(a='i', b='n')} <= 100""")

O_PAIRS_BINS = ("pairs_bins", f"""
select i.event_id, n.news_id, n.tone, {HAV.format(a='i', b='n')} as dist_km
from incidents_fx i join news_stage n
  on n.lat_bin between cast(floor(i.lat * 2) as bigint) - 2 and cast(floor(i.lat * 2) as bigint) + 2
 and n.lon_bin between cast(floor(i.lon * 2) as bigint) - 2 and cast(floor(i.lon * 2) as bigint) + 2
 and n.event_time between i.start_time - interval 24 hour
                      and coalesce(i.end_time, i.start_time) + interval 24 hour
where i.lat is not null and i.lon is not null
  and {HAV.format(a='i', b='n')} <= 100""")

O_NM = ("nm", """
select event_id, count(*) as news_articles_48h, avg(tone) as news_tone_48h from pairs group by event_id""")

O_LOCATED = ("located", """
select i.*, c.country_id, c.iso_code, c.country_name, c.is_land, c.version
from incidents_fx i left join countries_fx c
  on i.lat > c.min_lat and i.lat < c.max_lat and i.lon > c.min_lon and i.lon < c.max_lon""")

O_BEST = ("best", """
select * exclude (rn, country_id, is_land, version) from (
  select *, row_number() over (partition by event_id order by is_land desc nulls last,
         version desc nulls last, iso_code, country_id) as rn from located) where rn = 1""")

O_POPY = ("popy", """
select c.iso_code, p.year, max(p.midyear_population) as midyear_population
from countries_fx c join population_fx p on upper(c.iso_code) = p.country_code group by 1, 2""")

O_NEEDED = ("needed", """
select * from countries_fx where iso_code in (select iso_code from best where iso_code is not null)""")

O_ROADPAIRS = ("roadpairs", """
select r.road_id, c.country_id, c.iso_code,
       (least(r.lat_b, c.max_lat) - greatest(r.lat_a, c.min_lat)) * 6371.0088 * pi() / 180 as road_km
from {polys} c join roads_fx r
  on r.lon > c.min_lon and r.lon < c.max_lon and r.lat_b > c.min_lat and r.lat_a < c.max_lat""")

O_RK = ("rk", "select iso_code, sum(road_km) as road_km from roadpairs group by iso_code")

O_ENRICHED = ("enriched", """
select b.*, p.midyear_population as population_estimate, coalesce(rk.road_km, 100) as road_km_country
from best b left join popy p on p.iso_code = b.iso_code and p.year = year(b.start_time)
left join rk on rk.iso_code = b.iso_code""")

O_BASE = ("base", """
select e.event_id, e.hazard_type, e.start_time, e.country_name, e.severity,
       log10(1 + coalesce(e.population_estimate, 0)) as log_pop,
       coalesce(n.news_articles_48h, 0) as news_articles_48h,
       coalesce(n.news_tone_48h, 0.0) as news_tone_48h
from enriched e left join nm n using (event_id)""")

O_BYH = ("byh", """
select hazard_type,
       avg(severity) as severity_mean, stddev_pop(severity) as severity_std,
       avg(log_pop) as log_pop_mean, stddev_pop(log_pop) as log_pop_std,
       avg(news_articles_48h) as news_mean, stddev_pop(news_articles_48h) as news_std
from base group by hazard_type""")

O_FEAT = ("feat", """
select b.*,
  (b.severity - h.severity_mean) / nullif(h.severity_std, 0) as z_severity,
  (b.log_pop - h.log_pop_mean) / nullif(h.log_pop_std, 0) as z_log_pop,
  (b.news_articles_48h - h.news_mean) / nullif(h.news_std, 0) as z_news,
  least(100, 20 + 20 * coalesce((b.severity - h.severity_mean) / nullif(h.severity_std, 0), 0)
             + 20 * coalesce((b.log_pop - h.log_pop_mean) / nullif(h.log_pop_std, 0), 0)
             + 10 * coalesce((b.news_articles_48h - h.news_mean) / nullif(h.news_std, 0), 0)
             + 5 * coalesce(b.news_tone_48h / 10.0, 0)) as impact_score
from base b join byh h using (hazard_type)""")

ENRICH_CHAIN = ["incidents_fx", "countries_fx", "population_fx", "roads_fx",
                O_LOCATED, O_BEST, O_POPY, O_NEEDED,
                (O_ROADPAIRS[0], O_ROADPAIRS[1].format(polys="needed")), O_RK, O_ENRICHED]
NEWS_CHAIN = ["news_fx", O_STAGE, O_PAIRS, O_NM]
FEATURE_CHAIN = ENRICH_CHAIN + NEWS_CHAIN + [O_BASE, O_BYH, O_FEAT]


# ----------------------------------------------------------------- queries
@query("grid_bins", with_ctes("news_fx", O_STAGE, body="select news_id, lat_bin, lon_bin from news_stage"))
def q_grid_bins(spark, d):
    return staged_news(spark, d).select("news_id", "lat_bin", "lon_bin")


@query("parse_yyyymmdd", with_ctes("news_fx", body="""
select news_id, sqldate, try_strptime(cast(sqldate as varchar), '%Y%m%d') as event_time from news_fx"""))
def q_parse_yyyymmdd(spark, d):
    from ..functions.clean import parse_yyyymmdd
    return fx.news_fx(spark, d).select("news_id", "sqldate", parse_yyyymmdd("sqldate").alias("event_time"))


@query("lookback_filter", with_ctes("news_fx", body="""
select news_id, cast(strptime(cast(sqldate as varchar), '%Y%m%d') as timestamp) as event_time from news_fx
where sqldate between 20240113 and 20240120 and lat between -90 and 90 and lon between -180 and 180
  and tone is not null and num_articles is not null"""))
def q_lookback(spark, d):
    """A week's look-back inside the month of news: days before it and after it are dropped."""
    return news.stage_news(fx.news_fx(spark, d), "2024-01-20", days=7).select("news_id", "event_time")


@query("staged_news", with_ctes("news_fx", O_STAGE, body="""
select news_id, event_time, round(lat, 6) as lat, round(lon, 6) as lon, round(tone, 6) as tone,
       cast(num_articles as bigint) as num_articles, lat_bin, lon_bin from news_stage"""))
def q_staged(spark, d):
    s = staged_news(spark, d)
    return s.select("news_id", "event_time", r6("lat").alias("lat"), r6("lon").alias("lon"),
                    r6("tone").alias("tone"), F.col("num_articles").cast("bigint").alias("num_articles"),
                    "lat_bin", "lon_bin")


@query("news_near_incident", with_ctes("incidents_fx", *NEWS_CHAIN[:3], body="""
select event_id, news_id, round(tone, 6) as tone, round(dist_km, 6) as dist_km from pairs"""))
def q_news_near(spark, d):
    return pairs(spark, d, digits=6, brief=True).select("event_id", "news_id", "tone", "dist_km")


@query("news_near_incident_bins", with_ctes("incidents_fx", "news_fx", O_STAGE, O_PAIRS_BINS, body="""
select event_id, news_id, round(tone, 6) as tone, round(dist_km, 6) as dist_km from pairs_bins"""))
def q_news_near_bins(spark, d):
    return pairs(spark, d, mode="bins", digits=6, brief=True).select("event_id", "news_id", "tone", "dist_km")


@query("bin_neighbourhood", with_ctes("incidents_fx", body="""
select i.event_id, cast(floor(i.lat * 2) as bigint) + dy as lat_bin, cast(floor(i.lon * 2) as bigint) + dx as lon_bin
from incidents_fx i, (select unnest([-2, -1, 0, 1, 2]) as dy) a, (select unnest([-2, -1, 0, 1, 2]) as dx) b
where i.lat is not null"""))
def q_bin_neighbourhood(spark, d):
    """The 5 x 5 bin offsets of every located incident (UNNEST twice)."""
    offs = F.sequence(F.lit(-2), F.lit(2)).cast("array<bigint>")
    i = fx.incidents_fx(spark, d).where(F.col("lat").isNotNull())
    return (i.select("event_id", F.floor(F.col("lat") * 2).cast("bigint").alias("lb"),
                     F.floor(F.col("lon") * 2).cast("bigint").alias("ob"))
            .withColumn("dy", F.explode(offs)).withColumn("dx", F.explode(offs))
            .select("event_id", (F.col("lb") + F.col("dy")).alias("lat_bin"),
                    (F.col("ob") + F.col("dx")).alias("lon_bin")))


@query("news_metrics", with_ctes("incidents_fx", *NEWS_CHAIN, body="""
select event_id, cast(news_articles_48h as bigint) as news_articles_48h,
       round(news_tone_48h, 6) as news_tone_48h from nm"""))
def q_news_metrics(spark, d):
    return metrics(spark, d).select("event_id", F.col("news_articles_48h").cast("bigint").alias("news_articles_48h"),
                                    r6("news_tone_48h").alias("news_tone_48h"))


@query("news_metrics_daily", with_ctes("incidents_fx", *NEWS_CHAIN, body="""
select event_id, cast(news_articles_48h as bigint) as news_articles_48h,
       round(news_tone_48h, 6) as news_tone_48h from nm"""))
def q_news_metrics_daily(spark, d):
    """A1 kept up day by day: a run of three days before without the incidents that start near its end, then
    one of the day itself that reads those days' news only and meets the new incidents with the days near them."""
    store = news_daily.DailyNews(spark, scratch_path(spark, "news-daily"))
    inc, feed = fx.incidents_fx(spark, d), fx.news_fx(spark, d)
    before = str(dt.date.fromisoformat(AS_OF) - dt.timedelta(days=3))
    store.update(feed, inc.where(F.col("start_time") < F.date_sub(F.lit(before).cast("date"), 2).cast("timestamp_ntz")), before)
    store.update(feed, inc, AS_OF)
    return store.metrics().select("event_id", "news_articles_48h", r6("news_tone_48h").alias("news_tone_48h"))


@query("country_of_incident", with_ctes("incidents_fx", "countries_fx", O_LOCATED, body="""
select event_id, country_id, iso_code, country_name from located"""))
def q_country_of_incident(spark, d):
    polys = fx.countries_fx(spark, d).select("country_id", "iso_code", "country_name", "geom")
    inc = fx.incidents_fx(spark, d).select("event_id", "lat", "lon")
    return spatial.locate(inc, polys).select("event_id", "country_id", "iso_code",
                                                                     "country_name")


@query("best_country", with_ctes("incidents_fx", "countries_fx", O_LOCATED, O_BEST, body="""
select event_id, iso_code, country_name from best"""))
def q_best_country(spark, d):
    inc = fx.incidents_fx(spark, d)
    return enrich.attach_country(inc, fx.countries_fx(spark, d)).select("event_id", "iso_code", "country_name")


@query("population_by_country", with_ctes("countries_fx", "population_fx", body="""
select c.country_id, c.iso_code, c.country_name, cast(p.year as bigint) as year,
       cast(p.midyear_population as bigint) as midyear_population
from countries_fx c join population_fx p on upper(c.iso_code) = p.country_code"""))
def q_population_by_country(spark, d):
    out = enrich.population_by_country(fx.countries_fx(spark, d), fx.population_fx(spark, d))
    return out.select("country_id", "iso_code", "country_name", F.col("year").cast("bigint").alias("year"),
                      F.col("midyear_population").cast("bigint").alias("midyear_population"))


@query("population_for_year", with_ctes(*ENRICH_CHAIN, body="""
select event_id, iso_code, cast(population_estimate as bigint) as population_estimate from enriched"""))
def q_population_for_year(spark, d):
    return enriched(spark, d).select("event_id", "iso_code",
                                     F.col("population_estimate").cast("bigint").alias("population_estimate"))


@query("countries_needed", with_ctes("incidents_fx", "countries_fx", O_LOCATED, O_BEST, O_NEEDED, body="""
select country_id, iso_code from needed"""))
def q_countries_needed(spark, d):
    c = fx.countries_fx(spark, d)
    located = enrich.attach_country(fx.incidents_fx(spark, d), c)
    return enrich.countries_needed(c, located).select("country_id", "iso_code")


@query("road_country_pairs", with_ctes("countries_fx", "roads_fx",
                                       (O_ROADPAIRS[0], O_ROADPAIRS[1].format(polys="countries_fx")), body="""
select road_id, country_id, round(road_km, 3) as road_km from roadpairs"""))
def q_road_country_pairs(spark, d):
    c = fx.countries_fx(spark, d)
    out = line_length_in(fx.roads_fx(spark, d), c, line_key="road_id", poly_key="country_id")
    return out.select("road_id", "country_id", F.round("length_km", 3).alias("road_km"))


@query("multiline_road_pairs", with_ctes("countries_fx", "multi_roads_fx", (
    O_ROADPAIRS[0], O_ROADPAIRS[1].format(polys="countries_fx").replace("roads_fx", "multi_roads_fx")), body="""
select road_id, country_id, round(sum(road_km), 3) as road_km from roadpairs group by road_id, country_id"""))
def q_multiline_road_pairs(spark, d):
    """J7 on roads of several lines, landed as multi-lines: one row per road and country."""
    roads = shapes.road_segments(fx.multi_roads_fx(spark, d), subtype="road")
    out = line_length_in(roads, fx.countries_fx(spark, d), line_key="road_id", poly_key="country_id")
    return out.select("road_id", "country_id", F.round("length_km", 3).alias("road_km"))


@query("road_km_by_country", with_ctes(*ENRICH_CHAIN[:8], (O_ROADPAIRS[0], O_ROADPAIRS[1].format(polys="needed")),
                                       O_RK, body="select iso_code, round(road_km, 3) as road_km from rk"))
def q_road_km_by_country(spark, d):
    c = fx.countries_fx(spark, d)
    located = materialize(enrich.attach_country(fx.incidents_fx(spark, d), c), "located")
    rk = enrich.road_km_by_country(fx.roads_fx(spark, d), enrich.countries_needed(c, located))
    return rk.select("iso_code", F.round("road_km", 3).alias("road_km"))


@query("incidents_enriched", with_ctes(*ENRICH_CHAIN, body="""
select event_id, hazard_type, iso_code, country_name, cast(population_estimate as bigint) as population_estimate,
       round(road_km_country, 3) as road_km_country from enriched"""))
def q_incidents_enriched(spark, d):
    return enriched(spark, d).select(
        "event_id", "hazard_type", "iso_code", "country_name",
        F.col("population_estimate").cast("bigint").alias("population_estimate"),
        F.round("road_km_country", 3).alias("road_km_country"))


@query("log_population", with_ctes(*ENRICH_CHAIN, body="""
select event_id, round(log10(1 + coalesce(population_estimate, 0)), 6) as log_pop from enriched"""))
def q_log_population(spark, d):
    from ..functions.clean import log_population
    return enriched(spark, d).select("event_id", r6(log_population("population_estimate")).alias("log_pop"))


@query("hazard_baselines", with_ctes(*FEATURE_CHAIN[:-1], body="""
select hazard_type, round(severity_mean, 6) as severity_mean, round(severity_std, 6) as severity_std,
       round(log_pop_mean, 6) as log_pop_mean, round(log_pop_std, 6) as log_pop_std,
       round(news_mean, 6) as news_mean, round(news_std, 6) as news_std from byh"""))
def q_hazard_baselines(spark, d):
    base = scoring.impact_features(enriched(spark, d), metrics(spark, d))
    st = scoring.hazard_baselines(base, "hazard_type", {"severity": "severity", "log_pop": "log_pop",
                                                        "news_articles_48h": "news"})
    return st.select("hazard_type", *[r6(c).alias(c) for c in st.columns if c != "hazard_type"])


IMPACT_COLS = ["event_id", "hazard_type", "start_time", "country_name", "severity", "log_pop",
               "news_articles_48h", "news_tone_48h", "z_severity", "z_log_pop", "z_news", "impact_score"]


@query("impact_score", with_ctes(*FEATURE_CHAIN, body="""
select event_id, hazard_type, start_time, country_name, round(severity, 6) as severity,
       round(log_pop, 6) as log_pop, cast(news_articles_48h as bigint) as news_articles_48h,
       round(news_tone_48h, 6) as news_tone_48h, round(z_severity, 6) as z_severity,
       round(z_log_pop, 6) as z_log_pop, round(z_news, 6) as z_news, round(impact_score, 6) as impact_score
from feat"""))
def q_impact_score(spark, d):
    f = features(spark, d)
    return f.select("event_id", "hazard_type", "start_time", "country_name", r6("severity").alias("severity"),
                    r6("log_pop").alias("log_pop"), F.col("news_articles_48h").cast("bigint").alias("news_articles_48h"),
                    *[r6(c).alias(c) for c in ("news_tone_48h", "z_severity", "z_log_pop", "z_news", "impact_score")])


@query("bbox_from_point", with_ctes("incidents_fx", body="""
select event_id,
  round(case when lon - dlon < -180 then lon - dlon + 360 else lon - dlon end, 6) as min_lon,
  round(greatest(lat - dlat, -90.0), 6) as min_lat,
  round(case when lon + dlon > 180 then lon + dlon - 360 else lon + dlon end, 6) as max_lon,
  round(least(lat + dlat, 90.0), 6) as max_lat
from (select event_id, lat, lon, 100 / 111.0 as dlat,
             100 / (111.320 * greatest(cos(radians(lat)), 1e-6)) as dlon
      from incidents_fx where lat is not null)"""))
def q_bbox(spark, d):
    i = fx.incidents_fx(spark, d).where(F.col("lat").isNotNull())
    b = bbox_from_point("lat", "lon", 100.0)
    return i.select("event_id", *[r6(b[k]).alias(k) for k in ("min_lon", "min_lat", "max_lon", "max_lat")])


O_SENS = ("sens", """
select i.event_id, i.hazard_type, i.lat as incident_lat, i.lon as incident_lon, s.location_id,
       s.location_name, s.lat as latitude, s.lon as longitude,
       case when s.country_raw is null then null
            when ltrim(s.country_raw) like '{%' then coalesce(json_extract_string(s.country_raw, '$.code'),
                                                               json_extract_string(s.country_raw, '$.name'))
            when ltrim(s.country_raw) like '[%' then null else s.country_raw end as country,
       cast(null as varchar) as city
from (select *, 100 / 111.0 as dlat, 100 / (111.320 * greatest(cos(radians(lat)), 1e-6)) as dlon
      from incidents_fx where lat is not null) i
join sensors_fx s
  on s.lat between greatest(i.lat - i.dlat, -90.0) and least(i.lat + i.dlat, 90.0)
 and s.lon between i.lon - i.dlon and i.lon + i.dlon""")


def sensors_near(spark, d, **how):
    from ..operators.air import sensors_near_incident
    return sensors_near_incident(fx.incidents_fx(spark, d), fx.sensors_fx(spark, d), **how)


@query("sensors_near_incident", with_ctes("incidents_fx", "sensors_fx", O_SENS, body="""
select event_id, hazard_type, round(incident_lat, 6) as incident_lat, round(incident_lon, 6) as incident_lon,
       location_id, location_name, round(latitude, 6) as latitude, round(longitude, 6) as longitude, country, city
from sens"""))
def q_sensors_near(spark, d):
    return sensors_near(spark, d, digits=6).select(
        "event_id", "hazard_type", "incident_lat", "incident_lon", "location_id", "location_name",
        "latitude", "longitude", "country", "city")


@query("within_distance", with_ctes("incidents_fx", "sensors_fx", O_SENS, body=f"""
select event_id, location_id,
       round({HAV.format(a='x', b='y').replace('x.lat', 'incident_lat').replace('x.lon', 'incident_lon').replace('y.lat', 'latitude').replace('y.lon', 'longitude')}, 6) as dist_km,
       {HAV.format(a='x', b='y').replace('x.lat', 'incident_lat').replace('x.lon', 'incident_lon').replace('y.lat', 'latitude').replace('y.lon', 'longitude')} <= 100 as within_100km
from sens"""))
def q_within_distance(spark, d):
    s = sensors_near(spark, d, distances=True)
    return s.select("event_id", "location_id", rounded("dist_km", 6).alias("dist_km"), (F.col("dist_km") <= 100.0).alias("within_100km"))


@query("incidents_roads_10d", with_ctes("incidents_fx", "countries_fx", "roads_fx",
                                        (O_ROADPAIRS[0], O_ROADPAIRS[1].format(polys="countries_fx")), body="""
select i.event_id, i.hazard_type, i.start_time, i.end_time, c.country_name, c.iso_code,
       round(rbc.road_km, 3) as road_km
from (select * from incidents_fx where lat is not null and lon is not null
        and start_time >= timestamp '2024-01-31 00:00:00' - interval 10 day) i
left join countries_fx c on i.lat > c.min_lat and i.lat < c.max_lat and i.lon > c.min_lon and i.lon < c.max_lon
left join (select country_id, sum(road_km) as road_km from roadpairs group by country_id) rbc
  on rbc.country_id = c.country_id"""))
def q_incidents_roads_10d(spark, d):
    """Step 2B: last-10-day incidents x containing polygons x road km per polygon."""
    out = enrich.incident_roads(fx.incidents_fx(spark, d), fx.countries_fx(spark, d), fx.roads_fx(spark, d), AS_OF)
    return out.withColumn("road_km", F.round("road_km", 3))
