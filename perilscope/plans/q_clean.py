"""Registered queries: cleaning, the three-feed union, landed-file sources, sinks (phase 2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import clean
from ..operators import normalize
from ..session import scratch_path
from ..sources import files, shapes, sinks
from .oracle_fixtures import with_ctes
from .q_enrich import O_STAGE, r6, staged_news
from .registry import query

INT_RX = r"'(-?\d+)'"
FLT_RX = r"'(-?\d+(\.\d+)?)'"


def _o_int(c):
    return f"try_cast(nullif(regexp_extract(trim({c}), {INT_RX}, 1), '') as bigint)"


def _o_flt(c):
    return f"try_cast(nullif(regexp_extract(replace(trim({c}), ',', ''), {FLT_RX}, 1), '') as double)"


O_QC = ("qc", f"""
select id, {_o_int('year')} as year, {_o_int('month')} as month, {_o_int('day')} as day,
       {_o_int('hour')} as hour, {_o_int('minute')} as minute, {_o_int('second')} as second,
       {_o_flt('latitude')} as latitude, {_o_flt('longitude')} as longitude, {_o_flt('eqmagnitude')} as eqmagnitude
from quakes_fx""")

O_QTS = """case when year >= 1 and month between 1 and 12 and day between 1 and 31 and hour between 0 and 23
     and minute between 0 and 59 and coalesce(cast(second as double), 0) between 0 and 59.9999
     then try(make_timestamp(year, month, day, hour, minute, floor(coalesce(cast(second as double), 0)))) end"""

O_UNION = ("u", f"""
select 'storm' as hazard_type, event_id, event_begin_time as start_time, event_end_time as end_time,
       case when event_latitude between -90 and 90 and event_longitude between -180 and 180 then event_latitude end as lat,
       case when event_latitude between -90 and 90 and event_longitude between -180 and 180 then event_longitude end as lon,
       event_type, cast(magnitude as double) as severity,
       cast(coalesce(deaths_direct, 0) + coalesce(deaths_indirect, 0) as bigint) as fatalities,
       cast(coalesce(injuries_direct, 0) + coalesce(injuries_indirect, 0) as bigint) as injuries,
       cast(coalesce(damage_property, 0) + coalesce(damage_crops, 0) as bigint) as damage_usd,
       'NOAA Storms' as source
from storms_fx
union all
select 'hurricane', sid, try_cast(iso_time as timestamp), try_cast(iso_time as timestamp),
       case when try_cast(lat as double) between -90 and 90 and try_cast(lon as double) between -180 and 180 then try_cast(lat as double) end,
       case when try_cast(lat as double) between -90 and 90 and try_cast(lon as double) between -180 and 180 then try_cast(lon as double) end,
       'tropical cyclone', try_cast(wmo_wind as double), null::bigint, null::bigint, null::bigint, 'IBTrACS v04r01'
from tracks_fx
where try_cast(iso_time as timestamp) is not null and year(try_cast(iso_time as timestamp)) between 1901 and 2025
union all
select 'earthquake', cast(id as varchar), {O_QTS}, {O_QTS}, latitude, longitude, 'earthquake', eqmagnitude,
       null::bigint, null::bigint, null::bigint, 'NOAA Significant Earthquakes (HazEL)'
from qc
where latitude between -90 and 90 and longitude between -180 and 180 and year between 1901 and 2025""")

UNION_CHAIN = ["storms_fx", "tracks_fx", "quakes_fx", O_QC, O_UNION]


def union(spark, d):
    return normalize.union_incidents(fx.storms_fx(spark, d), fx.tracks_fx(spark, d), fx.quakes_fx(spark, d))


@query("incidents_union", with_ctes(*UNION_CHAIN, body="""
select hazard_type, event_id, start_time, end_time, round(lat, 6) as lat, round(lon, 6) as lon, event_type,
       round(severity, 6) as severity, fatalities, injuries, damage_usd, source from u"""))
def q_incidents_union(spark, d):
    u = union(spark, d)
    return u.select("hazard_type", "event_id", "start_time", "end_time", r6("lat").alias("lat"),
                    r6("lon").alias("lon"), "event_type", r6("severity").alias("severity"),
                    "fatalities", "injuries", "damage_usd", "source")


@query("null_safe_totals", with_ctes("storms_fx", body="""
select event_id, cast(coalesce(deaths_direct, 0) + coalesce(deaths_indirect, 0) as bigint) as fatalities,
       cast(coalesce(injuries_direct, 0) + coalesce(injuries_indirect, 0) as bigint) as injuries,
       cast(coalesce(damage_property, 0) + coalesce(damage_crops, 0) as bigint) as damage_usd from storms_fx"""))
def q_null_safe_totals(spark, d):
    s = fx.storms_fx(spark, d)
    return s.select("event_id",
                    clean.null_safe_sum("deaths_direct", "deaths_indirect").cast("bigint").alias("fatalities"),
                    clean.null_safe_sum("injuries_direct", "injuries_indirect").cast("bigint").alias("injuries"),
                    clean.null_safe_sum("damage_property", "damage_crops").cast("bigint").alias("damage_usd"))


@query("safe_cast", with_ctes("tracks_fx", body="""
select sid, iso_time, try_cast(iso_time as timestamp) as start_time, try_cast(lat as double) as lat,
       try_cast(lon as double) as lon, try_cast(wmo_wind as double) as severity from tracks_fx"""))
def q_safe_cast(spark, d):
    t = fx.tracks_fx(spark, d)
    return t.select("sid", "iso_time", clean.safe_cast("iso_time", "timestamp_ntz").alias("start_time"),
                    clean.safe_cast("lat", "double").alias("lat"), clean.safe_cast("lon", "double").alias("lon"),
                    clean.safe_cast("wmo_wind", "double").alias("severity"))


@query("coerce_int", with_ctes("quakes_fx", O_QC, body="select id, year, month, day, hour, minute, second from qc"))
def q_coerce_int(spark, d):
    q = fx.quakes_fx(spark, d)
    return q.select("id", *[clean.coerce_int(c).alias(c) for c in ("year", "month", "day", "hour", "minute", "second")])


@query("coerce_float", with_ctes("quakes_fx", O_QC, body="""
select id, round(latitude, 6) as latitude, round(longitude, 6) as longitude, round(eqmagnitude, 6) as eqmagnitude from qc"""))
def q_coerce_float(spark, d):
    q = fx.quakes_fx(spark, d)
    return q.select("id", *[r6(clean.coerce_float(c)).alias(c) for c in ("latitude", "longitude", "eqmagnitude")])


@query("datetime_from_parts", with_ctes("quakes_fx", O_QC, body=f"select id, {O_QTS} as start_time from qc"))
def q_datetime_from_parts(spark, d):
    q = normalize.coerce_quakes(fx.quakes_fx(spark, d))
    return q.select("id", clean.datetime_from_parts("year", "month", "day", "hour", "minute", "second")
                    .alias("start_time"))


@query("valid_coords", with_ctes("quakes_fx", O_QC, body="""
select id, coalesce(latitude between -90 and 90 and longitude between -180 and 180, false) as valid from qc"""))
def q_valid_coords(spark, d):
    q = normalize.coerce_quakes(fx.quakes_fx(spark, d))
    return q.select("id", F.coalesce(clean.valid_coords("latitude", "longitude"), F.lit(False)).alias("valid"))


@query("year_range", with_ctes("tracks_fx", body="""
select sid, iso_time, coalesce(year(try_cast(iso_time as timestamp)) between 1901 and 2025, false) as in_range
from tracks_fx"""))
def q_year_range(spark, d):
    t = fx.tracks_fx(spark, d)
    return t.select("sid", "iso_time", F.coalesce(clean.year_between(F.col("iso_time").try_cast("timestamp_ntz")),
                                                  F.lit(False)).alias("in_range"))


@query("pick_label", with_ctes("sensors_fx", body="""
select location_id, country_raw,
       case when country_raw is null then null
            when ltrim(country_raw) like '{%' then coalesce(json_extract_string(country_raw, '$.code'),
                                                             json_extract_string(country_raw, '$.name'))
            when ltrim(country_raw) like '[%' then null else country_raw end as country from sensors_fx"""))
def q_pick_label(spark, d):
    s = fx.sensors_fx(spark, d)
    return s.select("location_id", "country_raw", clean.pick_label("country_raw", ("code", "name")).alias("country"))


@query("format_iso_minute", with_ctes("incidents_fx", body="""
select event_id, strftime(start_time, '%Y-%m-%dT%H:%MZ') as when_text from incidents_fx"""))
def q_format_iso_minute(spark, d):
    return fx.incidents_fx(spark, d).select("event_id", clean.format_iso_minute("start_time").alias("when_text"))


@query("dedupe_by_key", with_ctes("tracks_fx", body="""
select sid, iso_time, lat, lon, wmo_wind from (
  select *, row_number() over (partition by sid order by try_cast(iso_time as timestamp) asc nulls last,
         iso_time asc nulls last, lat asc nulls last, lon asc nulls last, wmo_wind asc nulls last) as rn
  from tracks_fx) where rn = 1"""))
def q_dedupe_by_key(spark, d):
    t = fx.tracks_fx(spark, d)
    order = [F.col("iso_time").try_cast("timestamp_ntz").asc_nulls_last()] + \
            [F.col(c).asc_nulls_last() for c in ("iso_time", "lat", "lon", "wmo_wind")]
    return normalize.dedupe_by_key(t, "sid", order).select("sid", "iso_time", "lat", "lon", "wmo_wind")


@query("quakes_deduped", with_ctes("quakes_fx", body=f"""
select {', '.join(f'cast({c} as varchar) as {c}' for c in ('id', 'year', 'month', 'day', 'hour', 'minute', 'second', 'latitude', 'longitude', 'eqmagnitude'))}
from quakes_fx"""))
def q_quakes_deduped(spark, d):
    """Overlapping pages bring every quake three times, once with a later value; one row per id stays."""
    q = fx.quakes_fx(spark, d)
    later = q.withColumn("eqmagnitude", F.concat(F.lit("~"), F.coalesce("eqmagnitude", F.lit(""))))
    out = normalize.dedupe_quakes(q.unionByName(q).unionByName(later))
    return out.select(*[F.col(c).cast("string").alias(c) for c in QUAKE_FIELDS])


@query("tables_by_readback", with_ctes("incidents_fx", body="""
select event_id, hazard_type, cast(row_number() over (order by event_id) - 1 as bigint) as "index" from incidents_fx"""))
def q_tables_by_readback(spark, d):
    """K1, K3, K4, K8: indexed by id, written clustered, guarded against emptiness, and read back."""
    t = sinks.with_index(fx.incidents_fx(spark, d).select("event_id", "hazard_type"), ["event_id"])
    path = sinks.write_table(t, scratch_path(spark, "indexed-incidents"), cluster_by=["hazard_type", "event_id"])
    back = spark.read.parquet(path)
    sinks.require_rows(back, "incidents")
    return back.select("event_id", "hazard_type", F.col("index").cast("bigint").alias("index"))


AQ_UNION = """
select u.event_id, a.row_id, a.pollutant, a.value,
  max(case when a.ts >= u.start_time - interval 24 hour and a.ts < u.start_time then 1 else 0 end) as before,
  max(case when a.ts > coalesce(u.end_time, u.start_time) and a.ts <= coalesce(u.end_time, u.start_time) + interval 24 hour then 1 else 0 end) as after
from (select *, 100 / 111.0 as dlat, 100 / (111.320 * greatest(cos(radians(lat)), 1e-6)) as dlon from u where lat is not null) u
join sensors_fx s on s.lat between greatest(u.lat - u.dlat, -90.0) and least(u.lat + u.dlat, 90.0)
 and s.lon between u.lon - u.dlon and u.lon + u.dlon
join (select *, row_number() over () as row_id from air_fx) a on a.location_id = s.location_id and a.pollutant in ('pm25', 'pm10')
 and a.ts between u.start_time - interval 24 hour and coalesce(u.end_time, u.start_time) + interval 24 hour
group by 1, 2, 3, 4"""


@query("air_quality_repeated_ids", with_ctes(*UNION_CHAIN, "sensors_fx", "air_fx", ("aqu", AQ_UNION), body="""
select event_id,
  round(avg(case when pollutant = 'pm25' and before = 1 then value end), 6) as pm25_before,
  round(avg(case when pollutant = 'pm25' and after = 1 then value end), 6) as pm25_after,
  round(avg(case when pollutant = 'pm10' and before = 1 then value end), 6) as pm10_before,
  round(avg(case when pollutant = 'pm10' and after = 1 then value end), 6) as pm10_after
from aqu where before = 1 or after = 1 group by event_id"""))
def q_air_quality_repeated_ids(spark, d):
    """I1 on the union feed, where a storm has a row per track point: each point pairs its own sensors with its own window."""
    from ..operators import air
    a = air.air_quality_before_after(union(spark, d), fx.sensors_fx(spark, d), fx.air_fx(spark, d))
    return a.select("event_id", *[r6(c).alias(c) for c in ("pm25_before", "pm25_after", "pm10_before", "pm10_after")])


@query("load_report", with_ctes("storms_fx", "tracks_fx", "quakes_fx", body="""
select 'storms' as table_name, count(*)::bigint as n_rows, 13::bigint as n_columns from storms_fx
union all select 'tracks', count(*)::bigint, 5::bigint from tracks_fx
union all select 'quakes', count(*)::bigint, 10::bigint from quakes_fx"""))
def q_load_report(spark, d):
    return sinks.load_report({"storms": fx.storms_fx(spark, d), "tracks": fx.tracks_fx(spark, d),
                              "quakes": fx.quakes_fx(spark, d)})


# --------------------------------------------------------------- landed files
STORM_COLS = ["event_id", "event_begin_time", "event_end_time", "event_latitude", "event_longitude",
              "event_type", "magnitude", "deaths_direct", "deaths_indirect", "injuries_direct",
              "injuries_indirect", "damage_property", "damage_crops"]


@query("scan_wildcard", with_ctes("storms_fx", body="""
select event_id, event_begin_time, event_end_time, round(event_latitude, 6) as event_latitude,
       round(event_longitude, 6) as event_longitude, event_type, round(magnitude, 6) as magnitude,
       cast(deaths_direct as bigint) as deaths_direct, cast(deaths_indirect as bigint) as deaths_indirect,
       cast(injuries_direct as bigint) as injuries_direct, cast(injuries_indirect as bigint) as injuries_indirect,
       cast(damage_property as bigint) as damage_property, cast(damage_crops as bigint) as damage_crops
from storms_fx"""))
def q_scan_wildcard(spark, d):
    """Storm feed landed as five yearly tables, read back with one ``storms_*`` scan."""
    storms = fx.storms_fx(spark, d)
    base = scratch_path(spark, "landed-storms")
    for k in range(5):
        sinks.write_table(storms.where(F.pmod(F.col("event_id").cast("bigint"), F.lit(5)) == k),
                          f"{base}/storms_{2020 + k}")
    s = files.read_wildcard(spark, f"{base}/storms_*")
    ints = ["deaths_direct", "deaths_indirect", "injuries_direct", "injuries_indirect", "damage_property",
            "damage_crops"]
    return s.select(*[r6(c).alias(c) if c in ("event_latitude", "event_longitude", "magnitude")
                      else F.col(c).cast("bigint").alias(c) if c in ints else F.col(c) for c in STORM_COLS])


@query("csv_track_load", with_ctes("tracks_fx", body="select sid, iso_time, lat, lon, wmo_wind from tracks_fx"))
def q_csv_track_load(spark, d):
    """Track feed landed as CSV (upper-case header, every field quoted), read back as text."""
    t = fx.tracks_fx(spark, d)
    path = scratch_path(spark, "landed-tracks-csv")
    (t.select(*[F.col(c).alias(c.upper()) for c in t.columns]).write.mode("overwrite")
     .option("header", "true").option("quoteAll", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
    return files.read_csv_landed(spark, path, ["sid", "iso_time", "lat", "lon", "wmo_wind"])


QUAKE_FIELDS = ["id", "year", "month", "day", "hour", "minute", "second", "latitude", "longitude", "eqmagnitude"]


def _land_pages(df, path, *, group, page, shape):
    """Write ``df`` as JSON page files ``<path>/<group>=G/page=N/part-*``, one page per file.

    ``page`` numbers the page of a row from its key, so a page holds a bounded
    number of items and no window over a whole group is needed.
    """
    keys = [*group, "page"]
    cols = [c for c in df.columns if c not in group]
    bodies = (df.withColumn("page", page.cast("int")).groupBy(*keys)
              .agg(F.to_json(F.collect_list(F.struct(*cols))).alias("_items")))
    bodies = bodies.withColumn("value", shape(F.col("page"), F.col("_items"))).select(*keys, "value")
    bodies.repartition(*keys).write.mode("overwrite").partitionBy(*keys).text(path)
    return bodies


@query("quake_pages_load", with_ctes("quakes_fx", body=f"""
select {', '.join(f'cast({c} as varchar) as {c}' for c in QUAKE_FIELDS)} from quakes_fx"""))
def q_quake_pages_load(spark, d):
    """Quake feed landed as API pages: ``{"items": [...]}`` or a bare list, plus
    an empty page and an object without items; read back as text fields."""
    q = fx.quakes_fx(spark, d).withColumn("yr", F.pmod(F.col("id"), F.lit(7)))
    path = scratch_path(spark, "landed-quake-pages")
    shape = lambda page, items: F.when(page % 2 == 0, items).otherwise(
        F.concat(F.lit('{"items":'), items, F.lit("}")))
    bodies = _land_pages(q, path, group=["yr"], page=F.floor(F.pmod("id", F.lit(10_000_000)) / (7 * 200)) + 1, shape=shape)
    # an empty page and one without the list per bucket: both must yield no rows
    last = bodies.groupBy("yr").agg(F.max("page").alias("page"))
    tail = (last.select("yr", (F.col("page") + 1).alias("page"), F.lit('{"items": []}').alias("value"))
            .unionByName(last.select("yr", (F.col("page") + 2).alias("page"), F.lit('{"next": null}').alias("value"))))
    tail.repartition("yr", "page").write.mode("append").partitionBy("yr", "page").text(path)
    return files.read_json_pages(spark, path, QUAKE_FIELDS, list_keys=("items",))


SENSOR_FIELDS = ["location_id", "lat", "lon", "country_raw", "location_name"]


@query("sensor_pages_load", with_ctes("sensors_fx", body=f"""
select {', '.join(f'cast({c} as varchar) as {c}' for c in SENSOR_FIELDS)} from sensors_fx"""))
def q_sensor_pages_load(spark, d):
    """Sensor locations landed as paged ``{"results": [...]}`` bodies per request; an empty
    page ends a request, and a page after it is never read."""
    s = fx.sensors_fx(spark, d).withColumn("query", F.pmod(F.col("location_id"), F.lit(11)))
    path = scratch_path(spark, "landed-sensor-pages")
    shape = lambda page, items: F.concat(F.lit('{"results":'), items, F.lit("}"))
    bodies = _land_pages(s, path, group=["query"], page=F.floor(F.col("location_id") / (11 * 100)) + 1,
                         shape=shape)
    last = bodies.groupBy("query").agg(F.max("page").alias("page"))
    tail = (last.select("query", (F.col("page") + 1).alias("page"), F.lit('{"results": []}').alias("value"))
            .unionByName(last.select("query", (F.col("page") + 2).alias("page"),
                                     F.lit('{"results": [{"location_id": "-1", "lat": "0", "lon": "0"}]}')
                                     .alias("value"))))
    tail.repartition("query", "page").write.mode("append").partitionBy("query", "page").text(path)
    out = files.read_json_pages(spark, path, SENSOR_FIELDS + ["query"], list_keys=("results",),
                                stop_at_empty=True)
    return out.select(*SENSOR_FIELDS)


BOX_POINTS = ["min_lon min_lat", "max_lon min_lat", "max_lon max_lat", "min_lon max_lat", "min_lon min_lat"]
_AREA_SQL = """
select c.country_id, c.iso_code, c.country_name, c.is_land, cast(c.version as bigint) as version,
       round(min_lon, 6) as first_lon, round(max_lat, 6) as third_lat, 1::bigint as n_parts, 5::bigint as n_points
from countries_fx c"""


def _landed_areas(spark, d, geometry):
    """Division areas as they land: names as a struct, flags as text, regions and shapeless areas among them."""
    c = fx.countries_fx(spark, d)
    rows = c.select(F.col("country_id").alias("id"), F.struct(F.col("country_name").alias("primary")).alias("names"),
                    F.col("iso_code").alias("country"), F.lit("country").alias("subtype"),
                    F.col("is_land").cast("string").alias("is_land"), F.col("version").cast("string").alias("version"),
                    geometry.alias("geometry"))
    other = rows.withColumn("subtype", F.lit("region"))
    return rows.unionByName(other).unionByName(rows.withColumn("geometry", F.lit(None).cast(rows.schema["geometry"].dataType)))


def _areas_out(a):
    return a.select("country_id", "iso_code", "country_name", "is_land", "version",
                    r6(F.col("geom")[0][0][0]["lon"]).alias("first_lon"), r6(F.col("geom")[0][0][2]["lat"]).alias("third_lat"),
                    F.size("geom").cast("bigint").alias("n_parts"), F.size(F.col("geom")[0][0]).cast("bigint").alias("n_points"))


@query("division_area_load", with_ctes("countries_fx", body=_AREA_SQL))
def q_division_area_load(spark, d):
    """S5/F5 from GeoJSON: country areas only, names.primary, cast flags, decoded rings."""
    pts = [F.format_string("[%s,%s]", *[F.col(x).cast("string") for x in p.split()]) for p in BOX_POINTS]
    g = F.concat(F.lit('{"type":"Polygon","coordinates":[['), F.concat_ws(",", *pts), F.lit("]]}"))
    return _areas_out(shapes.division_areas(_landed_areas(spark, d, g)))


@query("segment_load", with_ctes("roads_fx", body="""
select road_id, round(lon, 6) as lon, round(lat_a, 6) as lat_a, round(lat_b, 6) as lat_b from roads_fx"""))
def q_segment_load(spark, d):
    """S5 from GeoJSON lines; rails and shapeless segments are left out."""
    r = fx.roads_fx(spark, d)
    s = [F.col(c).cast("string") for c in ("lon", "lat_a", "lon", "lat_b")]
    g = F.format_string('{"type":"LineString","coordinates":[[%s,%s],[%s,%s]]}', *s)
    rows = r.select(F.col("road_id").alias("id"), F.lit("road").alias("subtype"), g.alias("geometry"))
    landed = rows.unionByName(rows.withColumn("subtype", F.lit("rail"))).unionByName(
        rows.withColumn("geometry", F.lit(None).cast("string")))
    return shapes.road_segments(landed, subtype="road").select(
        "road_id", r6(F.col("geom")[0][0]["lon"]).alias("lon"), r6(F.col("geom")[0][0]["lat"]).alias("lat_a"),
        r6(F.col("geom")[0][1]["lat"]).alias("lat_b"))


@query("sensor_items", with_ctes("sensors_fx", body="""
select location_id, round(lat, 6) as lat, round(lon, 6) as lon, location_name,
       case when country_raw is null then null
            when ltrim(country_raw) like '{%' then coalesce(json_extract_string(country_raw, '$.code'),
                                                             json_extract_string(country_raw, '$.name'))
            else country_raw end as country from sensors_fx"""))
def q_sensor_items(spark, d):
    """Sensor lists in the service's shape: coordinates as an object, names and countries as objects or text."""
    s = fx.sensors_fx(spark, d)
    country = F.when(F.col("country_raw").startswith("{"), F.col("country_raw")).when(
        F.col("country_raw").isNotNull(), F.concat(F.lit('"'), F.col("country_raw"), F.lit('"'))).otherwise(F.lit("null"))
    body = F.concat(F.lit('{"id":'), F.col("location_id").cast("string"), F.lit(',"name":"'), F.col("location_name"),
                    F.lit('","coordinates":{"latitude":'), F.col("lat").cast("string"), F.lit(',"longitude":'),
                    F.col("lon").cast("string"), F.lit('},"country":'), country, F.lit("}"))
    path = scratch_path(spark, "landed-sensor-items")
    s.select(F.concat(F.lit('{"results":['), body, F.lit("]}")).alias("value"), F.pmod("location_id", F.lit(50)).alias("k")) \
        .groupBy("k").agg(F.min("value"), F.collect_list(F.expr("substring(value, 13, length(value) - 14)")).alias("v")) \
        .select(F.concat(F.lit('{"results":['), F.array_join("v", ","), F.lit("]}")).alias("value"), F.col("k").alias("page")) \
        .repartition("page").write.mode("overwrite").partitionBy("page").text(path)
    items = files.read_json_pages(spark, path, ["id", "name", "coordinates", "country"], list_keys=("results",))
    out = shapes.sensor_items(items)
    return out.select("location_id", r6("lat").alias("lat"), r6("lon").alias("lon"), "location_name",
                      clean.pick_label("country_raw", ("code", "name")).alias("country"))


@query("staged_news_layout", with_ctes("news_fx", O_STAGE, body="""
select news_id, cast(event_time as date) as event_date, lat_bin, lon_bin from news_stage
where cast(event_time as date) >= date '2024-01-15'"""))
def q_staged_news_layout(spark, d):
    """News staged PARTITION BY day CLUSTER BY bins, then read back with a day filter
    that prunes partitions (the plan shows PartitionFilters)."""
    path = scratch_path(spark, "staged-news")
    sinks.stage_partitioned(staged_news(spark, d), path, "event_time", cluster_by=["lat_bin", "lon_bin"])
    back = spark.read.parquet(path)
    return (back.where(F.col("event_date") >= F.lit("2024-01-15").cast("date"))
            .select("news_id", "event_date", "lat_bin", "lon_bin"))
