"""Test inputs derived from the driver tables by integer arithmetic (FIXTURES.md).

Spark side of the fixtures; the DuckDB twin lives in ``plans/oracle_fixtures.py``.  The
expressions are SQL expression strings evaluated by ``selectExpr``, so Catalyst
prunes each source to the columns a fixture reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions.geo import box_polygon

# fixed as-of dates of every test (FIXTURES.md §2)
AS_OF_VECTORS = "2024-01-01"
AS_OF_NEWS = "2024-01-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def incidents_fx(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case event_id % 3 when 0 then 'storm' when 1 then 'hurricane' else 'earthquake' end as hazard_type",
        "ts as start_time",
        "case when event_id % 11 = 0 then null else ts + make_dt_interval(0, cast(event_id % 48 as int), 0, 0) end as end_time",
        "case when event_id % 97 = 0 then null else (200 + (event_id * 7919) % 400) / 10.0e0 end as lat",
        "case when event_id % 97 = 0 then null else (-300 + (event_id * 104729) % 600) / 10.0e0 end as lon",
        "case when event_id % 13 = 0 then null else value end as severity",
        "event_id % 4 as fatalities",
        "event_id % 9 as injuries",
        "(event_id % 7) * 1000 as damage_usd",
        "event_type",
    )


def storms_fx(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "cast(event_id as string) as event_id",
        "ts as event_begin_time",
        "case when event_id % 11 = 0 then null else ts + make_dt_interval(0, cast(event_id % 48 as int), 0, 0) end as event_end_time",
        "(200 + (event_id * 7919) % 400) / 10.0e0 as event_latitude",
        "(-300 + (event_id * 104729) % 600) / 10.0e0 as event_longitude",
        "event_type",
        "value as magnitude",
        "case when event_id % 5 = 0 then null else event_id % 4 end as deaths_direct",
        "event_id % 2 as deaths_indirect",
        "event_id % 9 as injuries_direct",
        "case when event_id % 7 = 0 then null else event_id % 3 end as injuries_indirect",
        "case when event_id % 2 = 0 then null else (event_id % 7) * 1000 end as damage_property",
        "0 as damage_crops",
    )


def tracks_fx(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "'T' || cast(user_id as string) as sid",
        "case when event_id % 17 = 0 then ' ' when event_id % 19 = 0 then '2023-02-30 00:00:00' "
        "when event_id % 23 = 0 then '1850-06-01 00:00:00' else '20' || lpad(cast(event_id % 26 as string), 2, '0') "
        "|| '-01-' || lpad(cast(1 + event_id % 28 as string), 2, '0') || ' 06:00:00' end as iso_time",
        "case when event_id % 29 = 0 then 'degrees_north' else cast(cast((200 + (event_id * 7919) % 400) / 10.0e0 as decimal(9,1)) as string) end as lat",
        "cast(cast((-300 + (event_id * 104729) % 600) / 10.0e0 as decimal(9,1)) as string) as lon",
        "case when event_id % 4 = 0 then ' ' else cast(20 + event_id % 130 as string) end as wmo_wind",
    )


def quakes_fx(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id + 10000000 as id",
        "case when event_id % 31 = 0 then '1900?' else ' ' || cast(1890 + event_id % 140 as string) end as year",
        "case when event_id % 10 = 0 then '' else cast(1 + event_id % 12 as string) end as month",
        "cast(1 + event_id % 31 as string) as day",
        "cast(event_id % 25 as string) as hour",
        "cast(event_id % 60 as string) as minute",
        "case when event_id % 3 = 0 then null else cast(event_id % 60 as string) || '.7' end as second",
        "cast(cast((200 + (event_id * 7919) % 400) / 10.0e0 as decimal(9,1)) as string) as latitude",
        "case when event_id % 37 = 0 then '999' else cast(cast((-300 + (event_id * 104729) % 600) / 10.0e0 as decimal(9,1)) as string) end as longitude",
        "case when event_id % 41 = 0 then '1,234.5' when event_id % 43 = 0 then 'n/a' else cast(cast(event_id % 90 as decimal(9,1)) as string) end as eqmagnitude",
    )


def news_fx(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as news_id",
        "cast('202401' || lpad(cast(1 + o_orderkey % 30 as string), 2, '0') as int) as sqldate",
        "(200 + (o_orderkey * 6151) % 400) / 10.0e0 as lat",
        "(-300 + (o_orderkey * 30011) % 600) / 10.0e0 as lon",
        "case when o_orderkey % 53 = 0 then null else (o_orderkey * 37) % 2000 / 100.0e0 - 10.0e0 end as tone",
        "1 + o_orderkey % 20 as num_articles",
    )


def countries_fx(spark, sf_dir) -> DataFrame:
    """Country polygons: boxes, with the closed ring as ``geom``."""
    df = table(spark, sf_dir, "nation").where("n_nationkey % 7 <> 6").selectExpr(
        "n_nationkey as country_id",
        "'C' || lpad(cast(n_nationkey as string), 2, '0') as iso_code",
        "n_name as country_name",
        "19.55e0 + 8 * floor(n_nationkey / 5.0e0) as min_lat",
        "28.45e0 + 8 * floor(n_nationkey / 5.0e0) as max_lat",
        "-30.45e0 + 12 * (n_nationkey % 5) as min_lon",
        "-17.55e0 + 12 * (n_nationkey % 5) as max_lon",
        "n_nationkey % 3 <> 0 as is_land",
        "n_nationkey % 4 as version",
    )
    return df.withColumn("geom", box_polygon("min_lon", "min_lat", "max_lon", "max_lat"))


def population_fx(spark, sf_dir) -> DataFrame:
    nations = table(spark, sf_dir, "nation").where("n_nationkey % 6 <> 5")
    return nations.withColumn("year", F.explode(F.sequence(F.lit(2022), F.lit(2024)))).selectExpr(
        "'C' || lpad(cast(n_nationkey as string), 2, '0') as country_code",
        "year",
        "cast(1000000 + n_nationkey * 250000 + (year - 2020) * 1000 as bigint) as midyear_population",
    )


def roads_fx(spark, sf_dir) -> DataFrame:
    """Roads along a meridian from lat_a to lat_b, with the line as ``geom``."""
    df = table(spark, sf_dir, "part").selectExpr(
        "p_partkey as road_id",
        "(-300 + (p_partkey * 613) % 600) / 10.0e0 as lon",
        "(200 + (p_partkey * 271) % 380) / 10.0e0 as lat_a",
        "(200 + (p_partkey * 271) % 380) / 10.0e0 + 0.1e0 * (1 + p_partkey % 90) as lat_b",
    )
    return df.withColumn("geom", F.array(
        F.struct(F.col("lon").alias("lon"), F.col("lat_a").alias("lat")),
        F.struct(F.col("lon").alias("lon"), F.col("lat_b").alias("lat"))))


def multi_roads_fx(spark, sf_dir) -> DataFrame:
    """Landed roads of one to three meridian lines each, as GeoJSON: ``id, subtype, geometry``."""
    lon = "(-300 + (p_partkey * 613 + k * 37) % 600) / 10.0e0"
    lat_a = "(200 + (p_partkey * 271 + k * 53) % 380) / 10.0e0"
    lat_b = f"{lat_a} + 0.1e0 * (1 + (p_partkey + 7 * k) % 90)"
    line = f"'[[' || ({lon}) || ',' || ({lat_a}) || '],[' || ({lon}) || ',' || ({lat_b}) || ']]'"
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as id", "'road' as subtype",
        "'{\"type\":\"MultiLineString\",\"coordinates\":[' || array_join(transform(sequence(0, cast(p_partkey % 3 as int)), "
        f"k -> {line}), ',') || ']}}' as geometry")


def sensors_fx(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as location_id",
        "(200 + (c_custkey * 5851) % 400) / 10.0e0 as lat",
        "(-300 + (c_custkey * 9733) % 600) / 10.0e0 as lon",
        "case c_custkey % 4 when 0 then '{\"code\":\"C' || lpad(cast(c_nationkey as string), 2, '0') || '\",\"name\":\"x\"}' "
        "when 1 then '{\"name\":\"N' || cast(c_nationkey as string) || '\"}' when 2 then 'plain' else null end as country_raw",
        "c_name as location_name",
    )


def air_fx(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber as meas_id",
        "l_suppkey as location_id",
        "case when l_linenumber % 2 = 0 then 'pm25' else 'pm10' end as pollutant",
        "cast(timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, cast((l_orderkey * 7 + l_linenumber) % 720 as int), 0, 0) as timestamp_ntz) as ts",
        "l_quantity as value",
    )


def vectors_fx(spark, sf_dir) -> DataFrame:
    """Vector metadata joined to the 64-wide embedding (as double)."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.selectExpr(
        "vec_id as event_id",
        f"date_sub(date '{AS_OF_VECTORS}', cast(vec_id * 37 % 1800 as int)) as event_date",
        "case label % 3 when 0 then 'storm' when 1 then 'hurricane' else 'earthquake' end as hazard_type",
        "transform(embedding, x -> cast(x as double)) as emb",
    )


def action_json_fx(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as query_event",
        "case when c_custkey % 10 = 0 then 'not json' when c_custkey % 10 = 1 then '[]' "
        "when c_custkey % 10 = 2 then null else '[{\"priority\":' || cast(1 + c_custkey % 5 as string) "
        "|| ',\"action\":\"Open shelter ' || cast(c_custkey as string) || '\",\"owner\":\"Ops\",\"eta_hours\":' "
        "|| cast(c_custkey % 48 as string) || '},{\"priority\":\"high\",\"action\":\"Check roads\",\"owner\":\"Logistics\"}]' end as json_actions",
    )


def pipeline_sources(spark, sf_dir):
    """All pipeline inputs derived from the driver tables (see ``plans.pipeline.Sources``)."""
    from .plans.pipeline import Sources
    return Sources(
        storms=storms_fx(spark, sf_dir), tracks=tracks_fx(spark, sf_dir), quakes=quakes_fx(spark, sf_dir),
        news_events=news_fx(spark, sf_dir),
        countries=countries_fx(spark, sf_dir).select("country_id", "iso_code", "country_name", "is_land",
                                                     "version", "geom"),
        population=population_fx(spark, sf_dir), roads=roads_fx(spark, sf_dir).select("road_id", "geom"),
        sites=sensors_fx(spark, sf_dir),
        measurements=air_fx(spark, sf_dir).select("location_id", "pollutant", "ts", "value"))
