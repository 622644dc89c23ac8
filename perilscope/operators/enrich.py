"""Incident enrichment: country, population for the year, road length (step 3).

    incidents --locate_best--> country (land first, latest version)
              --lookup_by_year--> population_estimate
              --join iso--> road_km_country (roads clipped to the needed countries)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .roads import line_length_in, length_by
from .spatial import best_match, locate, locate_best

# fixed value: road length used when a country has none (the reference's default)
ROAD_KM_DEFAULT = 100.0

COUNTRY_ORDER = [("is_land", "desc"), ("version", "desc"), ("iso_code", "asc"), ("country_id", "asc")]


def population_by_country(divisions: DataFrame, population: DataFrame) -> DataFrame:
    """Division polygons x population on UPPER(iso) = country_code."""
    d = divisions.select("country_id", "country_name", "iso_code",
                         F.upper("iso_code").alias("_cc"))
    p = population.select(F.col("country_code").alias("_cc"), "year", "midyear_population")
    return d.join(p, "_cc", "inner").drop("_cc")


def population_lookup(pop_by_country: DataFrame) -> DataFrame:
    """One row per (iso_code, year) -- several polygons under one iso would
    otherwise multiply incidents (max population kept)."""
    return (pop_by_country.groupBy("iso_code", "year")
            .agg(F.max("midyear_population").alias("midyear_population")))


def lookup_by_year(df: DataFrame, ref: DataFrame, *, key: str = "iso_code",
                   ts_col: str = "start_time", value: str = "midyear_population",
                   out: str = "population_estimate") -> DataFrame:
    """Left join on (key, YEAR(ts)) -- a slowly-changing look-up."""
    r = ref.select(F.col(key).alias("_k"), F.col("year").cast("int").alias("_y"), F.col(value).alias(out))
    l = df.withColumn("_k", F.col(key)).withColumn("_y", F.year(ts_col))
    return l.join(r, ["_k", "_y"], "left").drop("_k", "_y")


def countries_needed(countries: DataFrame, located: DataFrame, key: str = "iso_code") -> DataFrame:
    """Countries whose iso occurs among the located incidents (semi-join)."""
    present = located.where(F.col(key).isNotNull()).select(key).distinct()   # one row per task and key
    return countries.join(present, key, "left_semi")


def best_polygon_per_iso(countries: DataFrame) -> DataFrame:
    """One polygon per iso (land first, then latest version), so overlapping
    polygons under one iso never count a road twice."""
    from pyspark.sql import Window
    w = Window.partitionBy("iso_code").orderBy(
        F.col("is_land").desc_nulls_last(), F.col("version").desc_nulls_last(), F.col("country_id"))
    return countries.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def road_km_by_country(roads: DataFrame, countries: DataFrame, *, tile_deg: float = 1.0) -> DataFrame:
    """A2 over J7: total clipped road length per iso_code, in km."""
    polys = best_polygon_per_iso(countries)
    pairs = line_length_in(roads, polys, line_key="road_id", poly_key="country_id", tile_deg=tile_deg)
    return length_by(pairs, polys, poly_key="country_id", group="iso_code")


def attach_country(incidents: DataFrame, countries: DataFrame, *, tile_deg: float = 1.0,
                   key: list[str] | None = ("event_id",)) -> DataFrame:
    """J6 + W1: incidents with iso_code and country_name of the preferred polygon.

    With ``key`` (default ``event_id``, the reference's only key) rows sharing a
    key -- a cyclone track has one row per observation -- collapse to one, the
    first by land, latest version, iso code, then start time and position; a
    WindowGroupLimit keeps one row per key on the map side, so a long track is
    never shipped whole.  ``key=None`` keeps every input row.
    """
    polys = countries.select("country_id", "iso_code", "country_name", "is_land", "version", "geom")
    out = locate_best(incidents, polys, COUNTRY_ORDER, tile_deg=tile_deg)
    if key:
        order = [F.col("is_land").desc_nulls_last(), F.col("version").desc_nulls_last(),
                 F.col("iso_code").asc_nulls_last(), F.col("country_id").asc_nulls_last()]
        order += [F.col(c).asc_nulls_last() for c in ("start_time", "end_time", "lat", "lon")
                  if c in incidents.columns]
        out = best_match(out, list(key), order)
    return out.drop("country_id", "is_land", "version", "n_containing")


def enrich_incidents(incidents: DataFrame, countries: DataFrame, population: DataFrame,
                     roads: DataFrame, *, tile_deg: float = 1.0, road_default: float = ROAD_KM_DEFAULT,
                     key: list[str] | None = ("event_id",)) -> DataFrame:
    """Step 3: ``incidents.* , iso_code, country_name, population_estimate, road_km_country``."""
    # read twice (rows, and the semi-join that limits roads to present countries)
    located = materialize(attach_country(incidents, countries, tile_deg=tile_deg, key=key))
    pop = population_lookup(population_by_country(countries, population))
    with_pop = lookup_by_year(located, pop)
    needed = countries_needed(countries, located)
    rk = road_km_by_country(roads, needed, tile_deg=tile_deg)
    return (with_pop.join(rk, "iso_code", "left")
            .withColumn("road_km_country", F.coalesce(F.col("road_km"), F.lit(road_default)))
            .drop("road_km"))


def road_km_by_polygon(roads: DataFrame, countries: DataFrame, *, tile_deg: float = 1.0) -> DataFrame:
    """roads_by_country of step 2B: clipped road km per polygon id, with its name and iso."""
    pairs = line_length_in(roads, countries, line_key="road_id", poly_key="country_id", tile_deg=tile_deg)
    return (pairs.groupBy("country_id").agg(F.sum("length_km").alias("road_km"))
            .join(countries.select("country_id", "country_name", "iso_code"), "country_id", "inner"))


def incident_roads(incidents: DataFrame, countries: DataFrame, roads: DataFrame, as_of: str, *,
                   days: int = 10, tile_deg: float = 1.0) -> DataFrame:
    """Step 2B (incidents_roads_10d): recent located incidents, every polygon that
    contains them (no preference -- one row per match, unmatched kept), and the
    road length of that polygon.  ``start_time >= as_of - days`` at midnight."""
    lo = F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")
    inc = incidents.where((F.col("start_time") >= lo) & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    polys = countries.select("country_id", "country_name", "iso_code", "geom")
    hit = locate(inc.select("event_id", "hazard_type", "start_time", "end_time", "lat", "lon"), polys,
                 tile_deg=tile_deg)
    # both sides of the look-up read it: stored once; only polygons that hold an incident are clipped
    hit = materialize(hit, "recent-located")
    held = hit.select("country_id").where("country_id is not null").distinct()
    rbc = road_km_by_polygon(roads, countries.join(held, "country_id", "left_semi"), tile_deg=tile_deg).select("country_id", "road_km")
    return (hit.join(rbc, "country_id", "left")
            .select("event_id", "hazard_type", "start_time", "end_time", "country_name", "iso_code", "road_km"))
