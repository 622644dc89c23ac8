"""Three hazard feeds -> one incident table (step 1C, U1).

Each normaliser returns the same 12 columns; ``union_incidents`` stacks them
with ``unionByName``.  Points are a (lat, lon) pair that is NULL as a whole when
either part is missing or out of range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.clean import coerce_float, coerce_int, datetime_from_parts, null_safe_sum, valid_coords

INCIDENT_COLUMNS = ["hazard_type", "event_id", "start_time", "end_time", "lat", "lon", "event_type",
                    "severity", "fatalities", "injuries", "damage_usd", "source"]

# fixed values: hazard tags and source names of the three feeds
STORM_TAG, STORM_SOURCE = "storm", "NOAA Storms"
TRACK_TAG, TRACK_EVENT_TYPE, TRACK_SOURCE = "hurricane", "tropical cyclone", "IBTrACS v04r01"
QUAKE_TAG, QUAKE_SOURCE = "earthquake", "NOAA Significant Earthquakes (HazEL)"
YEAR_MIN, YEAR_MAX = 1901, 2025


def point(lat: Column, lon: Column) -> list[Column]:
    ok = lat.isNotNull() & lon.isNotNull() & valid_coords(lat, lon)
    return [F.when(ok, lat).alias("lat"), F.when(ok, lon).alias("lon")]


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def normalize_storms(storms: DataFrame) -> DataFrame:
    """Storm feed: typed already; NULL-safe totals of the direct/indirect parts."""
    return storms.select(
        F.lit(STORM_TAG).alias("hazard_type"),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_begin_time").alias("start_time"),
        F.col("event_end_time").alias("end_time"),
        *point(F.col("event_latitude").cast("double"), F.col("event_longitude").cast("double")),
        F.col("event_type"),
        F.col("magnitude").cast("double").alias("severity"),
        null_safe_sum("deaths_direct", "deaths_indirect").cast("bigint").alias("fatalities"),
        null_safe_sum("injuries_direct", "injuries_indirect").cast("bigint").alias("injuries"),
        null_safe_sum("damage_property", "damage_crops").cast("bigint").alias("damage_usd"),
        F.lit(STORM_SOURCE).alias("source"),
    )


def normalize_tracks(tracks: DataFrame) -> DataFrame:
    """Cyclone-track feed, all text: SAFE_CAST everything, keep rows with a time in range.

    One row per observation (several per storm id), as the reference keeps them.
    """
    t = F.col("iso_time").try_cast("timestamp_ntz")
    return (tracks.where(t.isNotNull() & F.year(t).between(YEAR_MIN, YEAR_MAX))
            .select(
                F.lit(TRACK_TAG).alias("hazard_type"),
                F.col("sid").cast("string").alias("event_id"),
                t.alias("start_time"), t.alias("end_time"),
                *point(F.col("lat").try_cast("double"), F.col("lon").try_cast("double")),
                F.lit(TRACK_EVENT_TYPE).alias("event_type"),
                F.col("wmo_wind").try_cast("double").alias("severity"),
                _null("bigint").alias("fatalities"), _null("bigint").alias("injuries"),
                _null("bigint").alias("damage_usd"),
                F.lit(TRACK_SOURCE).alias("source"),
            ))


def coerce_quakes(quakes: DataFrame) -> DataFrame:
    """The quake loader's typing: integer parts and float parts out of dirty text."""
    ints = ["year", "month", "day", "hour", "minute", "second"]
    floats = ["latitude", "longitude", "eqmagnitude", "depth"]
    cols = []
    for c in quakes.columns:
        if c in ints:
            cols.append(coerce_int(c).alias(c))
        elif c in floats:
            cols.append(coerce_float(c).alias(c))
        else:
            cols.append(F.col(c))
    return quakes.select(*cols)


def dedupe_quakes(quakes: DataFrame) -> DataFrame:
    """A7 on load: one row per quake id, as overlapping pages repeat them.

    The smallest by its other fields in turn, missing ones last: a minimum of structs, combined within
    tasks before the shuffle, without a sort.
    """
    others = [c for c in quakes.columns if c != "id"]
    key = F.struct(*[f for i, c in enumerate(others) for f in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])
    one = quakes.groupBy("id").agg(F.min(key if others else F.struct("id")).alias("_m"))
    return one.select(*["id" if c == "id" else F.col(f"_m.v{others.index(c)}").alias(c) for c in quakes.columns])


def normalize_quakes(quakes: DataFrame, *, coerce: bool = True) -> DataFrame:
    """Quake feed: one row per id; datetime from parts under range guards; located, 1901-2025 rows only."""
    quakes = dedupe_quakes(quakes)
    q = coerce_quakes(quakes) if coerce else quakes
    y, m, d = (F.col(c).try_cast("bigint") for c in ("year", "month", "day"))
    hh, mm = F.col("hour").try_cast("bigint"), F.col("minute").try_cast("bigint")
    ss = F.coalesce(F.col("second").try_cast("double"), F.col("second").try_cast("bigint").cast("double"))
    lat, lon = F.col("latitude").try_cast("double"), F.col("longitude").try_cast("double")
    ts = datetime_from_parts(y, m, d, hh, mm, ss)
    return (q.where(lat.between(-90, 90) & lon.between(-180, 180) & y.between(YEAR_MIN, YEAR_MAX))
            .select(
                F.lit(QUAKE_TAG).alias("hazard_type"),
                F.col("id").cast("string").alias("event_id"),
                ts.alias("start_time"), ts.alias("end_time"),
                lat.alias("lat"), lon.alias("lon"),
                F.lit(QUAKE_TAG).alias("event_type"),
                F.col("eqmagnitude").try_cast("double").alias("severity"),
                _null("bigint").alias("fatalities"), _null("bigint").alias("injuries"),
                _null("bigint").alias("damage_usd"),
                F.lit(QUAKE_SOURCE).alias("source"),
            ))


def union_incidents(storms: DataFrame, tracks: DataFrame, quakes: DataFrame) -> DataFrame:
    """incidents_raw: UNION ALL of the three normalised feeds (one shuffle, of the quakes by id)."""
    parts = [normalize_storms(storms), normalize_tracks(tracks), normalize_quakes(quakes)]
    out = parts[0].select(*INCIDENT_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*INCIDENT_COLUMNS))
    return out


def dedupe_by_key(df: DataFrame, key: str | list[str], order_by: list[Column]) -> DataFrame:
    """One row per key, the first by a stated total order.

    ``dropDuplicates`` keeps an arbitrary row; this keeps a repeatable one.  The
    window's WindowGroupLimit keeps one row per key on the map side before the
    shuffle, so a hot key ships one row per task, not all its copies.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
