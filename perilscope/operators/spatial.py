"""Spatial joins rewritten as equi-joins on grid tiles plus an exact residual.

Catalyst cannot turn a distance or containment predicate into a hash key, so
every operator here does it by hand:

* the side whose reach is a region (an incident's circle or box, a polygon's
  bbox) is exploded over the tiles the region touches -- never both sides;
* the point side keeps one row and one tile key;
* the equi-join on the tile key (plus the day, for time bands) lets Spark pick a
  broadcast or shuffle join at run time (AQE), and split hot tiles (AQE skew
  join) -- no broadcast hint is forced on a side whose size grows with data;
* the exact predicate (haversine, ray cast, box bounds) runs as a residual.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..session import spread
from ..functions.geo import haversine_km, lat_reach_deg, lon_reach_deg, bbox_from_point
from .outlines import FineTiles, by_part, fine_tiles, inside_tile


# --------------------------------------------------------------------------- J5
def near_in_time(left: DataFrame, right: DataFrame, *, radius_km: float = 100.0,
                 before_hours: int = 24, after_hours: int = 24, mode: str = "exact",
                 tile_deg: float = 1.0, bin_deg: float = 0.5, bins_reach: int = 2,
                 max_window_days: int = 31, right_window: tuple[str, str] | None = None) -> DataFrame:
    """Spatio-temporal band join.

    ``left``: incidents with ``lat, lon, start_time, end_time`` (end NULL -> start).
    ``right``: dated points with ``lat, lon, event_time``.
    A pair matches when ``event_time`` lies in [start - before, end + after] and the
    great-circle distance is <= ``radius_km``.  ``right`` columns other than the
    point come back as they are; its point comes back as ``r_lat, r_lon``, plus
    ``dist_km``.

    ``mode='exact'``: each incident covers exactly the ``tile_deg`` tiles its
    circle's bounding range touches (the longitude reach grows with latitude, is
    the whole circle near a pole, and wraps at +-180), so no pair is lost.
    ``mode='bins'``: the reference rule -- +-``bins_reach`` bins of ``bin_deg`` on
    unwrapped ``floor(x / bin_deg)`` -- which misses pairs whose bins are farther.

    Plan: the incident side is exploded over its tiles and over day blocks that
    cover its window: single days, and for a window of more than ``max_window_days``
    blocks of 8, 64, ... days in its middle, so its rows grow with the logarithm of its
    length.  The equi-key is (tile, block); a hot tile is cut by day.  The point side has
    one row per level (single days alone, unless there are long windows; a scalar subquery, so planning
    runs no job) and is shuffled once.  Both sides
    are shuffled on the key (sort-merge, with AQE's skew split for hot keys): the exploded
    side is many times its input, so it must never be the broadcast side.
    ``right_window=(lo, hi)``: the time span the point side is
    known to cover (e.g. the staged look-back); incidents whose window misses it
    are skipped before the explode, windows are cut to it, and the bound reaches the incident scan.
    """
    if mode not in ("exact", "bins"):
        raise ValueError("mode must be 'exact' or 'bins'")
    size = bin_deg if mode == "bins" else tile_deg
    n_lon = int(round(360.0 / size))
    fl = lambda c: F.floor(c / F.lit(size)).cast("bigint")
    t0 = F.col("start_time") - F.make_dt_interval(F.lit(0), F.lit(before_hours))
    t1 = F.coalesce(F.col("end_time"), F.col("start_time")) + F.make_dt_interval(F.lit(0), F.lit(after_hours))

    lcols = list(left.columns)
    keep = F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("start_time").isNotNull()
    if right_window is not None:
        lo, hi = (F.lit(x).cast("timestamp_ntz") for x in right_window)
        keep = keep & (t1 >= lo) & (t0 <= hi)
    kept = left.where(keep)
    first, last, single = F.to_date("_t0"), F.to_date("_t1"), False
    if right_window is not None:
        # days outside the point side's span have no partner; a short span is cut by single days throughout
        first, last = F.greatest(first, F.to_date(lo)), F.least(last, F.to_date(hi))
        single = (dt.date.fromisoformat(right_window[1][:10]) - dt.date.fromisoformat(right_window[0][:10])).days < SPAN_DAYS
    # blocks are listed once per incident, before the shuffle that spreads them: the explodes behind it stay small
    L = spread(kept.withColumn("_t0", t0).withColumn("_t1", t1).withColumn(
        "_blocks", day_blocks(first, last, SPAN_DAYS if single else max_window_days, single)))
    if mode == "bins":
        # tiles of as many bins as the rule reaches: two to a side at most; the bins themselves are compared behind the join
        square = lambda b: F.floor(b / F.lit(2 * bins_reach + 1)).cast("bigint")
        lat_tiles, lon_tiles = (F.sequence(square(fl(F.col(c)) - bins_reach), square(fl(F.col(c)) + bins_reach)) for c in ("lat", "lon"))
    else:
        dlat = lat_reach_deg(radius_km) + 1e-9
        lat_tiles = F.sequence(fl(F.col("lat") - dlat), fl(F.col("lat") + dlat))
        dlon = lon_reach_deg(F.col("lat"), radius_km) + F.lit(1e-9)
        x0, x1 = fl(F.col("lon") - dlon), fl(F.col("lon") + dlon)
        all_lon = F.sequence(F.lit(0), F.lit(n_lon - 1)).cast("array<bigint>")
        lon_tiles = F.when(dlon.isNull() | (x1 - x0 + 1 >= n_lon), all_lon).otherwise(
            F.transform(F.sequence(x0, x1), lambda t: F.pmod(t, F.lit(n_lon))))

    days = F.datediff(F.to_date(t1), F.to_date(t0)) + 1
    longest = kept.agg(F.coalesce(F.max(days), F.lit(0)).alias("days")).scalar()
    levels = F.explode(F.when(longest > max_window_days, F.sequence(F.lit(0), F.lit(BLOCK_LEVELS - 1))).otherwise(F.array(F.lit(0))))
    R = right.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("event_time").isNotNull())
    r_lon = fl(F.col("lon"))
    R = (R.withColumn("_tile_lat", square(fl(F.col("lat"))) if mode == "bins" else fl(F.col("lat")))
          .withColumn("_tile_lon", square(r_lon) if mode == "bins" else F.pmod(r_lon, F.lit(n_lon)))
          .withColumn("_day", _day(F.to_date("event_time"))).withColumn("_lv", F.lit(0) if single else levels)
          .withColumn("_block", _block(F.col("_day"), F.col("_lv")))
          .withColumnRenamed("lat", "r_lat").withColumnRenamed("lon", "r_lon"))
    rcols = [c for c in R.columns if not c.startswith("_")]
    r = R.hint("merge").alias("r")
    l = (L.withColumn("_tile_lat", F.explode(lat_tiles)).withColumn("_tile_lon", F.explode(lon_tiles))
          .withColumn("_block", F.explode("_blocks")).drop("_blocks").alias("l"))
    dist = haversine_km(l["lat"], l["lon"], r["r_lat"], r["r_lon"])
    near = F.lit(True)
    if mode == "bins":
        near = (F.abs(fl(l["lat"]) - fl(r["r_lat"])) <= bins_reach) & (F.abs(fl(l["lon"]) - fl(r["r_lon"])) <= bins_reach)
    j = l.join(r, [l["_tile_lat"] == r["_tile_lat"], l["_tile_lon"] == r["_tile_lon"], l["_block"] == r["_block"],
                   r["event_time"].between(l["_t0"], l["_t1"]) & near & (dist <= F.lit(float(radius_km)))], "inner")
    return j.select(*[l[c] for c in lcols], *[r[c] for c in rcols], dist.alias("dist_km"))


#: days of a block of the next level, and levels (8 ** 4 days are eleven years)
BLOCK_BASE, BLOCK_LEVELS = 8, 5
#: a point side known to span fewer days is always cut by single days
SPAN_DAYS = 128


def _day(d: Column) -> Column:
    return F.datediff(d, F.lit("1970-01-01").cast("date"))


def _block(day: Column, lv: Column) -> Column:
    """A day's block of a level, as one number: block * 8 + level."""
    return F.floor(day / F.pow(F.lit(float(BLOCK_BASE)), lv)).cast("bigint") * 8 + lv


def day_blocks(first: Column, last: Column, max_days: int, single: bool = False) -> Column:
    """Blocks (``_block``) that cover the days first..last, each day once.

    Up to ``max_days`` days are single (level 0).  Longer spans take the largest aligned blocks in the
    middle and smaller ones towards both ends: fewer than 2 * 8 of each level below the top.  ``single``:
    no span is longer.
    """
    def run(lv, a, b):                                   # blocks a .. b - 1 of a level
        return F.when(b > a, F.sequence(a * 8 + lv, (b - 1) * 8 + lv, F.lit(8).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    s, e = _day(first).cast("bigint"), (_day(last) + 1).cast("bigint")
    if single:
        return run(0, s, e)
    # of each level, the whole blocks within the span
    inner = [(F.ceil(s / BLOCK_BASE ** j).cast("bigint"), F.floor(e / BLOCK_BASE ** j).cast("bigint")) for j in range(BLOCK_LEVELS)]
    parts = [run(BLOCK_LEVELS - 1, *inner[-1])]
    for j, (a, b) in enumerate(inner[:-1]):
        a1, b1 = inner[j + 1]
        some = a1 < b1
        parts.append(run(j, a, F.when(some, a1 * BLOCK_BASE).otherwise(b)))
        parts.append(run(j, F.when(some, b1 * BLOCK_BASE).otherwise(b), b))
    return F.when(e - s <= max_days, run(0, s, e)).otherwise(F.concat(*parts))


def count_and_mean(pairs: DataFrame, key: str, value: str, *, count_name: str,
                   mean_name: str) -> DataFrame:
    """COUNT(*) and AVG(value) per key (A1) -- partial aggregation before the shuffle."""
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias(count_name), F.avg(value).alias(mean_name))


# --------------------------------------------------------------------------- J6
def tile_index(tiles: FineTiles) -> DataFrame:
    """One row per cell: ``lv, ty, tx, cands`` = array of the polygons that reach into it, each with its
    class, its own edges in the cell, part by part, and its anchor (``outlines``).

    Its size is set by the outlines and the cells, never by the points.
    """
    cols = [c for c in tiles.cells.columns if c not in ("lv", "ty", "tx", "edges", "odd", "blank")]
    cand = F.struct("lv", "ty", "tx", *cols, by_part(F.col("edges"), F.col("odd")).alias("parts"))
    return tiles.cells.groupBy("lv", "ty", "tx").agg(F.collect_list(F.when(~F.col("blank"), cand)).alias("cands"))


def _with_matches(points: DataFrame, polygons: DataFrame, tile_deg: float, geom_col: str) -> DataFrame:
    """Points + ``_hits``: the polygons that contain each point (possibly empty).

    A left join on the point's cell brings at most one index row per point.  In an interior cell a
    point is inside at once; in a boundary cell the cell's own edges decide.  Spark broadcasts the index
    if it is small enough, else both sides are sorted by cell and a hot cell is split.  A point in a
    tile that was split asks at each of the tile's levels; it is in one cell of them, since the cells of
    a split tile are all in the index, empty ones too.
    """
    tiles = fine_tiles(polygons, geom=geom_col, tile_deg=tile_deg)

    def place(lv: Column):
        width = F.lit(tile_deg) / F.pow(F.lit(2.0), lv)
        return [F.floor(F.col(c) / width).cast("bigint") for c in ("lat", "lon")]
    ty, tx = place(F.lit(0))
    pts = spread(points).withColumn("_ty", ty).withColumn("_tx", tx)
    if tiles.levels is None:
        pts = pts.withColumn("_lv", F.lit(0))
    else:
        # a row per split tile: 360 * 180 / tile_deg ** 2 at most, whatever the data
        lv = tiles.levels.select(F.col("ty").alias("_y"), F.col("tx").alias("_x"), "lvs")
        pts = pts.join(F.broadcast(lv), (F.col("_ty") == F.col("_y")) & (F.col("_tx") == F.col("_x")), "left")
        pts = pts.withColumn("_lv", F.explode(F.coalesce("lvs", F.array(F.lit(0)))))
        ty, tx = place(F.col("_lv"))
        pts = pts.withColumn("_ty", ty).withColumn("_tx", tx)
    p, q = pts.alias("p"), tile_index(tiles).alias("q")
    j = p.join(q, [p["_lv"] == q["lv"], p["_ty"] == q["ty"], p["_tx"] == q["tx"]], "left")
    if tiles.levels is not None:
        j = j.where((p["_lv"] == 0) | q["lv"].isNotNull())
    hits = F.filter(F.coalesce(q["cands"], F.array()),
                    lambda c: (c["cls"] == 0) | inside_tile(p["lon"], p["lat"], c, tile_deg))
    return j.select(*[p[c] for c in points.columns], hits.alias("_hits"))


def locate(points: DataFrame, polygons: DataFrame, *, tile_deg: float = 1.0,
           how: str = "left", geom_col: str = "geom") -> DataFrame:
    """Point-in-polygon join (J6): ST_WITHIN(point, polygon).

    One row per (point, containing polygon); with ``how='left'`` a point in no
    polygon is kept once with NULL polygon columns.  Every ``polygons`` column but
    the geometry is returned.
    """
    m = _with_matches(points, polygons, tile_deg, geom_col)
    ex = F.explode_outer("_hits") if how == "left" else F.explode("_hits")
    pcols = [c for c in polygons.columns if c != geom_col and c not in points.columns]
    return (m.select(*points.columns, ex.alias("_m"))
             .select(*points.columns, *[F.col(f"_m.{c}").alias(c) for c in pcols]))


def _sort_key(c: Column, spec: list[tuple[str, str]]) -> Column:
    """Struct key giving ORDER BY spec with NULLs last, for array_min."""
    parts = []
    for i, (field, direction) in enumerate(spec):
        v = c[field]
        parts.append(v.isNull().alias(f"n{i}"))
        if direction == "desc":
            dt = v.cast("double")
            parts.append(F.when(v.isNotNull(), -dt).alias(f"v{i}"))
        else:
            parts.append(v.alias(f"v{i}"))
    return F.struct(*parts)


def locate_best(points: DataFrame, polygons: DataFrame, order: list[tuple[str, str]], *,
                tile_deg: float = 1.0, geom_col: str = "geom") -> DataFrame:
    """J6 + W1 in one pass: the first containing polygon by ``order`` (NULLs last), or NULLs.

    Equivalent to ROW_NUMBER() OVER (PARTITION BY point ORDER BY ...) = 1 on the
    left join, without the shuffle by point key: the containing polygons of a
    point already sit in one row.  ``order`` must end in a unique polygon key.
    """
    m = _with_matches(points, polygons, tile_deg, geom_col)
    keyed = F.transform("_hits", lambda h: F.struct(_sort_key(h, order).alias("k"), h.alias("h")))
    best = F.array_min(keyed)["h"]
    pcols = [c for c in polygons.columns if c != geom_col and c not in points.columns]
    return (m.withColumn("_b", best)
             .select(*points.columns, *[F.col("_b")[c].alias(c) for c in pcols],
                     F.size("_hits").alias("n_containing")))


def best_match(df: DataFrame, key: str | list[str], order_by: list[Column]) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY key ORDER BY ...) = 1 (W1); needs a total order.

    Planned as a WindowGroupLimit (partial, before the shuffle) + Window.
    """
    from pyspark.sql import Window
    keys = [key] if isinstance(key, str) else key
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


# --------------------------------------------------------------------------- J11
def in_box(points: DataFrame, sites: DataFrame, *, radius_km: float = 100.0,
           bin_deg: float = 1.0, many: bool = False) -> DataFrame:
    """Box join (J11): sites inside the box ``bbox_from_point(point, radius_km)``.

    ``points``: ``lat, lon`` + keys; ``sites``: ``lat, lon`` + attributes, returned
    as ``site_lat, site_lon``.  A box over the antimeridian (min_lon > max_lon)
    wraps; a box whose half-width reaches 180 deg covers every longitude.  Box
    bounds are inclusive.  The point side is exploded over the box's bins.
    ``many``: a bin's pairs are many times its rows, so the bins stay dealt over all shuffle
    partitions (they would be merged by their bytes, which do not tell the pairs), and sites meet boxes
    in packs of one cell of a bin (``_packs``): a box skips a pack that it does not reach, and a pack's sites are
    compared one by one without being joined one by one.
    """
    b = bin_deg
    fl = lambda c: F.floor(c / F.lit(b)).cast("bigint")
    P = spread(points.where(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)))
    P = P.withColumn("_bb", bbox_from_point(F.col("lat"), F.col("lon"), radius_km))
    dlon = F.lit(float(radius_km)) / (F.lit(111.320) * F.greatest(F.cos(F.radians("lat")), F.lit(1e-6)))
    P = P.withColumns({"_all_lon": dlon >= 180.0, "_y0": F.col("_bb.min_lat"), "_y1": F.col("_bb.max_lat"),
                       "_x0": F.col("_bb.min_lon"), "_x1": F.col("_bb.max_lon")}).drop("_bb")
    lo, hi = F.col("_x0"), F.col("_x1")
    lat_rng = F.sequence(fl(F.col("_y0")), fl(F.col("_y1")))
    full = F.sequence(fl(F.lit(-180.0)), fl(F.lit(180.0)))
    lon_rng = (F.when(F.col("_all_lon"), full)
               .when(lo <= hi, F.sequence(fl(lo), fl(hi)))
               .otherwise(F.concat(F.sequence(fl(lo), fl(F.lit(180.0))),
                                   F.sequence(fl(F.lit(-180.0)), fl(hi)))))
    P = P.withColumn("_ty", F.explode(lat_rng)).withColumn("_tx", F.explode(F.array_distinct(lon_rng)))
    S = (sites.withColumnRenamed("lat", "site_lat").withColumnRenamed("lon", "site_lon")
              .withColumn("_ty", fl(F.col("site_lat"))).withColumn("_tx", fl(F.col("site_lon"))))
    kept = [c for c in S.columns if not c.startswith("_")]
    lon_to = F.col("site_lon")
    lon_ok = (F.col("_all_lon") | ((lo <= hi) & lon_to.between(lo, hi))
              | ((lo > hi) & ((lon_to >= lo) | (lon_to <= hi))))
    inside = F.col("site_lat").between(F.col("_y0"), F.col("_y1")) & lon_ok
    if not many:
        return P.join(S.select("_ty", "_tx", *kept), ["_ty", "_tx"]).where(inside).select(*points.columns, *kept)
    near = (F.col("_lat1") >= F.col("_y0")) & (F.col("_lat0") <= F.col("_y1")) & (
        F.col("_all_lon") | (lo > hi) | ((F.col("_lon1") >= lo) & (F.col("_lon0") <= hi)))
    met = spread(P, "_ty", "_tx").join(_packs(S, kept, b).hint("merge"), ["_ty", "_tx"]).where(near)
    return met.select("*", F.inline("_pack")).where(inside).select(*points.columns, *kept)


#: cells of a bin to a side, and parts of a cell's sites
PACK_CELLS, PACK_PARTS = 4, 8


def _packs(sites: DataFrame, kept: list[str], bin_deg: float) -> DataFrame:
    """``_ty, _tx, _lat0, _lat1, _lon0, _lon1, _pack``: the sites of one cell in ``PACK_PARTS`` parts by hash, as lists
    of their columns ``kept``, with the range of their places.  Dealt by bin, in one shuffle."""
    cell = [F.floor(F.col(c) * (PACK_CELLS / bin_deg)).alias(f"_{c}") for c in ("site_lat", "site_lon")]
    part = F.pmod(F.xxhash64(*kept), F.lit(PACK_PARTS)).alias("_part")
    return spread(sites.where(F.col("_ty").isNotNull() & F.col("_tx").isNotNull()), "_ty", "_tx").groupBy("_ty", "_tx", *cell, part).agg(
        F.min("site_lat").alias("_lat0"), F.max("site_lat").alias("_lat1"), F.min("site_lon").alias("_lon0"),
        F.max("site_lon").alias("_lon1"), F.collect_list(F.struct(*kept)).alias("_pack")).drop("_site_lat", "_site_lon", "_part")
