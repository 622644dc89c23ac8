"""Line-polygon intersection join and clipped length (J7, G-5, G-6, A2).

Lines are cut at tile borders and joined with the polygons' tiles (``outlines``):
equal tiles meet, interior tiles count whole, and boundary tiles are clipped
against their own edges only.  A road of several lines is cut, clipped and measured line by line, and
its lines are added up per polygon.  ``clip_length_km`` is the plain kernel for one
line and one outline; the tests hold the join against it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import spread
from ..functions.geo import EARTH_RADIUS_KM
from .outlines import clip_pieces, cut_lines, fine_tiles, one_line_each


PIECE = "struct<seg:int,t0:double,t1:double,x0:double,y0:double,x1:double,y1:double>"


def _hav(lon1, lat1, lon2, lat2):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    dp, dl = p2 - p1, np.radians(lon2) - np.radians(lon1)
    a = np.sin(dp / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(dl / 2) ** 2
    return 2.0 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(1.0, a)))


def _inside(mx, my, part, ax, ay, bx, by):
    """Even-odd containment of points (mx, my) in any part; shape (n_points,).

    Points are taken in chunks so that points x edges stays under 4M cells."""
    mx, my = np.asarray(mx, float), np.asarray(my, float)
    out = np.zeros(len(mx), dtype=bool)
    parts = np.unique(part)
    step = max(1, int(4_000_000 // max(1, len(ax))))
    for k in range(0, len(mx), step):
        x, y = mx[k:k + step], my[k:k + step]
        straddle = (ay[None, :] > y[:, None]) != (by[None, :] > y[:, None])
        with np.errstate(divide="ignore", invalid="ignore"):
            xat = ax[None, :] + (bx - ax)[None, :] * (y[:, None] - ay[None, :]) / (by - ay)[None, :]
        cross = straddle & (x[:, None] < xat)
        for p in parts:
            sel = part == p
            out[k:k + step] |= (cross[:, sel].sum(axis=1) % 2) == 1
    return out


def clip_length_km(lx, ly, part, ax, ay, bx, by):
    """(length of the line inside the polygon in km, whether they intersect)."""
    lx, ly = np.asarray(lx, float), np.asarray(ly, float)
    ax, ay, bx, by = (np.asarray(v, float) for v in (ax, ay, bx, by))
    part = np.asarray(part)
    total, touches = 0.0, False
    ex, ey = bx - ax, by - ay
    for i in range(len(lx) - 1):
        x0, y0, x1, y1 = lx[i], ly[i], lx[i + 1], ly[i + 1]
        dx, dy = x1 - x0, y1 - y0
        denom = dx * ey - dy * ex
        qx, qy = ax - x0, ay - y0
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (qx * ey - qy * ex) / denom
            u = (qx * dy - qy * dx) / denom
        hit = (denom != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        if hit.any():
            touches = True
        ts = np.unique(np.concatenate(([0.0, 1.0], t[hit])))
        mids = (ts[:-1] + ts[1:]) / 2.0
        inside = _inside(x0 + mids * dx, y0 + mids * dy, part, ax, ay, bx, by)
        if inside.any():
            px, py = x0 + ts * dx, y0 + ts * dy
            seg = _hav(px[:-1], py[:-1], px[1:], py[1:])
            total += float(seg[inside].sum())
    if not touches and len(lx):
        touches = bool(_inside(lx[:1], ly[:1], part, ax, ay, bx, by)[0])
    return total, touches or total > 0


def _clip(batches, tile_deg: float):
    """Rows of (line, polygon, tile) -> the parts of the line inside, one array of intervals per row."""
    import pyarrow as pa

    def items(col, names):
        off = col.offsets.to_numpy().astype("i8")
        flat = col.values.slice(off[0], off[-1] - off[0])
        return {n: flat.field(k).to_numpy(zero_copy_only=False) for k, n in enumerate(names)}, off - off[0]

    for batch in batches:
        step = 256                                   # rows at a time: pieces x edges stay small
        for lo in range(0, batch.num_rows, step):
            b = batch.slice(lo, step)
            p, p_off = items(b.column("pieces"), ["seg", "t0", "t1", "x0", "y0", "x1", "y1"])
            e, e_off = items(b.column("edges"), ["part", "ax", "ay", "bx", "by"])
            odd_col = b.column("odd")
            o_off = odd_col.offsets.to_numpy().astype("i8")
            odd = odd_col.values.slice(o_off[0], o_off[-1] - o_off[0]).to_numpy(zero_copy_only=False)
            width = tile_deg / 2.0 ** b.column("lv").to_numpy()
            xc = (b.column("tx").to_numpy() + 0.5) * width
            yc = (b.column("ty").to_numpy() + 0.5) * width
            row, piece, t0, t1, touched = clip_pieces(p, p_off, e, e_off, odd, o_off - o_off[0], xc, yc)
            counts = np.bincount(row, minlength=b.num_rows)
            keep = touched | (counts > 0)
            off = np.concatenate([[0], np.cumsum(counts)])
            parts = pa.StructArray.from_arrays(
                [pa.array(p["seg"][piece]), pa.array(t0), pa.array(t1), *[pa.array(p[n][piece]) for n in ("x0", "y0", "x1", "y1")]],
                names=["seg", "t0", "t1", "x0", "y0", "x1", "y1"])
            out = pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("line_id", "line", "poly_id", "alone")], pa.ListArray.from_arrays(pa.array(off.astype("i4")), parts)],
                ["line_id", "line", "poly_id", "alone", "parts"])
            yield out.filter(pa.array(keep))


def _runs(s):
    """Intervals (sorted) of a line, those that meet end to end taken as one (in the JVM)."""
    # a run starts where no other interval of its segment ends, and ends where none starts
    n = F.size(s)
    nxt = F.concat(F.slice(s, 2, F.greatest(n - 1, F.lit(0))), F.array(F.lit(None).cast(PIECE)))
    prv = F.concat(F.array(F.lit(None).cast(PIECE)), F.slice(s, 1, F.greatest(n - 1, F.lit(0))))

    def joined(a, b):
        return F.coalesce((a["seg"] == b["seg"]) & (a["t1"] == b["t0"]), F.lit(False))
    starts = F.filter(F.zip_with(s, prv, lambda x, q: F.when(~joined(q, x), x)), lambda x: x.isNotNull())
    ends = F.filter(F.zip_with(s, nxt, lambda x, q: F.when(~joined(x, q), x)), lambda x: x.isNotNull())
    return F.zip_with(starts, ends, lambda a, b: F.struct(
        a["t0"].alias("t0"), b["t1"].alias("t1"), *[a[k].alias(k) for k in ("x0", "y0", "x1", "y1")]))


def _run_km(runs):
    """Great-circle length of runs."""
    def leg(x):
        (lon1, lat1), (lon2, lat2) = x["a"], x["b"]
        p1, p2 = F.radians(lat1), F.radians(lat2)
        h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
        return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))

    def point(x, t):
        return x["x0"] + t * (x["x1"] - x["x0"]), x["y0"] + t * (x["y1"] - x["y0"])
    return F.aggregate(runs, F.lit(0.0), lambda acc, x: acc + leg({"a": point(x, x["t0"]), "b": point(x, x["t1"])}))


def _lengths(parts: DataFrame) -> DataFrame:
    """``line_id, line, poly_id, parts`` -> ``km``.  Step by step: a column that the next one uses several
    times is worked out once per row."""
    ids = ["line_id", "line", "poly_id"]
    return parts.select(*ids, F.array_sort("parts").alias("s")).select(*ids, _runs(F.col("s")).alias("runs")).select(
        *ids, _run_km(F.col("runs")).alias("km"))


def line_length_in(lines: DataFrame, polygons: DataFrame, *, line_key: str = "road_id",
                   poly_key: str = "country_id", tile_deg: float = 1.0,
                   line_geom: str = "geom", poly_geom: str = "geom") -> DataFrame:
    """ST_INTERSECTS join + ST_LENGTH(ST_INTERSECTION) per (line, polygon) pair in km.

    Returns ``line_key, poly_key, length_km``, one row per intersecting pair (touching
    pairs have length 0).  A road is one line (a list of points) or several (a list of lines, or rows
    that share its key): they count together, a line that is listed twice once.  Roads without a key are
    each their own.  Lines are cut at the cell borders and joined by cell with the polygons' cells
    (``outlines``):

    * pieces are clipped against their cell's own edges, whole batches at a time
      in numpy; in a cell inside the polygon there are none, and they stay whole;
    * a line in one cell is done then; the intervals of the others meet by
      (line, polygon), where intervals that were cut at a border are joined again;
    * the lengths of a road's lines, one number each, meet by (road, polygon).

    No row carries an outline, and which rows go where depends on the row alone.
    """
    tiles = fine_tiles(polygons.select(F.col(poly_key).alias("poly_id"), F.col(poly_geom).alias("geom")), tile_deg=tile_deg)
    cut = cut_lines(spread(one_line_each(lines, line_key, line_geom)), tile_deg=tile_deg, split=tiles.by_tile())
    j = cut.join(tiles.cells.where("not blank").drop("blank"), ["lv", "ty", "tx"])
    lt, pt = (j.schema[c].dataType.simpleString() for c in ("line_id", "poly_id"))
    both = j.select("line_id", "line", "poly_id", "alone", "lv", "ty", "tx", "pieces", "edges", "odd").mapInArrow(
        lambda it: _clip(it, tile_deg), f"line_id {lt}, line bigint, poly_id {pt}, alone boolean, parts array<{PIECE}>")
    one = both.where("alone").select("line_id", "line", "poly_id", "parts")
    # at most the pieces of one line
    many = both.where("not alone").groupBy("line_id", "line", "poly_id").agg(
        F.array_distinct(F.flatten(F.collect_list("parts"))).alias("parts"))
    km = _lengths(one.unionByName(many))
    lone = F.when(F.col("line_id").isNull(), F.col("line"))
    # at most one number per line of a road; summed in one order, so that runs agree
    road = km.groupBy("line_id", "poly_id", lone.alias("lone")).agg(F.array_sort(F.collect_set(F.struct("line", "km"))).alias("m"))
    return road.select(F.col("line_id").alias(line_key), F.col("poly_id").alias(poly_key),
                       F.aggregate("m", F.lit(0.0), lambda a, x: a + x["km"]).alias("length_km"))


def length_by(pairs: DataFrame, polygons: DataFrame, *, poly_key: str = "country_id",
              group: str = "iso_code") -> DataFrame:
    """SUM(length) per group of polygons (A2), in km."""
    return (pairs.join(polygons.select(poly_key, group), poly_key, "inner")
            .groupBy(group).agg(F.sum("length_km").alias("road_km")))
