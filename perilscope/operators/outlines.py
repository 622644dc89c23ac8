"""Polygon outlines cut to tiles: the shared index of the point and line joins.

Each polygon is cut once.  A tile that its outline crosses (``cls`` 2) keeps the edges that cross
it and, as an anchor, the parts of the polygon in which the tile's centre lies (``odd``); a tile
wholly inside (``cls`` 0) keeps nothing else; tiles outside have no row.  Whether a point of a tile
is inside follows from the anchor and the tile's own edges: the path from the point up or down to
the centre's height, and on to the centre, changes sides at every edge that it crosses.  So no row
of the index, and none of the joins, carries a whole outline.

Where many edges share a tile (archipelagos, detailed coasts) it is split into quarters, again and
again, until a cell has ``EDGE_LIMIT`` edges at most (``fine_tiles``); every cell has its own anchor.
A cell of level ``lv`` is ``tile_deg / 2 ** lv`` wide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

EDGE = "struct<part:int,ax:double,ay:double,bx:double,by:double>"
_KEYS = ("part", "ax", "ay", "bx", "by")
#: edges of all polygons in one cell, beyond which it is split
EDGE_LIMIT = 256
#: a cell is split so often at most: edges that meet in one point cannot be told apart
MAX_SPLITS = 12


def _left(ax, ay, bx, by, x, y):
    """Whether a point is left of an edge; one on its line is taken a hair right and then up, so that
    every point has a side and all uses agree on it."""
    cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
    return (cross > 0) | (cross == 0) & ((by < ay) | (by == ay) & (bx > ax))


def _changes(ax, ay, bx, by, x, y, xc, yc):
    """How often the way from (x, y) up or down to yc and on to (xc, yc) crosses each edge."""
    corner = _left(ax, ay, bx, by, x, yc)
    upright = ((ax > x) != (bx > x)) & (_left(ax, ay, bx, by, x, y) != corner)
    level = ((ay > yc) != (by > yc)) & (corner != _left(ax, ay, bx, by, xc, yc))
    return upright.astype("i8") + level


def _edge_columns(geom: str) -> list[Column]:
    """Parallel arrays over every ring edge of a polygon: part, ax, ay, bx, by."""
    parts = F.transform(F.col(geom), lambda part, i: F.transform(
        part, lambda ring: F.zip_with(
            F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1),
            lambda a, b: F.struct(i.alias("part"), a["lon"].alias("ax"), a["lat"].alias("ay"),
                                  b["lon"].alias("bx"), b["lat"].alias("by")))))
    edges = F.flatten(F.flatten(parts))
    return [F.transform(edges, lambda e: e[k]).alias(f"_e_{k}") for k in _KEYS]


def _spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each index as often as its span lo..hi has integers, and those integers."""
    n = np.maximum(hi - lo + 1, 0).astype("i8")
    at = np.repeat(np.arange(len(lo)), n)
    return at, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def cut_outline(part, ax, ay, bx, by, size: float):
    """Tiles of one polygon: (ty, tx, cls, edge numbers, their offsets, odd parts, their offsets)."""
    # tile rows of each edge, then the columns it reaches within the row (a hair wider)
    low, high = np.minimum(ay, by), np.maximum(ay, by)
    edge, row = _spans(np.floor(low / size).astype("i8"), np.floor(high / size).astype("i8"))
    y0, y1 = np.maximum(low[edge], row * size), np.minimum(high[edge], (row + 1) * size)
    dy = (by - ay)[edge]
    flat = dy == 0
    safe = np.where(flat, 1.0, dy)

    def x_at(y, flat_x):
        return np.where(flat, flat_x, ax[edge] + (bx - ax)[edge] * ((y - ay[edge]) / safe))
    xa, xb = x_at(y0, np.minimum(ax, bx)[edge]), x_at(y1, np.maximum(ax, bx)[edge])
    eps = 1e-9 * size
    k, col = _spans(np.floor((np.minimum(xa, xb) - eps) / size).astype("i8"), np.floor((np.maximum(xa, xb) + eps) / size).astype("i8"))
    e_tile, e_row, e_col = edge[k], row[k], col
    # every tile of the bounding box: which parts hold its centre (one scan line per tile row)
    r0, r1 = int(np.floor(ay.min() / size)), int(np.floor(ay.max() / size))
    c0, c1 = int(np.floor(ax.min() / size)), int(np.floor(ax.max() / size))
    ny, nx = r1 - r0 + 1, c1 - c0 + 1
    centres = (np.arange(c0, c1 + 1) + 0.5) * size
    odd_tile, odd_part = [], []
    for r in range(ny):
        y = (r0 + r + 0.5) * size
        s = np.flatnonzero((ay > y) != (by > y))
        if not len(s):
            continue
        s = s[np.argsort(part[s], kind="stable")]
        first = np.flatnonzero(np.concatenate([[True], part[s][1:] != part[s][:-1]]))
        beyond = _left(ax[s], ay[s], bx[s], by[s], centres[:, None], y) == (by[s] > ay[s])
        is_odd = np.add.reduceat(beyond, first, axis=1, dtype="i8") % 2 == 1
        c, p = np.nonzero(is_odd)
        odd_tile.append(r * nx + c)
        odd_part.append(part[s][first][p])
    odd_tile = np.concatenate(odd_tile) if odd_tile else np.empty(0, "i8")
    odd_part = np.concatenate(odd_part) if odd_part else np.empty(0, "i4")
    inner = (e_row >= r0) & (e_row <= r1) & (e_col >= c0) & (e_col <= c1)
    e_id = (e_row[inner] - r0) * nx + e_col[inner] - c0
    order = np.lexsort((e_tile[inner], e_id))
    e_id, e_no = e_id[order], e_tile[inner][order]
    tiles = np.union1d(e_id, odd_tile)
    o = np.lexsort((odd_part, odd_tile))
    odd_tile, odd_part = odd_tile[o], odd_part[o]
    e_off = np.concatenate([np.searchsorted(e_id, tiles), [len(e_id)]])
    o_off = np.concatenate([np.searchsorted(odd_tile, tiles), [len(odd_tile)]])
    cls = np.where(np.diff(e_off) > 0, 2, 0)
    return r0 + tiles // nx, c0 + tiles % nx, cls, e_no, e_off, odd_part, o_off


def outline_tiles(polygons: DataFrame, *, geom: str = "geom", tile_deg: float = 1.0) -> DataFrame:
    """Every other column of ``polygons`` with ``ty, tx, cls, edges, odd``, one row per tile.

    Its size follows the outlines (an edge is in the few tiles it crosses) and the tiles inside, not
    the points or lines.  A NULL or empty geometry has no tiles.
    """
    attrs = [c for c in polygons.columns if c != geom]

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for i in range(b.num_rows):
                part, ax, ay, bx, by = (np.asarray(b.column(len(attrs) + k)[i].values.to_numpy(zero_copy_only=False), t)
                                        for k, t in enumerate(("i4", "f8", "f8", "f8", "f8")))
                if not len(ax):
                    continue
                ty, tx, cls, no, e_off, odd, o_off = cut_outline(part, ax, ay, bx, by, tile_deg)
                edges = pa.StructArray.from_arrays([pa.array(part[no], pa.int32()), *[pa.array(v[no]) for v in (ax, ay, bx, by)]],
                                                   fields=[pa.field("part", pa.int32()), *[pa.field(x, pa.float64()) for x in _KEYS[1:]]])
                same = b.slice(i, 1).take(pa.array(np.zeros(len(ty), "i8")))
                yield pa.RecordBatch.from_arrays(
                    [*[same.column(k) for k in range(len(attrs))], pa.array(ty), pa.array(tx), pa.array(cls.astype("i4")),
                     pa.ListArray.from_arrays(pa.array(e_off.astype("i4")), edges),
                     pa.ListArray.from_arrays(pa.array(o_off.astype("i4")), pa.array(odd.astype("i4")))],
                    [*attrs, "ty", "tx", "cls", "edges", "odd"])

    flat = polygons.where(F.col(geom).isNotNull()).select(*attrs, *_edge_columns(geom))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in polygons.schema if f.name != geom)
    return flat.mapInArrow(run, (ddl + ", " if ddl else "") + f"ty bigint, tx bigint, cls int, edges array<{EDGE}>, odd array<int>")


def split_cell(part, ax, ay, bx, by, odd, lv: int, cy: int, cx: int, tile_deg: float):
    """The quarters of a cell that its polygon reaches: (cy, cx, edge numbers, odd parts) each."""
    size, half = tile_deg / 2 ** lv, tile_deg / 2 ** (lv + 1)
    xc, yc = (cx + 0.5) * size, (cy + 0.5) * size
    eps = 1e-9 * half
    slack = eps * (np.abs(bx - ax) + np.abs(by - ay))
    parts = np.union1d(part, odd)
    of = np.searchsorted(parts, part)
    anchor = np.isin(parts, odd)
    for y, x in ((2 * cy + i, 2 * cx + j) for i in (0, 1) for j in (0, 1)):
        x0, x1, y0, y1 = x * half - eps, (x + 1) * half + eps, y * half - eps, (y + 1) * half + eps
        near = (np.minimum(ax, bx) <= x1) & (np.maximum(ax, bx) >= x0) & (np.minimum(ay, by) <= y1) & (np.maximum(ay, by) >= y0)
        cross = np.stack([(bx - ax) * (v - ay) - (by - ay) * (u - ax) for u in (x0, x1) for v in (y0, y1)])
        near &= (cross.max(0) >= -slack) & (cross.min(0) <= slack)           # not all corners on one side
        n = np.bincount(of, _changes(ax, ay, bx, by, (x + 0.5) * half, (y + 0.5) * half, xc, yc), len(parts)).astype("i8")
        inside = parts[anchor ^ (n % 2 == 1)]
        if near.any() or len(inside):
            yield y, x, np.flatnonzero(near), inside


def _split(cells: DataFrame, attrs: list[str], tile_deg: float) -> DataFrame:
    """Every row of a cell -> the rows of its quarters."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            for i in range(b.num_rows):
                lv, cy, cx = (b.column(k)[i].as_py() for k in ("lv", "ty", "tx"))
                e = b.column("edges")[i].values
                part, ax, ay, bx, by = (e.field(k).to_numpy(zero_copy_only=False) for k in range(5))
                odd = np.asarray(b.column("odd")[i].values, "i4")
                kids = list(split_cell(part, ax, ay, bx, by, odd, lv, cy, cx, tile_deg))
                if not kids:
                    continue
                same = b.slice(i, 1).take(pa.array(np.zeros(len(kids), "i8")))
                no = pa.array(np.concatenate([k[2] for k in kids]).astype("i8"))

                def offsets(j):
                    return pa.array(np.concatenate([[0], np.cumsum([len(k[j]) for k in kids])]).astype("i4"))
                yield pa.RecordBatch.from_arrays(
                    [*[same.column(k) for k in attrs], pa.array([k[0] for k in kids], pa.int64()), pa.array([k[1] for k in kids], pa.int64()),
                     pa.array([2 if len(k[2]) else 0 for k in kids], pa.int32()), pa.ListArray.from_arrays(offsets(2), e.take(no)),
                     pa.ListArray.from_arrays(offsets(3), pa.array(np.concatenate([k[3] for k in kids]).astype("i4"))),
                     pa.array([lv + 1] * len(kids), pa.int32()), pa.array([False] * len(kids))],
                    [*attrs, "ty", "tx", "cls", "edges", "odd", "lv", "blank"])
    cells = cells.select(*attrs, "ty", "tx", "cls", "edges", "odd", "lv", "blank")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema)
    return cells.mapInArrow(run, types)


@dataclass
class FineTiles:
    """``cells``: the rows of ``outline_tiles`` with ``lv`` and ``blank`` (a cell that no polygon reaches,
    kept where its tile was split); ``levels``: ``ty, tx, lvs`` of the tiles that were, or None."""
    cells: DataFrame
    levels: DataFrame | None

    def by_tile(self) -> dict[tuple[int, int], list[int]]:
        """Levels of each split tile; a grid of whole tiles has 360 * 180 of them at one degree."""
        return {} if self.levels is None else {(r["ty"], r["tx"]): sorted(r["lvs"]) for r in self.levels.collect()}


def fine_tiles(polygons: DataFrame, *, geom: str = "geom", tile_deg: float = 1.0, limit: int = EDGE_LIMIT,
               splits: int = MAX_SPLITS) -> FineTiles:
    """``outline_tiles`` with dense tiles split into quarters until a cell has ``limit`` edges at most.

    Edges are counted per cell over all polygons, in Spark; a row is split on its own, from its own
    edges and anchor.  Outlines with fewer edges than ``limit`` in all are not split and not stored.
    """
    attrs = [c for c in polygons.columns if c != geom]
    tiles = outline_tiles(polygons, geom=geom, tile_deg=tile_deg).withColumn("lv", F.lit(0)).withColumn("blank", F.lit(False))
    rings = F.flatten(F.transform(geom, lambda p: F.transform(p, lambda r: F.size(r).cast("bigint"))))
    if (polygons.agg(F.sum(F.aggregate(rings, F.lit(0).cast("bigint"), lambda a, n: a + n))).first()[0] or 0) <= limit:
        return FineTiles(tiles, None)
    here, leaves = materialize(tiles, "outline-tiles"), []
    for lv in range(splits):
        dense = materialize(here.groupBy("ty", "tx").agg(F.sum(F.size("edges")).alias("n")).where(F.col("n") > limit)
                            .select("ty", "tx"), "dense-tiles")
        if dense.isEmpty():
            break
        leaves.append(here.join(dense, ["ty", "tx"], "left_anti"))
        quarter = F.explode(F.array(*[F.struct((F.col("ty") * 2 + i).alias("y"), (F.col("tx") * 2 + j).alias("x"))
                                      for i in (0, 1) for j in (0, 1)])).alias("q")
        blank = dense.select(quarter).select(F.col("q.y").alias("ty"), F.col("q.x").alias("tx"), F.lit(0).alias("cls"),
                                             F.array().cast(f"array<{EDGE}>").alias("edges"), F.array().cast("array<int>").alias("odd"),
                                             F.lit(lv + 1).alias("lv"), F.lit(True).alias("blank"))
        kids = _split(here.join(dense, ["ty", "tx"], "left_semi").where("not blank"), attrs, tile_deg)
        here = materialize(kids.select(here.columns).unionByName(blank, allowMissingColumns=True), "outline-tiles")
    cells = here
    for part in leaves:
        cells = cells.unionByName(part)
    if not leaves:
        return FineTiles(cells, None)
    levels = cells.where("lv > 0").groupBy(F.expr("shiftright(ty, lv)").alias("ty"), F.expr("shiftright(tx, lv)").alias("tx")).agg(
        F.collect_set("lv").alias("lvs"))
    return FineTiles(cells, materialize(levels, "split-tiles"))


def by_part(edges: Column, odd: Column) -> Column:
    """A cell's edges, part by part, so that a look-up visits each edge once: part, odd, edges."""
    parts = F.array_distinct(F.concat(F.transform(edges, lambda e: e["part"]), odd))
    return F.transform(parts, lambda p: F.struct(
        F.array_contains(odd, p).alias("odd"), F.filter(edges, lambda e: e["part"] == p).alias("edges")))


def inside_tile(x: Column, y: Column, tile: Column, size: float) -> Column:
    """Whether a point of a boundary cell is inside the polygon; on its outline it is not.

    ``tile``: struct with ``ty, tx, lv, parts`` (``by_part``); ``size``: width of a tile.  Higher-order
    functions over the cell's edges only, each visited once for its side and once for touching.
    """
    width = F.lit(size) / F.pow(F.lit(2.0), tile["lv"])
    xc, yc = (tile["tx"] + 0.5) * width, (tile["ty"] + 0.5) * width

    def cross(e: Column, px: Column, py: Column) -> Column:
        return (e["bx"] - e["ax"]) * (py - e["ay"]) - (e["by"] - e["ay"]) * (px - e["ax"])

    def left(e: Column, px: Column, py: Column) -> Column:
        c = cross(e, px, py)
        return (c > 0) | ((c == 0) & ((e["by"] < e["ay"]) | ((e["by"] == e["ay"]) & (e["bx"] > e["ax"]))))

    def crossings(e: Column) -> Column:
        upright = ((e["ax"] > x) != (e["bx"] > x)) & (left(e, x, y) != left(e, x, yc))
        level = ((e["ay"] > yc) != (e["by"] > yc)) & (left(e, x, yc) != left(e, xc, yc))
        return upright.cast("int") + level.cast("int")

    def touches(e: Column) -> Column:
        return (cross(e, x, y) == 0) & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])) \
            & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))

    def holds(p: Column) -> Column:
        return F.aggregate(p["edges"], p["odd"].cast("int"), lambda a, e: a + crossings(e)) % 2 == 1

    return F.exists(tile["parts"], holds) & ~F.exists(tile["parts"], lambda p: F.exists(p["edges"], touches))


# ------------------------------------------------------------------ lines
def one_line_each(lines: DataFrame, key: str, geom: str) -> DataFrame:
    """``line_id, line, g``: a row per line.  A road may be a list of lines, and several rows may share its
    key; ``line`` tells them apart (a hash of the points and of the place in the list)."""
    several = lines.schema[geom].dataType.elementType.typeName() == "array"
    k = F.col(key).alias("line_id")
    rows = lines.select(k, F.posexplode(geom).alias("n", "g")) if several else lines.select(k, F.lit(0).alias("n"), F.col(geom).alias("g"))
    return rows.where(F.size("g") > 1).select("line_id", F.xxhash64("n", "g").alias("line"), "g")


def _grid_cuts(a, b, x0, y0, x1, y1, size: float):
    """Segments, from share a to share b, cut where they cross the grid: (segment, from, to, ty, tx)."""
    n = np.arange(len(a))
    cuts, shares = [n, n], [a, b]
    for p, q in ((x0, x1), (y0, y1)):
        u, v = p + a * (q - p), p + b * (q - p)
        at, grid = _spans(np.floor(np.minimum(u, v) / size).astype("i8") + 1, np.ceil(np.maximum(u, v) / size).astype("i8") - 1)
        cuts.append(at)
        shares.append(np.clip((grid * size - p[at]) / (q - p)[at], a[at], b[at]))
    c, t = np.concatenate(cuts), np.concatenate(shares)
    o = np.lexsort((t, c))
    c, t = c[o], t[o]
    k = np.flatnonzero(c[:-1] == c[1:])
    k = k[(t[k + 1] > t[k]) | (a[c[k]] == b[c[k]]) | (t[k] == 0.0) & (t[k + 1] == 1.0)]
    c, t0, t1 = c[k], t[k], t[k + 1]
    mid = (t0 + t1) / 2
    ty = np.floor((y0[c] + mid * (y1 - y0)[c]) / size).astype("i8")
    tx = np.floor((x0[c] + mid * (x1 - x0)[c]) / size).astype("i8")
    return c, t0, t1, ty, tx


def cut_lines(lines: DataFrame, *, tile_deg: float = 1.0, split: dict[tuple[int, int], list[int]] | None = None) -> DataFrame:
    """``line_id, line, lv, ty, tx, alone, pieces``: each line's pieces, cut at the borders of the cells.

    ``lines``: ``line_id, line, g`` (``one_line_each``).  A piece is (segment number, from, to, the
    segment's ends); from and to are shares of the segment, so pieces of neighbouring cells meet in the
    same number.  In a tile that was split (``split``: its levels) a piece is cut for each level; it
    meets a cell on one of them.  alone: the line has this cell only.
    """
    dense = sorted(split or {})
    levels = sorted({lv for k in dense for lv in split[k]})

    def tiles_with(ty, tx, lv):
        if not hasattr(tiles_with, "known"):
            tiles_with.known = {v: {k for k in dense if v in split[k]} for v in levels} | {None: set(dense)}
        known = tiles_with.known[lv]
        return np.fromiter(((y, x) in known for y, x in zip(ty.tolist(), tx.tolist())), bool, len(ty))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            points = b.column(2)
            n = np.diff(points.offsets.to_numpy())
            flat = points.flatten()
            lon, lat = (np.asarray(flat.field(k).to_numpy(zero_copy_only=False), "f8") for k in (0, 1))
            if not len(lon):
                continue
            line = np.repeat(np.arange(len(n)), n)
            seg_no = np.arange(len(lon)) - np.repeat(np.cumsum(n) - n, n)
            s = np.flatnonzero((line[:-1] == line[1:]))
            ends = lon[s], lat[s], lon[s + 1], lat[s + 1]
            c, t0, t1, ty, tx = _grid_cuts(np.zeros(len(s)), np.ones(len(s)), *ends, tile_deg)
            lv = np.zeros(len(c), "i8")
            if dense:
                fine = [(c, t0, t1, ty, tx, lv)]
                whole = ~tiles_with(ty, tx, None)
                fine = [tuple(v[whole] for v in fine[0])]
                for l in levels:
                    m = np.flatnonzero(~whole)
                    m = m[tiles_with(ty[m], tx[m], l)]
                    k, f0, f1, fy, fx = _grid_cuts(t0[m], t1[m], *[e[c[m]] for e in ends], tile_deg / 2 ** l)
                    fine.append((c[m][k], f0, f1, fy, fx, np.full(len(k), l)))
                c, t0, t1, ty, tx, lv = (np.concatenate(v) for v in zip(*fine))
            ln = line[s][c]
            o = np.lexsort((t0, c, tx, ty, lv, ln))
            c, t0, t1, ty, tx, lv, ln = c[o], t0[o], t1[o], ty[o], tx[o], lv[o], ln[o]
            if not len(ln):
                continue
            new = np.concatenate([[True], (ln[1:] != ln[:-1]) | (lv[1:] != lv[:-1]) | (ty[1:] != ty[:-1]) | (tx[1:] != tx[:-1])])
            first = np.flatnonzero(new)
            cells_of = np.bincount(ln[first], minlength=len(n))
            pieces = pa.StructArray.from_arrays(
                [pa.array(seg_no[s][c].astype("i4")), *[pa.array(v) for v in (t0, t1, *[e[c] for e in ends])]],
                names=["seg", "t0", "t1", "x0", "y0", "x1", "y1"])
            at = pa.array(ln[first])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), pa.array(lv[first].astype("i4")), pa.array(ty[first]), pa.array(tx[first]),
                 pa.array(cells_of[ln[first]] == 1), pa.ListArray.from_arrays(pa.array(np.concatenate([first, [len(ln)]]).astype("i4")), pieces)],
                ["line_id", "line", "lv", "ty", "tx", "alone", "pieces"])

    kind = lines.schema["line_id"].dataType.simpleString()
    return lines.mapInArrow(run, (
        f"line_id {kind}, line bigint, lv int, ty bigint, tx bigint, alone boolean, "
        "pieces array<struct<seg:int,t0:double,t1:double,x0:double,y0:double,x1:double,y1:double>>"))


def _pairs(a_off: np.ndarray, b_off: np.ndarray, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All (a, b) of equal rows: items a with rows given by offsets (or ``of``), items b by offsets."""
    row = np.repeat(np.arange(len(a_off) - 1), np.diff(a_off)) if of is None else of
    a, b = _spans(b_off[:-1][row], b_off[1:][row] - 1)
    return a, b


def clip_pieces(p: dict, p_off: np.ndarray, e: dict, e_off: np.ndarray, odd: np.ndarray, o_off: np.ndarray,
                xc: np.ndarray, yc: np.ndarray):
    """Pieces of many (line, tile, polygon) rows against each row's edges, all at once.

    Returns the sub-pieces (row, piece, from, to) that lie inside, and the rows that touch the outline.
    """
    row = np.repeat(np.arange(len(p_off) - 1), np.diff(p_off))
    a, b = _pairs(p_off, e_off)
    x0, y0, dx, dy = p["x0"], p["y0"], p["x1"] - p["x0"], p["y1"] - p["y0"]
    ex, ey = (e["bx"] - e["ax"])[b], (e["by"] - e["ay"])[b]
    denom = dx[a] * ey - dy[a] * ex
    qx, qy = e["ax"][b] - x0[a], e["ay"][b] - y0[a]
    ok = denom != 0
    safe = np.where(ok, denom, 1.0)
    t, u = (qx * ey - qy * ex) / safe, (qx * dy[a] - qy * dx[a]) / safe
    hit = ok & (t >= p["t0"][a]) & (t <= p["t1"][a]) & (u >= 0) & (u <= 1)
    touched = np.zeros(len(p_off) - 1, bool)
    touched[row[a[hit]]] = True
    c = np.concatenate([np.arange(len(row)), np.arange(len(row)), a[hit]])
    s = np.concatenate([p["t0"], p["t1"], t[hit]])
    o = np.lexsort((s, c))
    c, s = c[o], s[o]
    k = np.flatnonzero((c[:-1] == c[1:]) & (s[1:] > s[:-1]))
    piece, t0, t1 = c[k], s[k], s[k + 1]
    # the middle of each sub-piece: sides changed on the way to the tile's centre, per part
    m = (t0 + t1) / 2
    mx, my, r = x0[piece] + m * dx[piece], y0[piece] + m * dy[piece], row[piece]
    a, b = _pairs(None, e_off, r) if len(r) else (np.empty(0, "i8"), np.empty(0, "i8"))
    n = _changes(*(e[k][b] for k in _KEYS[1:]), mx[a], my[a], xc[r][a], yc[r][a])
    oa, ob = _pairs(None, o_off, r) if len(r) else (np.empty(0, "i8"), np.empty(0, "i8"))
    who = np.concatenate([a, oa])
    part = np.concatenate([e["part"][b], odd[ob]]).astype("i8")
    change = np.concatenate([n, np.ones(len(oa), "i8")])
    key, at = np.unique(who * (1 << 31) + part, return_inverse=True)
    is_odd = np.bincount(at, weights=change, minlength=len(key)).astype("i8") % 2 == 1
    inside = np.zeros(len(piece), bool)
    inside[(key >> 31)[is_odd]] = True
    return r[inside], piece[inside], t0[inside], t1[inside], touched
