"""A stored vector index: lists by nearest centre, and searches that open only the blocks they need (V1, V2).

Layout under ``path``: ``lists/`` (the vectors, normalised, with their other columns, partitioned by
``list_id``), ``blocks/`` (one row per list, ring and load: rows, least and largest distance from the
list's centre), ``centres/`` (one row per list) and ``schema/``.  A ring is the vectors of a list at similar
distance from its centre.  New vectors are assigned to the stored centres, without a new fit.

Distances are those of unit vectors, so that the triangle inequality holds: a vector v of a list with
centre c is no nearer to a query q than | |q - c| - |v - c| |.  The exact search first opens each query's
nearest lists until they hold k others; from then on its k-th distance bounds what can still matter, and
of all other lists only the rings within that reach are opened.  The approximate search opens a share of
the lists.  Either way only the opened lists' folders are read.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import materialize, scratch_path
from .vectors import BLOCK_ROWS, IVF_LISTS, IVF_SHARE, TOP_K, blocked_topk, build_lists

#: vectors per list that the fit sees, at most; every vector is indexed
FIT_ROWS_PER_LIST = 32
#: groups of centres that a new vector looks into
GROUPS_TRIED = 4
#: lists of an index made for one search, at most (their centres come to the driver)
SEARCH_LISTS = 4096


def _distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((v * v).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2.0 * (v @ c.T), 0.0))


def _grouped(centres: np.ndarray, rounds: int = 10) -> np.ndarray:
    """Group number of every centre: about as many groups as centres in a group."""
    g = max(1, math.isqrt(len(centres)))
    heads = centres[np.linspace(0, len(centres) - 1, g).astype(int)]
    for _ in range(rounds):
        of = _distances(centres, heads).argmin(1)
        heads = np.stack([centres[of == i].mean(0) if (of == i).any() else heads[i] for i in range(g)])
    return _distances(centres, heads).argmin(1)


class Centres:
    """The lists' centres in two levels; a few megabytes, shipped to the tasks."""

    def __init__(self, centres: np.ndarray, group: np.ndarray):
        self.centres, self.group = centres, group
        self.members = [np.flatnonzero(group == g) for g in np.unique(group)]
        self.heads = np.stack([centres[m].mean(0) for m in self.members])

    def assign(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(list, distance from its centre): the nearest centre of the few nearest groups."""
        tried = np.argsort(_distances(v, self.heads), axis=1, kind="stable")[:, :GROUPS_TRIED]
        best, far = np.zeros(len(v), "i8"), np.full(len(v), np.inf)
        for g, members in enumerate(self.members):
            rows = np.flatnonzero((tried == g).any(1))
            if len(rows):
                d = _distances(v[rows], self.centres[members])
                k = d.argmin(1)
                near = d[np.arange(len(rows)), k]
                better = near < far[rows]
                best[rows[better]], far[rows[better]] = members[k[better]], near[better]
        # the distance as the bounds use it, from the difference itself
        return best, np.linalg.norm(v - self.centres[best], axis=1)


def _stack(vecs: pd.Series) -> np.ndarray:
    return np.stack(vecs.to_numpy()).astype(np.float64)


def _unit(df: DataFrame, id_col: str, vec_col: str, others: list[str]) -> DataFrame:
    """``id, vec`` (length one) and the other columns; vectors without a direction are left out."""
    norm = F.sqrt(F.aggregate(vec_col, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    d = df.select(F.col(id_col).alias("id"), F.transform(vec_col, lambda x: x.cast("double")).alias("vec"), norm.alias("_n"), *others)
    return d.where((F.col("_n") > 0) & (F.col("_n") < float("inf"))).withColumn(
        "vec", F.transform("vec", lambda x: x / F.col("_n"))).drop("_n")


class VectorIndex:
    """An index in a folder that all executors share.  ``VectorIndex(spark, path)`` opens a stored one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        rows = sorted(spark.read.parquet(f"{path}/centres").collect(), key=lambda r: r["list_id"])   # one per list
        self.centres = Centres(np.array([r["centre"] for r in rows]), np.array([r["grp"] for r in rows]))
        self.widths = spark.read.parquet(f"{path}/centres").select("list_id", "width")
        #: stored too, so that opening the lists reads no file of a list that is not asked
        self.schema = StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()[0]))

    @classmethod
    def build(cls, vectors: DataFrame, path: str, *, n_lists: int = IVF_LISTS, id_col: str = "event_id", vec_col: str = "emb",
              fit_rows: int = FIT_ROWS_PER_LIST, block_rows: int = BLOCK_ROWS, seed: int = 7) -> "VectorIndex":
        """Fit the centres on at most about ``fit_rows`` vectors a list (chosen by a hash of the id), then
        index every vector with all of its columns.  Fewer vectors than lists are an error."""
        spark = vectors.sparkSession
        rows = materialize(_unit(vectors, id_col, vec_col, [c for c in vectors.columns if c not in (id_col, vec_col)]), "index-input")
        n = rows.count()
        part = int(min(1.0, fit_rows * n_lists / max(n, 1)) * (1 << 20))
        sample = rows.where(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 20)) < part)
        if part < (1 << 20) and sample.count() < n_lists:
            sample = rows
        fitted = build_lists(sample, n_lists=n_lists, vec_col="vec", seed=seed, max_iter=10)
        centres = Centres(fitted, _grouped(fitted))
        assigned = materialize(_assigned(rows, centres), "index-assigned")
        size = {r["list_id"]: r for r in assigned.groupBy("list_id").agg(
            F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}          # one row per list

        def width(i):
            r = size.get(i)
            return 1.0 if r is None or r["far"] == 0 else r["far"] / math.ceil(r["n"] / block_rows) * (1 + 1e-9)
        spark.createDataFrame([(i, int(g), c.tolist(), width(i)) for i, (c, g) in enumerate(zip(fitted, centres.group))],
                              "list_id int, grp int, centre array<double>, width double").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/centres")
        kept = StructType([assigned.schema[c] for c in assigned.columns if c != "list_id"] + [
            StructField("ring", IntegerType()), StructField("list_id", IntegerType())])
        spark.createDataFrame([(kept.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/schema")
        index = cls(spark, path)
        index._store(assigned, "overwrite")
        return index

    def add(self, vectors: DataFrame, *, id_col: str = "event_id", vec_col: str = "emb") -> None:
        """Index more vectors (with the columns of the first ones) by the stored centres."""
        others = [c for c in self.lists().columns if c not in ("list_id", "ring", "id", "vec", "far")]
        self._store(materialize(_assigned(_unit(vectors, id_col, vec_col, others), self.centres), "index-assigned"), "append")

    def _store(self, assigned: DataFrame, mode: str) -> None:
        ringed = assigned.join(F.broadcast(self.widths), "list_id").withColumn(      # one row per list
            "ring", F.floor(F.col("far") / F.col("width")).cast("int")).drop("width")
        # what bounds a list is stored before its vectors, so a load that fails between leaves bounds that hold
        ringed.groupBy("list_id", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("lo"), F.max("far").alias("hi")) \
            .write.mode(mode).parquet(f"{self.path}/blocks")
        ringed.repartitionByRange("list_id", "ring", "id").sortWithinPartitions("list_id", "ring", "id") \
            .write.mode(mode).partitionBy("list_id").parquet(f"{self.path}/lists")

    def lists(self, ids: list[int] | None = None) -> DataFrame:
        """The stored vectors, of some lists only if ``ids`` says so (their folders alone are read)."""
        d = self.spark.read.schema(self.schema).parquet(f"{self.path}/lists")
        return d if ids is None else d.where(F.col("list_id").isin(ids))

    def blocks(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/blocks").groupBy("list_id", "ring").agg(
            F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    def _sizes(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows and radius of every list."""
        n, r = np.zeros(len(self.centres.centres), "i8"), np.zeros(len(self.centres.centres))
        for row in self.blocks().groupBy("list_id").agg(F.sum("n").alias("n"), F.max("hi").alias("r")).collect():
            n[row["list_id"]], r[row["list_id"]] = row["n"], row["r"]
        return n, r

    def probes(self, queries: DataFrame) -> DataFrame:
        """Rings that queries open: ``qid, qvec, asks`` (lists with the query's distance ``d``; ``reach``,
        null: without bound) -> ``list_id, ring, qid, qvec, n``."""
        asks = queries.select("qid", "qvec", "reach", F.explode("asks").alias("a")).select(
            "qid", "qvec", "reach", F.col("a.list_id").alias("list_id"), F.col("a.d").alias("d"))
        b = self.blocks()
        near = F.col("reach").isNull() | ((F.col("hi") >= F.col("d") - F.col("reach")) & (F.col("lo") <= F.col("d") + F.col("reach")))
        return asks.join(b, "list_id").where(near).select("list_id", "ring", "qid", "qvec", "n")

    def _open(self, queries: DataFrame, k: int, block_rows: int, exclude_self: bool, decimals, base, same: list[str],
              opened: list | None) -> DataFrame:
        probes = materialize(self.probes(queries), "index-probes")
        ids = sorted(r[0] for r in probes.select("list_id").distinct().collect())        # at most one per list
        rows = self.lists(ids).select("list_id", "ring", "id", "vec", *same)
        if base is not None:
            rows = rows.join(base, ["id", *same], "left_semi")
        rows = rows.drop(*same)
        if opened is not None:
            opened.append(probes.agg(F.sum("n")).first()[0] or 0)
        return blocked_topk(rows, probes.drop("n"), ["list_id", "ring"], k, block_rows, exclude_self,
                            rows.schema["id"].dataType.simpleString(), decimals=decimals)

    def search(self, query: DataFrame, *, k: int = TOP_K, share: float = IVF_SHARE, exact: bool = False, id_col: str = "event_id",
               vec_col: str = "emb", exclude_self: bool = True, decimals: int | None = None, base: DataFrame | None = None,
               same: tuple[str, ...] = (), block_rows: int = BLOCK_ROWS, opened: list | None = None) -> DataFrame:
        """The k nearest of every query: ``query_event, neighbor_event, cosine_distance, cosine_similarity``.

        The ``share`` of lists nearest to a query is opened, and further ones until they hold k others;
        with ``exact`` also every ring elsewhere that can hold a nearer vector.  ``base``: only vectors
        whose id it has, with equal values of the columns ``same``.  Ties go by id (of distances rounded to ``decimals``, if given).  ``opened``
        receives the number of (query, vector) pairs of each pass.
        """
        q = _unit(query, id_col, vec_col, []).select(F.col("id").alias("qid"), F.col("vec").alias("qvec"))
        n, radius = self._sizes()
        if base is not None:                     # rows of each list that count: at most one number per list
            base = base.select(F.col(id_col).alias("id"), *same).distinct()
            n = np.zeros_like(n)
            for r in self.lists().select("list_id", "id", *same).join(base, ["id", *same], "left_semi").groupBy("list_id").count().collect():
                n[r["list_id"]] = r["count"]
        least = k + int(exclude_self)
        first = _nearest(self.centres.centres, n, 1 if exact else max(1, math.ceil(share * len(n))), least)
        q = materialize(q.withColumn("asks", first("qvec")).withColumn("reach", F.lit(None).cast("double")), "index-queries")
        found = self._open(q, k, block_rows, exclude_self, decimals, base, list(same), opened)
        if exact:
            found = materialize(found, "index-found")
            kth = found.groupBy("query_event").agg(F.count(F.lit(1)).alias("_n"), F.max("cosine_distance").alias("_d"))
            slack = 1e-9 if decimals is None else 10.0 ** -decimals
            reach = F.when(F.col("_n") >= k, F.sqrt(2.0 * (F.greatest(F.col("_d"), F.lit(0.0)) + slack)) + 1e-7)
            more = q.drop("reach").join(kth, q["qid"] == kth["query_event"], "left").withColumn("reach", reach)
            more = more.withColumn("asks", _within(self.centres.centres, radius, n)("qvec", "reach", F.transform("asks", lambda a: a["list_id"])))
            rest = self._open(more.where(F.size("asks") > 0).select("qid", "qvec", "asks", "reach"), k, block_rows, exclude_self,
                              decimals, base, list(same), opened)
            cols = ["query_event", "neighbor_event", "cosine_distance", "cosine_similarity"]
            w = Window.partitionBy("query_event").orderBy("cosine_distance", "neighbor_event")
            found = found.select(cols).unionByName(rest.select(cols)).withColumn("_rn", F.row_number().over(w)) \
                .where(F.col("_rn") <= k).drop("_rn")
        return found


def refresh(vectors: DataFrame, path: str, *, id_col: str = "event_id", vec_col: str = "emb", **build) -> VectorIndex:
    """The index under ``path``, with every row of ``vectors`` in it: opened if it is there, else built.

    Rows are known by their id and a hash of their vector (column ``vec_hash``): only new ones are
    assigned.  A search with ``base=`` the same rows and ``same=("vec_hash",)`` leaves out what is no
    longer current.
    """
    spark = vectors.sparkSession
    rows = with_hash(vectors, vec_col)
    try:
        index = VectorIndex(spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return VectorIndex.build(rows, path, id_col=id_col, vec_col=vec_col, **build)
    held = index.lists().select(F.col("id").alias(id_col), "vec_hash")
    new = materialize(rows.join(held, [id_col, "vec_hash"], "left_anti"), "index-new")
    if not new.isEmpty():
        index.add(new, id_col=id_col, vec_col=vec_col)
    return index


def with_hash(vectors: DataFrame, vec_col: str = "emb") -> DataFrame:
    return vectors.withColumn("vec_hash", F.xxhash64(F.transform(vec_col, lambda x: x.cast("double"))))


def _assigned(rows: DataFrame, centres: Centres) -> DataFrame:
    @F.pandas_udf("list_id int, far double")
    def place(vecs: pd.Series) -> pd.DataFrame:
        if not len(vecs):
            return pd.DataFrame({"list_id": pd.Series([], dtype="int32"), "far": pd.Series([], dtype="float64")})
        of, far = centres.assign(_stack(vecs))
        return pd.DataFrame({"list_id": of.astype("i4"), "far": far})
    return rows.withColumn("_p", place("vec")).select("*", F.col("_p.list_id").alias("list_id"), F.col("_p.far").alias("far")).drop("_p")


_ASK = "array<struct<list_id:int,d:double>>"


def _asks(lists: np.ndarray, d: np.ndarray) -> list[dict]:
    return [{"list_id": int(i), "d": float(x)} for i, x in zip(lists, d)]


def _nearest(centres: np.ndarray, n: np.ndarray, probe: int, least: int):
    """The ``probe`` nearest lists of a vector that hold any rows, and further ones until they hold ``least``."""
    some = np.flatnonzero(n)

    @F.pandas_udf(_ASK)
    def nearest(vecs: pd.Series) -> pd.Series:
        if not len(vecs) or not len(some):
            return pd.Series([[] for _ in range(len(vecs))], dtype=object)
        d = _distances(_stack(vecs), centres[some])
        order = np.argsort(d, axis=1, kind="stable")
        held = np.cumsum(n[some][order], axis=1)
        p = np.minimum(np.maximum(probe, (held < least).sum(1) + 1), len(some))
        return pd.Series([_asks(some[o[:m]], row[o[:m]]) for o, m, row in zip(order, p, d)], dtype=object)
    return nearest


def _within(centres: np.ndarray, radius: np.ndarray, n: np.ndarray):
    """Lists that can hold a vector within ``reach`` (null: any), without those already opened."""
    @F.pandas_udf(_ASK)
    def within(vecs: pd.Series, reach: pd.Series, opened: pd.Series) -> pd.Series:
        if not len(vecs):
            return pd.Series([], dtype=object)
        d = _distances(_stack(vecs), centres)
        far = np.where(np.isnan(reach.to_numpy(dtype="f8")), np.inf, reach.to_numpy(dtype="f8"))
        can = (d - radius[None, :] <= far[:, None] + 1e-7) & (n > 0)[None, :]
        for i, o in enumerate(opened):
            can[i, np.asarray(o, dtype="i8")] = False
        return pd.Series([_asks(np.flatnonzero(c), row[c]) for c, row in zip(can, d)], dtype=object)
    return within


def search_exact(base: DataFrame, query: DataFrame, n: int, *, k: int, id_col: str, vec_col: str, block_rows: int,
                 exclude_self: bool, decimals: int | None) -> DataFrame:
    """Exact top-k of a base of ``n`` vectors by an index made for this search, in the shared scratch folder."""
    lists = max(1, min(SEARCH_LISTS, 4 * math.isqrt(n), n))
    index = VectorIndex.build(base.select(id_col, vec_col), scratch_path(base.sparkSession, "search-index"), n_lists=lists,
                              id_col=id_col, vec_col=vec_col, block_rows=block_rows)
    return index.search(query, k=k, exact=True, id_col=id_col, vec_col=vec_col, exclude_self=exclude_self,
                        decimals=decimals, block_rows=block_rows)
