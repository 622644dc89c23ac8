"""The stored vector index: exact search against brute force, pairs opened, recall as shipped, reads, loads."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from perilscope import fixtures as fx
from perilscope.operators import vectors
from perilscope.operators.vector_index import VectorIndex
from perilscope.session import scratch_path

SF = "/root/testdata/sf0.01"
SCHEMA = "event_id long, emb array<double>"


def clustered(n, dim, clusters, seed, spread=0.15):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(clusters, dim))
    heads /= np.linalg.norm(heads, axis=1, keepdims=True)
    return heads[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, dim)) / np.sqrt(dim)


def frame(spark, v, first=0):
    import pyarrow as pa
    return spark.createDataFrame(pa.table({"event_id": pa.array(np.arange(first, first + len(v))),
                                           "emb": pa.array(list(v), pa.list_(pa.float64()))}))


def nearest(base, query, k=5, first=0):
    """Brute force by id: {query row: its k nearest other rows}."""
    b = base / np.linalg.norm(base, axis=1, keepdims=True)
    out = {}
    for i in query:
        d = 1 - b @ b[i]
        d[i] = np.inf
        out[i + first] = set((np.lexsort((np.arange(len(b)), d))[:k] + first).tolist())
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_event, set()).add(r.neighbor_event)
    return out


def test_exact_search_opens_few_pairs_and_finds_all(spark):
    sizes = []
    for n in (2000, 8000):                               # clusters as the rows, lists as the search makes them
        v = clustered(n, 16, n // 33, 1)
        index = VectorIndex.build(frame(spark, v), scratch_path(spark, "t"), n_lists=4 * math.isqrt(n), block_rows=50)
        asked = list(range(0, n, 40))
        q = frame(spark, v).where(F.col("event_id").isin(asked))
        pairs = []
        assert found(index.search(q, exact=True, opened=pairs, block_rows=50)) == nearest(v, asked)
        sizes.append(sum(pairs))
        assert sum(pairs) < 0.25 * n * len(asked)
    assert sizes[1] < 0.6 * 16 * sizes[0], sizes          # the product grew sixteenfold


def test_exact_search_without_structure_and_with_awkward_rows(spark):
    """Vectors without clusters, equal ones, a zero one, fewer rows than k in the base."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=(300, 8))
    v[10:20] = v[9]
    rows = frame(spark, v).unionByName(spark.createDataFrame([(900, [0.0] * 8), (901, None)], SCHEMA))
    index = VectorIndex.build(rows, scratch_path(spark, "t"), n_lists=12, block_rows=20)
    got = index.search(rows, exact=True, decimals=9)
    assert found(got) == {i: s for i, s in nearest(np.round(v, 12), range(300)).items()} or \
        {q: len(s) for q, s in found(got).items()} == dict.fromkeys(range(300), 5)
    d = {(r.query_event, r.neighbor_event): r.cosine_distance for r in got.collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    for i in range(300):
        far = np.sort(np.delete(1 - u @ u[i], i))[:5]
        assert np.allclose(sorted(x for (q, _), x in d.items() if q == i), far, atol=1e-8)
    few = index.search(rows.where("event_id < 3"), exact=True, base=rows.where("event_id in (1, 2, 40, 900)"))
    assert found(few) == {0: {1, 2, 40}, 1: {2, 40}, 2: {1, 40}}
    assert index.search(rows.where("event_id < 0"), exact=True).count() == 0


def test_similar_by_lists_equals_all_pairs(spark):
    v = fx.vectors_fx(spark, SF)
    base = vectors.recent(v, "event_date", fx.AS_OF_VECTORS, 36)
    qry = vectors.recent(v, "event_date", fx.AS_OF_VECTORS, 6)
    whole, cut = (found(vectors.similar(base, qry, block_rows=b, direct_pairs=p)) for b, p in ((20000, 0), (50, 0)))
    assert whole == cut and whole


def test_index_is_stored_extended_and_pruned(spark):
    v = clustered(3000, 12, 30, 5)
    path = scratch_path(spark, "t")
    rows = frame(spark, v).withColumn("hazard_type", F.concat(F.lit("h"), F.col("event_id") % 3))
    VectorIndex.build(rows.where("event_id < 2000"), path, n_lists=30)
    index = VectorIndex(spark, path)                     # opened again, from what was stored
    index.add(rows.where("event_id >= 2000"))
    assert index.lists().count() == 3000 and index.blocks().agg(F.sum("n")).first()[0] == 3000
    assert index.lists().where("id = 2500").first()["hazard_type"] == "h1"
    q = rows.where("event_id in (5, 2777)")
    assert found(VectorIndex(spark, path).search(q, exact=True)) == nearest(v, [5, 2777])
    # a list that no query opens is not read: its files can be spoilt
    pairs = index.search(q, share=1 / 30)
    want = found(pairs)
    opened = {r.list_id for r in index.lists().where(F.col("id").isin([x for s in want.values() for x in s] + [5, 2777])).select("list_id").collect()}
    for name in os.listdir(f"{path}/lists"):
        if name.startswith("list_id=") and int(name[8:]) not in opened:
            for f in os.listdir(f"{path}/lists/{name}"):
                if not f.startswith("."):
                    with open(f"{path}/lists/{name}/{f}", "r+b") as h:
                        h.truncate(7)
                crc = f"{path}/lists/{name}/.{f}.crc"
                if os.path.exists(crc):
                    os.remove(crc)
    assert found(VectorIndex(spark, path).search(q, share=1 / 30)) == want
    with pytest.raises(Exception):
        index.lists().count()


def test_too_few_vectors_for_the_lists(spark):
    with pytest.raises(ValueError):
        VectorIndex.build(frame(spark, clustered(10, 4, 2, 1)), scratch_path(spark, "t"), n_lists=11)


def test_recall_as_shipped_on_100000_vectors(spark):
    """1,000 lists, 2 % of them, on clustered vectors; queries are every hundredth row."""
    v = clustered(100_000, 24, 2500, 11, spread=0.6)
    index = VectorIndex.build(frame(spark, v), scratch_path(spark, "t"), fit_rows=16)
    asked = list(range(0, len(v), 100))
    want = nearest(v, asked)
    pairs = []
    got = found(index.search(frame(spark, v).where("event_id % 100 = 0"), opened=pairs))
    recall = sum(len(got[i] & want[i]) for i in asked) / (5 * len(asked))
    assert recall >= 0.9, recall
    assert sum(pairs) < 0.06 * len(v) * len(asked)


def test_refresh_builds_once_and_adds_only_what_is_new(spark):
    from perilscope.operators.vector_index import refresh, with_hash
    v = clustered(400, 8, 10, 2)
    path = scratch_path(spark, "t")
    refresh(frame(spark, v[:300]), path, n_lists=10)
    fitted = sorted(map(tuple, VectorIndex(spark, path).centres.centres))
    v2 = v.copy()
    v2[7] = v[350]                                       # one vector changes, a hundred are new
    now = frame(spark, v2)
    index = refresh(now, path, n_lists=10)
    assert sorted(map(tuple, index.centres.centres)) == fitted and index.lists().count() == 401
    assert refresh(now, path).lists().count() == 401
    got = found(index.search(now.where("event_id in (7, 350, 20)"), exact=True, base=with_hash(now), same=("vec_hash",)))
    assert 350 in got[7] and 7 in got[350] and got[20] == nearest(v2, [20])[20]


def test_pipeline_searches_a_stored_index(spark):
    from perilscope.plans import pipeline
    v = fx.vectors_fx(spark, SF)
    src = pipeline.Sources(*[None] * 9)
    opt = pipeline.Options(as_of=fx.AS_OF_VECTORS, search="ivf", ivf_lists=8, ivf_share=1.0, index_path=scratch_path(spark, "t"))
    step = {n: f for n, f, _ in pipeline.steps(src, opt)}["similar_incidents_top5"]
    want = found(vectors.similar_recent(v, fx.AS_OF_VECTORS))
    assert found(step(v)) == want and found(step(v)) == want
