"""Mixing sources to target weights: repetition rates per source, then whole and drawn copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .common import WORD, hash_unit, text_col

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = "mix-1"


def _ranked_sources(sizes: DataFrame) -> DataFrame:
    """``source, source_size, rank``: the place of each source by code point, null last.

    Places are counted within range partitions; only one count per partition is collected, so a
    table with one source per web host is numbered without a single-task sort.
    """
    parts = sizes.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn(
        "_part", F.spark_partition_id())
    parts = materialize(parts, "mix-sources")
    before, offsets = 0, {}
    for r in parts.groupBy("_part").count().orderBy("_part").collect():   # one row per partition
        offsets[r["_part"]] = before
        before += r["count"]
    if not offsets:
        return parts.select("source", "source_size", F.lit(0).cast("bigint").alias("rank"))
    offset = F.create_map(*[x for k, v in offsets.items() for x in (F.lit(k), F.lit(v))])[F.col("_part")]
    w = Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())
    return parts.select("source", "source_size", (offset + F.row_number().over(w) - 1).cast("bigint").alias("rank"))


def source_targets(sizes: DataFrame, *, weights: Sequence[int] = WEIGHTS,
                   most: int = MOST_REPEATS) -> DataFrame:
    """``source, source_size, weight, target`` from ``source, source_size`` (one row per source).

    The sources, by code point with null last, weigh ``weights`` in turn and share the sum of all
    sizes; a target stops at ``most`` times its source's size and what is cut off is shared again by
    weight until none is above.  Each round is one aggregate over the table of sources; it ends when
    the set of stopped sources no longer grows.  Sources without any words get 0.
    """
    w = F.array(*[F.lit(int(x)) for x in weights])
    t = materialize(_ranked_sources(sizes).withColumn(
        "weight", F.element_at(w, (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))), "mix-weights")
    cap = (F.col("source_size") * F.lit(int(most))).cast("double")
    total = t.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        is_stopped = cap <= F.lit(level) * F.col("weight") if stopped >= 0 else F.lit(False)
        r = t.agg(F.coalesce(F.sum(F.when(is_stopped, F.col("source_size") * int(most))), F.lit(0)).alias("cut"),
                  F.coalesce(F.sum(F.when(~is_stopped, F.col("weight"))), F.lit(0)).alias("open"),
                  F.sum(F.when(is_stopped, 1).otherwise(0)).alias("n")).first()
        if not r["open"] or r["n"] == stopped:
            break
        stopped = r["n"]
        level = (total - r["cut"]) / r["open"]
    return t.select("source", "source_size", "weight",
                    F.least(cap, F.lit(level) * F.col("weight")).alias("target"))


def plan_copies(docs: DataFrame, *, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS,
                seed: str = SEED) -> DataFrame:
    """``docs`` as a struct ``_row`` with its ``size``, ``source_size``, ``target`` and ``copies``.

    size: words of the text (null: 0).  The rate of a source is target / source size; a document is
    taken floor(rate) times and once more if its seeded draw (of seed, id and size) is below the
    fraction.  Equal ids and sizes draw alike; empty documents take part with size 0.  Null is a
    source of its own, the last in order; an empty table gives no rows.  The table of sources is joined by value: broadcast only if its stored size is below Spark's limit, else
    sorted, where Spark splits a hot source.
    """
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                    F.col("doc_id").alias("_id"), F.col("source").cast("string").alias("_source"),
                    F.coalesce(F.regexp_count(text_col(), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))
    sizes = d.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    t = materialize(source_targets(sizes, weights=weights, most=most), "mix-targets")
    j = d.join(t, d["_source"].eqNullSafe(t["source"]))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))) \
            .otherwise(F.lit(0.0))
    j = j.withColumn("_rate", rate).withColumn("_draw", hash_unit(F.lit(seed), F.col("_id"), F.col("size")))
    copies = F.floor("_rate") + (F.col("_draw") < F.col("_rate") - F.floor("_rate")).cast("int")
    return j.select("_row", "_id", "size", "source_size", "target", copies.cast("bigint").alias("copies"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, with the columns of ``docs``."""
    p = plan_copies(docs, **how).where("copies > 0")
    return p.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")


def mix_report(docs: DataFrame, **how) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every document."""
    return plan_copies(docs, **how).select(
        F.col("_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"))
