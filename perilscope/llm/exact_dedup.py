"""Exact de-duplication by salted combining (equal texts, whole contents compared).

1. every task combines its own equal texts (partial aggregation keyed by digest, salt and text);
2. the rows of one (digest, salt) meet and are merged, so a text held by a third of all rows is
   spread over ``salts`` reducers, each of which gets at most one row per task;
3. the at most ``salts`` winners of a text are combined globally.

The whole text is part of the grouping key in all three, so a digest that clashes never merges two
different texts.  What is kept of a text is its row with the largest id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import text_col

SALTS = 16


def winners(docs: DataFrame, *, carry: list[str] | None = None, salts: int = SALTS,
            digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per distinct text: ``_text``, ``group_size`` and ``_best``.

    ``_best`` is the largest id, or with ``carry`` the largest struct of the id and the carried
    columns.  A null text counts as empty; a null id is smaller than any other; an empty table
    gives no rows.  ``digest`` only deals rows out: any function of the text gives the same result.
    """
    best = F.col("doc_id") if carry is None else F.struct("doc_id", *[c for c in carry if c != "doc_id"])
    rows = docs.select(text_col().alias("_text"), best.alias("_best")).select(
        digest(F.col("_text")).alias("_digest"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt"),
        "_text", "_best")
    salted = rows.groupBy("_digest", "_salt", "_text").agg(
        F.max("_best").alias("_best"), F.count(F.lit(1)).alias("group_size"))
    return salted.groupBy("_digest", "_text").agg(
        F.max("_best").alias("_best"), F.sum("group_size").alias("group_size")).drop("_digest")


def assign(docs: DataFrame, *, salts: int = SALTS) -> DataFrame:
    """Every row with its group: ``doc_id, keep_id, group_size, kept, text_sha256``.

    The winners, found by content, are looked up by the sha-256 of their text; the document side of
    that join holds ids and digests only and is split by Spark where one digest is hot.  Rows that
    repeat both the id and the text of the kept row are all marked kept (``survivors`` returns one).
    """
    w = winners(docs, salts=salts).select(F.sha2("_text", 256).alias("text_sha256"),
                                          F.col("_best").alias("keep_id"), "group_size")
    d = docs.select("doc_id", F.sha2(text_col(), 256).alias("text_sha256"))
    return d.join(w.hint("merge"), "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def survivors(docs: DataFrame, *, salts: int = SALTS) -> DataFrame:
    """The kept rows with the columns of ``docs``: one row per distinct text.

    A document whose text was null stays null if all of its group were null, else it is the empty
    text.  Whole repeats (same id, text and other columns) leave one row.  Other columns must be
    orderable (no maps); ties of the id are broken by them, in column order.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # the other columns stand in a struct of their own: no name of theirs can meet one of ours
    tagged = docs.select("doc_id", F.col("text").cast("string").alias("text"),
                         F.struct(*[F.col(c) for c in others], *([] if others else [F.lit(0)])).alias("_row"),
                         F.col("text").isNotNull().alias("_had_text"))
    best = F.col("_best")
    cols = [F.when(best["_had_text"], F.col("_text")).alias("text") if c == "text"
            else (best["doc_id"] if c == "doc_id" else best["_row"].getField(c)).alias(c) for c in docs.columns]
    return winners(tagged, carry=["_row", "_had_text"], salts=salts).select(*cols)
