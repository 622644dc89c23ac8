"""Secret scan: spans of credentials in every text, and how widely each value is held.

Found values are counted over the whole corpus by distinct repositories and owners: an example key
that many owners copied is told apart from a credential that only its owner holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import text_col


@dataclass(frozen=True)
class Kind:
    """A kind of secret: all leftmost matches of ``pattern``; those whose ``group`` has fewer than
    ``least`` characters are dropped afterwards (they still use up their text)."""
    name: str
    pattern: str
    group: int
    least: int


# fixed values: the patterns of the base kinds, in the order in which equal starts are listed
KINDS = (
    Kind("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 16),
    # a run of 32 or more is the same as the runs of any length of which shorter ones are dropped
    Kind("hex", r"[0-9a-f]{32,}", 0, 32),
)
WIDE_OWNERS = 3


def _spans(text: Column, kind: Kind, order: int) -> Column:
    """Array of (start, ord, kind, end, value); positions in code points, end exclusive.

    The gaps between the matches (``split``) and the matches themselves add up to the positions.
    """
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    value = whole if kind.group == 0 else F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    gaps = F.split(text, kind.pattern, -1)
    pairs = F.zip_with(F.zip_with(whole, value, lambda m, v: F.struct(m.alias("m"), v.alias("v"))),
                       F.slice(gaps, 1, F.size(whole)),
                       lambda p, g: F.struct(F.length(g).alias("gap"), F.length(p["m"]).alias("n"), p["v"].alias("v")))
    empty = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int,value:string>>")
    walked = F.aggregate(
        pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda a, p: F.struct(
            (a["at"] + p["gap"] + p["n"]).alias("at"),
            F.when(F.length(p["v"]) >= kind.least, F.concat(a["out"], F.array(F.struct(
                (a["at"] + p["gap"]).alias("start"), F.lit(order).alias("ord"), F.lit(kind.name).alias("kind"),
                (a["at"] + p["gap"] + p["n"]).alias("end"), p["v"].alias("value"))))).otherwise(a["out"]).alias("out")),
        lambda a: a["out"])
    return F.when(text.rlike(kind.pattern), walked).otherwise(empty)


def scan(docs: DataFrame, *, kinds=KINDS) -> DataFrame:
    """``docs`` rows as ``doc_id, text_hash`` and ``found``: spans by start, then kind as listed.

    A null text counts as empty and has none; equal starts keep the order of ``kinds``.
    """
    t = F.col("_text")
    found = F.array_sort(F.concat(*[_spans(t, k, i) for i, k in enumerate(kinds)]))
    return docs.select("*", text_col().alias("_text")).withColumn("found", found) \
               .withColumn("text_hash", F.xxhash64("_text")).drop("_text")


def span_list(found: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def ownership(found: DataFrame, *, wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """``value_hash, n_rows, n_repositories, n_owners, wide`` of each value in the corpus.

    ``found``: ``owner, repository, value_hash``.  Rows are combined per (value, owner, repository)
    before the shuffle, so a value held by a third of all documents reaches the next step as its
    distinct repositories only; those are counted per owner, then the owners per value.
    """
    per_repo = found.groupBy("value_hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    per_owner = per_repo.groupBy("value_hash", "owner").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("repositories"))
    return per_owner.groupBy("value_hash").agg(
        F.sum("n").alias("n_rows"), F.sum("repositories").alias("n_repositories"),
        F.count(F.lit(1)).alias("n_owners")).withColumn("wide", F.col("n_owners") >= wide_owners)


def secret_scan(docs: DataFrame, *, owner: str = "source", repository: str = "lang", kinds=KINDS,
                wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """One row per document: ``doc_id, found, n_wide, n_live``.

    n_wide: its spans whose value at least ``wide_owners`` owners hold (copied examples); n_live: the
    others, held by few owners.  Null owners and repositories count as one owner or repository each.
    Rows that repeat id and text are scanned alike and counted each; a null text counts as empty; an
    empty table gives no rows.
    """
    d = docs.select("doc_id", "text", F.col(owner).cast("string").alias("_owner"),
                    F.col(repository).cast("string").alias("_repository"))
    s = scan(d, kinds=kinds).select("doc_id", "text_hash", "_owner", "_repository", "found")
    s = materialize(s, "secret-spans")                    # ids and spans only; texts are read once
    each = s.select("doc_id", "text_hash", "_owner", "_repository", F.explode("found").alias("f")).select(
        "doc_id", "text_hash", F.col("_owner").alias("owner"), F.col("_repository").alias("repository"),
        F.xxhash64("f.value").alias("value_hash"))
    wide = ownership(each, wide_owners=wide_owners).where("wide").select("value_hash", F.lit(1).alias("hit"))
    # spans of one document with one value are combined before the join; repeats of a row count once
    per_doc = each.groupBy("doc_id", "text_hash", "owner", "repository", "value_hash").agg(F.lit(1).alias("one")) \
                  .join(wide, "value_hash", "left")
    hits = per_doc.where("hit = 1").groupBy("doc_id", "text_hash").agg(
        F.collect_set("value_hash").alias("wide_values"))   # at most the spans of one text
    h = hits.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "wide_values")
    j = s.join(h, s["doc_id"].eqNullSafe(h["_d"]) & (s["text_hash"] == h["_h"]), "left")
    n_wide = F.size(F.filter("found", lambda f: F.array_contains(
        F.coalesce("wide_values", F.array().cast("array<bigint>")), F.xxhash64(f["value"]))))
    return j.select("doc_id", "found", n_wide.cast("bigint").alias("n_wide"),
                    (F.size("found") - n_wide).cast("bigint").alias("n_live"))
