"""I-Match fingerprints: hashes of a document's mid-frequency terms under randomised lexicons.

The lexicon holds the terms whose document frequency lies in a band of shares of the corpus.  Its
size is bounded whatever the corpus: every term in it takes at least ``low`` of all documents, so
there are at most (mean distinct terms of a document) / ``low`` of them.  It becomes an ``IN`` set
of the expression, and everything else is computed inside the row, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import text_col

LOW, HIGH = 0.005, 0.20
#: (level, subset): at level l the lexicon is dealt at random into 2**l subsets
SUBSETS = tuple((level, i) for level in range(1, 9) for i in range(min(2 ** level, 6)))
BLOCKS_PER_PARTITION = 8


def terms(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), "")


def lexicon(docs: DataFrame, *, low: float = LOW, high: float = HIGH) -> list[str]:
    """The terms held by a share of ``low`` to ``high`` of all documents, counted over all of them."""
    n = docs.count()
    df = docs.select(F.explode(terms(text_col())).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    band = df.where((F.col("df") >= max(2.0, low * n)) & (F.col("df") <= high * n))
    return sorted(r[0] for r in band.select("term").collect())


def _in(x: Column, words: list[str]) -> Column:
    return x.isin(words) if words else F.lit(False)


def signature(text: Column, words: list[str], subsets=SUBSETS) -> Column:
    """Array of one hash per subset of the lexicon: of the sorted distinct terms of the text in it.

    A subset without a term of the text gives null.  The last element hashes all terms of the text,
    and the text itself if it has none, so that texts without a lexicon term still differ.
    """
    all_terms = terms(text)
    return F.transform(F.array(F.struct(all_terms.alias("t"))), lambda a: _hashes(a["t"], text, words, subsets))[0]


def _hashes(all_terms: Column, text: Column, words: list[str], subsets) -> Column:
    kept = F.array_sort(F.filter(all_terms, lambda t: _in(t, words)))
    hashed = F.transform(kept, lambda t: F.xxhash64(t))
    whole = F.when(F.size(all_terms) > 0, F.xxhash64(F.array_sort(all_terms))).otherwise(F.xxhash64(text))

    def per_subset(h: Column) -> Column:
        out = []
        for level, i in subsets:
            # disjoint bits of the hash for each level, so levels deal the terms independently
            part = F.filter(h, lambda x: F.shiftrightunsigned(x, level * (level - 1) // 2).bitwiseAND(
                F.lit((1 << level) - 1)) == i)
            out.append(F.when(F.size(part) > 0, F.xxhash64(part)))
        return F.array(*out, whole)

    return F.transform(F.array(F.struct(hashed.alias("h"))), lambda a: per_subset(a["h"]))[0]


def fingerprint(sig: Column) -> Column:
    """The signature as text: 16 hex digits per subset, ``-`` for an empty one."""
    return F.array_join(F.transform(sig, lambda x: F.coalesce(F.lower(F.lpad(F.hex(x), 16, "0")), F.lit("-"))), ".")


def likeness(a: Column, b: Column) -> Column:
    """Share of the subsets with a term in either signature on which both agree (0 to 1).

    The last element counts too where neither has a lexicon term; equal signatures give 1.
    """
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    subsets = F.slice(pairs, 1, F.size(a) - 1)
    either = F.size(F.filter(subsets, lambda p: p["x"].isNotNull() | p["y"].isNotNull()))
    same = F.size(F.filter(subsets, lambda p: p["x"] == p["y"]))
    return F.when(F.element_at(a, -1) == F.element_at(b, -1), F.lit(1.0)) \
            .when(either > 0, same / either).otherwise(F.lit(0.0))


def fingerprints(docs: DataFrame, *, low: float = LOW, high: float = HIGH) -> DataFrame:
    """``docs`` with ``signature``; a null text counts as empty."""
    words = lexicon(docs, low=low, high=high)
    return docs.withColumn("signature", signature(text_col(), words))


def with_next(docs: DataFrame, cols: list[str]) -> DataFrame:
    """Each row with ``next_<c>`` of the row that follows it by descending ``doc_id`` (after the last: the first).

    Rows go once to blocks, whose bounds are quantiles of the ids (their number follows the shuffle
    partitions); the first row of a block is also sent to the block before it, so that each block
    looks ahead on its own.  Null ids come last; rows that share an id are ordered by ``_tie``.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * BLOCKS_PER_PARTITION
    q = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n + 1)], 20 * n).alias("q"),
                 F.max("doc_id").alias("top"), F.max(F.col("doc_id").isNull()).alias("nulls")).first()
    tops = sorted({*(q["q"] or []), *([] if q["top"] is None else [q["top"]])}, reverse=True)
    nulls = len(tops)                                         # the block of null ids
    last = nulls if q["nulls"] else nulls - 1
    bounds = F.array(*[F.lit(x) for x in tops]) if tops else F.array().cast("array<bigint>")
    block = F.when(F.col("doc_id").isNull(), F.lit(nulls)).otherwise(
        F.size(F.filter(bounds, lambda b: b >= F.col("doc_id"))) - 1)
    first_of_block = F.col("doc_id").isNull() | F.array_contains(bounds, F.col("doc_id"))
    guest = F.when(F.col("_block") > 0, F.col("_block") - 1).otherwise(F.lit(last))
    placed = docs.withColumn("_block", block).withColumn("_at", F.explode(
        F.when(first_of_block, F.array(F.struct(F.col("_block").alias("b"), F.lit(0).alias("guest")),
                                       F.struct(guest.alias("b"), F.lit(1).alias("guest"))))
         .otherwise(F.array(F.struct(F.col("_block").alias("b"), F.lit(0).alias("guest"))))))
    w = Window.partitionBy("_at.b").orderBy(F.col("_at.guest"), F.col("doc_id").desc_nulls_last(), F.col("_tie"))
    out = placed.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in cols])
    return out.where("_at.guest = 0").drop("_block", "_at")


def edited_fingerprints(docs: DataFrame, *, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to it and to the next document's.

    Edited: the last floor(n / 2) code points are replaced by the first as many (or all) of the next
    document.  ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    A null text counts as empty.  Null ids come last and rows of one id follow each other by the hash of
    their text; a lone document is its own next; an empty table gives no rows.
    """
    words = lexicon(docs, low=low, high=high)
    d = docs.select("doc_id", text_col().alias("_text"))
    d = d.withColumn("_sig", signature(F.col("_text"), words)).withColumn("_tie", F.xxhash64("_text"))
    d = with_next(d, ["_text", "_sig"])
    half = F.floor(F.length("_text") / 2).cast("int")
    d = d.withColumn("_edited", F.concat(
        F.substring(F.col("_text"), F.lit(1), F.length("_text") - half),
        F.substring(F.col("next__text"), F.lit(1), half)))
    d = d.withColumn("_esig", signature(F.col("_edited"), words))
    return d.select("doc_id", F.length("_text").cast("bigint").alias("n_chars"),
                    F.sha2("_edited", 256).alias("edited_sha256"),
                    fingerprint(F.col("_sig")).alias("fingerprint"),
                    fingerprint(F.col("_esig")).alias("edited_fingerprint"),
                    likeness(F.col("_sig"), F.col("_esig")).alias("near_edited"),
                    likeness(F.col("_sig"), F.col("next__sig")).alias("near_next"))
