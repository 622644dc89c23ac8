"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: a word: a run without ASCII white space
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def text_col(name: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_remainder(n: int, name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def hash_unit(*cols: Column) -> Column:
    """A repeatable draw in [0, 1): the first 52 bits of an md5 digest of the joined values."""
    joined = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    bits = F.conv(F.substring(F.md5(joined.cast("binary")), 1, 13), 16, 10).cast("bigint")
    return bits.cast("double") / F.lit(float(1 << 52))
