"""Readers for landed source files.

The reference pulls feeds over REST and CSV downloads; here the files are
already landed in a directory and each reader is one distributed scan.  Dirty
sources are read as declared all-text schemas and typed later with ``try_cast``
(no schema inference: it costs an extra pass and varies with the sample).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_wildcard(spark: SparkSession, pattern: str, *, merge_schema: bool = True) -> DataFrame:
    """Every table matching ``<dir>/storms_*`` as one scan; the suffix is not read."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(pattern)


def read_csv_landed(spark: SparkSession, path: str, columns: Sequence[str], *,
                    header: bool = True) -> DataFrame:
    """CSV with a header row and quoted newlines, every column as text.

    Header names are matched case-insensitively to ``columns`` by position-free
    lookup: the file's header must contain them (extra columns are ignored).  All
    files must have the same header: one with other columns, or the same in
    another order, stops the read instead of being read by position.
    """
    def reader():
        return (spark.read.option("header", str(header).lower())
                .option("multiLine", "true").option("quote", '"').option("escape", '"')
                .option("mode", "PERMISSIVE").option("inferSchema", "false"))

    schema = reader().csv(path).schema                    # the header of one file
    raw = reader().schema(schema).option("enforceSchema", "false").csv(path)   # checked in every file
    lower = {c.lower(): c for c in raw.columns}
    return raw.select(*[F.col(f"`{lower[c.lower()]}`").cast("string").alias(c) for c in columns])


def _page_items(value, item_ddl: str, list_keys: Sequence[str], file):
    """The item array of one JSON page body: an object holding one of
    ``list_keys``, or a bare array; an object without any of them has no items.  A
    body that is not whole JSON stops the read and names its file."""
    whole = F.try_parse_json(value)
    obj_ddl = "struct<" + ",".join(f"{k}:array<{item_ddl}>" for k in list_keys) + ">"
    head = F.ltrim(value)
    as_obj = F.from_json(value, obj_ddl)
    from_obj = F.coalesce(*[as_obj[k] for k in list_keys])
    as_list = F.from_json(value, f"array<{item_ddl}>")
    items = F.coalesce(F.when(head.startswith("["), as_list).when(head.startswith("{"), from_obj),
                       F.array().cast(f"array<{item_ddl}>"))
    return F.when(whole.isNull(), F.raise_error(F.concat(F.lit("page is not whole JSON: "), file))
                  .cast(f"array<{item_ddl}>")).otherwise(items)


def read_json_pages(spark: SparkSession, path: str, fields: Sequence[str], *,
                    list_keys: Sequence[str] = ("items",), stop_at_empty: bool = False) -> DataFrame:
    """Landed JSON page bodies -> one row per item, fields as text.

    Each file is one page (``wholetext``; a page is bounded by the source's page
    size).  With ``stop_at_empty`` the pages are numbered by the ``page=N``
    folder they sit in (within an optional ``query=Q`` folder, one per paged
    request), and pages after the first empty one of a request are ignored, as
    the paging client would never have fetched them.  Only a page that was parsed
    and holds no items is empty; one that cannot be parsed is an error.
    """
    item_ddl = "struct<" + ",".join(f"`{f}`:string" for f in fields) + ">"
    pages = (spark.read.option("wholetext", "true").text(path)
             .select(F.col("value"), F.col("_metadata.file_path").alias("_file")))
    pages = pages.withColumn("_items", _page_items(F.col("value"), item_ddl, list_keys, F.col("_file")))
    if stop_at_empty:
        pages = (pages.withColumn("_page", F.regexp_extract("_file", r"page=(\d+)", 1).cast("int"))
                 .withColumn("_query", F.regexp_extract("_file", r"query=([^/]+)", 1)))
        first_empty = (pages.where(F.size("_items") == 0).groupBy("_query")
                       .agg(F.min("_page").alias("_stop")))
        pages = (pages.join(first_empty, "_query", "left")
                 .where(F.col("_stop").isNull() | (F.col("_page") < F.col("_stop"))))
    return pages.select(F.explode("_items").alias("_it")).select(*[F.col(f"_it.`{f}`").alias(f) for f in fields])
