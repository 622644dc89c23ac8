"""Best-fit packing of token sequences: greedy filling, then the best-two-fit exchange."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .tokens import encoder, slices, vocabulary

CAPACITY = 4096
END_ID = 1
BINS_PER_GROUP = 2048


def pieces(docs: DataFrame, *, vocab: str | None = None, lower_words: bool = True, end_id: int = END_ID,
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every document.

    A document is its token ids and the end id (a null or empty text: the end id alone).  Only a
    longer one is cut, into pieces of ``capacity`` ids, the last of which may be shorter.
    """
    path = vocab or vocabulary("word_bpe_49k.json")
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def run(batches):
        import pyarrow as pa
        enc = encoder(path, lower_words)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in slices(texts):
                out = defaultdict(list)
                for doc_id, data in zip(ids[lo:hi], enc.encode(texts[lo:hi])):
                    data += end
                    for k, at in enumerate(range(0, len(data), step)):
                        part = data[at:at + step]
                        out["doc_id"].append(doc_id)
                        out["piece"].append(k)
                        out["start"].append(at // 4)
                        out["length"].append(len(part) // 4)
                        out["ids_crc32"].append(zlib.crc32(part))
                        if with_ids:
                            out["ids"].append(np.frombuffer(part, dtype="<u4").astype("i4"))
                arrays = [pa.array(out["doc_id"], pa.int64()), pa.array(out["piece"], pa.int32())]
                arrays += [pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32")]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(out["ids"], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, schema + (", ids array<int>" if with_ids else ""))


def fill(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item (lengths from 1 to ``capacity``).

    A bin is filled with the longest item that still fits, again and again.  If a gap is left, its
    smallest item is replaced by the two unpacked items that fill the widened gap best, if they
    leave less of it than the item did.  Items of one length are interchangeable and taken in
    order, so the result only depends on the order of the rows.
    """
    order = np.argsort(lengths, kind="stable")
    bounds = np.searchsorted(lengths[order], np.arange(capacity + 2))
    count = np.diff(bounds)
    bins: list[list[int]] = []                  # lengths in each bin
    while (present := np.flatnonzero(count)).size:
        gap, content = capacity, []
        while (k := int(np.searchsorted(present, gap, side="right"))):
            size = int(present[k - 1])
            n = min(int(count[size]), gap // size)
            content += [size] * n
            gap -= n * size
            count[size] -= n
            present = present[:k - 1]           # smaller ones only: none of this size is left or fits
        if gap and content:
            smallest, room = content[-1], gap + content[-1]
            left = np.flatnonzero(count[:room])                  # a pair needs two parts below the room
            if left.size:
                other = np.searchsorted(left, room - left, side="right") - 1
                ok = other >= 0
                b = left[np.maximum(other, 0)]
                twice = ok & (b == left) & (count[left] < 2)      # the same length twice: two must be there
                b = np.where(twice, left[np.maximum(other - 1, 0)], b)
                ok &= ~(twice & (other < 1))
                both = np.where(ok & (left + b <= room), left + b, 0)
                best = int(both.argmax())
                if both[best] > smallest:
                    content.pop()
                    count[smallest] += 1
                    for size in (int(left[best]), int(b[best])):
                        content.append(size)
                        count[size] -= 1
        bins.append(content)
    at = bounds[:-1].copy()
    bin_of, offset = np.empty(len(lengths), "i8"), np.empty(len(lengths), "i8")
    for k, content in enumerate(bins):
        place = 0
        for size in content:
            row = order[at[size]]
            at[size] += 1
            bin_of[row], offset[row] = k, place
            place += size
    return bin_of, offset


def pack(parts: DataFrame, *, capacity: int = CAPACITY, bins_per_group: int = BINS_PER_GROUP) -> DataFrame:
    """``parts`` (any table with ``doc_id, piece, length``) with ``sequence_id`` and ``offset``.

    Rows are dealt by hash into groups of about ``bins_per_group`` full sequences each, which are
    packed on their own: a group has a bounded number of tokens, and only its last few bins stay
    open, about one sequence in ``bins_per_group``.  The number of groups follows the tokens.
    """
    total = parts.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (capacity * bins_per_group)))
    key = F.pmod(F.xxhash64("doc_id", "piece", *[c for c in ("start", "ids_crc32") if c in parts.columns]),
                 F.lit(groups))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([c for c in ("doc_id", "piece", "ids_crc32") if c in pdf], kind="stable")
        group = int(pdf["_group"].iloc[0])
        bin_of, offset = fill(pdf["length"].to_numpy().astype("i8"), capacity)
        return pdf.drop(columns="_group").assign(sequence_id=(group << 32) + bin_of, offset=offset)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return parts.withColumn("_group", key).groupBy("_group").applyInPandas(
        run, schema + ", sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, *, capacity: int = CAPACITY, with_ids: bool = False, **how) -> DataFrame:
    """Tokenise, cut and pack: one row per piece.

    The pieces are stored first (in the shared folder), so that no text is tokenised twice and a
    lost executor repeats its own task only.  Rows that repeat an id are packed as rows of their own;
    an empty table gives no rows.
    """
    return pack(materialize(pieces(docs, capacity=capacity, with_ids=with_ids, **how), "pack-pieces"),
                capacity=capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, input_ids`` of pieces packed ``with_ids`` (at most a capacity each)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("_p")).select(
        "sequence_id", "n_tokens", F.flatten(F.transform("_p", lambda p: p["ids"])).alias("input_ids"))
