"""Links of documents by the Jaccard similarity of their word shingles (token-group matrix).

1. *Sets.* Every text becomes its set of hashed 5-word shingles; documents with the same set are one
   class, and the rest works on classes.
2. *Groups.* Classes that share min-hashes are paired with a leader and a neighbour of their bucket
   (a bounded number of pairs per class, also in a bucket that holds a third of all rows); pairs are
   verified on whole sets, and what is linked becomes a group.
3. *Matrix.* Each group stores the union of its members' prefix tokens: the first ``n - ceil(t n) + 1``
   of a set in a common order, by band of sizes, with the sizes that a linked set may have if the token
   is the first that both share: all the overlap then lies at or behind it.  Classes of the smaller
   group query the larger one; only groups whose bound reaches the threshold are opened.
4. *Opened groups.* A class is compared with members drawn by token first; what they do not join to the
   group meets its members by the same bound, one by one.  Pairs are bounded by what both prefixes share
   and verified on whole sets.  Pairs inside one group are never looked at again: they are linked already.

At a late token a class and a group also meet by sketches: parities of whole sets, which differ in no more bits
than the sets in tokens.  So copies of one text that are too far apart for a link are not paired.

The order puts tokens that many documents share last (a list of bounded length), then goes by hash;
any order gives the same links.  Shingle hashes have 64 bits, class keys 128.
"""

from __future__ import annotations

from collections import Counter
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize, spread
from .tokens import slices

WIDTH = 5
#: similarity of 3/4: 100 * intersection >= 75 * union
NUM, DEN = 3, 4
HASHES, AGREE, SALTS = 8, 5, 64
#: min-hashes whose buckets also give neighbours
NEIGHBOURS = 4
#: rounds in which a class meets one member by token of a group it opens, before it meets all (speed only)
ROUNDS = 2
#: a token is ordered late if at least this share of the documents holds it
HOT_SHARE, HOT_LEAST = 1 / 20000, 16
#: prefixes are the tokens of the smallest hashes, a quarter of a set and little more: below this share of all hashes
COUNTED = 5 / 16
#: bits of a hash by which tokens are counted in classes first, and of these the ones that deal the classes to tasks
CLASS_BITS, PART_BITS = 26, 11
#: late tokens of a prefix that go with the next late one, so that two classes meet once, not at every token they share
BEFORE = 16
#: longs of a set's sketch
SKETCH = 8

_U = np.uint64
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD], "u8")
_MULTIPLIERS = np.array([(0xA0761D6478BD642F * (2 * k + 1)) & (2 ** 64 - 1) | 1 for k in range(1, HASHES + 1)], "u8")
_BASE, _SEGMENT = 0x9DDFEA08EB382D69, 1 << 19


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_values() -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value for each byte (A-Z those of a-z), and whether it is ASCII white space."""
    value = _mix(np.arange(1, 257, dtype="u8") * _U(0x9E3779B97F4A7C15))
    value[65:91] = value[97:123]
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return value, space


_VALUE, _SPACE = _byte_values()


class Shingler:
    """Sets of shingle hashes of a chunk of texts at a time, in numpy.

    A word's hash is the sum of its bytes' values times powers of an odd base (modulo 2^64), taken
    from running sums over the chunk; words are split on exactly the ASCII white space.
    """

    def __init__(self):
        self.power, self.inverse = np.ones(1, "u8"), np.ones(1, "u8")

    def _powers(self, n: int) -> None:
        while len(self.power) < n:
            m = len(self.power)
            up, down = _U(pow(_BASE, m, 2 ** 64)), _U(pow(pow(_BASE, -1, 2 ** 64), m, 2 ** 64))
            self.power = np.concatenate([self.power, self.power * up])
            self.inverse = np.concatenate([self.inverse, self.inverse * down])

    def words(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and start of each word of ``b`` (bytes that end with white space)."""
        space = _SPACE[b]
        start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        end = np.flatnonzero(~space[:-1] & space[1:]) + 1
        self._powers(len(b))
        total = np.concatenate([np.zeros(1, "u8"), np.cumsum(_VALUE[b] * self.power[:len(b)], dtype="u8")])
        h = (total[end] - total[start]) * self.inverse[start]
        return _mix(h + (end - start).astype("u8") * _ODD[0]), start

    def long_words(self, text: bytes) -> np.ndarray:
        """Word hashes of one long text, in segments cut at white space."""
        b = np.frombuffer(text + b" ", "u1")
        out, lo = [], 0
        while lo < len(b):
            hi = min(lo + _SEGMENT, len(b))
            while hi < len(b) and not _SPACE[b[hi - 1]]:
                gap = np.flatnonzero(_SPACE[b[hi:hi + _SEGMENT]])
                hi = hi + int(gap[0]) + 1 if len(gap) else min(hi + _SEGMENT, len(b))
            out.append(self.words(b[lo:hi])[0])
            lo = hi
        return np.concatenate(out)

    def sets(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text.

        Fewer than five words: one hash for the whole sequence; none: empty.
        """
        out: list[np.ndarray] = [np.empty(0, "u8")] * len(texts)
        small = []
        for i, t in enumerate(texts):
            if t and len(t) > _SEGMENT:
                out[i] = self._unique(self._shingles(self.long_words(t)))
            elif t:
                small.append(i)
        for lo, hi in slices([texts[i] for i in small], _SEGMENT):
            some = small[lo:hi]
            b = np.frombuffer(b" ".join([texts[i] for i in some]) + b" ", "u1")
            h, start = self.words(b)
            size = np.array([len(texts[i]) + 1 for i in some])
            first = np.searchsorted(start, np.concatenate([[0], np.cumsum(size)]))
            all5 = self._shingles(h) if len(h) >= WIDTH else None
            for k, i in enumerate(some):
                a, z = first[k], first[k + 1]
                if z - a >= WIDTH:
                    out[i] = self._unique(all5[a:z - WIDTH + 1].copy())
                elif z > a:
                    out[i] = self._shingles(h[a:z])
        return out

    @staticmethod
    def _shingles(h: np.ndarray) -> np.ndarray:
        n = min(len(h), WIDTH)
        if not n:
            return h
        s = np.full(len(h) - n + 1, n, "u8")
        for k in range(n):
            s += h[k:len(h) - n + 1 + k] * _ODD[k]
        return _mix(s)

    @staticmethod
    def _unique(s: np.ndarray) -> np.ndarray:
        s.sort()
        return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def min_hashes(s: np.ndarray) -> list[int]:
    x = s[None, :] * _MULTIPLIERS[:, None]
    return (x ^ (x >> _U(32))).min(1).view("i8").tolist()


def _key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set, as two signed integers."""
    from hashlib import blake2b
    return tuple(np.frombuffer(blake2b(s.tobytes(), digest_size=16).digest(), "<i8").tolist())


def prefix(s: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The first n - ceil(n t) + 1 tokens in the common order (hot ones last, then by hash)."""
    if len(hot) and len(s):
        at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
        is_hot = hot[at] == s
        s = np.concatenate([s[~is_hot], s[is_hot]])
    return s[:len(s) - -(-NUM * len(s) // DEN) + 1]


def sketch(s: np.ndarray) -> bytes:
    """Of each of 64 * ``SKETCH`` classes of hashes, whether the set has an odd number: a token in one of two sets
    only flips one bit, so two sketches differ in no more bits than the sets in tokens."""
    bits = 64 * SKETCH
    return np.packbits((np.bincount((s % _U(bits)).astype("i8"), minlength=bits) & 1).astype(bool)).tobytes()


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """4 * intersection >= 3 * union, in whole numbers."""
    i = len(np.intersect1d(a, b, assume_unique=True))
    return i > 0 and DEN * i >= NUM * (len(a) + len(b) - i)


_SHINGLER = Shingler()


def _pieces(batches, rows: int = 2000):
    """Record batches of fewer rows: their texts are Python objects one piece at a time."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def _bytes() -> Column:
    return F.col("text").cast("string").cast("binary").alias("text")


def _counts(batches):
    """Of each slice of texts its distinct tokens, ascending, and how many of the texts hold each; copies count each."""
    for b in _pieces(batches):
        texts = b.column(0).to_pylist()
        for lo, hi in slices(texts, 6_000_000):
            copies = Counter(t for t in texts[lo:hi] if t)
            sets = _SHINGLER.sets(list(copies))
            if any(map(len, sets)):
                token = np.concatenate(sets)
                if len(copies) == sum(copies.values()):
                    u, n = np.unique(token, return_counts=True)
                else:
                    order = np.argsort(token, kind="stable")
                    u, first = np.unique(token[order], return_index=True)
                    n = np.add.reduceat(np.repeat(list(copies.values()), list(map(len, sets)))[order], first)
                yield u, n.astype("i8")


def _packed(at: np.ndarray, n: np.ndarray) -> bytes:
    """Places (ascending, of two bytes) and counts: the gaps' low bytes, their high ones (mostly 0, which Spark's
    compression removes), then the counts, one byte each where all fit."""
    gap = np.diff(at, prepend=0).astype("<u2").view("u1").reshape(-1, 2)
    small = bool(n.max() < 256)
    return bytes([small]) + len(at).to_bytes(4, "little") + gap.T.tobytes() + n.astype("u1" if small else "<i8").tobytes()


def _unpacked(held: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(held[1:5], "little")
    low, high = np.frombuffer(held, "u1", 2 * size, 5).reshape(2, size).astype("i8")
    return np.cumsum(low + 256 * high), np.frombuffer(held, "u1" if held[0] else "<i8", size, 5 + 2 * size).astype("i8")


def hot_tokens(docs: DataFrame, least: int) -> np.ndarray:
    """Tokens that at least ``least`` documents hold: every token of every document is counted.

    First by class, the tokens of one value of their first ``CLASS_BITS`` bits: a task sends about a byte a token
    (``_packed``), and a class of fewer than ``least`` holds no such token.  Then token by token in the classes
    that are left, so that the many tokens of few documents are not shuffled one by one.  The list is bounded by
    (tokens of all documents) / ``least``, the classes by their bits.
    """
    shift, part = _U(64 - CLASS_BITS), CLASS_BITS - PART_BITS

    def by_class(batches):
        import pyarrow as pa
        for u, n in _counts(batches):
            c, first = np.unique(u >> shift, return_index=True)
            c, n = c.astype("i8"), np.add.reduceat(n, first)
            p, start = np.unique(c >> part, return_index=True)
            held = [_packed(c[a:z] & ((1 << part) - 1), n[a:z]) for a, z in zip(start, [*start[1:], len(c)])]
            yield pa.RecordBatch.from_arrays([pa.array(p.astype("i4")), pa.array(held, pa.binary())], ["part", "held"])

    def summed(batches):
        import pyarrow as pa
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for p, held in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at, n = _unpacked(held)
                totals.setdefault(p, np.zeros(1 << part, "i8"))[at] += n
        for p, n in totals.items():
            at = np.flatnonzero(n >= least)
            yield pa.RecordBatch.from_arrays([pa.array((p << part) + at, pa.int64())], ["class"])

    texts = docs.select(_bytes())
    rows = spread(texts.mapInArrow(by_class, "part int, held binary"), "part").mapInArrow(summed, "class bigint").toPandas()
    if rows.empty:
        return np.empty(0, "u8")
    full = np.zeros(1 << CLASS_BITS, bool)
    full[rows["class"].to_numpy("i8")] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(full))

    def by_token(batches):
        import pyarrow as pa
        for u, n in _counts(batches):
            c = (u >> shift).astype("i8")
            told = (shared.value[c >> 3] >> (7 - (c & 7)).astype("u1")) & 1 == 1
            yield pa.RecordBatch.from_arrays([pa.array(u[told].view("i8")), pa.array(n[told])], ["token", "n"])

    counted = texts.mapInArrow(by_token, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") >= least).select("token").toPandas()
    return np.sort(rows["token"].to_numpy("i8").view("u8"))


def shingle_sets(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """``doc_id, th, n, c1, c2, m0.., prefix, sketch``: text hash, and size, key and min-hashes of every document's set.

    ``prefix`` (binary, tokens in order) and ``sketch`` (binary) come once per class and task.  Empty sets have n = 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        import pyarrow as pa
        names = ["doc_id", "th", "n", "c1", "c2", *[f"m{k}" for k in range(HASHES)], "prefix", "sketch"]
        types = [pa.int64()] * (5 + HASHES) + [pa.binary()] * 2
        seen = set()
        for b in _pieces(batches):
            ids, texts, hashes = (b.column(i).to_pylist() for i in range(3))
            for lo, hi in slices(texts, 8_000_000):
                rows = []
                for doc_id, th, s in zip(ids[lo:hi], hashes[lo:hi], _SHINGLER.sets(texts[lo:hi])):
                    key = _key(s)
                    m = min_hashes(s) if len(s) else [0] * HASHES
                    first = (None, None) if key in seen or not len(s) else (prefix(s, shared.value).tobytes(), sketch(s))
                    seen.add(key)
                    rows.append((doc_id, th, len(s), *key, *m, *first))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    ms = ", ".join(f"m{k} bigint" for k in range(HASHES))
    return docs.select(F.col("doc_id").cast("bigint"), _bytes(), _text_hash()).mapInArrow(
        run, f"doc_id bigint, th bigint, n bigint, c1 bigint, c2 bigint, {ms}, prefix binary, sketch binary")


def bucket_pairs(classes: DataFrame) -> DataFrame:
    """``a, b`` (a > b): each class with the leader and with a neighbour of its buckets.

    A bucket is the classes with one value of one min-hash.  Its smallest class leads; neighbours
    follow each other in one of ``SALTS`` parts of the bucket, so no part gets a whole hot bucket.
    Pairs on which too few min-hashes agree are left to the exact step.
    """
    ms = F.array(*[f"m{k}" for k in range(HASHES)])
    b = classes.select("c1", "m0", "m1", F.posexplode(ms).alias("r", "v"))
    lead = b.groupBy("r", "v").agg(F.min("c1").alias("lead"), F.count(F.lit(1)).alias("size")).where("size > 1")
    stars = b.join(lead, ["r", "v"]).where("c1 <> lead").select(F.col("c1").alias("a"), F.col("lead").alias("b"))
    w = Window.partitionBy("r", "v", F.pmod("c1", F.lit(SALTS))).orderBy("m0", "m1", "c1")
    near = b.where(F.col("r") < NEIGHBOURS).withColumn("b", F.lag("c1").over(w)).where("b is not null and b <> c1").select(F.col("c1").alias("a"), "b")
    pairs = stars.union(near).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    one = classes.select("c1", "n", ms.alias("m"))
    x = one.select(F.col("c1").alias("a"), F.col("n").alias("na"), F.col("m").alias("ma"))
    y = one.select(F.col("c1").alias("b"), F.col("n").alias("nb"), F.col("m").alias("mb"))
    agree = F.size(F.filter(F.zip_with("ma", "mb", lambda p, q: p == q), lambda e: e))
    return pairs.join(x, "a").join(y, "b").where((agree >= AGREE) & _sizes_fit("na", "nb")).select("a", "b")


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _id_key(name: str) -> Column:
    """The id, null as the smallest number: a plain key of an equi-join."""
    return F.coalesce(F.col(name).cast("bigint"), F.lit(-(2 ** 63)))


@contextmanager
def _bloom_filters(spark):
    """Joins planned meanwhile may drop rows by a Bloom filter before they shuffle, at any input size
    (by default from 10 GB on); its bits are bounded by Spark's own setting."""
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "0")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _sizes_fit(a: str, b: str) -> Column:
    return DEN * F.least(a, b) >= NUM * F.greatest(a, b)


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The ``pairs`` whose sets are linked, compared whole.

    The sets are made from the texts of one document of each class that is needed; the join that
    fetches the texts is by id and text hash, so that rows of one id, null ids too, do not meet each
    other, and Spark can drop the others by a Bloom filter before it moves any.
    """
    need = pairs.select(F.explode(F.array("a", "b")).alias("c1")).distinct()
    need = materialize(need.join(classes.select("c1", "c2", "doc", "th"), "c1").select(
        "c1", "c2", _id_key("doc").alias("key"), "th", F.lit(1).alias("wanted")), "wanted-sets").where("wanted = 1")
    texts = docs.select(_id_key("doc_id").alias("key"), _text_hash().alias("th"), _bytes())
    found = texts.join(need, ["key", "th"]).select("c1", "c2", "text")

    def sets(batches):
        import pyarrow as pa
        for b in _pieces(batches):
            c1, c2, t = (b.column(i).to_pylist() for i in range(3))
            for lo, hi in slices(t):
                out = [(x, s.tobytes()) for x, y, s in zip(c1[lo:hi], c2[lo:hi], _SHINGLER.sets(t[lo:hi]))
                       if _key(s) == (x, y)]                               # else another row with the same id
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, p) for c, p in zip(
                        zip(*out), (pa.int64(), pa.binary()))], ["c1", "s"])

    with _bloom_filters(docs.sparkSession):
        held = materialize(found.mapInArrow(sets, "c1 bigint, s binary"), "sets")
    both = pairs.join(held.select(F.col("c1").alias("a"), F.col("s").alias("sa")), "a") \
                .join(held.select(F.col("c1").alias("b"), F.col("s").alias("sb")), "b")

    def check(batches):
        import pyarrow as pa
        for x in batches:
            a, b = x.column(0).to_numpy(), x.column(1).to_numpy()
            ok = [linked(np.frombuffer(p.as_buffer(), "u8"), np.frombuffer(q.as_buffer(), "u8"))
                  for p, q in zip(x.column(2), x.column(3))]
            ok = np.array(ok, bool)
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], ["a", "b"])

    return both.select("a", "b", "sa", "sb").mapInArrow(check, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node of each component of ``a, b``; nodes without an edge are left out.

    Every round a node takes the smallest label around it and then that label's label, so that
    chains shorten by half; rounds are stored, and it ends when no label changes.
    """
    e = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
        "node", F.least("node", "b").alias("label")), "labels")
    while True:
        around = e.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"))
        step = labels.join(around, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        step = materialize(step, "label-step")
        up = step.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = materialize(step.join(up, "label", "left").select(
            "node", "old", F.least("label", "up").alias("label")), "labels")
        labels = new.select("node", "label")
        if not new.where("label <> old").limit(1).count():
            return labels


def _tokens(sets: DataFrame, hot: np.ndarray) -> DataFrame:
    """``token, c1, n, u, before, sketch`` of the prefixes; u: most tokens that a set linked by this token may have.

    If a token is the first that two sets of n and m tokens share, all that they share lies at or
    behind it: with r tokens left from there, m is at most 7 r / 3 - n.  ``before``, of a late token: the
    late ones in front of it, the nearest ``BEFORE``; ``sketch``, of a late token: its set's, in longs (empty if
    ``sets`` have none).
    """
    sketched = "sketch" in sets.columns
    late = sets.sparkSession.sparkContext.broadcast(hot.view("i8").copy())

    def run(batches):
        import pyarrow as pa
        for b in batches:
            c1, n = b.column(0).to_numpy(), b.column(1).to_numpy()
            parts = [np.frombuffer(p.as_buffer(), "i8") for p in b.column(2)]
            step = 500
            for lo in range(0, len(parts), step):
                some = parts[lo:lo + step]
                size = [len(p) for p in some]
                each = np.repeat(n[lo:lo + step], size)
                place = np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size)
                most = np.minimum((NUM + DEN) * (each - place) // NUM - each, DEN * each // NUM)
                token = np.concatenate(some)
                # late ones are the last of a prefix
                is_late = np.isin(token, late.value)
                n_late = np.add.reduceat(is_late.astype("i8"), np.cumsum(size) - size)
                front = np.where(is_late, np.minimum(place - np.repeat(size - n_late, size), BEFORE), 0)
                ends = np.cumsum(front)
                at = np.repeat(np.arange(len(token)) - ends, front) + np.arange(ends[-1])
                before = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype("i4")), pa.array(token[at]))
                own, longs = np.empty(0, "i8"), 0
                if sketched:
                    whole = np.frombuffer(b"".join(b.column(3)[lo:lo + step].to_pylist()), "i8").reshape(len(some), SKETCH)
                    own, longs = np.repeat(whole, n_late, axis=0).reshape(-1), SKETCH
                ends = np.concatenate([[0], np.cumsum(is_late * longs)]).astype("i4")
                yield pa.RecordBatch.from_arrays([
                    pa.array(token), pa.array(np.repeat(c1[lo:lo + step], size)), pa.array(each.astype("i4")),
                    pa.array(most.astype("i4")), before, pa.ListArray.from_arrays(pa.array(ends), pa.array(own))],
                    ["token", "c1", "n", "u", "before", "sketch"])

    return sets.where("prefix is not null").select("c1", "n", "prefix", *["sketch"] * sketched).mapInArrow(
        run, "token bigint, c1 bigint, n int, u int, before array<bigint>, sketch array<bigint>")


def _sketches_fit(sketch: str, every: str, some: str, n: Column, m: Column) -> Column:
    """Whether a set of ``n`` tokens may be linked with one of at most ``m``, by sketches; without them, it may.

    ``every``, ``some``: bits that all and that any of the other sets' sketches have; where these agree, so do
    all the sets.  Linked sets share 3/7 of all their tokens at least, so they differ in 1/7 at most.
    """
    def bits(k: int) -> Column:
        a, x, y = (F.get(c, F.lit(k)) for c in (sketch, every, some))
        return F.bit_count(a.bitwiseXOR(x).bitwiseAND(F.bitwise_not(x.bitwiseXOR(y))))
    apart = sum((bits(k) for k in range(1, SKETCH)), bits(0))
    return (NUM + DEN) * F.coalesce(apart, F.lit(0)) <= (DEN - NUM) * (n + m)


def _least(n: str) -> Column:
    """Fewest tokens that a set linked with one of ``n`` tokens has."""
    return F.ceil(F.col(n) * NUM / DEN).cast("int")


def _band(n: Column) -> Column:
    """Sizes in bands, each a third wider than the one before."""
    return F.floor(F.log(n) / float(np.log(DEN / NUM))).cast("int")


def open_groups(sets: DataFrame, groups: DataFrame, hot: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """The groups that classes of other groups open, and the labelled tokens of all classes.

    The first: ``token, band, q, q_label, q_n, q_u, q_before, q_sketch, g, g_members, reps``; ``reps`` are members of ``g`` drawn by token.
    ``sets``: ``c1, n, prefix`` and ``sketch`` if made; ``groups``: ``node, label`` (a class not in it is a group of its
    own).  Only tokens of two groups at least go on.  The matrix holds, by token, group and band of
    sizes, the range of the members' sizes and the most that one of them can reach (``_tokens``).
    The smaller group's classes query the larger group, so a hot group is never paired with itself
    and asks nothing; a query meets only the bands that its token's place lets it reach.  What two
    linked sets share first meets every bound here, so no link is lost.  A row of one member is left out
    if the query shares a token with it before (``before``): it was met there; at a late token any row is, if the
    query's sketch is too far from those of all its members.
    """
    tokens = _tokens(sets, hot)
    # counted within tasks first: a token of many classes is one row per task
    several = tokens.groupBy("token").agg(F.min("c1").alias("lo"), F.max("c1").alias("hi")).where("lo <> hi")
    several = materialize(several.select("token", F.lit(1).alias("wanted")), "several").where("wanted = 1")
    with _bloom_filters(sets.sparkSession):
        shared = materialize(tokens.join(several, "token").select("token", "c1", "n", "u", "before", "sketch").distinct(), "shared-tokens")
    size = groups.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
    g = materialize(groups.join(size, "label").select(F.col("node").alias("c1"), "label", "members"), "group-members")
    rows = materialize(shared.join(g, "c1", "left").select(
        "token", "c1", "n", "u", "before", "sketch", F.coalesce("label", "c1").alias("label"),
        F.coalesce("members", F.lit(1)).alias("members")), "labelled-tokens")
    late = F.max(F.size("sketch")) > 0
    bits = [F.get("sketch", F.lit(k)) for k in range(SKETCH)]
    matrix = materialize(rows.groupBy("token", _band(F.col("n")).alias("band"), F.col("label").alias("g")).agg(
        F.first("members").alias("g_members"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("u").alias("up"),
        F.when(F.count(F.lit(1)) == 1, F.first("before")).otherwise(F.array().cast("array<bigint>")).alias("g_before"),
        F.when(late, F.array(*map(F.bit_and, bits))).alias("g_every"), F.when(late, F.array(*map(F.bit_or, bits))).alias("g_some"),
        F.array(*[F.min(F.struct(F.xxhash64("token", "c1", F.lit(k)).alias("h"), "c1"))["c1"] for k in range(ROUNDS)]).alias("reps")),
        "token-group-matrix")
    met = matrix.groupBy("token").agg(F.min("g").alias("x"), F.max("g").alias("y")).where("x <> y").select("token")
    query = rows.join(met, "token", "left_semi").select(
        "token", F.col("c1").alias("q"), F.col("label").alias("q_label"), F.col("members").alias("q_members"),
        F.col("n").alias("q_n"), F.col("u").alias("q_u"), F.col("before").alias("q_before"), F.col("sketch").alias("q_sketch"),
        F.explode(F.sequence(_band(_least("n")), _band(F.col("u")))).alias("band"))
    smaller = (F.col("q_members") < F.col("g_members")) | (
        (F.col("q_members") == F.col("g_members")) & (F.col("q_label") < F.col("g")))
    opened = query.join(matrix, ["token", "band"]).where(
        smaller & (F.col("lo") <= F.col("q_u")) & (F.col("hi") >= _least("q_n"))
        & (F.col("q_n") <= F.col("up")) & (F.col("q_n") >= _least("lo")) & ~F.arrays_overlap("q_before", "g_before")
        & _sketches_fit("q_sketch", "g_every", "g_some", F.col("q_n"), F.least("hi", "q_u"))).select(
            "token", "band", "q", "q_label", "q_n", "q_u", "q_before", "q_sketch", "g", "g_members", "reps")
    return materialize(opened, "opened-groups"), rows


def representatives(opened: DataFrame, k: int) -> DataFrame:
    """``a, b`` (a > b): classes with the k-th representative of each group they open, one by token.

    A group of one class is done with it.
    """
    rep = F.col("reps")[k]
    return opened.select(F.greatest("q", rep).alias("a"), F.least("q", rep).alias("b")).distinct()


def still_open(opened: DataFrame, groups: DataFrame) -> DataFrame:
    """What is left of ``opened`` once ``groups`` are linked: groups of several classes that the query has not joined."""
    x = groups.select(F.col("node").alias("q_label"), F.col("label").alias("x"))
    y = groups.select(F.col("node").alias("g"), F.col("label").alias("y"))
    left = opened.where("g_members > 1").join(x, "q_label", "left").join(y, "g", "left").where(
        F.coalesce("x", "q_label") != F.coalesce("y", "g"))
    return left.select(*opened.columns)


def group_members(opened: DataFrame, rows: DataFrame) -> DataFrame:
    """``a, b`` (a > b): classes with the members of the groups they open, within the bounds of the
    query's token and the member's own; at the first late token that both hold, not at the next ones."""
    member = rows.select("token", _band(F.col("n")).alias("band"), F.col("label").alias("g"), F.col("c1").alias("s"),
                         F.col("n").alias("s_n"), F.col("u").alias("s_u"), F.col("before").alias("s_before"), F.col("sketch").alias("s_sketch"))
    pairs = opened.join(member, ["token", "band", "g"]).where(
        F.col("s_n").between(_least("q_n"), F.col("q_u")) & F.col("q_n").between(_least("s_n"), F.col("s_u"))
        & ~F.arrays_overlap("q_before", "s_before") & _sketches_fit("q_sketch", "s_sketch", "s_sketch", F.col("q_n"), F.col("s_n")))
    return pairs.select(F.greatest("q", "s").alias("a"), F.least("q", "s").alias("b")).distinct()


def prefixes_reach(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` whose prefixes share enough tokens for a link.

    Tokens in both sets but not in both prefixes lie behind the end of one of the prefixes, so the
    overlap is at most what the prefixes share and the longer rest.
    """
    need = materialize(pairs.select(F.explode(F.array("a", "b")).alias("c1")).distinct().select(
        "c1", F.lit(1).alias("wanted")), "wanted-prefixes").where("wanted = 1")
    with _bloom_filters(sets.sparkSession):
        held = materialize(sets.where("prefix is not null").join(need, "c1").groupBy("c1").agg(
            F.first("n").alias("n"), F.first("prefix").alias("p")), "prefixes")
    both = pairs.join(held.select(F.col("c1").alias("a"), F.col("n").alias("na"), F.col("p").alias("pa")), "a") \
                .join(held.select(F.col("c1").alias("b"), F.col("n").alias("nb"), F.col("p").alias("pb")), "b")

    def check(batches):
        import pyarrow as pa
        for x in batches:
            a, b, na, nb = (x.column(i).to_numpy() for i in range(4))
            shared = np.array([len(np.intersect1d(np.frombuffer(p.as_buffer(), "u8"), np.frombuffer(q.as_buffer(), "u8"),
                                                  assume_unique=True)) for p, q in zip(x.column(4), x.column(5))], "i8")
            rest = np.maximum(-(-NUM * na // DEN), -(-NUM * nb // DEN)) - 1
            ok = (NUM + DEN) * (shared + rest) >= NUM * (na + nb)
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], ["a", "b"])

    return both.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(check, "a bigint, b bigint")


def _components(docs: DataFrame) -> DataFrame:
    """``doc_id, th, n, label, component_id`` of every row; label: one number per component, null for empty sets."""
    n_docs = docs.count()
    hot = hot_tokens(docs, max(HOT_LEAST, round(n_docs * HOT_SHARE)))
    sets = materialize(shingle_sets(docs, hot), "shingle-sets")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th"))   # null only if all are
    mins = [f"m{k}" for k in range(HASHES)]
    classes = materialize(sets.where("n > 0").groupBy("c1", "c2", "n").agg(least.alias("r"), *[F.min(m).alias(m) for m in mins])
                          .select("c1", "c2", "n", F.col("r.doc_id").alias("doc"), F.col("r.th").alias("th"), *mins), "classes")
    first = materialize(verify(materialize(bucket_pairs(classes), "bucket-pairs"), classes, docs), "links")
    groups = components(first)

    def links(pairs: DataFrame) -> DataFrame:
        near = materialize(prefixes_reach(pairs, sets), "candidates")
        return materialize(verify(near, classes, docs), "links")

    def merged(groups: DataFrame, more: DataFrame) -> DataFrame:
        return components(groups.select(F.col("node").alias("a"), F.col("label").alias("b")).where("a <> b").union(more))

    # members drawn by token first: most of what belongs to a group joins it by one of them
    opened, rows = open_groups(sets, groups, hot)
    asked = None
    for k in range(ROUNDS):
        pairs = representatives(opened, k)
        pairs = materialize(pairs if asked is None else pairs.join(asked, ["a", "b"], "left_anti"), "representatives")
        groups = merged(groups, links(pairs))
        opened = materialize(still_open(opened, groups), "opened-groups")
        asked = pairs if asked is None else asked.union(pairs)
    rest = group_members(opened, rows).join(asked, ["a", "b"], "left_anti")
    labels = merged(groups, links(materialize(rest, "member-pairs")))
    of_class = classes.join(labels, classes["c1"] == labels["node"], "left").select(
        "c1", "c2", "doc", F.coalesce("label", "c1").alias("label"))
    smallest = of_class.groupBy("label").agg(F.min("doc").alias("component_id"))
    named = materialize(of_class.join(smallest, "label").select("c1", "c2", "label", "component_id"), "class-components")
    s = sets.select("doc_id", "th", "n", "c1", "c2")
    # equal sets may be a third of all rows: sorted by key, where Spark splits the hot one
    return s.join(named.hint("merge"), ["c1", "c2"], "left").select(
        "doc_id", "th", "n", F.when(F.col("n") > 0, F.col("label")).alias("label"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; the component's smallest id.

    Null and empty texts have no shingles and are linked with nothing: their component is their own
    id.  Null ids take part and never give a component its id unless all of its ids are null.  Rows
    that repeat an id are rows of their own; equal texts are always linked.  An empty table gives no rows.
    """
    return _components(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_per_component(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id, with the columns of ``docs``.

    Texts without words are components of their own and all stay.  If different texts of a component
    share its smallest id, one of them stays.  Rows equal in id and text stay or go together (exact
    dedup comes first).
    """
    c = materialize(_components(docs), "row-components")
    kept = c.where("n > 0 and doc_id <=> component_id").groupBy("label", "doc_id").agg(F.min("th").alias("th"))
    keys = kept.select("doc_id", "th").union(c.where("n = 0").select("doc_id", "th").distinct())
    keys = keys.select(_id_key("doc_id").alias("_key"), "th").distinct()
    cols = [F.col(f"`{x}`") for x in docs.columns]
    d = docs.select(F.struct(*cols).alias("_row"), _id_key("doc_id").alias("_key"), _text_hash().alias("th"))
    return d.join(keys, ["_key", "th"], "left_semi").select("_row.*")
