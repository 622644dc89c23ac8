"""Merkle manifest of a table, and proofs by descent of its content-addressed graph.

The leaves of a group (a language) stand in the order of their ids; every ``ARITY`` neighbours become
one node, level by level, until one is left, the group's subroot; the subroots in turn become the
root.  What is stored is *digest to children*: a record holds, under the digest of its top, the nodes
of ``SEGMENT`` levels below it.  Equal contents share one record, wherever they stand.

A proof is found from the root down.  A request starts with the root's digest; its rank, read in
digits of base ``ARITY ** SEGMENT``, says at each record which child to follow; the children that are
not followed are collected, and the segments of the path are put in reverse at the end, leaf first.
Requests that share their leading digits descend together, so the root's record is opened once and
not once per leaf, and only one row per ``ARITY ** SEGMENT`` leaves is ever joined.

Ranks come from a range-partitioned, sorted table (position in the partition plus the rows before
it), so no group is in one task, however large its share of the rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

ARITY = 2
#: levels of a record: 256 leaves under one digest
SEGMENT = 8
#: a row whose id's crc32 this divides is tampered with in the report
TAMPER = 7

_LEVELS = "array<array<binary>>"
_STEP = "struct<left:string,right:string>"


# leaves --------------------------------------------------------------------------------------------

def framed(c: Column) -> Column:
    """A value as hashed: ``-`` if null, else its length in UTF-8 bytes, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(n_chars: Column) -> Column:
    """The 32 bytes of a row's leaf, with ``n_chars`` as given."""
    parts = [framed(F.col(c)) for c in ("doc_id", "source", "lang")]
    return F.unhex(F.sha2(F.concat(*parts, framed(n_chars), framed(F.col("text"))), 256))


def leaves(docs: DataFrame, *, tamper: int = TAMPER) -> DataFrame:
    """``doc_id, lang, leaf, other``; ``other``: the leaf of a row whose ``n_chars`` was changed.

    ``other`` is null where nothing changes: an id that is not chosen (a null id never is), or a null
    ``n_chars``.
    """
    n = F.col("n_chars").cast("bigint")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % tamper == 0
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        leaf_digest(n).alias("leaf"),
        F.when(chosen & n.isNotNull(), leaf_digest(F.try_add(n, F.lit(1)))).alias("other"))


# ranks ---------------------------------------------------------------------------------------------

def ranked(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``rank`` (from 0, within ``group``, by ``order``, nulls first) and ``n``, the group's rows.

    Rows that are equal in all of ``order`` are told apart by where they were read, so a value that
    repeats is split like any other.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "_read")]
    s = materialize(df.withColumn("_read", F.monotonically_increasing_id()), f"{name}-read")
    s = materialize(s.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("_at", F.monotonically_increasing_id()), f"{name}-sorted")
    part = F.shiftright("_at", 33)                       # the partition; the bits below count its rows
    runs = s.groupBy(F.col(group).alias("_g"), part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    of_group = Window.partitionBy("_g")                  # a row per partition that holds the group
    runs = runs.select("*", F.sum("_rows").over(of_group).alias("n"), (
        F.sum("_rows").over(of_group.orderBy("_part")) - F.col("_rows")).alias("_before"))
    j = s.withColumn("_p", part).join(runs, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_p") == F.col("_part")))
    return j.select(*df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("rank"), "n")


def height(n: int, arity: int) -> int:
    """Levels above ``n`` nodes."""
    h, reach = 0, 1
    while reach < n:
        h, reach = h + 1, reach * arity
    return h


# building ------------------------------------------------------------------------------------------

def _few(batches, rows: int = 64):
    """Batches of few records: a record has hundreds of nodes."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def parent(run: list[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in run).encode()).digest()


def raise_levels(nodes: list[bytes], ups: int, arity: int) -> list[list[bytes]]:
    """``nodes`` and the levels above them; the last one has the top alone."""
    levels = [nodes]
    for _ in range(ups):
        below = levels[-1]
        levels.append([parent(below[i:i + arity]) for i in range(0, len(below), arity)])
    return levels


def _fold(nodes: DataFrame, item: str, arity: int, segment: int) -> DataFrame:
    """Nodes ``grp, n, rank, digest, item`` -> one row per record: ``grp, n, block, digest, levels, items``."""
    width = arity ** segment
    blocks = nodes.groupBy("grp", "n", F.floor(F.col("rank") / width).cast("bigint").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "digest", "item"))).alias("m"))      # at most ``width``
    flat = blocks.select("grp", "n", "block", F.col("m.digest").alias("nodes"), F.col("m.item").alias("items"))

    def run(batches):
        import pyarrow as pa
        for b in _few(batches):
            tops, stored = [], []
            for n, nodes_ in zip(b.column(1).to_pylist(), b.column(3).to_pylist()):
                levels = raise_levels(nodes_, min(segment, height(n, arity)), arity)
                tops.append(levels[-1][0])
                stored.append(levels[:-1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(tops, pa.binary()), pa.array(stored, pa.list_(pa.list_(pa.binary()))), b.column(4)],
                ["grp", "n", "block", "digest", "levels", "items"])
    return flat.mapInArrow(run, f"grp string, n bigint, block bigint, digest binary, levels {_LEVELS}, items array<{item}>")


class Forest:
    """One tree per group: ``blocks`` (the lowest records with their items), ``records``, ``roots``."""

    def __init__(self, nodes: DataFrame, item: str, name: str, *, arity: int = ARITY, segment: int = SEGMENT):
        width = arity ** segment
        self.arity, self.segment = arity, segment
        self.blocks = materialize(_fold(nodes, item, arity, segment), f"{name}-0")
        most = self.blocks.agg(F.max("n")).first()[0] or 0           # one number: how many rounds there are
        self.rounds = max(1, -(-height(most, arity) // segment))
        done, stored, below = [], [self.blocks.select("digest", "levels")], self.blocks
        for r in range(1, self.rounds):
            up = below.select("grp", F.ceil(F.col("n") / width).cast("bigint").alias("n"), F.col("block").alias("rank"),
                              "digest", F.lit(None).cast("string").alias("item"))
            done.append(up.where("n = 1"))
            below = materialize(_fold(up.where("n > 1"), "string", arity, segment), f"{name}-{r}")
            stored.append(below.select("digest", "levels"))
        done.append(below.select("grp", "n", "block", "digest"))
        tops = done[0].select("grp", "digest")
        for d in done[1:]:
            tops = tops.unionByName(d.select("grp", "digest"))
        sizes = self.blocks.where("block = 0").select(F.col("grp").alias("_g"), "n")
        #: ``grp, digest, n`` of every group
        self.roots = tops.join(sizes, F.col("grp").eqNullSafe(F.col("_g"))).drop("_g")
        records = stored[0]
        for s in stored[1:]:
            records = records.unionByName(s)
        #: digest to children, each digest once
        self.records = materialize(records.where(F.size("levels") > 0).groupBy("digest").agg(
            F.first("levels").alias("levels")), f"{name}-records")

    def level(self, n: Column) -> Column:
        """Round of the record that holds the top of a tree of ``n`` leaves."""
        width = F.lit(float(self.arity ** self.segment))
        out = F.lit(0)
        for r in range(1, self.rounds):
            out = F.when(n > F.pow(width, F.lit(r)), F.lit(r)).otherwise(out)
        return out.cast("int")

    def descend(self, requests: DataFrame) -> DataFrame:
        """From rows ``grp, n, digest, path`` of whole trees to the digests of their lowest records.

        Returns ``block`` as well; ``path`` has the children passed by, those next to the leaf first.
        Other columns are carried.
        """
        carried = [c for c in requests.columns if c not in ("digest", "path")]
        at = requests.withColumn("block", F.lit(0).cast("bigint"))
        if self.rounds == 1:
            return at
        at = materialize(at.withColumn("_level", self.level(F.col("n"))), "merkle-requests")
        kinds = ", ".join(f"`{c}` {at.schema[c].dataType.simpleString()}" for c in carried)
        reached = None
        for r in range(self.rounds - 1, -1, -1):
            here = at.where(F.col("_level") == r).select(*carried, "block", "digest", "path")
            here = here if reached is None else here.unionByName(reached)
            if r == 0:
                return here
            reached = here.join(self.records, "digest").select(*carried, "block", "path", "levels").mapInArrow(
                _steps(len(carried), self.arity, self.segment), f"{kinds}, block bigint, digest binary, path array<{_STEP}>")

    def open(self, requests: DataFrame) -> DataFrame:
        """The lowest records that requests reached, with their ``items`` and ``levels``."""
        items = self.blocks.select(F.col("grp").alias("_g"), F.col("block").alias("_b"), "items")
        j = requests.join(items, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b"))).drop("_g", "_b")
        return j.join(self.records, "digest", "left")


def passed_by(levels: list[list[bytes]], digit: int, arity: int) -> list[tuple[str, str]]:
    """Children not followed from a record's top to its node ``digit``, lowest first: (left, right) in hex."""
    path = []
    for nodes in levels:
        lo = digit - digit % arity
        path.append(("".join(d.hex() for d in nodes[lo:digit]), "".join(d.hex() for d in nodes[digit + 1:lo + arity])))
        digit //= arity
    return path


def _steps(carried: int, arity: int, segment: int):
    """Rows with a record -> one row per child of its lowest level, path extended."""
    width = arity ** segment

    def run(batches):
        import pyarrow as pa
        step = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        for b in _few(batches):
            row, block, digest, path = [], [], [], []
            for i, (k, above, levels) in enumerate(zip(*(b.column(carried + j).to_pylist() for j in range(3)))):
                for d, child in enumerate(levels[0]):
                    row.append(i)
                    block.append(k * width + d)
                    digest.append(child)
                    path.append([{"left": x, "right": y} for x, y in passed_by(levels, d, arity)] + above)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(j).take(at) for j in range(carried)], pa.array(block, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(path, step)],
                [*[b.schema.field(j).name for j in range(carried)], "block", "digest", "path"])
    return run


# the manifest of a table ---------------------------------------------------------------------------

class Manifest:
    """Trees of the documents by language, and the tree of their subroots."""

    def __init__(self, docs: DataFrame, *, arity: int = ARITY, segment: int = SEGMENT, tamper: int = TAMPER):
        rows = ranked(leaves(docs, tamper=tamper), "lang", ["doc_id", "leaf"], "merkle")
        self.docs = Forest(rows.select(F.col("lang").alias("grp"), "n", "rank", F.col("leaf").alias("digest"),
                                       F.struct("doc_id", "other").alias("item")),
                           "struct<doc_id:bigint,other:binary>", "merkle-docs", arity=arity, segment=segment)
        subroots = ranked(self.docs.roots.select(F.lit("").alias("top"), F.col("grp").alias("lang"), "digest",
                                                 F.col("n").alias("size")), "top", ["lang"], "merkle-lang")
        self.langs = Forest(subroots.select(F.col("top").alias("grp"), "n", "rank", "digest",
                                            F.struct("lang", F.col("size").alias("n")).alias("item")),
                            "struct<lang:string,n:bigint>", "merkle-top", arity=arity, segment=segment)

    @property
    def root(self) -> DataFrame:
        """The one row of the root (``grp, digest, n``); none for an empty table."""
        return self.langs.roots

    @property
    def records(self) -> DataFrame:
        """Every record: ``digest, levels`` (its nodes from the lowest level up, without the top)."""
        return self.docs.records.unionByName(self.langs.records)

    def proofs(self) -> DataFrame:
        """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row."""
        arity = self.docs.arity
        start = self.langs.roots.select("grp", "n", "digest", F.array().cast(f"array<{_STEP}>").alias("path"),
                                        F.col("digest").alias("root"))
        opened = self.langs.open(self.langs.descend(start))

        def languages(batches):
            import pyarrow as pa
            step = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
            for b in _few(batches):
                out = [[], [], [], [], []]
                for lone, items, levels, above, root in zip(*(b.column(j).to_pylist() for j in range(5))):
                    for d, item in enumerate(items):
                        path = [{"left": x, "right": y} for x, y in passed_by(levels or [], d, arity)] + above
                        for column, v in zip(out, (item["lang"], item["n"], levels[0][d] if levels else lone, path, root)):
                            column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(out, (pa.string(), pa.int64(), pa.binary(), step, pa.binary()))],
                    ["grp", "n", "digest", "path", "root"])
        subroots = opened.select("digest", "items", "levels", "path", "root").mapInArrow(
            languages, f"grp string, n bigint, digest binary, path array<{_STEP}>, root binary")
        found = self.docs.open(self.docs.descend(subroots.withColumn("subroot", F.col("digest"))))
        return found.select("digest", "items", "levels", "path", "root", "subroot").mapInArrow(
            lambda it: _prove(it, arity), "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
            "folded_root string, verified boolean")


def _prove(batches, arity: int):
    """Lowest records with their requests -> the proof and the root folded from each leaf."""
    import pyarrow as pa

    sha = hashlib.sha256
    for b in _few(batches):
        cols = [[] for _ in range(7)]
        for lone, items, levels, above, root, subroot in zip(*(b.column(j).to_pylist() for j in range(6))):
            upper = [(s["left"], s["right"]) for s in above]
            tail = "".join(x + y for x, y in upper)
            root, subroot, levels = root.hex(), subroot.hex(), levels or []
            for d, item in enumerate(items):
                leaf = (levels[0][d] if levels else lone).hex()
                path = passed_by(levels, d, arity)
                proof = sha(("".join(x + y for x, y in path) + tail).encode()).hexdigest()
                top = leaf if item["other"] is None else item["other"].hex()
                for x, y in path:
                    top = sha((x + top + y).encode()).hexdigest()
                for x, y in upper:
                    top = sha((x + top + y).encode()).hexdigest()
                for column, v in zip(cols, (item["doc_id"], leaf, subroot, root, proof, top, top == root)):
                    column.append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), *[pa.array(c, pa.string()) for c in cols[1:6]], pa.array(cols[6], pa.bool_())],
            ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def manifest(docs: DataFrame, **kw) -> DataFrame:
    """Every row of ``docs`` with its leaf, its proof and the root folded from its tampered leaf.

    A null in any column is hashed as ``-``; a null id comes first and is never tampered with; a null
    language is a group of its own and comes first; rows with one id are ordered by their leaf, and
    rows that repeat in full have a place and a proof each.  A lone leaf is its subroot, a lone
    subroot the root.  An empty table gives no rows.  Other columns are not read.
    """
    return Manifest(docs, **kw).proofs()
